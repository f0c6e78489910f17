"""Least squares of all series at once: sums of products, then a small solve per series.

A design of ``p`` columns needs the matrix of their products and their products with
the target, summed over the rows of a series. These are plain aggregates: every task
sums its own rows first, and what moves is one row per series and task. The solve is
an expression over the arrays of that row, so no step leaves the JVM and none holds
more of a series than its ``p * p`` numbers.

Two designs need fewer sums than products. Hinges ``max(t - s, 0)`` follow from sums
over the stretches between the knots, and the harmonics of one season from the sums
of the first ``2 * order`` cosines and sines.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# A pivot below this share of its own square sum is taken for zero.
SINGULAR = 1e-12

_EMPTY = "array<double>"


def design_moments(
    rows: DataFrame,
    keys: list[str],
    columns: Mapping[str, Column],
    time: str | None = None,
    extra: Iterable[Column] = (),
) -> DataFrame:
    """One row per series: ``gram``, ``rhs``, ``n_obs``, ``sum_yy``, ``lost``, ``origin``.

    ``columns`` are the design's columns over a row, in order; target ``y``. Rows without
    a target take no part. ``lost`` counts, by column, the rows whose value is missing.
    Column ``time``, if named, is counted from its smallest value in the series, the
    ``origin``; the first column must then be constant 1. ``extra`` are further
    aggregates.
    """
    names = list(columns)
    x = [f"_x{i}" for i in range(len(names))]
    known = F.col("y").isNotNull()
    staged = rows.withColumns(
        {c: F.when(known, v.cast("double")) for c, v in zip(x, columns.values(), strict=True)}
    )
    sums = {
        (i, j): F.sum(F.col(x[i]) * F.col(x[j])) for i in range(len(x)) for j in range(i, len(x))
    }
    grouped = staged.groupBy(*keys).agg(
        *[total.alias(f"_g{i}_{j}") for (i, j), total in sums.items()],
        *[F.sum(F.col(c) * F.col("y")).alias(f"_b{i}") for i, c in enumerate(x)],
        *[F.count_if(known & F.col(c).isNull()).alias(f"_lost{i}") for i, c in enumerate(x)],
        F.min(x[names.index(time)] if time else F.lit(0.0)).alias("origin"),
        *_facts(),
        *extra,
    )
    gram = {pair: F.col(f"_g{pair[0]}_{pair[1]}") for pair in sums}
    rhs = [F.col(f"_b{i}") for i in range(len(x))]
    lost = F.array(*[F.col(f"_lost{i}") for i in range(len(x))])
    return _assembled(grouped, gram, rhs, names.index(time) if time else None).withColumn(
        "lost", lost
    ).drop(*[c for c in grouped.columns if c.startswith(("_g", "_b", "_lost"))])


def fourier_moments(
    rows: DataFrame,
    keys: list[str],
    t: Column,
    period: float,
    order: int,
    extra: Iterable[Column] = (),
) -> DataFrame:
    """Moments of the design 1, t, sin 1..order, cos 1..order of one season.

    The product of two harmonics is half a sum of two others, so the sums of the
    first ``2 * order`` give all of them. Same columns as ``design_moments``, without
    ``lost``; ``t`` counts in the unit of ``period``. The phase of the harmonics is
    that of ``t`` itself, whatever the origin.
    """
    known = F.col("y").isNotNull()
    staged = rows.withColumn("_t", F.when(known, t.cast("double")))
    harmonics = range(1, order + 1)
    wave = {}
    for m in range(1, 2 * order + 1):
        angle = F.lit(2 * m) * F.pi() * F.col("_t") / F.lit(float(period))
        wave |= {f"_s{m}": F.sin(angle), f"_c{m}": F.cos(angle)}
    staged = staged.withColumns(wave)
    grouped = staged.groupBy(*keys).agg(
        *[F.sum(name).alias(name) for name in wave],
        *[F.sum(F.col("_t") * F.col(f"_{f}{m}")).alias(f"_t{f}{m}") for f in "sc" for m in harmonics],
        *[F.sum(F.col("y") * F.col(f"_{f}{m}")).alias(f"_y{f}{m}") for f in "sc" for m in harmonics],
        F.sum("_t").alias("_t1"),
        F.sum(F.col("_t") * F.col("_t")).alias("_t2"),
        F.sum(F.col("_t") * F.col("y")).alias("_ty"),
        F.sum("y").alias("_y1"),
        F.min("_t").alias("origin"),
        *_facts(),
        *extra,
    )
    n = F.col("n_obs").cast("double")

    def total(kind: str, m: int) -> Column:
        if m == 0:
            return n if kind == "c" else F.lit(0.0)
        return F.col(f"_{kind}{m}") if m > 0 or kind == "c" else -F.col(f"_{kind}{-m}")

    def product(a: tuple[str, int], b: tuple[str, int]) -> Column:
        (f, i), (g, j) = a, b
        if f == g:
            sign = -1 if f == "s" else 1
            return (total("c", abs(i - j)) + sign * total("c", i + j)) / 2
        i, j = (i, j) if f == "s" else (j, i)
        return (total("s", i + j) + total("s", i - j)) / 2

    terms = [("s", m) for m in harmonics] + [("c", m) for m in harmonics]
    gram = {(0, 0): n, (0, 1): F.col("_t1"), (1, 1): F.col("_t2")}
    for i, (f, m) in enumerate(terms, 2):
        gram |= {(0, i): total(f, m), (1, i): F.col(f"_t{f}{m}")}
        gram |= {(i, j): product((f, m), other) for j, other in enumerate(terms, 2) if j >= i}
    rhs = [F.col("_y1"), F.col("_ty"), *[F.col(f"_y{f}{m}") for f, m in terms]]
    kept = [c for c in grouped.columns if not c.startswith("_")]
    return _assembled(grouped, gram, rhs, 1).select(*kept, "gram", "rhs")


def hinge_moments(
    steps: DataFrame, keys: list[str], t: Column, knots: Column, extra: Iterable[Column] = ()
) -> DataFrame:
    """Moments of the design 1, t, and one hinge ``max(t - s, 0)`` per knot ``s``.

    ``knots`` is a sorted array, the same on all rows of a series. Rows are summed by
    the stretch between knots that they lie in; a hinge's products are sums over the
    stretches after its knot, so no hinge column exists. Rows without a target or a
    date take no part, but count in ``extra``. Columns: keys, ``knots``, ``gram``,
    ``rhs``, ``n_obs``, ``sum_yy`` and the extra ones.
    """
    extra = list(extra)
    known = F.col("y").isNotNull() & t.isNotNull()
    time = F.when(known, t.cast("double"))
    staged = steps.withColumns({"_t": time, "_knots": knots.cast(_EMPTY)})
    passed = F.size(F.filter("_knots", lambda s: s < F.col("_t")))
    staged = staged.withColumns(
        {"_stretch": F.when(known, passed).otherwise(0), "_y": F.when(known, F.col("y"))}
    )
    zero = F.lit(0.0)
    stretch = F.struct(
        F.col("_stretch").alias("at"),
        *[F.coalesce(F.col(c), zero).alias(c) for c in ("n", "t", "tt", "y", "ty")],
    )
    by_stretch = staged.groupBy(*keys, "_knots", "_stretch").agg(
        F.count("_t").cast("double").alias("n"),
        F.sum("_t").alias("t"),
        F.sum(F.col("_t") * F.col("_t")).alias("tt"),
        F.sum("_y").alias("y"),
        F.sum(F.col("_t") * F.col("_y")).alias("ty"),
        F.sum(F.col("_y") * F.col("_y")).alias("sum_yy"),
        *extra,
    )
    further = [c for c in by_stretch.columns if c not in {*keys, *"n t tt y ty sum_yy".split()}]
    further = [c for c in further if not c.startswith("_")]
    # At most one row per knot and one more.
    gathered = by_stretch.groupBy(*keys).agg(
        F.first("_knots").alias("knots"),
        F.collect_list(stretch).alias("_parts"),
        F.sum("n").cast("bigint").alias("n_obs"),
        F.sum("sum_yy").alias("sum_yy"),
        *[F.max(c).alias(c) for c in further],
    )

    def after(name: str) -> Column:
        """By level: the sum over all stretches, then over those after each knot."""
        return F.transform(
            F.sequence(F.lit(0), F.size("knots")),
            lambda level: F.aggregate(
                F.filter("_parts", lambda part: part["at"] >= level),
                F.lit(0.0),
                lambda so_far, part: so_far + part[name],
            ),
        )

    sums = gathered.withColumns({f"_{name}": after(name) for name in ("n", "t", "tt", "y", "ty")})
    # Every column is a * t + b on the stretches from its level on.
    line = lambda level, a, b: F.struct(
        level.cast("int").alias("level"), a.alias("a"), b.alias("b")
    )
    one, zero = F.lit(1.0), F.lit(0.0)
    hinges = F.transform("knots", lambda s, k: line(k + 1, one, -s))
    basis = F.concat(F.array(line(F.lit(0), zero, one), line(F.lit(0), one, zero)), hinges)

    def product(p: Column, q: Column) -> Column:
        level = F.greatest(p["level"], q["level"])
        return (
            p["a"] * q["a"] * F.get("_tt", level)
            + (p["a"] * q["b"] + q["a"] * p["b"]) * F.get("_t", level)
            + p["b"] * q["b"] * F.get("_n", level)
        )

    sums = sums.withColumn("_basis", basis)
    gram = F.transform("_basis", lambda p: F.transform("_basis", lambda q: product(p, q)))
    rhs = F.transform(
        "_basis", lambda p: p["a"] * F.get("_ty", p["level"]) + p["b"] * F.get("_y", p["level"])
    )
    return sums.select(
        *keys, "knots", gram.alias("gram"), rhs.alias("rhs"), "n_obs", "sum_yy", *further
    )


def even_knots(first: Column, last: Column, count: int, share: float = 0.8) -> Column:
    """``count`` whole knots, evenly spaced over the first ``share`` of the history."""
    reach = (last - first).cast("double") * F.lit(share)
    inner = F.transform(
        F.sequence(F.lit(1), F.lit(count)),
        lambda k: (first + F.floor(reach * k / F.lit(count))).cast("double"),
    )
    return F.array_sort(F.array_distinct(inner)) if count else F.array().cast(_EMPTY)


def _facts() -> list[Column]:
    return [F.count("y").alias("n_obs"), F.sum(F.col("y") * F.col("y")).alias("sum_yy")]


def _assembled(
    grouped: DataFrame, gram: dict[tuple[int, int], Column], rhs: list[Column], time: int | None
) -> DataFrame:
    """Adds ``gram`` and ``rhs``, with the time column counted from the origin."""
    gram = dict(gram)
    rhs = list(rhs)
    if time is not None:
        origin = F.col("origin")
        moved = {
            (min(time, j), max(time, j)): gram[min(time, j), max(time, j)]
            - origin * gram[min(0, j), max(0, j)]
            for j in range(len(rhs))
            if j != time
        }
        square = gram[time, time] - 2 * origin * gram[0, time] + origin * origin * gram[0, 0]
        gram |= {**moved, (time, time): square}
        rhs[time] = rhs[time] - origin * rhs[0]
    filled = lambda value: F.coalesce(value.cast("double"), F.lit(0.0))
    size = range(len(rhs))
    matrix = F.array(*[F.array(*[filled(gram[min(i, j), max(i, j)]) for j in size]) for i in size])
    return grouped.withColumns({"gram": matrix, "rhs": F.array(*[filled(b) for b in rhs])})


def with_solution(moments: DataFrame, ridge: Column | None = None) -> DataFrame:
    """Adds ``solution``, the coefficients; null where the design is singular.

    Cholesky's factor row by row, then both substitutions. A column that is zero on
    all rows gets coefficient 0. ``ridge`` is an array of penalties added to the
    diagonal.
    """
    if ridge is not None:
        penalised = F.transform(
            "gram",
            lambda row, i: F.transform(
                row, lambda g, j: F.when(i == j, g + F.get(ridge, i)).otherwise(g)
            ),
        )
        moments = moments.withColumn("gram", penalised)
    last = F.size("rhs") - 1
    factor = F.aggregate(
        F.sequence(F.lit(0), last),
        F.array().cast(f"array<{_EMPTY}>"),
        lambda lower, i: F.array_append(lower, _factor_row(F.get("gram", i), lower, i)),
    )
    forward = F.aggregate(
        F.sequence(F.lit(0), last),
        F.array().cast(_EMPTY),
        lambda z, i: F.array_append(
            z,
            F.try_divide(
                F.get("rhs", i) - _dot(z, F.slice(F.get("_lower", i), F.lit(1), i)),
                F.get(F.get("_lower", i), i),
            ),
        ),
    )
    backward = F.aggregate(
        F.sequence(last, F.lit(0), F.lit(-1)),
        F.array().cast(_EMPTY),
        lambda x, i: F.array_prepend(
            x,
            F.try_divide(
                F.get("_z", i) - _dot(x, F.transform(
                    F.slice("_lower", i + 2, last - i), lambda row: F.get(row, i)
                )),
                F.get(F.get("_lower", i), i),
            ),
        ),
    )
    solved = moments.withColumn("_lower", factor).withColumn("_z", forward)
    solved = solved.withColumn("_x", backward)
    whole = ~F.exists("_x", lambda v: v.isNull() | F.isnan(v))
    return solved.withColumn("solution", F.when(whole, F.col("_x"))).drop("_lower", "_z", "_x")


def _factor_row(gram: Column, lower: Column, i: Column) -> Column:
    own = F.get(gram, i)

    def entry(row: Column, j: Column) -> Column:
        other = F.when(j < i, F.get(lower, j)).otherwise(row)
        rest = F.get(gram, j) - _dot(row, F.slice(other, F.lit(1), j))
        pivot = F.when(own == 0, F.lit(1.0)).when(rest > SINGULAR * own, F.sqrt(F.abs(rest)))
        scaled = F.try_divide(rest, F.get(F.get(lower, j), j))
        return F.array_append(row, F.when(j < i, scaled).otherwise(pivot))

    return F.aggregate(F.sequence(F.lit(0), i), F.array().cast(_EMPTY), entry)


def _dot(a: Column, b: Column) -> Column:
    products = F.zip_with(a, b, lambda x, y: x * y)
    return F.aggregate(products, F.lit(0.0), lambda total, value: total + value)


def relative_gradient() -> Column:
    """Largest ``|gram x - rhs|`` of a solution, relative to the terms it sums."""

    def one(row: Column, i: Column) -> Column:
        size = F.abs(F.get("rhs", i)) + _dot(
            F.transform(row, F.abs), F.transform("solution", F.abs)
        )
        return F.coalesce(
            F.try_divide(F.abs(_dot(row, F.col("solution")) - F.get("rhs", i)), size), F.lit(0.0)
        )

    return F.array_max(F.transform("gram", one))
