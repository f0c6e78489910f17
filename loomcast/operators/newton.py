"""Fits that need several rounds, for all series at once.

One round is one pass over the folded steps: every task sums the gradient and the
curvature of its series at their present coefficients, and a small solve per series
gives the next ones. What is held per series is ``p * p`` numbers. The steps are written
once, bucketed by series, so a round moves coefficients and no steps. Series that settle
leave; the driver sees two counts a round.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loomcast.operators.keys import null_safe_join
from loomcast.operators.moments import with_solution
from loomcast.session import shared_folder

UNSETTLED = "fit did not settle"
SINGULAR_DESIGN = "singular design"

_MATRIX = "array<array<double>>"


@dataclass(frozen=True)
class Point:
    """What a form says of one step, of which ``n_obs`` targets sum to ``sum_y``.

    ``fitted`` is the value per target and ``slopes`` are its derivatives, up to a
    factor that ``curvature`` makes good: the gradient of the loss is
    ``-(sum_y - n_obs * fitted) * slopes`` and its curvature
    ``n_obs * curvature * slopes * slopes``. ``loss`` is what a round must not raise,
    and ``scale`` the size against which the targets' remainder is small.
    """

    fitted: Column
    slopes: list[Column]
    curvature: Column
    loss: Column
    scale: Column


Form = Callable[[Column], Point]


def newton_fits(
    steps: DataFrame,
    keys: list[str],
    start: DataFrame,
    form: Form,
    rounds: int = 100,
    tolerance: float = 1e-9,
) -> DataFrame:
    """``start`` with ``solution`` moved to where the loss is least, and ``error``.

    ``steps`` hold ``n_obs``, ``sum_y`` and what ``form`` reads; ``start`` is one row a
    series with the first ``solution``, whose length is that of the form's slopes.
    Series of ``steps`` that ``start`` lacks take no part. A series has settled when no
    component of its gradient exceeds ``tolerance`` times the sum of ``scale`` times the
    slopes. One that has not after ``rounds`` rounds, or has no finite loss, is
    ``fit did not settle``; one whose curvature is not of full rank where it settles is
    a ``singular design``. Both keep their row with an error. A column that is zero on
    all steps keeps its first coefficient. ``rounds`` bounds the jobs, not the data.
    """
    spark = steps.sparkSession
    own = start.columns
    folder = shared_folder(spark, "newton")
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    name = f"newton_steps_{uuid.uuid4().hex}"
    # One file a bucket. The entry goes afterwards; no result reads the steps again.
    steps.repartition(buckets, *keys).write.bucketBy(buckets, *keys).saveAsTable(
        name, format="parquet", path=f"{folder}/steps"
    )
    nothing = F.lit(None)
    state = start.withColumns(
        {
            "candidate": F.col("solution"),
            "gram": nothing.cast(_MATRIX),
            "rhs": nothing.cast("array<double>"),
            "loss": nothing.cast("double"),
            "gradient": nothing.cast("double"),
            "damping": F.lit(1e-3),
            "settled": F.lit(False),
        }
    ).checkpoint()
    settled = []
    try:
        placed = spark.read.table(name)
        for _ in range(rounds):
            found = _evaluated(placed, keys, state, form)
            state = _moved(state, found, keys, tolerance).checkpoint()
            left, total = state.agg(F.count_if(~F.col("settled")), F.count("*")).first()
            if left < total:
                settled.append(state.where("settled"))
            state = state.where("not settled")
            if not left:
                break
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {name}")
    lost = state.withColumn("error", F.lit(UNSETTLED)).select(*own, "error")
    if not settled:
        return lost
    # The undamped curvature tells whether the coefficients are the only ones.
    done = reduce(DataFrame.unionByName, settled).withColumn("_found", F.col("solution"))
    error = F.when(F.col("solution").isNull(), SINGULAR_DESIGN)
    done = with_solution(done.drop("solution")).withColumn("error", error)
    done = done.drop("solution").withColumnRenamed("_found", "solution")
    return lost.unionByName(done.select(*own, "error"))


def _evaluated(steps: DataFrame, keys: list[str], state: DataFrame, form: Form) -> DataFrame:
    """Gradient, curvature and loss of every series at its candidate."""
    at = null_safe_join(steps, state.select(*keys, "candidate"), keys)
    point = form(F.col("candidate"))
    size = range(len(point.slopes))
    n = F.col("n_obs").cast("double")
    y = F.coalesce(F.col("sum_y"), F.lit(0.0))
    at = at.withColumns({f"_x{i}": slope for i, slope in enumerate(point.slopes)})
    at = at.withColumns(
        {
            "_rest": y - n * point.fitted,
            "_scale": point.scale,
            "_w": n * point.curvature,
            "_loss": point.loss,
        }
    )
    x = [F.col(f"_x{i}") for i in size]
    sums = at.where("n_obs > 0").groupBy(*keys).agg(
        *[
            F.sum(F.col("_w") * x[i] * x[j]).alias(f"_g{i}_{j}")
            for i in size
            for j in range(i, len(x))
        ],
        F.array(*[F.sum(F.col("_rest") * x[i]) for i in size]).alias("_new_rhs"),
        F.array(*[F.sum(F.col("_scale") * F.abs(x[i])) for i in size]).alias("_sizes"),
        F.sum("_loss").alias("_new_loss"),
    )
    matrix = F.array(*[F.array(*[F.col(f"_g{min(i, j)}_{max(i, j)}") for j in size]) for i in size])
    share = F.zip_with(
        "_new_rhs", "_sizes", lambda g, s: F.coalesce(F.try_divide(F.abs(g), s), F.lit(0.0))
    )
    return sums.select(
        *keys, matrix.alias("_new_gram"), "_new_rhs", "_new_loss",
        F.array_max(share).alias("_new_gradient"),
    )


def _moved(state: DataFrame, found: DataFrame, keys: list[str], tolerance: float) -> DataFrame:
    """Accepts candidates that do not raise the loss and sets the next ones.

    The damping falls with every success and grows with every failure, so a series
    goes from short safe steps to full ones on its own.
    """
    columns = state.columns
    joined = null_safe_join(state, found, keys, how="left")
    slack = F.abs("loss") * F.lit(1e-12)
    fine = F.col("_new_loss").isNotNull() & ~F.isnan("_new_loss")
    better = fine & (F.col("loss").isNull() | (F.col("_new_loss") <= F.col("loss") + slack))
    better = F.coalesce(better, F.lit(False))
    kept = {
        "solution": F.when(better, F.col("candidate")).otherwise(F.col("solution")),
        "damping": F.when(better, F.greatest(F.col("damping") / 10, F.lit(1e-12))).otherwise(
            F.least(F.col("damping") * 10, F.lit(1e12))
        ),
    }
    for name in ("gram", "rhs", "loss", "gradient"):
        kept[name] = F.when(better, F.col(f"_new_{name}")).otherwise(F.col(name))
    joined = joined.withColumns(kept)
    joined = joined.withColumn(
        "settled", F.coalesce(F.col("gradient") <= F.lit(tolerance), F.lit(False))
    )
    plain = joined.withColumns({"_base": F.col("solution"), "_gram": F.col("gram")})
    ridge = F.transform("_gram", lambda row, i: F.col("damping") * F.get(row, i))
    moved = with_solution(plain, ridge)
    step = F.zip_with("_base", "solution", lambda base, move: base + move)
    return moved.withColumns(
        {"candidate": F.coalesce(step, F.col("_base")), "solution": F.col("_base"),
         "gram": F.col("_gram")}
    ).select(*columns)
