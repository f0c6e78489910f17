"""Language identification by interpolated Kneser-Ney character models.

Kneser and Ney, "Improved Backing-off for M-gram Language Modeling" (1995), in
the interpolated form of Chen and Goodman (1999), over four-grams of code points.
Counts, continuation counts, discounts and probabilities are joins and sums over
tables of n-grams; they cover every training text and nothing of them passes through
the driver. The result holds, for every four-gram of the collection, a 64-bit hash and
its log probability in each language. Texts look their four-grams up in the arrays of
that table, sorted by hash, where its measured size allows to send it to the tasks, and
are joined with it where not. A text goes to the language with the lowest cross-entropy
per character; its margin gives a calibrated score, and texts that no model explains are
marked as rejected.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.types import ArrayType, DoubleType, LongType, StructType

from loomcast.llm.common import GOLDEN, Scratch, held_out, mix64

ORDER = 4
#: Bits of a code point; three of them fit into one integer.
BITS = 21
_UNKNOWN = 255


@dataclass(frozen=True)
class LanguageSettings:
    """``calibration_rows`` bounds the texts that fit the score's three numbers.

    The table of four-grams is sent to the tasks if it takes at most
    ``broadcast_bytes`` there; a larger one is joined by a shuffle, with equal results.
    ``accept`` is the share of calibration texts whose cross-entropy must stay below
    the rejection limit.
    """

    calibration_rows: int = 2000
    accept: float = 0.995
    broadcast_bytes: int = 96 << 20


#: 2 for letters, 1 for marks that belong to letters, 0 for the rest.
_kinds = np.full(0x110000, _UNKNOWN, dtype=np.uint8)


def _kind(char: str) -> int:
    return 2 if char.isalpha() else int(unicodedata.category(char).startswith("M"))


def encode(text: str | None) -> np.ndarray:
    """Code points of the lower-cased text, one 0 between runs of letters and at the ends.

    A text without a letter gives none.
    """
    if not text:
        return np.zeros(0, dtype=np.int64)
    points = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    kinds = _kinds[points]
    if (kinds == _UNKNOWN).any():
        for point in np.unique(points[kinds == _UNKNOWN]).tolist():
            _kinds[point] = _kind(chr(point))
        kinds = _kinds[points]
    if not (kinds == 2).any():
        return np.zeros(0, dtype=np.int64)
    found = np.where(kinds > 0, points, 0).astype(np.int64)
    padded = np.concatenate([np.zeros(1, np.int64), found, np.zeros(1, np.int64)])
    return padded[np.concatenate([[True], (padded[1:] | padded[:-1]) > 0])]


def ngrams(codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Four-grams as their first three code points in one integer, and their last."""
    if len(codes) < ORDER:
        codes = np.concatenate([np.zeros(ORDER - len(codes), np.int64), codes])
    head = codes[:-3] << 2 * BITS | codes[1:-2] << BITS | codes[2:-1]
    return head, codes[3:]


def ngram_hash(head: np.ndarray, last: np.ndarray) -> np.ndarray:
    return mix64(head.view(np.uint64) ^ (last.view(np.uint64) + np.uint64(1)) * GOLDEN).view(np.int64)


def _merge(parts: list[tuple[np.ndarray, ...]]) -> tuple[np.ndarray, ...]:
    key, head, last, n = (np.concatenate(columns) for columns in zip(*parts, strict=True))
    key, first, inverse = np.unique(key, return_index=True, return_inverse=True)
    return key, head[first], last[first], np.bincount(inverse, weights=n).astype(np.int64)


def _counted(texts: list[np.ndarray]) -> tuple[np.ndarray, ...]:
    """Hash, head, last and count of the distinct four-grams of encoded texts."""
    codes = np.concatenate([np.pad(x, (max(ORDER - len(x), 0), 0)) for x in texts])
    letters = np.unique(codes)
    if len(letters) > 1 << 16:
        span = (1 << 16) - ORDER + 1
        starts = ((x, i) for x in texts for i in range(0, max(len(x) - ORDER + 1, 1), span))
        pieces = (x[i : i + (1 << 16)] for x, i in starts)
        return _merge([_counted([x]) for x in pieces])
    # Four places among the letters fit into one integer that sorts fast.
    places = np.searchsorted(letters, codes).astype(np.uint64)
    packed = np.zeros(len(codes) - ORDER + 1, np.uint64)
    for i in range(ORDER):
        packed = packed << np.uint64(16) | places[i : len(codes) - ORDER + 1 + i]
    within = np.ones(len(packed), bool)
    ends = np.cumsum([max(len(x), ORDER) for x in texts])[:-1]
    for i in range(1, ORDER):
        within[ends - i] = False
    packed, n = np.unique(packed[within], return_counts=True)
    first, second, third, last = (
        letters[(packed >> np.uint64(16 * i) & np.uint64(0xFFFF)).astype(np.int64)]
        for i in (3, 2, 1, 0)
    )
    head = first << 2 * BITS | second << BITS | third
    return ngram_hash(head, last), head, last, n


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sums of four-grams of one partition by language and fold.

    Sums are handed on when they reach a few million n-grams, so memory does not
    grow with the number of languages; the shuffle adds them up.
    """
    totals: dict[tuple[str | None, int], tuple[np.ndarray, ...]] = {}

    def flush():
        for (lang, fold), (key, head, last, n) in totals.items():
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([lang] * len(key), pa.string()),
                    pa.array(np.full(len(key), fold, np.int32)),
                    pa.array(key), pa.array(head), pa.array(last), pa.array(n),
                ],
                names=["lang", "fold", "key", "head", "last", "n"],
            )
        totals.clear()

    fresh: dict[tuple[str | None, int], list[np.ndarray]] = {}
    held = 0

    def settle():
        for group, parts in fresh.items():
            new = _counted(parts)
            totals[group] = _merge([totals[group], new]) if group in totals else new
        fresh.clear()

    for batch in batches:
        # One text at a time becomes a Python object, however long the others are.
        for row in zip(*(batch.column(i) for i in range(3)), strict=True):
            text, lang, fold = (value.as_py() for value in row)
            codes = encode(text)
            if len(codes):
                fresh.setdefault((lang, fold), []).append(codes)
                held += len(codes)
            if held > 1 << 20:
                settle()
                held = 0
                if sum(len(x[0]) for x in totals.values()) > 2_000_000:
                    yield from flush()
    settle()
    yield from flush()


def count_ngrams(rows: DataFrame) -> DataFrame:
    """Counts of four-grams by ``lang`` and ``fold`` over ``text``, ``lang``, ``fold``."""
    sums = rows.select("text", "lang", "fold").mapInArrow(
        _count, "lang string, fold int, key long, head long, last long, n long"
    )
    return sums.groupBy("lang", "fold", "head", "last", "key").agg(F.sum("n").alias("n"))


def _tail(gram: str, order: int) -> Column:
    """The n-gram of ``order`` without its first character, or the last ``order`` of it."""
    return F.col(gram).bitwiseAND(F.lit((1 << BITS * order) - 1))


def kneser_ney(counts: DataFrame, asked: DataFrame) -> DataFrame:
    """Interpolated probabilities ``p`` of the ``asked`` four-grams in every model.

    ``counts``: ``model``, ``head``, ``last``, ``n``. ``asked``: ``model``, ``head``,
    ``last``. Lower orders count the distinct characters before an n-gram. A context
    leaves the mass that discounts free to the next lower order, an unseen context all.
    The lowest order leaves it to equal shares of all characters seen in any model and
    one for all others.
    """
    third = (_tail("head", 2) * F.lit(1 << BITS) + F.col("last")).alias("gram")
    levels = [counts.select("model", F.col("head").alias("context"), "last", "n")]
    below = counts.select("model", third)
    grams = [asked.select("model", F.col("head").alias("context"), "last"),
             asked.select("model", third).distinct()]
    for order in (3, 2, 1):
        own = below.groupBy("model", "gram").agg(F.count("*").alias("n"))
        levels.append(own)
        below = own.select("model", _tail("gram", order - 1).alias("gram"))
        if order > 1:
            shorter = _tail("gram", order - 1).alias("gram")
            grams.append(grams[-1].select("model", shorter).distinct())
    alphabet = levels[3].agg(F.count_distinct("gram") + 1).scalar()

    p = None
    for order in (1, 2, 3, 4):
        own, wanted = levels[4 - order], grams[4 - order]
        if order < 4:
            split = [F.shiftright("gram", BITS).alias("context"),
                     F.col("gram").bitwiseAND(F.lit((1 << BITS) - 1)).alias("last")]
            own = own.select("model", *split, "n")
            wanted = wanted.select("model", *split)
        once, twice = F.count_if(F.col("n") == 1), F.count_if(F.col("n") == 2)
        discounts = own.groupBy("model").agg(
            F.when((once > 0) & (twice > 0), once / (once + 2 * twice)).otherwise(0.5).alias("d")
        )
        contexts = (
            own.groupBy("model", "context")
            .agg(F.sum("n").alias("total"), F.count("*").alias("kinds"))
            .join(discounts, "model")
        )
        # One key, the context, serves the mass that is left and the share of its own.
        rated = (
            wanted.join(contexts, ["model", "context"], "left")
            .join(own, ["model", "context", "last"], "left")
            .select(
                "model", "context", "last",
                F.coalesce((F.col("n") - F.col("d")) / F.col("total"), F.lit(0.0)).alias("seen"),
                F.coalesce(F.col("d") * F.col("kinds") / F.col("total"), F.lit(1.0)).alias("spare"),
            )
        )
        gram = F.col("context") * F.lit(1 << BITS) + F.col("last")
        if order == 1:
            lower = rated.withColumn("lower", F.lit(1.0) / alphabet)
        else:
            shorter = gram if order < 4 else _tail("context", 2) * F.lit(1 << BITS) + F.col("last")
            lower = rated.withColumn("gram", shorter).withColumn("gram", _tail("gram", order - 1))
            lower = lower.join(p, ["model", "gram"])
        value = (F.col("seen") + F.col("spare") * F.col("lower")).alias("p")
        if order < 4:
            p = lower.select("model", gram.alias("gram"), value.alias("lower"))
        else:
            p = lower.select("model", F.col("context").alias("head"), "last", value)
    return p


@dataclass
class LanguageModel:
    """Log probabilities of the collection's four-grams and the numbers of the score.

    ``grams`` holds ``key`` and ``logs``, an array with one entry per language for the
    models of all training texts, then one per language for those of fold 2 alone.
    """

    langs: list[str]
    grams: DataFrame | None
    slope: float = 1.0
    offset: float = 0.0
    limit: float = float("inf")


def fit_tables(rows: DataFrame, scratch: Scratch) -> LanguageModel:
    """The n-gram tables of ``rows`` (``text``, ``lang``, ``fold``).

    Rows without a language only name four-grams that texts will ask for. The
    languages themselves go to the driver: one short text each.
    """
    counts = scratch.save(count_ngrams(rows), "counts")
    known = counts.where("lang is not null")
    langs = [r.lang for r in known.select("lang").distinct().orderBy("lang").collect()]
    if not langs:
        return LanguageModel([], None)
    index = F.array_position(F.lit(langs), F.col("lang")).cast("int") - 1
    models = F.when(F.col("fold") == 2, F.array(index, index + len(langs))).otherwise(
        F.array(index)
    )
    trained = (
        known.select(F.explode(models).alias("model"), "head", "last", "n")
        .groupBy("model", "head", "last").agg(F.sum("n").alias("n"))
    )
    trained = scratch.save(trained, "trained")
    asked = scratch.save(counts.select("head", "last", "key").distinct(), "asked")
    each = asked.select(
        F.explode(F.sequence(F.lit(0), F.lit(2 * len(langs) - 1))).alias("model"), "head", "last"
    )
    p = kneser_ney(trained, each)
    by_model = F.array_sort(F.collect_list(F.struct("model", F.log2("p").alias("log"))))
    logs = p.groupBy("head", "last").agg(by_model["log"].alias("logs"))
    grams = asked.join(logs, ["head", "last"]).select("key", "logs")
    return LanguageModel(langs, scratch.save(grams, "grams"))


def gram_logs(
    rows: DataFrame, model: LanguageModel, half: bool, settings: LanguageSettings
) -> DataFrame:
    """``rows`` with ``n_grams`` of ``text`` and ``logs``, their summed logs by language.

    Texts without a letter have 0 and no sums. ``text`` is dropped.
    """
    n_langs = len(model.langs)
    size = model.grams.count() * (8 + 4 * n_langs)
    if size <= settings.broadcast_bytes:
        return _looked_up(rows, model, half)
    return _joined(rows, model, half)


def _looked_up(rows: DataFrame, model: LanguageModel, half: bool) -> DataFrame:
    n_langs = len(model.langs)
    logs = F.slice("logs", n_langs + 1 if half else 1, n_langs).cast("array<float>")
    # Bounded by broadcast_bytes.
    table = model.grams.select("key", logs.alias("logs")).toArrow()
    key = table.column("key").to_numpy()
    values = table.column("logs").combine_chunks().flatten().to_numpy().reshape(-1, n_langs)
    order = np.argsort(key)
    state = rows.sparkSession.sparkContext.broadcast((key[order], values[order]))

    def of(codes: np.ndarray) -> tuple[int, list[float] | None]:
        keys, values = state.value
        if not len(codes):
            return 0, None
        found, n = np.unique(ngram_hash(*ngrams(codes)), return_counts=True)
        return int(n.sum()), (n @ values[np.searchsorted(keys, found)]).tolist()

    made = StructType().add("n_grams", "long").add("logs", ArrayType(DoubleType()))
    return _mapped(rows, of, made)


def _joined(rows: DataFrame, model: LanguageModel, half: bool) -> DataFrame:
    n_langs = len(model.langs)

    def of(codes: np.ndarray) -> tuple[int, list[int] | None, list[int] | None]:
        if not len(codes):
            return 0, None, None
        keys, counts = np.unique(ngram_hash(*ngrams(codes)), return_counts=True)
        return int(counts.sum()), keys.tolist(), counts.tolist()

    scratch = Scratch(rows.sparkSession, "language-join")
    made = StructType().add("n_grams", "long").add("keys", ArrayType(LongType()))
    numbered = rows.withColumn("_row", F.monotonically_increasing_id())
    # Written once, so that a task that runs again cannot number its rows anew.
    made = made.add("counts", ArrayType(LongType()))
    texts = scratch.save(_mapped(numbered, of, made), "texts")
    pairs = texts.select("_row", F.explode(F.arrays_zip("keys", "counts")).alias("g"))
    shift = n_langs if half else 0
    sums = (
        pairs.select("_row", F.col("g.keys").alias("key"), F.col("g.counts").alias("n"))
        .join(model.grams, "key")
        .groupBy("_row")
        .agg(*[
            F.sum(F.col("n") * F.get("logs", F.lit(shift + i))).alias(f"_{i}")
            for i in range(n_langs)
        ])
        .select("_row", F.array(*[f"_{i}" for i in range(n_langs)]).alias("logs"))
    )
    return texts.drop("keys", "counts").join(sums, "_row", "left").drop("_row")


def _mapped(rows: DataFrame, of: Callable, made: StructType) -> DataFrame:
    """Replace ``text`` by the columns ``of`` makes of its code points."""
    kept = [c for c in rows.columns if c != "text"]
    types = [to_arrow_type(field.dataType) for field in made]
    schema = StructType([rows.schema[c] for c in kept] + made.fields)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [of(encode(text.as_py())) for text in batch.column("text")]
            columns = zip(*found, strict=True) if found else [[] for _ in types]
            new = [pa.array(c, t) for c, t in zip(columns, types, strict=True)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(c) for c in kept] + new, names=schema.names
            )

    return rows.mapInArrow(run, schema)


def _margin(bits: np.ndarray, length: int) -> float:
    """Gap between the two best languages, growing with the text's length."""
    if len(bits) < 2:
        return 0.0
    best, second = np.sort(bits)[:2]
    return float(np.log2(1 + (second - best) * length))


def calibrate(model: LanguageModel, rows: list[tuple], accept: float) -> None:
    """Logistic fit of "is right" on the margin; rejection limit from right texts.

    ``rows`` are (language, four-grams, summed logs by language).
    """
    margins, right, bits_of_right = [], [], []
    for lang, n_grams, logs in rows:
        bits = -np.array(logs) / n_grams
        hit = model.langs[int(np.argmin(bits))] == lang
        margins.append(_margin(bits, n_grams))
        right.append(float(hit))
        if hit:
            bits_of_right.append(float(bits.min()))
    if bits_of_right:
        model.limit = float(np.quantile(bits_of_right, accept)) * 1.05
    if margins:
        # One row of each kind at margin 0 keeps the fit finite when all are right.
        x, y = np.append(margins, [0.0, 0.0]), np.append(right, [0.0, 1.0])
        w = np.zeros(2)
        design = np.column_stack([x, np.ones_like(x)])
        for _ in range(50):
            p = 1 / (1 + np.exp(-design @ w))
            hessian = (design * (p * (1 - p))[:, None]).T @ design + 1e-2 * np.eye(2)
            step = np.linalg.solve(hessian, design.T @ (y - p) - 1e-2 * w)
            w += step
            if np.abs(step).max() < 1e-9:
                break
        model.slope, model.offset = max(float(w[0]), 1e-3), float(w[1])


def fit_languages(
    documents: DataFrame, settings: LanguageSettings = LanguageSettings()
) -> LanguageModel:
    """Fit on texts with a language outside the held-out fold (crc32 mod 3 is 1).

    The score is calibrated on texts of fold 0 by models of fold 2 alone; the
    final models count both folds.
    """
    digest = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    fold = F.coalesce(F.pmod(digest, F.lit(3)), F.lit(0)).cast("int")
    lang = F.when(F.col("fold") != 1, F.col("lang").cast("string")).alias("lang")
    rows = (
        documents.select("text", "lang", fold.alias("fold"), "doc_id")
        .where("text is not null").select("text", lang, "fold", "doc_id")
    )
    model = fit_tables(rows, Scratch(documents.sparkSession, "language"))
    if model.langs:
        # The ids are chosen first, so that only the chosen texts move.
        known = rows.where("fold = 0 and lang is not null")
        rank, limit = F.xxhash64("doc_id"), settings.calibration_rows
        chosen = (
            known.where("doc_id is not null").select("doc_id").distinct()
            .orderBy(rank, "doc_id").limit(limit)
        )
        sample = (
            known.join(F.broadcast(chosen), "doc_id")
            .orderBy(rank, "doc_id").limit(limit).select("text", "lang")
        )
        seen = gram_logs(sample, model, True, settings).where("n_grams > 0")
        calibrate(model, [tuple(r) for r in seen.collect()], settings.accept)
    return model


def identify_languages(
    documents: DataFrame, settings: LanguageSettings = LanguageSettings()
) -> DataFrame:
    """One row per document: doc_id, held_out, lang_pred, score, bits, rejected.

    ``lang_pred`` is ``und`` with score 0 for null texts, texts without letters
    and when nothing could be learned. Other columns are ignored.
    """
    model = fit_languages(documents, settings)
    base = documents.select("doc_id", held_out("doc_id", 3, 1).alias("held_out"), "text")
    if not model.langs:
        return base.select(
            "doc_id", "held_out", F.lit("und").alias("lang_pred"), F.lit(0.0).alias("score"),
            F.lit(float("nan")).alias("bits"), F.lit(True).alias("rejected"),
        )
    bits = F.transform("logs", lambda x: -x / F.col("n_grams"))
    found = gram_logs(base, model, False, settings).withColumn("all_bits", bits)
    ranked = F.array_sort("all_bits")
    best = F.get(ranked, F.lit(0))
    # With one language there is no second and the margin is 0.
    gap = F.coalesce(F.get(ranked, F.lit(1)) - best, F.lit(0.0))
    margin = F.log2(1 + gap * F.col("n_grams"))
    score = 1 / (1 + F.exp(-(F.lit(model.slope) * margin + F.lit(model.offset))))
    lang = F.get(F.lit(model.langs), (F.array_position("all_bits", best) - 1).cast("int"))
    none = F.col("n_grams") == 0
    return found.select(
        "doc_id",
        "held_out",
        F.when(none, "und").otherwise(lang).alias("lang_pred"),
        F.when(none, 0.0).otherwise(score).alias("score"),
        F.when(none, float("nan")).otherwise(best).alias("bits"),
        (none | (best > F.lit(model.limit))).alias("rejected"),
    )
