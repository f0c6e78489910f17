"""Quality classifier: hashed word n-grams, logistic regression by FTRL-Proximal.

McMahan et al., "Ad Click Prediction: a View from the Trenches" (2013) for the
updates; hashing after Weinberger et al. (2009). A text's features are the words
and word pairs in it and the shapes of both (letters, digits and marks as
classes), each with its share of the text as value. A score is the sigmoid of one
sparse dot product, taken over flat arrays of a batch of texts.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import regex
from pyspark.broadcast import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType
from xxhash import xxh64_intdigest

from loomcast.llm.common import GOLDEN, held_out, mix64, slices


@dataclass(frozen=True)
class QualitySettings:
    """``max_rows`` bounds the labelled rows that the fit reads.

    They are the labels with the smallest hash of the id, so the choice does not
    depend on the partitioning, and only their texts move.
    """

    buckets_log2: int = 18
    max_rows: int = 4000
    epochs: int = 2
    alpha: float = 0.5
    beta: float = 1.0
    l1: float = 0.02
    l2: float = 0.05
    scale: float = 10.0
    threshold: float = 0.3


#: Workers are used again and keep their words: some 25 MB each beside what runs next.
_CACHE_LIMIT = 1 << 16
#: Characters whose n-grams are in memory at a time.
_SLICE = 1 << 18
_words: dict[str, tuple[int, int]] = {}
_SHAPES = (
    (regex.compile(r"\p{Lu}+"), "A"),
    (regex.compile(r"\p{L}+"), "a"),
    (regex.compile(r"\d+"), "0"),
)


def _hashes(word: str) -> tuple[int, int]:
    """Hash of the word and of its shape: "Oft.!!" has the shape "Aa.!!"."""
    shape = word
    for pattern, mark in _SHAPES:
        shape = pattern.sub(mark, shape)
    if len(_words) >= _CACHE_LIMIT:
        _words.clear()
    found = _words[word] = (
        xxh64_intdigest(word) >> 1,
        xxh64_intdigest(shape, 1) >> 1,
    )
    return found


def features(texts: list[str | None], buckets_log2: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text number, bucket, value) of every n-gram of every text; repeats are kept."""
    rows, flat = [], []
    for text in texts:
        words = text.split() if text else []
        rows.append(len(words))
        flat += words
    get = _words.get
    pairs = np.array([get(w) or _hashes(w) for w in flat], dtype=np.uint64).reshape(-1, 2)
    owner = np.repeat(np.arange(len(texts)), rows)
    share = np.repeat(1.0 / np.maximum(rows, 1), rows)
    inside = owner[1:] == owner[:-1]
    first, second = pairs[:-1][inside], pairs[1:][inside]
    # A word that repeats its predecessor is one feature, whatever the word.
    again = first[:, 0] == second[:, 0]
    joint = mix64(first + GOLDEN) + second
    joint[again, 0] = 1
    families = [pairs[:, 0], pairs[:, 1], joint[:, 0], joint[:, 1]]
    owners = [owner, owner, owner[1:][inside], owner[1:][inside]]
    shares = [share, share, share[1:][inside], share[1:][inside]]
    shift = np.uint64(64 - buckets_log2)
    buckets = [
        (mix64(f + np.uint64(i + 1)) >> shift).astype(np.int64) for i, f in enumerate(families)
    ]
    return np.concatenate(owners), np.concatenate(buckets), np.concatenate(shares)


def fit_ftrl(
    texts: list[str | None], labels: list[int], settings: QualitySettings
) -> tuple[float, np.ndarray]:
    """Bias and weights after ``epochs`` passes in the given order."""
    rows = []
    for start, end in slices(texts, _SLICE):
        owner, bucket, value = features(texts[start:end], settings.buckets_log2)
        order = np.argsort(owner, kind="stable")
        cuts = np.searchsorted(owner[order], np.arange(end - start + 1))
        for i in range(end - start):
            own = order[cuts[i] : cuts[i + 1]]
            ids, inverse = np.unique(bucket[own], return_inverse=True)
            sums = np.bincount(inverse, weights=value[own], minlength=len(ids))
            rows.append((ids.astype(np.int32), sums * settings.scale))
    size = 1 << settings.buckets_log2
    z, n = np.zeros(size), np.zeros(size)
    bias_z = bias_n = 0.0

    def weights(z, n):
        small = np.abs(z) <= settings.l1
        step = (settings.beta + np.sqrt(n)) / settings.alpha + settings.l2
        return np.where(small, 0.0, -(z - np.sign(z) * settings.l1) / step)

    for _ in range(settings.epochs):
        for (ids, values), label in zip(rows, labels, strict=True):
            w = weights(z[ids], n[ids])
            bias = -bias_z / ((settings.beta + bias_n**0.5) / settings.alpha)
            error = _sigmoid(bias + float(w @ values)) - label
            gradient = error * values
            grown = n[ids] + gradient**2
            z[ids] += gradient - (np.sqrt(grown) - np.sqrt(n[ids])) / settings.alpha * w
            n[ids] = grown
            more = bias_n + error**2
            bias_z += error - (more**0.5 - bias_n**0.5) / settings.alpha * bias
            bias_n = more
    bias = -bias_z / ((settings.beta + bias_n**0.5) / settings.alpha)
    return float(bias), weights(z, n)


def _sigmoid(x):
    return 1.0 / (1.0 + np.exp(-np.clip(x, -500, 500)))


def score_texts(texts: list[str | None], bias: float, weights: np.ndarray, scale: float):
    log2 = int(len(weights)).bit_length() - 1
    out = np.full(len(texts), bias)
    for start, end in slices(texts, _SLICE):
        owner, bucket, value = features(texts[start:end], log2)
        out[start:end] += np.bincount(
            owner, weights=weights[bucket] * value * scale, minlength=end - start
        )
    return _sigmoid(out)


class QualityModel:
    """A fitted model; ``score`` gives a column expression."""

    def __init__(self, state: Broadcast, settings: QualitySettings):
        self.state, self.settings = state, settings

    def score(self, text_col: str = "text") -> Column:
        state, scale = self.state, self.settings.scale

        def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
            bias, weights = state.value
            for texts in batches:
                yield pd.Series(score_texts(texts.tolist(), bias, weights, scale))

        run.__annotations__ = {"batches": Iterator[pd.Series], "return": Iterator[pd.Series]}
        return F.pandas_udf(run, DoubleType())(F.col(text_col))


def fit_quality(
    documents: DataFrame, labels: DataFrame, settings: QualitySettings = QualitySettings()
) -> QualityModel:
    """Fit on labelled rows outside the held-out fold (crc32 of the id mod 5 is 0).

    Rows with a null label or id and labels other than 0 and 1 teach nothing; a
    document with several labels counts once for each. Without any row the model
    scores 0.5. The fit runs in one task over at most ``max_rows`` texts; the
    weights, 2 ** ``buckets_log2`` numbers, are broadcast.
    """
    spark = documents.sparkSession
    known = labels.select("doc_id", F.col("quality").cast("int").alias("quality")).where(
        "quality in (0, 1) and doc_id is not null"
    )
    chosen = (
        known.where(~held_out("doc_id", 5, 0))
        .withColumn("rank", F.xxhash64("doc_id", "quality"))
        .orderBy("rank", "doc_id", "quality")
        .limit(settings.max_rows)
    )
    # At most ``max_rows`` rows of three numbers: small enough to send to every task.
    # The second limit matters where rows repeat an id.
    rows = (
        documents.select("doc_id", "text")
        .join(F.broadcast(chosen), "doc_id")
        .orderBy("rank", "doc_id")
        .limit(settings.max_rows)
    )

    def fit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        texts, marks, ranks = [], [], []
        for batch in batches:
            ranks += batch.column(0).to_pylist()
            texts += batch.column(1).to_pylist()
            marks += batch.column(2).to_pylist()
        order = sorted(range(len(ranks)), key=lambda i: (ranks[i], texts[i] or "", marks[i]))
        bias, weights = fit_ftrl([texts[i] for i in order], [marks[i] for i in order], settings)
        yield pa.RecordBatch.from_arrays(
            [pa.array([bias]), pa.array([weights.astype(np.float32).tobytes()], pa.binary())],
            names=["bias", "weights"],
        )

    fitted = (
        rows.select("rank", "text", "quality")
        .repartition(1)
        .mapInArrow(fit, "bias double, weights binary")
        .collect()
    )
    bias, weights = 0.0, np.zeros(1 << settings.buckets_log2, dtype=np.float32)
    for row in fitted:  # one, or none where there is no partition
        bias, weights = row["bias"], np.frombuffer(row["weights"], dtype=np.float32)
    return QualityModel(spark.sparkContext.broadcast((bias, weights)), settings)


def quality_scores(
    documents: DataFrame, labels: DataFrame, settings: QualitySettings = QualitySettings()
) -> DataFrame:
    """One row per document: doc_id, held_out, score, predicted.

    Null and empty texts get the score of a text without words. A null id is not
    held out. Other columns are ignored.
    """
    model = fit_quality(documents, labels, settings)
    return documents.select(
        "doc_id", held_out("doc_id", 5, 0).alias("held_out"), model.score("text").alias("score")
    ).withColumn("predicted", (F.col("score") >= settings.threshold).cast("int"))


def good_documents(
    documents: DataFrame, labels: DataFrame, settings: QualitySettings = QualitySettings()
) -> DataFrame:
    """The documents, with all their columns, that the model predicts to be good."""
    model = fit_quality(documents, labels, settings)
    return documents.where(model.score("text") >= settings.threshold)
