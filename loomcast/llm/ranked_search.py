"""Ranked lexical search of all documents, hybrid between terms and documents at a time.

Every task holds a block of documents as inverted lists of the queries' terms and
answers all queries of a batch against it:

1. Term at a time: a query's short lists are summed into accumulators. Sorted by
   document they form one list with one bound, its largest sum.
2. Document at a time: that list and the long lists are iterators over windows of
   documents. A window whose bounds cannot reach the query's threshold (the k-th best
   score that the task has seen) is skipped. Elsewhere lists of small bounds that
   cannot reach it together are not walked: they are only looked up for the documents
   of the others, list by list, and documents that fall out of reach are left.
3. The best k of each task go to the query; there they are cut to k again in parts
   before the last ranking, so that no group grows with the number of tasks.

Scores are integers and sums of integers, so skipping is exact: a document is left
only when its bound lies below the threshold.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from loomcast.llm.common import Scratch, slices

#: Runs of digits, letters and every byte beyond ASCII.
TERM = re.compile(rb"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
TERM_SQL = "[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+"
SCALE = 1_000_000_000
PARTS = 64


@dataclass(frozen=True)
class SearchSettings:
    """``batch_terms`` bounds what a task holds of the queries: the queries are answered
    in batches of about that many terms, each with a pass over the texts. ``short``
    is the share of a block's documents that a query's short lists may hold together."""

    k: int = 50
    batch_terms: int = 1 << 18
    block_docs: int = 8192
    block_postings: int = 1 << 21
    window_docs: int = 1024
    short: float = 0.25


def query_terms(queries: DataFrame, id_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """(item_id, term), each term of an item once."""
    lowered = F.translate(
        F.col(text_col).cast("string"), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    )
    terms = F.explode(F.regexp_extract_all(lowered, F.lit(TERM_SQL), F.lit(0)))
    return queries.select(F.col(id_col).alias("item_id"), terms.alias("term")).distinct()


def ranked_search(
    documents: DataFrame,
    queries: DataFrame,
    settings: SearchSettings = SearchSettings(),
    doc_id: str = "doc_id",
    doc_text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
) -> DataFrame:
    """``item_id``, ``rank``, ``doc_id``, ``score``: each item's best ``k`` documents.

    Null, empty and termless texts are no documents and ask for nothing. Rows that
    repeat an item's id (null included) are one item with the terms of all of them.
    Document rows that repeat an id are documents of their own; those without an id
    come after others of their score. Empty tables give no rows. Other columns are
    ignored.
    """
    spark = documents.sparkSession
    scratch = Scratch(spark, "ranked-search")
    texts = documents.select(
        F.col(doc_id).cast("long").alias("doc_id"), F.col(doc_text).cast("binary").alias("text")
    )
    asked = scratch.save(query_terms(queries, item_id, item_text), "asked")
    asked = scratch.save(_numbered(asked, settings.batch_terms), "batches", partition_by="batch")
    batches = [row.batch for row in asked.select("batch").distinct().orderBy("batch").collect()]
    found = [
        _search(texts, asked.where(F.col("batch") == b), settings, scratch) for b in batches
    ]
    item_type = asked.schema["item_id"].dataType
    if not found:
        return spark.createDataFrame([], "item long, doc_id long, score long").select(
            F.lit(None).cast(item_type).alias("item_id"),
            F.lit(0).alias("rank"),
            "doc_id",
            "score",
        )
    out = found[0]
    for more in found[1:]:
        out = out.union(more)
    return out


def _numbered(asked: DataFrame, batch_terms: int) -> DataFrame:
    """Adds ``item`` (a number from 0 in its batch) and ``batch``.

    Items fall into batches by their hash; the number of batches follows from the
    number of rows. Only the table of items is ranked, one batch to a task.
    """
    n_rows = asked.count()
    n_batches = -(-n_rows // batch_terms)
    items = asked.select("item_id").distinct()
    batch = F.pmod(F.xxhash64("item_id"), F.lit(max(n_batches, 1))).cast("int")
    order = Window.partitionBy("batch").orderBy("item_id")
    items = items.select("item_id", batch.alias("batch")).withColumn(
        "item", (F.row_number().over(order) - 1).cast("int")
    )
    named = items.select(F.col("item_id").alias("same"), "item", "batch")
    return asked.join(named, F.col("item_id").eqNullSafe(F.col("same"))).drop("same")


def _search(texts: DataFrame, asked: DataFrame, settings: SearchSettings, scratch) -> DataFrame:
    """One batch of items against all documents."""
    # Bounded: a batch has about batch_terms rows.
    terms = sorted(row.term for row in asked.select("term").distinct().collect())
    spark = texts.sparkSession
    number = spark.sparkContext.broadcast({t.encode(): i for i, t in enumerate(terms)})
    postings = scratch.save(
        texts.mapInArrow(
            _postings(number), "doc_id long, n long, terms array<int>, counts array<int>"
        ),
        "postings",
    )
    n_docs, n_terms = postings.agg(
        F.count_if(F.col("n") > 0), F.coalesce(F.sum("n"), F.lit(0))
    ).first()
    weight = F.floor(
        1000 * F.log(F.lit(2 * n_docs + 2).cast("double") / (2 * F.col("df") + 1).cast("double"))
    )
    frequencies = (
        postings.select(F.explode("terms").alias("t")).groupBy("t").agg(F.count("*").alias("df"))
    )
    weights = np.zeros(len(terms), dtype=np.int64)
    for row in frequencies.select("t", weight.cast("long").alias("w")).collect():
        weights[row.t] = row.w
    index = {t: i for i, t in enumerate(terms)}
    items: dict[int, list[int]] = {}
    for row in asked.select("item", "term").collect():
        items.setdefault(row.item, []).append(index[row.term])
    wanted = spark.sparkContext.broadcast(
        (weights, {i: np.array(sorted(ts), dtype=np.int64) for i, ts in sorted(items.items())})
    )
    local = postings.where(F.size("terms") > 0).mapInArrow(
        _best(wanted, n_docs, n_terms, settings), "item int, doc_id long, score long"
    )
    order = [F.desc("score"), F.asc_nulls_last("doc_id")]
    part = F.pmod(F.xxhash64("doc_id", "score"), F.lit(PARTS))
    in_part = Window.partitionBy("item", "part").orderBy(*order)
    cut = (
        local.withColumn("part", part)
        .withColumn("place", F.row_number().over(in_part))
        .where(F.col("place") <= settings.k)
    )
    rank = F.row_number().over(Window.partitionBy("item").orderBy(*order))
    ranked = cut.select("item", rank.alias("rank"), "doc_id", "score").where(
        F.col("rank") <= settings.k
    )
    names = asked.select("item_id", "item").distinct()
    return ranked.join(names, "item").select("item_id", "rank", "doc_id", "score")


def _postings(number):
    """Per document its length in terms, and number and count of the queries' terms."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = number.value
        for batch in batches:
            texts = batch.column(1)
            lengths = [range(n or 0) for n in pc.binary_length(texts).to_pylist()]
            for start, end in slices(lengths):
                n, offsets, terms, counts = [], [0], [], []
                for raw in texts.slice(start, end - start).to_pylist():
                    words = TERM.findall(raw.lower()) if raw else []
                    n.append(len(words))
                    for word, count in Counter(words).items():
                        at = known.get(word)
                        if at is not None:
                            terms.append(at)
                            counts.append(count)
                    offsets.append(len(terms))
                places = pa.array(offsets, pa.int32())
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(start, end - start),
                        pa.array(n, pa.int64()),
                        pa.ListArray.from_arrays(places, pa.array(terms, pa.int32())),
                        pa.ListArray.from_arrays(places, pa.array(counts, pa.int32())),
                    ],
                    names=["doc_id", "n", "terms", "counts"],
                )

    return run


@dataclass
class Block:
    """Inverted lists of a block: postings sorted by term, then document."""

    docs: np.ndarray
    scores: np.ndarray
    begins: np.ndarray  # per term, the first posting; one more entry at the end
    highest: np.ndarray  # per term, the largest score
    n_docs: int


def inverted(
    lengths: np.ndarray,
    sizes: np.ndarray,
    terms: np.ndarray,
    counts: np.ndarray,
    weights: np.ndarray,
    n_docs: int,
    n_terms: int,
) -> Block:
    """``lengths``: terms of each document; ``sizes``: its postings in ``terms``."""
    docs = np.repeat(np.arange(len(lengths)), sizes)
    m = 50 + (50 * lengths * n_docs) // n_terms
    tf = counts.astype(np.int64)
    scores = weights[terms] * ((SCALE * tf) // (1000 * tf + 20 * m[docs]))
    order = np.argsort(terms, kind="stable")
    terms, docs, scores = terms[order], docs[order], scores[order]
    begins = np.searchsorted(terms, np.arange(len(weights) + 1))
    highest = np.zeros(len(weights), dtype=np.int64)
    full = begins[1:] > begins[:-1]
    if len(scores):
        highest[full] = np.maximum.reduceat(scores, begins[:-1][full])
    return Block(docs, scores, begins, highest, len(lengths))


def block_best(
    block: Block, terms: np.ndarray, floor: int, settings: SearchSettings
) -> tuple[np.ndarray, np.ndarray]:
    """Documents of the block, and their scores, that may be among the best k.

    ``floor`` is a score that a document must reach (0: any score above 0). Every
    document is returned that reaches the block's own k-th best score and ``floor``.
    """
    sizes = block.begins[terms + 1] - block.begins[terms]
    terms = terms[np.argsort(sizes, kind="stable")]
    sizes = np.sort(sizes)
    terms, sizes = terms[sizes > 0], sizes[sizes > 0]
    if not len(terms):
        return np.empty(0, dtype=np.int64), np.empty(0, dtype=np.int64)

    # Terms at a time: the short lists become one list of summed accumulators.
    n_short = int(np.searchsorted(np.cumsum(sizes), settings.short * block.n_docs, "right"))
    lists = []
    if n_short:
        sums = np.zeros(block.n_docs, dtype=np.int64)
        for t in terms[:n_short]:
            part = slice(block.begins[t], block.begins[t + 1])
            sums[block.docs[part]] += block.scores[part]
        docs = np.flatnonzero(sums)
        if len(docs):
            lists.append((docs, sums[docs], int(sums.max())))
            if len(docs) >= settings.k:
                kth = np.partition(sums[docs], len(docs) - settings.k)[len(docs) - settings.k]
                floor = max(floor, int(kth))
    for t in terms[n_short:]:
        part = slice(block.begins[t], block.begins[t + 1])
        lists.append((block.docs[part], block.scores[part], int(block.highest[t])))

    # Documents at a time, window by window.
    kept_docs, kept = np.empty(0, dtype=np.int64), np.empty(0, dtype=np.int64)
    for low in range(0, block.n_docs, settings.window_docs):
        high = min(low + settings.window_docs, block.n_docs)
        if sum(bound for _, _, bound in lists) < floor:
            break
        docs, scores = _window(lists, low, high, max(floor, 1))
        if not len(docs):
            continue
        kept_docs, kept = np.concatenate([kept_docs, docs]), np.concatenate([kept, scores])
        if len(kept) >= settings.k:
            kth = np.partition(kept, len(kept) - settings.k)[len(kept) - settings.k]
            floor = max(floor, int(kth))
            stay = kept >= floor
            kept_docs, kept = kept_docs[stay], kept[stay]
    stay = kept >= max(floor, 1)
    return kept_docs[stay], kept[stay]


def _window(lists: list, low: int, high: int, floor: int) -> tuple[np.ndarray, np.ndarray]:
    """Documents from ``low`` up to ``high`` that score ``floor`` or more."""
    here = []
    for docs, scores, _ in lists:
        start, end = np.searchsorted(docs, (low, high))
        if end > start:
            here.append((int(scores[start:end].max()), docs[start:end], scores[start:end]))
    here.sort(key=lambda entry: entry[0])
    reach = np.cumsum([bound for bound, _, _ in here])
    if not len(reach) or reach[-1] < floor:
        return np.empty(0, dtype=np.int64), np.empty(0, dtype=np.int64)
    # Documents that only the first lists hold stay below the floor: walk the others.
    first = int(np.searchsorted(reach, floor, "left"))
    sums = np.zeros(high - low, dtype=np.int64)
    met = np.zeros(high - low, dtype=bool)
    for _, docs, scores in here[first:]:
        sums[docs - low] += scores
        met[docs - low] = True
    found = np.flatnonzero(met)
    for at in range(first - 1, -1, -1):
        found = found[sums[found] + reach[at] >= floor]
        if not len(found):
            break
        _, docs, scores = here[at]
        places = np.minimum(np.searchsorted(docs, found + low), len(docs) - 1)
        hit = docs[places] == found + low
        sums[found[hit]] += scores[places[hit]]
    found = found[sums[found] >= floor]
    return found + low, sums[found]


def _best(wanted, n_docs: int, n_terms: int, settings: SearchSettings):
    """The task's best k of every item; blocks are bounded by documents and postings."""

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[list[pa.RecordBatch]]:
        held, docs, postings = [], 0, 0
        for batch in batches:
            ends = batch.column(2).offsets.to_numpy()
            ends = np.cumsum(np.diff(ends))
            start = 0
            while start < batch.num_rows:
                done = ends[start - 1] if start else 0
                end = int(np.searchsorted(ends, done + settings.block_postings - postings, "right"))
                end = min(max(end, start + (not held)), start + settings.block_docs - docs)
                end = min(end, batch.num_rows)
                if end > start:
                    held.append(batch.slice(start, end - start))
                    docs += end - start
                    postings += int(ends[end - 1] - done)
                    start = end
                if start < batch.num_rows:
                    yield held
                    held, docs, postings = [], 0, 0
        if held:
            yield held

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights, items = wanted.value
        best: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]] = {}
        for held in blocks(batches):
            rows = pa.Table.from_batches(held).combine_chunks()
            ids = rows.column(0).combine_chunks()
            missing = ids.is_null().to_numpy(zero_copy_only=False)
            ids = ids.fill_null(0).to_numpy(zero_copy_only=False)
            terms, counts = (rows.column(c).combine_chunks() for c in (2, 3))
            block = inverted(
                rows.column(1).to_numpy(),
                pc.list_value_length(terms).to_numpy(zero_copy_only=False),
                terms.flatten().to_numpy(),
                counts.flatten().to_numpy(),
                weights,
                n_docs,
                n_terms,
            )
            for item, own in items.items():
                old = best.get(item)
                floor = int(old[0][-1]) if old and len(old[0]) >= settings.k else 0
                docs, scores = block_best(block, own, floor, settings)
                if not len(docs):
                    continue
                found = (scores, ids[docs], missing[docs])
                if old:
                    found = tuple(np.concatenate(pair) for pair in zip(old, found, strict=True))
                order = np.lexsort((found[1], found[2], -found[0]))[: settings.k]
                best[item] = tuple(column[order] for column in found)
        if best:
            sizes = [len(scores) for scores, _, _ in best.values()]
            scores, ids, missing = (
                np.concatenate([entry[c] for entry in best.values()]) for c in range(3)
            )
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.repeat(np.array(list(best), dtype=np.int32), sizes)),
                    pa.array(ids, pa.int64(), mask=missing),
                    pa.array(scores, pa.int64()),
                ],
                names=["item", "doc_id", "score"],
            )

    return run
