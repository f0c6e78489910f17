"""Near-duplicate groups of documents by SuperMinHash signatures.

Ertl, "SuperMinHash - A New Minwise Hashing Algorithm for Jaccard Similarity
Estimation" (2017): each element of a set walks a random permutation of the
signature's positions; step j offers position p[j] the value j + u. All elements
take step j together here, so that a set of a few hundred elements fills its
signature in two or three vector steps and then stops early.

1. A map over the texts gives shingle set sizes, a fingerprint of the whole set
   and band hashes. Documents with equal sets become one class; where a
   document id stands for several classes their ids are 64 bits of the fingerprint.
2. Classes that share a band hash form buckets. In each bucket every class is
   verified against the smallest one: rows grow with the bucket, not its square.
3. Union-find over verified links gives components. In buckets that still hold
   several, classes outside the largest component are verified against random
   members of it. The few that stay outside are compared with every bucket mate of
   another component, in blocks of bounded size inside a task, so that no link
   between bucket mates is lost and no pair that fails becomes a row.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import dataclass
from hashlib import blake2b

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType
from xxhash import xxh64_intdigest

from loomcast.llm.common import GOLDEN, Scratch, few_tasks, mix64, put_back, row_keys, set_aside
from loomcast.llm.components import connected_components

EMPTY = np.empty(0, dtype=np.uint64)
CHUNK = 4096
STEPS = np.arange(1, 256, dtype=np.uint64) * GOLDEN
PIVOTS = 4
BLOCK_SHINGLES = 100_000
BLOCK_ROWS = 8
#: Texts, or pairs of shingle sets, that a task and its worker hold at a time.
TEXT_ROWS = 256
#: Pairs of shingle sets, and shingles in pairs of blocks, for each task that verifies them.
PAIRS_PER_TASK = 1000
SHINGLES_PER_TASK = 20 * BLOCK_SHINGLES
#: Keys of 16 bytes that are broadcast at most; more are joined by a shuffle.
MAX_BROADCAST_KEYS = 1 << 20


@dataclass(frozen=True)
class NearDupSettings:
    """``width`` words a shingle; linked when 100 * shared >= percent * union.

    A pair at similarity s shares a band with probability
    1 - (1 - s ** rows) ** bands; with the defaults a pair at exactly 0.8 is
    missed by 3 in a million, one at 0.9 never in practice.
    """

    width: int = 5
    percent: int = 80
    bands: int = 32
    rows: int = 5

    def __post_init__(self):
        if self.bands * self.rows > 255:
            raise ValueError("bands * rows must be at most 255")


def shingle_set(raw: bytes | None, width: int) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the text's word shingles.

    Words are runs of bytes other than ASCII white space after lower-casing A-Z.
    A text with fewer words than ``width`` is one shingle; no words, no shingle.
    """
    words = raw.lower().split() if raw else []
    if not words:
        return EMPTY
    hashes = np.fromiter(map(xxh64_intdigest, words), np.uint64, len(words))
    width = min(width, len(words))
    out = hashes[: len(hashes) - width + 1].copy()
    for i in range(1, width):
        out = mix64(out + GOLDEN) + hashes[i : len(hashes) - width + 1 + i]
    return np.unique(mix64(out + np.uint64(width)))


def super_minhash(elements: np.ndarray, size: int) -> np.ndarray:
    """Signature of ``size`` integers; position values are (step << 32) + random."""
    signature = np.full(size, np.iinfo(np.int64).max, dtype=np.int64)
    for start in range(0, len(elements), CHUNK):
        part = elements[start : start + CHUNK]
        walk = np.tile(np.arange(size, dtype=np.uint8), (len(part), 1))
        lines = np.arange(len(part))
        for step in range(size):
            draw = mix64(part + STEPS[step])
            value = (draw >> np.uint64(32)).astype(np.int64) + (step << 32)
            low = draw & np.uint64(0xFFFFFFFF)
            other = (step + ((low * np.uint64(size - step)) >> np.uint64(32))).astype(np.intp)
            place = walk[lines, other]
            walk[lines, other] = walk[:, step]
            np.minimum.at(signature, place, value)
            if signature.max() < (step + 1) << 32:
                break
    return signature


def band_hashes(signature: np.ndarray, bands: int, rows: int) -> np.ndarray:
    parts = signature.view(np.uint64).reshape(bands, rows)
    out = np.arange(1, bands + 1, dtype=np.uint64) * GOLDEN
    for i in range(rows):
        out = mix64(out ^ parts[:, i]) + GOLDEN
    return out.view(np.int64)


def _signatures(settings: NearDupSettings):
    size = settings.bands * settings.rows

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts, prints, offsets, bands = [], [], [0], []
            for raw in batch.column(1).to_pylist():
                found = shingle_set(raw, settings.width)
                counts.append(len(found))
                prints.append(blake2b(found.tobytes(), digest_size=16).digest())
                if len(found):
                    bands.append(
                        band_hashes(super_minhash(found, size), settings.bands, settings.rows)
                    )
                offsets.append(offsets[-1] + settings.bands * bool(len(found)))
            flat = np.concatenate(bands) if bands else np.empty(0, dtype=np.int64)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    batch.column(2),
                    batch.column(3),
                    pa.array(counts, pa.int64()),
                    pa.array(prints, pa.binary()),
                    pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(flat)),
                ],
                names=["doc_id", "k1", "k2", "n_shingles", "print", "bands"],
            )

    return run


def _sets(width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [shingle_set(raw, width) for raw in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array([s.tobytes() for s in found], pa.binary()),
                ],
                names=["cid", "shingles"],
            )

    return run


@F.pandas_udf(LongType())
def shared_shingles(left: pd.Series, right: pd.Series) -> pd.Series:
    out = []
    for a, b in zip(left, right, strict=True):
        both = np.concatenate([np.frombuffer(a, np.uint64), np.frombuffer(b, np.uint64)])
        both.sort()
        out.append(int((both[1:] == both[:-1]).sum()))
    return pd.Series(out, dtype="int64")


def _close_sizes(a: str, b: str, percent: int):
    small, large = F.least(F.col(a), F.col(b)), F.greatest(F.col(a), F.col(b))
    return small * 100 >= large * percent


def near_duplicates(
    documents: DataFrame,
    settings: NearDupSettings = NearDupSettings(),
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """One row per input row: id, ``n_shingles``, ``component_id``, ``kept``.

    ``component_id`` is the smallest id that verified links reach; ``kept`` marks
    the row that carries it. Null, empty and blank texts have no shingles and stay
    alone. Rows without an id are linked like any other and carry the smallest id of
    their component, or null if it has none (then they are kept). Rows that repeat an id with the same words are in one group; where an id
    carries different texts each row follows its own. Other columns are ignored, so
    their names cannot clash.
    """
    scratch = Scratch(documents.sparkSession, "near-dup")
    return _grouped(documents, settings, scratch, id_col, text_col).select(
        "doc_id", "n_shingles", "component_id", "kept"
    )


def distinct_documents(
    documents: DataFrame, settings: NearDupSettings = NearDupSettings()
) -> DataFrame:
    """The documents, with all their columns, that stay: one of each group.

    Rows without words are never linked and all stay. Of rows that repeat the
    group's id one stays.
    """
    scratch = Scratch(documents.sparkSession, "distinct")
    rows = scratch.save(_grouped(documents, settings, scratch), "rows")
    words = rows.where("n_shingles > 0")
    winners = words.where("kept").groupBy("root").agg(F.min(F.struct("k1", "k2")).alias("w"))
    stay = scratch.save(winners.select("w.k1", "w.k2"), "stay")
    repeated = words.groupBy("k1", "k2").count().where("count > 1").select("k1", "k2")
    repeated = scratch.save(repeated.join(stay, ["k1", "k2"], "left_semi"), "repeated")
    go = scratch.save(
        words.select("k1", "k2").distinct().join(stay, ["k1", "k2"], "left_anti"), "go"
    )
    renamed, own = set_aside(documents)
    k1, k2 = row_keys(own["doc_id"], own["text"])
    keyed = renamed.withColumns({"_k1": k1, "_k2": k2})

    def keys(of: DataFrame) -> DataFrame:
        return of.select(F.col("k1").alias("_k1"), F.col("k2").alias("_k2"))

    left = keyed.join(keys(go), ["_k1", "_k2"], "left_anti")
    if not repeated.isEmpty():
        once = left.join(keys(repeated), ["_k1", "_k2"], "left_semi").dropDuplicates(["_k1", "_k2"])
        left = left.join(keys(repeated), ["_k1", "_k2"], "left_anti").unionByName(once)
    return put_back(left, own)


def _grouped(
    documents: DataFrame,
    settings: NearDupSettings,
    scratch: Scratch,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    k1, k2 = row_keys(id_col, text_col)
    texts = documents.select(
        F.col(id_col).cast("long").alias("doc_id"),
        F.col(text_col).cast("binary").alias("text"),
        k1.alias("k1"),
        k2.alias("k2"),
    )
    with _records_per_batch(documents.sparkSession, TEXT_ROWS):
        rows = scratch.save(
            texts.mapInArrow(
                _signatures(settings),
                "doc_id long, k1 long, k2 long, n_shingles long, print binary, bands array<long>",
            ),
            "signatures",
        )
    n_rows = rows.count()
    classes = (
        rows.where("n_shingles > 0")
        .groupBy("print")
        .agg(
            F.min("doc_id").alias("rep"),
            F.min(F.struct("k1", "k2")).alias("speaker"),
            F.count("*").alias("n_rows"),
            F.first("n_shingles").alias("n"),
            F.first("bands").alias("bands"),
        )
    )
    classes = scratch.save(few_tasks(classes, n_rows), "classes")
    # A class goes by its smallest document id, or by its fingerprint where it has
    # none or shares it with another class.
    shared_ids = (
        classes.where("rep is not null")
        .groupBy("rep")
        .agg(F.count("*").alias("n_classes"))
        .where("n_classes > 1")
    )
    shared_ids = scratch.save(few_tasks(shared_ids, n_rows), "shared-ids")
    own = F.coalesce("rep", F.xxhash64("print"))
    if shared_ids.isEmpty():
        classes = classes.withColumn("cid", own)
    else:
        several = F.when(F.col("n_classes").isNotNull(), F.xxhash64("print")).otherwise(own)
        classes = classes.join(shared_ids, "rep", "left").withColumn("cid", several)
        classes = scratch.save(few_tasks(classes.drop("n_classes"), n_rows), "own-classes")
    roots = _links(texts, classes, n_rows, settings, scratch)
    # Roots are class ids; a component takes its name from all its classes.
    linked = roots.union(roots.select("root", "root").distinct())
    placed = (
        classes.select("print", "cid", "rep", "n_rows")
        .join(linked, classes["cid"] == linked["v"], "left")
        .where("n_rows > 1 or root is not null")
        .select("print", "rep", F.coalesce("root", "cid").alias("root"))
    )
    placed = scratch.save(few_tasks(placed, n_rows), "grouped")
    names = placed.groupBy("root").agg(F.min("rep").alias("component_id"))
    groups = placed.join(names, "root").select("print", "root", "component_id")
    groups = scratch.save(few_tasks(groups, n_rows), "groups")
    labelled = rows.select("doc_id", "k1", "k2", "n_shingles", "print").join(groups, "print", "left")
    component = F.when(F.col("n_shingles") > 0, F.coalesce("component_id", "doc_id")).otherwise(
        F.col("doc_id")
    )
    return few_tasks(labelled, n_rows).select(
        "doc_id",
        "k1",
        "k2",
        F.coalesce("root", F.xxhash64("print")).alias("root"),
        "n_shingles",
        component.alias("component_id"),
        F.col("doc_id").eqNullSafe(component).alias("kept"),
    )


def _links(
    texts: DataFrame, classes: DataFrame, n_rows: int, settings: NearDupSettings, scratch: Scratch
) -> DataFrame:
    """(v, root) over class ids that verified links join."""
    exploded = classes.select("cid", "n", F.explode("bands").alias("bucket"))
    buckets = (
        exploded.groupBy("bucket")
        .agg(F.count("*").alias("size"), F.min(F.struct("cid", "n")).alias("pivot"))
        .where("size > 1")
        .select("bucket", "pivot")
    )
    buckets = scratch.save(few_tasks(buckets, n_rows), "buckets")
    members = scratch.save(few_tasks(exploded.join(buckets, "bucket"), n_rows), "members")
    sets = _member_sets(texts, classes, members, n_rows, settings, scratch)
    star = members.select(
        F.col("cid").alias("a"),
        "n",
        F.col("pivot.cid").alias("b"),
        F.col("pivot.n").alias("m"),
    ).where("a <> b")
    # First with one pivot each, the one that most of its buckets name: what that links
    # need not be verified against the pivots of its other buckets.
    star = star.groupBy("a", "n", "b", "m").agg(F.count("*").alias("times"))
    star = scratch.save(few_tasks(star, n_rows), "star")
    nearest = star.groupBy("a", "n").agg(F.max_by(F.struct("b", "m"), F.struct("times", "b")).alias("p"))
    nearest = nearest.select("a", "n", F.col("p.b").alias("b"), F.col("p.m").alias("m"))
    roots = connected_components(_verified(nearest, sets, n_rows, settings, scratch), scratch)
    others = star.drop("times").join(nearest.select("a", "b"), ["a", "b"], "left_anti")
    others = _between_components(others, roots)
    roots = _joined(roots, _verified(others, sets, n_rows, settings, scratch), scratch)

    # Against random members of each bucket's largest component.
    placed, main = _placed(members, roots, n_rows, scratch)
    if main.isEmpty():
        return roots
    seeds = [
        F.min_by(F.struct("cid", "n"), F.xxhash64("cid", "bucket", F.lit(i))).alias(f"p{i}")
        for i in range(PIVOTS)
    ]
    inside = (
        placed.join(main, "bucket").where("component = main").groupBy("bucket", "main").agg(*seeds)
    )
    tries = (
        placed.join(inside, "bucket")
        .where("component <> main")
        .select("cid", "n", F.explode(F.array(*[f"p{i}" for i in range(PIVOTS)])).alias("p"))
        .select(F.col("cid").alias("a"), "n", F.col("p.cid").alias("b"), F.col("p.n").alias("m"))
    )
    roots = _joined(roots, _verified(tries, sets, n_rows, settings, scratch), scratch)

    # What is still apart, once for each pair of bucket mates: block against block.
    placed, main = _placed(members, roots, n_rows, scratch)
    if main.isEmpty():
        return roots
    bands = classes.groupBy("cid").agg(F.min("bands").alias("bands"))
    # Each block travels once for every block on the other side.
    outer, whole = F.col("outside_shingles"), F.col("all_shingles")
    carried = outer * F.ceil(whole / BLOCK_SHINGLES) + whole * F.ceil(outer / BLOCK_SHINGLES)
    n_shingles = main.agg(F.sum(carried)).first()[0]
    apart = placed.join(main, "bucket").join(bands, "cid").join(sets, "cid")
    outside = apart.where("component <> main")
    blocks = _member_blocks(outside, "outside_shingles", "a_").join(
        _member_blocks(apart, "all_shingles", "b_"), "bucket"
    )
    # A row holds two blocks: few of them at a time in a worker's memory.
    with _records_per_batch(blocks.sparkSession, BLOCK_ROWS):
        blocks = few_tasks(blocks, n_shingles, SHINGLES_PER_TASK)
        more = scratch.save(blocks.mapInArrow(_block_links(settings), "a long, b long"), "more")
    return _joined(roots, more, scratch)


def _between_components(pairs: DataFrame, roots: DataFrame) -> DataFrame:
    """The pairs (a, n, b, m) that known links do not join yet."""
    for side in ("a", "b"):
        root = roots.select(F.col("v").alias(side), F.col("root").alias(f"root_{side}"))
        pairs = pairs.join(root, side, "left")
    apart = F.coalesce("root_a", "a") != F.coalesce("root_b", "b")
    return pairs.where(apart).select("a", "n", "b", "m")


def _joined(roots: DataFrame, links: DataFrame, scratch: Scratch) -> DataFrame:
    """Components after further links: known ones count as one edge per member."""
    if links.isEmpty():
        return roots
    return connected_components(roots.union(links), scratch)


@contextmanager
def _records_per_batch(spark: SparkSession, rows: int) -> Iterator[None]:
    """Arrow batches of the jobs run inside hold at most that many rows."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, str(rows))
    try:
        yield
    finally:
        spark.conf.set(name, before)


def _member_blocks(rows: DataFrame, weight: str, prefix: str) -> DataFrame:
    """Members of each bucket packed into blocks of about ``BLOCK_SHINGLES`` shingles."""
    parts = F.ceil(F.col(weight) / BLOCK_SHINGLES)
    member = F.struct(
        "cid", "n", "component", (F.col("component") == F.col("main")).alias("main"), "bands",
        "shingles",
    )
    packed = rows.groupBy("bucket", F.pmod(F.xxhash64("cid"), parts).alias("part")).agg(
        F.collect_list(member).alias("rows")
    )
    fields = ("cid", "n", "component", "main", "bands", "shingles")
    return packed.select("bucket", *[F.col(f"rows.{f}").alias(prefix + f) for f in fields])


def _block_links(settings: NearDupSettings):
    """Links between the members of two blocks, one at most per member and component.

    A pair is looked at in the first band that it shares, and not at all if its
    sizes rule a link out.
    """

    def pair(bucket: int, left: list, right: list) -> list[tuple[int, int]]:
        a, n, ca, _, bands_a, sets_a = left
        b, m, cb, main, bands_b, sets_b = right
        b, cb, main = np.array(b), np.array(cb), np.array(main)
        n, m = np.array(n), np.array(m)
        bands_b = np.array(bands_b)
        tokens, codes = np.unique(
            np.frombuffer(b"".join(sets_b), np.uint64), return_inverse=True
        )
        starts = np.cumsum(m) - m
        out = []
        for i, rep in enumerate(a):
            same = bands_b == np.array(bands_a[i])
            first = bands_b[np.arange(len(b)), same.argmax(axis=1)]
            wanted = same.any(axis=1) & (first == bucket) & (cb != ca[i])
            wanted &= main | (rep < b)
            small, large = np.minimum(n[i], m), np.maximum(n[i], m)
            wanted &= small * 100 >= large * settings.percent
            if not wanted.any():
                continue
            flags = np.zeros(len(tokens) + 1, dtype=np.int64)
            own = np.frombuffer(sets_a[i], np.uint64)
            at = np.minimum(np.searchsorted(tokens, own), len(tokens) - 1)
            flags[at[tokens[at] == own]] = 1
            shared = np.add.reduceat(flags[codes], starts)
            linked = wanted & (shared * 100 >= (n[i] + m - shared) * settings.percent)
            hits = np.flatnonzero(linked)
            _, chosen = np.unique(cb[hits], return_index=True)
            out += [(rep, other) for other in b[hits[chosen]].tolist()]
        return out

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for line in range(batch.num_rows):
                row = [column[line].as_py() for column in batch.columns]
                found = pair(row[0], row[1:7], row[7:13])
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([x for x, _ in found], pa.int64()),
                        pa.array([y for _, y in found], pa.int64()),
                    ],
                    names=["a", "b"],
                )

    return run


def _member_sets(texts, classes, members, n_rows, settings, scratch) -> DataFrame:
    """Shingle sets of the classes that share a bucket with another class.

    One row of each class speaks for it.
    """
    wanted = members.select("cid").distinct()
    speakers = scratch.save(
        few_tasks(classes.join(wanted, "cid", "left_semi"), n_rows).select(
            "cid", "speaker.k1", "speaker.k2"
        ),
        "speakers",
    )
    n_sets = speakers.count()
    if n_sets <= MAX_BROADCAST_KEYS:
        # Most texts share no bucket: they stay where they are.
        speakers = F.broadcast(speakers)
    own = (
        texts.join(speakers, ["k1", "k2"])
        .select("cid", "text")
        .mapInArrow(_sets(settings.width), "cid long, shingles binary")
        .dropDuplicates(["cid"])
    )
    with _records_per_batch(texts.sparkSession, TEXT_ROWS):
        return scratch.save(few_tasks(own, n_sets, PAIRS_PER_TASK), "sets")


def _verified(
    pairs: DataFrame, sets: DataFrame, n_rows: int, settings: NearDupSettings, scratch: Scratch
) -> DataFrame:
    """The pairs (a, b) whose full sets are similar enough."""
    wanted = (
        pairs.where(_close_sizes("n", "m", settings.percent))
        .select(
            F.least("a", "b").alias("a"),
            F.greatest("a", "b").alias("b"),
            (F.col("n") + F.col("m")).alias("total"),
        )
        .distinct()
    )
    wanted = scratch.save(few_tasks(wanted, n_rows), "pairs")
    n_pairs = wanted.count()

    def asked(side: str, name: str) -> DataFrame:
        """The sets of one side of the pairs; the others do not travel."""
        some = sets.join(wanted.select(F.col(side).alias("cid")).distinct(), "cid", "left_semi")
        return some.select(F.col("cid").alias(side), F.col("shingles").alias(name))

    with_both = wanted.join(asked("a", "sa"), "a").join(asked("b", "sb"), "b")
    shared = with_both.select("a", "b", "total", shared_shingles("sa", "sb").alias("shared"))
    linked = shared.where(
        F.col("shared") * 100 >= (F.col("total") - F.col("shared")) * settings.percent
    )
    with _records_per_batch(sets.sparkSession, TEXT_ROWS):
        linked = few_tasks(linked.select("a", "b"), n_pairs, PAIRS_PER_TASK)
        return scratch.save(linked, "links")


def _placed(
    members: DataFrame, roots: DataFrame, n_rows: int, scratch: Scratch
) -> tuple[DataFrame, DataFrame]:
    """Members of buckets with several components, and each such bucket's largest one."""
    placed = (
        members.select("bucket", "cid", "n")
        .join(roots.withColumnRenamed("v", "cid"), "cid", "left")
        .select("bucket", "cid", "n", F.coalesce("root", "cid").alias("component"))
    )
    placed = scratch.save(few_tasks(placed, n_rows), "placed")
    sizes = placed.groupBy("bucket", "component").agg(
        F.count("*").alias("size"), F.sum("n").alias("shingles")
    )
    largest = F.max_by(F.struct("component", "shingles"), F.struct("size", "component"))
    main = (
        sizes.groupBy("bucket")
        .agg(
            largest.alias("largest"),
            F.sum("shingles").alias("all_shingles"),
            F.count("*").alias("n_components"),
        )
        .where("n_components > 1")
        .select(
            "bucket",
            F.col("largest.component").alias("main"),
            "all_shingles",
            (F.col("all_shingles") - F.col("largest.shingles")).alias("outside_shingles"),
        )
    )
    return placed, scratch.save(few_tasks(main, n_rows), "main")
