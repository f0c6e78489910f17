"""Exact top-k inner products by a three-phase uniform threshold.

Cao and Wang, "Efficient Top-K Query Calculation in Distributed Networks"
(2004), with the dimensions dealt into lists. Each list scores its own part of
every vector; a vector's score is the sum over the lists.

1. Every list hands in its best few vectors for each query, and their mean score.
   The exact scores of these few give a cutoff that the answer cannot fall below.
2. The cutoff goes back to every list with the queries, as one threshold per
   list: an even share of what the cutoff leaves above the lists' means. A vector
   below the threshold in every list is below the cutoff. The others are sent.
3. What was sent is scored exactly, and the best k remain.

Queries and vectors meet in blocks, as dense matrices. Vectors that are equal
are scored once and carry the smallest k + 1 ids, all that an answer can need.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from loomcast.llm.common import Scratch

EXACT = float(2**53)


@dataclass(frozen=True)
class TopKSettings:
    """Every row whose id is divisible by ``every`` asks for its ``k`` best rows."""

    k: int = 5
    every: int = 50
    scale: float = 256.0
    lists: int = 2
    query_block: int = 1024
    vector_block: int = 4096


def integer_vectors(vectors: DataFrame, id_col: str, vec_col: str, scale: float) -> DataFrame:
    """(vec_id, v): floor(scale * x) of each component, in double precision.

    Rows with a null id, a null vector or a null or non-finite component are left
    out.
    """
    v = F.transform(F.col(vec_col), lambda x: x.cast("double"))
    finite = F.forall(
        v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))
    )
    return (
        vectors.select(F.col(id_col).cast("long").alias("vec_id"), v.alias("v"))
        .where(F.col("vec_id").isNotNull() & F.col("v").isNotNull())
        .where(finite)
        .select("vec_id", F.transform("v", lambda x: F.floor(x * scale)).alias("v"))
    )


def top_k(
    vectors: DataFrame,
    settings: TopKSettings = TopKSettings(),
    id_col: str = "vec_id",
    vec_col: str = "embedding",
) -> DataFrame:
    """query_id, rank (from 1), vec_id, score: each query's ``k`` best other rows.

    Ties go to the smaller id; fewer rows give fewer ranks. Components that a
    shorter vector lacks count as zero. Repeated rows with one id and one vector
    count once; an id with several vectors is a row for each of them. Other
    columns are ignored.
    """
    scratch = Scratch(vectors.sparkSession, "top-k")
    rows = scratch.save(integer_vectors(vectors, id_col, vec_col, settings.scale), "integers")
    width = rows.agg(F.max(F.size("v"))).first()[0] or 0
    padded = F.concat("v", F.array_repeat(F.lit(0).cast("long"), F.lit(width) - F.size("v")))
    rows = rows.select("vec_id", padded.alias("v")).distinct()
    rank = F.row_number().over(Window.partitionBy("v").orderBy("vec_id"))
    # The rank limit cuts large groups of equal vectors before the shuffle.
    classes = scratch.save(
        rows.withColumn("rank", rank)
        .where(F.col("rank") <= settings.k + 1)
        .groupBy("v")
        .agg(F.min("vec_id").alias("cls"), F.sort_array(F.collect_list("vec_id")).alias("ids")),
        "classes",
    )
    asking = rows.where(F.col("vec_id") % settings.every == 0)
    queries = scratch.save(asking.select(F.col("vec_id").alias("query_id"), "v"), "queries")
    distinct = scratch.save(
        queries.groupBy("v").agg(F.min("query_id").alias("q")).select("q", "v"), "distinct"
    )
    best = _best_classes(distinct, classes, width, settings, scratch)

    own = queries.join(distinct, "v").select("query_id", "q")
    ranked = F.row_number().over(
        Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    )
    return (
        own.join(best, "q")
        .select("query_id", "score", F.explode("ids").alias("vec_id"))
        .where("vec_id <> query_id")
        .withColumn("rank", ranked.cast("int"))
        .where(F.col("rank") <= settings.k)
        .select("query_id", "rank", "vec_id", "score")
    )


def _best_classes(queries, classes, width: int, settings: TopKSettings, scratch) -> DataFrame:
    """(q, ids, score) of each query's best k + 1 classes, the query's own among them."""
    keep = settings.k + 1
    lists = [list(range(width))[i :: settings.lists] for i in range(settings.lists)]
    n_vec, n_query = classes.count(), queries.count()
    vec_blocks = max(1, -(-n_vec // settings.vector_block))
    query_blocks = max(1, -(-n_query // settings.query_block))
    blocks = scratch.save(_blocks(classes, "cls", vec_blocks, "block"), "blocks")
    query_packs = scratch.save(_blocks(queries, "q", query_blocks, "q_block"), "query-blocks")
    parts = blocks.select(
        "block",
        F.col("ids").alias("cls_ids"),
        F.col("values").alias("vectors"),
        F.explode(F.sequence(F.lit(0), F.lit(query_blocks - 1))).alias("q_block"),
    )

    # Phase 1: local score lists.
    met = parts.join(query_packs, "q_block").select(
        "cls_ids", "vectors", "ids", "values", F.lit(None).cast("binary").alias("floor")
    )
    local = met.mapInArrow(_scores(lists, width, keep), "q long, list int, cls long, part double")
    local = scratch.save(local, "local")
    means = (
        local.where("cls is null")
        .groupBy("q", "list")
        .agg(F.sum("part").alias("total"))
        .select("q", "list", (F.col("total") / F.lit(max(n_vec, 1))).alias("mean"))
    )
    order = Window.partitionBy("q", "list").orderBy(F.col("part").desc(), "cls")
    first = (
        local.where("cls is not null")
        .withColumn("rank", F.row_number().over(order))
        .where(F.col("rank") <= keep)
        .select("q", "cls")
        .distinct()
    )
    scored = _exact(first, queries, classes)
    ranked = F.row_number().over(Window.partitionBy("q").orderBy(F.col("score").desc(), "cls"))
    cutoff = (
        scored.withColumn("rank", ranked)
        .where(F.col("rank") <= keep)
        .groupBy("q")
        .agg(F.min("score").alias("cutoff"), F.count("*").alias("n"))
        # Fewer vectors than answers: everything is sent.
        .select("q", F.when(F.col("n") >= keep, F.col("cutoff")).alias("cutoff"))
    )
    spread = means.groupBy("q").agg(F.sum("mean").alias("sum_mean"))
    share = (F.col("cutoff") - F.col("sum_mean")) / len(lists)
    floors = (
        means.join(spread, "q")
        .join(cutoff, "q")
        .groupBy("q")
        .agg(
            F.transform(
                F.sort_array(
                    F.collect_list(
                        F.struct(
                            "list",
                            # Half a unit absorbs the rounding of means and shares.
                            F.coalesce(
                                F.col("mean") + share - 0.5, F.lit(float("-inf"))
                            ).alias("floor"),
                        )
                    )
                ),
                lambda x: x["floor"],
            ).alias("floors")
        )
    )

    # Phase 2: the cutoff travels with the queries; enough entries come back.
    with_floor = queries.join(floors, "q")
    query_packs = scratch.save(
        _blocks(with_floor, "q", query_blocks, "q_block", extra="floors"), "floors"
    )
    met = parts.join(query_packs, "q_block").select("cls_ids", "vectors", "ids", "values", "floor")
    sent = scratch.save(
        met.mapInArrow(_scores(lists, width, 0), "q long, list int, cls long, part double")
        .select("q", "cls")
        .distinct(),
        "sent",
    )

    # Phase 3: exact scores of what is left.
    return (
        _exact(sent, queries, classes)
        .withColumn("rank", ranked)
        .where(F.col("rank") <= keep)
        .join(classes.select("cls", "ids"), "cls")
        .select("q", "ids", "score")
    )


def _exact(pairs: DataFrame, queries: DataFrame, classes: DataFrame) -> DataFrame:
    """(q, cls, score) by the definition, in whole numbers."""
    product: Column = F.aggregate(
        F.zip_with("qv", "cv", lambda a, b: a * b), F.lit(0).cast("long"), lambda s, x: s + x
    )
    return (
        pairs.join(classes.select("cls", F.col("v").alias("cv")), "cls")
        .join(queries.select("q", F.col("v").alias("qv")), "q")
        .select("q", "cls", product.alias("score"))
    )


def _blocks(
    rows: DataFrame, key: str, n_blocks: int, name: str, extra: str | None = None
) -> DataFrame:
    """Rows packed into ``n_blocks`` blocks of about equal size by a hash of the key."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = [batch.column(0), batch.column(1)]
            for column in batch.columns[2:]:
                kind = np.dtype("<f8") if pa.types.is_floating(
                    column.type.value_type.value_type
                ) else np.dtype("<i8")
                flat = [
                    np.asarray(x.values.flatten(), dtype=kind).tobytes() for x in column
                ]
                columns.append(pa.array(flat, pa.binary()))
            yield pa.RecordBatch.from_arrays(columns, names=names)

    names = [name, "ids", "values"] + ["floor"] * bool(extra)
    packed = F.sort_array(
        F.collect_list(F.struct(key, "v", *([extra] if extra else [])))
    )
    grouped = rows.groupBy(
        F.pmod(F.xxhash64(key), F.lit(n_blocks)).cast("int").alias(name)
    ).agg(packed.alias("rows"))
    lists = [F.col(f"rows.{key}").alias("ids"), F.col("rows.v").alias("values")]
    schema = f"{name} int, ids array<long>, values binary"
    if extra:
        lists.append(F.col(f"rows.{extra}").alias("floor"))
        schema += ", floor binary"
    return grouped.select(name, *lists).mapInArrow(run, schema)


def _scores(lists: list[list[int]], width: int, keep: int):
    """Score lists of each block pair.

    With ``keep``: the best entries of each list and, with a null vector id, the
    sum of the list. Without: the entries that reach the query's floor.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                yield from _pair(row, lists, width, keep)

    return run


def _pair(row: dict, lists, width: int, keep: int) -> Iterator[pa.RecordBatch]:
    cls = np.array(row["cls_ids"], dtype=np.int64)
    vectors = np.frombuffer(row["vectors"], dtype="<i8").reshape(len(cls), width)
    q = np.array(row["ids"], dtype=np.int64)
    asked = np.frombuffer(row["values"], dtype="<i8").reshape(len(q), width)
    floors = None
    if not keep:
        floors = np.frombuffer(row["floor"], dtype="<f8").reshape(len(q), len(lists))
    small = width * _largest(vectors) * _largest(asked) < EXACT
    kind = np.float64 if small else np.int64
    for number, dims in enumerate(lists):
        own = vectors[:, dims].astype(kind).T
        for start in range(0, len(q), 256):
            part = q[start : start + 256]
            score = asked[start : start + 256][:, dims].astype(kind) @ own
            if keep:
                few = min(keep, len(cls))
                at = np.argpartition(-score, few - 1, axis=1)[:, :few]
                lines = np.repeat(np.arange(len(part)), few)
                yield _entries(part[lines], number, cls[at.ravel()], score[lines, at.ravel()])
                yield _entries(part, number, None, score.sum(axis=1))
            else:
                lines, at = np.nonzero(score >= floors[start : start + 256, number][:, None])
                yield _entries(part[lines], number, cls[at], score[lines, at])


def _largest(values: np.ndarray) -> float:
    return float(np.abs(values.astype(np.float64)).max()) if values.size else 0.0


def _entries(q, number: int, cls, part) -> pa.RecordBatch:
    ids = pa.nulls(len(q), pa.int64()) if cls is None else pa.array(cls)
    return pa.RecordBatch.from_arrays(
        [
            pa.array(q),
            pa.array(np.full(len(q), number, np.int32)),
            ids,
            pa.array(np.asarray(part, dtype=np.float64)),
        ],
        names=["q", "list", "cls", "part"],
    )
