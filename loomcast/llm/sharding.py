"""Shards that all have the corpus's mixture: proportional stratified interleaving.

Rows of a source are shuffled by a seeded digest and ranked; rank r of n rows has
the fractional rank (2 r - 1) / (2 n). In the order of fractional ranks every
source is spread evenly, so cutting that order into equal pieces gives each shard
every source in proportion, within one row.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loomcast.llm.common import Scratch, set_aside
from loomcast.llm.ranking import bucket_count, hex_bucket, with_running_total


@dataclass(frozen=True)
class ShardSettings:
    shards: int = 16
    seed: str = "shard"


def shuffle_digest(seed: str, *columns: str) -> Column:
    """Hexadecimal digest of the seed and the columns as text; null is empty."""
    parts = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in columns]
    return F.md5(F.concat_ws("|", F.lit(seed), *parts))


def interleave(
    rows: DataFrame,
    settings: ShardSettings,
    scratch: Scratch,
    id_col: str = "doc_id",
    source_col: str = "source",
) -> DataFrame:
    """The rows with ``_shard`` and ``_slot``; sizes differ by one row at most.

    A null source is a source of its own. Equal digests (repeated rows) are
    ordered by their columns' hash; which of two equal rows comes first does not
    show. ``rows`` must be a written table: it is read for the counts and again
    for the ranks.
    """
    source = F.coalesce(F.concat(F.lit("="), F.col(source_col).cast("string")), F.lit(""))
    n = rows.count()
    buckets = bucket_count(n)
    # A digest cannot order columns that have no order (maps), so they are hashed as JSON.
    tie = F.xxhash64(F.to_json(F.struct(*[F.col(c) for c in rows.columns])))
    keyed = (
        rows.withColumn("_source", source)
        .withColumn("_digest", shuffle_digest(settings.seed, id_col))
        .withColumn("_tie", tie)
        .withColumn("_bucket", hex_bucket(F.col("_digest"), buckets))
    )
    keyed = scratch.save(
        with_running_total(
            keyed,
            ["_source"],
            "_bucket",
            [F.col("_digest"), F.col("_tie")],
            F.lit(1).cast("long"),
            "_rank",
        ),
        "ranks",
    )
    # A written table has a known size, so that a small one is broadcast.
    sizes = scratch.save(keyed.groupBy("_source").agg(F.count("*").alias("_size")), "sizes")
    placed = keyed.join(sizes, "_source").withColumn(
        "_fraction", (2 * F.col("_rank") + 1) / (2 * F.col("_size"))
    )
    placed = placed.withColumn("_bucket", F.floor(F.col("_fraction") * buckets)).withColumn(
        "_all", F.lit(0)
    )
    ordered = with_running_total(
        placed,
        ["_all"],
        "_bucket",
        [F.col("_fraction"), F.col("_digest"), F.col("_source"), F.col("_tie")],
        F.lit(1).cast("long"),
        "_position",
    )
    shard = F.expr(f"cast(_position * {settings.shards} div {max(n, 1)} as int)")
    first = F.expr(f"(_shard * {n}L + {settings.shards - 1}L) div {settings.shards}L")
    return (
        ordered.withColumn("_shard", shard)
        .withColumn("_slot", F.col("_position") - first)
        .drop(
            "_source", "_digest", "_tie", "_bucket", "_rank", "_size", "_fraction", "_all",
            "_position",
        )
    )


def whole_row_keys(columns: list[str]) -> tuple[Column, Column]:
    """128 bits that are equal for rows with equal values in all columns."""
    whole = F.to_json(F.struct(*columns))
    return F.xxhash64(whole), F.xxhash64(F.lit(1), whole)


def sharded_documents(
    documents: DataFrame, settings: ShardSettings = ShardSettings()
) -> DataFrame:
    """The documents with all their columns, ``shard`` and ``slot``.

    Rows that are equal in every column share their places among them, so each
    distinct row moves once, to where its places are, and is repeated there. An
    own column named shard or slot is replaced.
    """
    scratch = Scratch(documents.sparkSession, "shards")
    renamed, own = set_aside(documents)
    k1, k2 = whole_row_keys(renamed.columns)
    renamed = renamed.withColumns({"_k1": k1, "_k2": k2})
    light = scratch.save(
        renamed.select(
            "_k1",
            "_k2",
            F.col(own["doc_id"]).cast("long").alias("doc_id"),
            F.col(own["source"]).cast("string").alias("source"),
        ),
        "light",
    )
    places = scratch.save(
        interleave(light, settings, scratch).select("_k1", "_k2", "_shard", "_slot"), "places"
    )
    rows = renamed.dropDuplicates(["_k1", "_k2"])
    kept = [c for c in documents.columns if c not in ("shard", "slot")]
    return rows.join(places, ["_k1", "_k2"]).select(
        *[F.col(own[c]).alias(c) for c in kept],
        F.col("_shard").alias("shard"),
        F.col("_slot").alias("slot"),
    )


def shard_assignment(
    documents: DataFrame, settings: ShardSettings = ShardSettings()
) -> DataFrame:
    """One row per document: where it goes.

    doc_id, size (UTF-8 bytes plus 1), text_crc32 (a null text counts as empty),
    law ``rows``, shard, slot (from 0 without gaps), grown_shard (null: this law
    has none), source. Texts are read once and do not move; other columns are
    ignored.
    """
    scratch = Scratch(documents.sparkSession, "shards")
    raw = F.coalesce(F.col("text").cast("binary"), F.lit("").cast("binary"))
    light = scratch.save(
        documents.select(
            F.col("doc_id").cast("long").alias("doc_id"),
            F.col("source").cast("string").alias("source"),
            (F.octet_length(raw).cast("long") + 1).alias("size"),
            F.crc32(raw).alias("text_crc32"),
        ),
        "light",
    )
    return interleave(light, settings, scratch).select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("rows").alias("law"),
        F.col("_shard").alias("shard"),
        F.col("_slot").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
        "source",
    )
