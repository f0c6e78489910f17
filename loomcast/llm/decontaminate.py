"""Benchmark passages in documents, found by winnowing.

Schleimer, Wilkerson and Aiken, "Winnowing: Local Algorithms for Document
Fingerprinting" (2003): of every run of ``window - gram + 1`` neighbouring word
grams the smallest hash is a fingerprint. A shared run of ``window`` words holds
the same grams on both sides, so it shares a fingerprint: no such run is missed.

1. Documents and items get their fingerprints; documents that share one with an
   item are candidates.
2. Hits are extended: all grams of a candidate meet all grams of the items, and
   neighbouring matches with one offset grow into runs.
3. Runs of ``window`` words or more are what counts; their words are the hits.

Items shorter than ``window`` words carry no guarantee and are matched whole, by
one gram of their own length. Only DataFrame functions are used.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from loomcast.llm.common import Scratch, put_back, row_keys, set_aside

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
BETWEEN_WORDS = "[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+"


@dataclass(frozen=True)
class DecontaminateSettings:
    """Contaminated: at least 1 / ``share`` of the words is hit, and one at all."""

    window: int = 13
    gram: int = 8
    share: int = 20


def ascii_lower(text: Column) -> Column:
    """Lower case of A to Z alone; texts of ASCII only take the faster way."""
    plain = F.octet_length(text) == F.char_length(text)
    return F.when(plain, F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))


def word_hashes(text: Column) -> Column:
    """One hash per word; null has none."""
    words = F.array_remove(F.split(ascii_lower(F.coalesce(text, F.lit(""))), BETWEEN_WORDS), "")
    return F.transform(words, lambda w: F.xxhash64(w))


def let(value: Column, body) -> Column:
    """``body`` of a value that is computed once, however often a lambda reads it."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _places(n: Column, width: int) -> Column:
    """0 .. n - width, empty if there are fewer than ``width``."""
    return F.when(n >= width, F.sequence(F.lit(0), n - width)).otherwise(
        F.array().cast("array<int>")
    )


def grams(hashes: Column, width: int) -> Column:
    """Hash of every run of ``width`` words."""
    return let(
        hashes,
        lambda h: F.transform(
            _places(F.size(h), width), lambda i: F.xxhash64(F.slice(h, i + 1, F.lit(width)))
        ),
    )


def fingerprints(gram_hashes: Column, run: int) -> Column:
    """The smallest of every ``run`` neighbouring gram hashes."""
    return let(
        gram_hashes,
        lambda g: F.array_distinct(
            F.transform(
                _places(F.size(g), run),
                lambda i: F.array_min(F.slice(g, i + 1, F.lit(run))),
            )
        ),
    )


def contamination(
    documents: DataFrame,
    benchmark: DataFrame,
    settings: DecontaminateSettings = DecontaminateSettings(),
) -> DataFrame:
    """One row per document.

    doc_id, n_words, n_hit, n_items, items_sha256, contaminated. Null and empty
    texts have no words; null and empty items never occur. Items with equal words
    all count; an item id that repeats counts once. Rows that are equal are
    answered alike. Other columns are ignored.
    """
    scratch = Scratch(documents.sparkSession, "contamination")
    rows, results = _found(documents, benchmark, settings, scratch)
    none = F.sha2(F.lit(""), 256)
    joined = rows.select("doc_id", "k1", "k2", "n_words").join(results, ["k1", "k2"], "left")
    return joined.select(
        "doc_id",
        "n_words",
        F.coalesce("n_hit", F.lit(0).cast("long")).alias("n_hit"),
        F.coalesce("n_items", F.lit(0).cast("long")).alias("n_items"),
        F.coalesce("items_sha256", none).alias("items_sha256"),
        F.coalesce(_contaminated(settings), F.lit(False)).alias("contaminated"),
    )


def clean_documents(
    documents: DataFrame,
    benchmark: DataFrame,
    settings: DecontaminateSettings = DecontaminateSettings(),
) -> DataFrame:
    """The documents that are not contaminated, with all their columns."""
    scratch = Scratch(documents.sparkSession, "clean")
    rows, results = _found(documents, benchmark, settings, scratch)
    bad = (
        rows.select("k1", "k2", "n_words")
        .join(results, ["k1", "k2"])
        .where(_contaminated(settings))
        .select(F.col("k1").alias("_k1"), F.col("k2").alias("_k2"))
        .distinct()
    )
    bad = scratch.save(bad, "contaminated")
    renamed, own = set_aside(documents)
    k1, k2 = row_keys(own["doc_id"], own["text"])
    keyed = renamed.withColumns({"_k1": k1, "_k2": k2})
    return put_back(keyed.join(bad, ["_k1", "_k2"], "left_anti"), own)


def _contaminated(settings: DecontaminateSettings) -> Column:
    return (F.col("n_hit") > 0) & (F.col("n_hit") * settings.share >= F.col("n_words"))


def _found(documents, benchmark, settings: DecontaminateSettings, scratch: Scratch):
    """(rows with keys and word counts, results of rows with hits), both written."""
    run = settings.window - settings.gram + 1
    items = scratch.save(
        benchmark.select(
            F.col("item_id").cast("string").alias("item_id"),
            word_hashes(F.col("text")).alias("h"),
        )
        .where("size(h) > 0")
        .groupBy("h")
        .agg(F.collect_set("item_id").alias("ids"))
        .withColumn("item", F.xxhash64("h")),
        "items",
    )
    long_items = items.where(F.size("h") >= settings.window).withColumn(
        "g", grams(F.col("h"), settings.gram)
    )
    item_grams = scratch.save(
        long_items.select("item", F.posexplode("g").alias("j", "gram")), "item-grams"
    )
    item_prints = scratch.save(
        long_items.select(F.explode(fingerprints(F.col("g"), run)).alias("gram")).distinct(),
        "item-prints",
    )
    k1, k2 = row_keys("doc_id", "text")
    rows = scratch.save(
        documents.select(
            F.col("doc_id").cast("long").alias("doc_id"),
            k1.alias("k1"),
            k2.alias("k2"),
            let(
                word_hashes(F.col("text")),
                lambda h: F.struct(
                    F.size(h).cast("long").alias("n_words"),
                    fingerprints(grams(h, settings.gram), run).alias("prints"),
                ),
            ).alias("found"),
        ).select("doc_id", "k1", "k2", "found.n_words", "found.prints"),
        "rows",
    )
    candidates = scratch.save(
        rows.select("k1", "k2", F.explode("prints").alias("gram"))
        .join(item_prints, "gram", "left_semi")
        .select("k1", "k2")
        .distinct(),
        "candidates",
    )
    texts = documents.select(k1.alias("k1"), k2.alias("k2"), "text")
    own = (
        texts.join(candidates, ["k1", "k2"], "left_semi")
        .select(
            "k1",
            "k2",
            F.posexplode(grams(word_hashes(F.col("text")), settings.gram)).alias("i", "gram"),
        )
    )
    hits = own.join(item_grams, "gram").select(
        "k1", "k2", "item", (F.col("i") - F.col("j")).alias("offset"), "i"
    )
    # Equal rows hit alike; distinct makes them one.
    hits = scratch.save(hits.distinct(), "hits")
    line = Window.partitionBy("k1", "k2", "item", "offset").orderBy("i")
    runs = (
        hits.withColumn("_run", F.col("i") - F.row_number().over(line))
        .groupBy("k1", "k2", "item", "offset", "_run")
        .agg(F.min("i").alias("first"), (F.max("i") + settings.gram - 1).alias("last"))
        .where(F.col("last") - F.col("first") + 1 >= settings.window)
        .select("k1", "k2", "item", "first", "last")
    )
    runs = runs.unionByName(_short_runs(texts, items, settings, scratch))
    runs = scratch.save(runs, "runs")
    words = (
        runs.select("k1", "k2", F.explode(F.sequence("first", "last")).alias("i"))
        .distinct()
        .groupBy("k1", "k2")
        .agg(F.count("*").alias("n_hit"))
    )
    named = (
        runs.select("k1", "k2", "item")
        .distinct()
        .join(items.select("item", F.explode("ids").alias("item_id")), "item")
        .groupBy("k1", "k2")
        .agg(F.sort_array(F.collect_set("item_id")).alias("ids"))
        .select(
            "k1",
            "k2",
            F.size("ids").cast("long").alias("n_items"),
            F.sha2(F.array_join("ids", ","), 256).alias("items_sha256"),
        )
    )
    return rows, scratch.save(words.join(named, ["k1", "k2"]), "results")


def _short_runs(texts, items, settings: DecontaminateSettings, scratch: Scratch) -> DataFrame:
    """Occurrences of items with fewer words than a window, one pass per length."""
    short = items.where(F.size("h") < settings.window)
    lengths = [r[0] for r in short.select(F.size("h")).distinct().collect()]
    empty = "k1 long, k2 long, item long, first int, last int"
    found = texts.sparkSession.createDataFrame([], empty)
    for length in sorted(lengths):  # at most window - 1 of them
        wanted = scratch.save(
            short.where(F.size("h") == length).select("item", F.xxhash64("h").alias("gram")),
            "short",
        )
        found_grams = grams(word_hashes(F.col("text")), length)
        places = texts.select("k1", "k2", F.posexplode(found_grams).alias("first", "gram"))
        found = found.union(
            places.join(wanted, "gram").select(
                "k1", "k2", "item", "first", (F.col("first") + length - 1).alias("last")
            )
        )
    return found
