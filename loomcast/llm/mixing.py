"""Mixing sources to target weights by temperature.

A source with token share q gets the weight q ** a / sum(q ** a). The exponent a
is bisected on [0, 1]: as large as the target entropy allows, then raised until no
source repeats more often than the limit. The token budget is the smallest that
uses every source at least once, unless one is given. A source's budget is filled
with block permutations: each block is all of the source's documents in an order
of its own, the last block is cut where the budget ends.
"""

from __future__ import annotations

from dataclasses import dataclass
from math import log

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loomcast.llm.common import Scratch, put_back, set_aside
from loomcast.llm.ranking import bucket_count, hex_bucket, with_running_total

#: Exponents are multiples of 1 / STEPS; ten halvings find one.
STEPS = 1024


@dataclass(frozen=True)
class MixSettings:
    """``entropy`` is the target as a share of log(number of sources).

    ``max_epochs`` bounds how often any source is read per reading of the least
    read one. ``budget`` is in tokens; None keeps every document at least once.
    """

    entropy: float = 0.998
    max_epochs: float = 2.0
    budget: int | None = None
    seed: str = "mix"


def n_tokens(text: Column) -> Column:
    """Words between ASCII white space, at least 1: each document costs something."""
    words = F.split(F.coalesce(text, F.lit("")), "[\\x20\\x09-\\x0D]+")
    return F.greatest(
        F.size(F.array_remove(words, "")).cast("long"), F.lit(1).cast("long")
    )


def source_key(source_col: str) -> Column:
    """Text of the source; a null source is one source of its own."""
    return F.coalesce(F.concat(F.lit("="), F.col(source_col).cast("string")), F.lit(""))


def find_exponent(sources: DataFrame, settings: MixSettings) -> float:
    """Bisection; each step sends three sums over the sources to the driver.

    The entropy falls and so do the repetitions as the exponent grows, so both
    conditions are one-sided: the largest exponent that keeps the entropy, or the
    smallest that keeps the repetition limit where that is larger.
    """
    low_row = sources.agg(F.min("tokens"), F.max("tokens"), F.count("*")).first()
    least, most, n = low_row
    if not n or least == most:
        return 1.0

    def entropy(step: int) -> float:
        weight = F.pow(F.col("tokens") / F.lit(float(most)), F.lit(step / STEPS))
        sums = sources.agg(F.sum(weight), F.sum(weight * F.log(weight))).first()
        total, logs = sums
        return float(log(total) - logs / total)

    target = settings.entropy * log(n)
    low, high = 0, STEPS
    if entropy(high) >= target:
        low = high
    while high - low > 1:
        middle = (low + high) // 2
        low, high = (middle, high) if entropy(middle) >= target else (low, middle)
    repeat_low, repeat_high = -1, STEPS
    while repeat_high - repeat_low > 1:
        middle = (repeat_low + repeat_high) // 2
        fits = (most / least) ** (1 - middle / STEPS) <= settings.max_epochs
        repeat_low, repeat_high = (repeat_low, middle) if fits else (middle, repeat_high)
    return max(low, repeat_high) / STEPS


def source_budgets(light: DataFrame, settings: MixSettings, scratch: Scratch) -> DataFrame:
    """Per source: tokens, weight, target tokens, whole blocks, tokens of the cut block."""
    sources = scratch.save(
        light.groupBy("_source").agg(F.sum("_tokens").alias("tokens")), "sources"
    )
    exponent = find_exponent(sources, settings)
    share = F.pow(F.col("tokens").cast("double"), F.lit(exponent))
    totals = sources.agg(
        F.sum(share).alias("s"), F.max(F.col("tokens") / share).alias("whole")
    ).first()
    scale = totals["whole"] or 0.0
    if settings.budget is not None:
        scale = settings.budget / totals["s"] if totals["s"] else 0.0
    # Sums of doubles depend on their order; a target is rounded to whole tokens.
    target = F.round(share * F.lit(scale), 0).cast("long")
    return scratch.save(
        sources.select(
            F.col("_source"),
            F.col("tokens"),
            F.round(share / F.lit(totals["s"] or 1.0), 9).alias("weight"),
            target.alias("target"),
        ).select(
            "*",
            F.expr("target div tokens").alias("blocks"),
            (F.col("target") % F.col("tokens")).alias("rest"),
        ),
        "budgets",
    )


def with_cutoffs(light: DataFrame, budgets: DataFrame, settings: MixSettings, scratch) -> DataFrame:
    """Budgets with the digest at which each source's cut block ends.

    The cut block takes documents in the order of its digests while the tokens
    before them are fewer than what the budget leaves; null means all of them.
    """
    n_buckets = bucket_count(light.count())
    cut = (
        light.join(budgets.where("rest > 0").select("_source", "blocks", "rest"), "_source")
        .withColumn("_digest", _digest(settings.seed, F.col("blocks"), "doc_id"))
        .withColumn("_bucket", hex_bucket(F.col("_digest"), n_buckets))
    )
    ends = (
        with_running_total(
            cut, ["_source"], "_bucket", [F.col("_digest")], F.col("_tokens"), "_before"
        )
        .where("_before >= rest")
        .groupBy("_source")
        .agg(F.min("_digest").alias("cutoff"))
    )
    return scratch.save(budgets.join(ends, "_source", "left"), "cutoffs")


def draw(rows: DataFrame, budgets: DataFrame, settings: MixSettings) -> DataFrame:
    """``rows``, which have ``_source``, once for each ``_block`` that draws them.

    Rows stay where they are: the budgets are one small row per source. Equal ids
    in one source are drawn alike.
    """
    last = _digest(settings.seed, F.col("blocks"), "doc_id")
    in_cut = (F.col("rest") > 0) & (F.col("cutoff").isNull() | (last < F.col("cutoff")))
    times = F.col("blocks") + in_cut.cast("long")
    return (
        rows.join(budgets.select("_source", "weight", "blocks", "rest", "cutoff"), "_source")
        .withColumn("_times", times)
        .where("_times > 0")
        .withColumn("_block", F.explode(F.sequence(F.lit(0).cast("long"), F.col("_times") - 1)))
    )


def _digest(seed: str, block: Column, id_col: str) -> Column:
    """Sort value of a document in a block: a permutation for each block."""
    return F.md5(
        F.concat_ws(
            "|",
            F.lit(seed),
            block.cast("string"),
            F.coalesce(F.col(id_col).cast("string"), F.lit("")),
        )
    )


def _light(documents: DataFrame, scratch: Scratch) -> DataFrame:
    return scratch.save(
        documents.select(
            F.col("doc_id").cast("long").alias("doc_id"),
            F.col("source").cast("string").alias("source"),
            source_key("source").alias("_source"),
            n_tokens(F.col("text")).alias("_tokens"),
        ),
        "light",
    )


def mixture(documents: DataFrame, settings: MixSettings = MixSettings()) -> DataFrame:
    """The mixed corpus as ids: one row per document and block it is drawn in.

    doc_id, source, n_tokens, block (from 0), order (position key in the block),
    weight (the source's target weight). Null sources form one source; null and
    empty texts cost one token. Texts are read once, for their token counts; other
    columns are ignored. An empty table gives no row.
    """
    scratch = Scratch(documents.sparkSession, "mix")
    light = _light(documents, scratch)
    budgets = with_cutoffs(light, source_budgets(light, settings, scratch), settings, scratch)
    return draw(light, budgets, settings).select(
        "doc_id",
        "source",
        F.col("_tokens").alias("n_tokens"),
        F.col("_block").alias("block"),
        _digest(settings.seed, F.col("_block"), "doc_id").alias("order"),
        "weight",
    )


def mixed_documents(documents: DataFrame, settings: MixSettings = MixSettings()) -> DataFrame:
    """The documents themselves, with their columns, as often as the mixture has them."""
    scratch = Scratch(documents.sparkSession, "mix")
    light = _light(documents, scratch)
    budgets = with_cutoffs(light, source_budgets(light, settings, scratch), settings, scratch)
    renamed, own = set_aside(documents)
    rows = renamed.withColumns(
        {
            "_source": source_key(own["source"]),
            "doc_id": F.col(own["doc_id"]).cast("long"),
        }
    )
    return put_back(draw(rows, budgets, settings), own)
