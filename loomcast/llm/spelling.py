"""Spelling variants of words by a frontier walking a distributed trie.

Words that differ by one code point agree on their first half or on their last, so
each word enters the trie twice, as spelled and reversed, and its walk starts at
the node of its own first half: the crowded top of the trie is never entered with
an edit to spend.

1. The edge table holds (level, parent, label, child). Nodes are hashes of prefixes.
   Below a child that one word alone passes, the edge is a tail that names the
   word; other edges carry a 64-bit sketch of the rests of the words below.
   Labels are single code points down to ``SINGLE`` and then double in width, so
   that long words need few levels.
2. A state (word, position, node, edits) joins the edges of its level. Without an
   edit it meets all children of its node; with one it follows the edge that spells
   its own next label. A new state must find its rest in the edge's sketch. A tail
   is compared at once and ends the walk: a one-edit match is a neighbour.
3. Deletions and replacements by a larger code point are walked; insertions and the
   other replacements are the same pairs seen from the neighbour.

States of a hot node are spread by adaptive execution, as the edges of a node are
few (one per code point that follows it); no step gathers words that share a node.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loomcast.llm.common import Scratch, slices

SINGLE = 32
#: Distinct words that a task sums up before it hands them on.
HELD = 200_000


@dataclass(frozen=True)
class SpellingSettings:
    """Words have ``min_length`` code points and ``min_count`` occurrences at least.

    Of about every ``typo_every``-th (document, run) one code point is deleted
    first (0: never), which plants variants. A form is ``ratio`` times as frequent.
    """

    min_length: int = 7
    min_count: int = 2
    typo_every: int = 31
    ratio: int = 10


def bounds(longest: int) -> list[int]:
    """Depths at which levels begin, ending beyond the longest word."""
    out, width = list(range(SINGLE + 1)), 2
    while out[-1] <= longest:
        out.append(out[-1] + width)
        width *= 2
    return out


def vocabulary(
    documents: DataFrame,
    settings: SpellingSettings = SpellingSettings(),
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """(word, n) of the words that are long and frequent enough."""
    texts = documents.select(
        F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary").alias("id"),
        F.col(text_col).cast("binary").alias("text"),
    )
    counted = texts.mapInArrow(_counted(settings), "word string, n long")
    return counted.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= settings.min_count)


def _counted(settings: SpellingSettings):
    """Occurrences of the words in the texts, summed as far as ``HELD`` words go."""
    least = settings.min_length
    runs = re.compile(f"[a-z\u00C0-\u00FF]{{{least},}}")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter[str] = Counter()
        for batch in batches:
            ids, texts = batch.columns
            lengths = [range(n or 0) for n in pc.binary_length(texts).to_pylist()]
            for start, end in slices(lengths):
                part = (c.slice(start, end - start).to_pylist() for c in (ids, texts))
                for doc_id, raw in zip(*part, strict=True):
                    found = runs.findall(raw.lower().decode("utf-8", "replace")) if raw else []
                    if not settings.typo_every:
                        counts.update(found)
                        continue
                    begun = zlib.crc32(doc_id + b":")
                    for word, n in Counter(found).items():
                        h = zlib.crc32(word.encode(), begun)
                        if h % settings.typo_every == 0:
                            at = h % len(word)
                            word = word[:at] + word[at + 1 :]
                            if len(word) < least:
                                continue
                        counts[word] += n
                if len(counts) > HELD:
                    yield _word_batch(counts)
                    counts = Counter()
        if counts:
            yield _word_batch(counts)

    return run


def _word_batch(counts: Counter[str]) -> pa.RecordBatch:
    words = pa.array(list(counts), pa.string())
    return pa.RecordBatch.from_arrays([words, pa.array(counts.values(), pa.int64())], names=["word", "n"])


def spelling_variants(
    documents: DataFrame,
    settings: SpellingSettings = SpellingSettings(),
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """One row per word: ``word``, ``form``, ``root``, ``n``, ``n_near``, ``form_n``.

    ``n_near`` counts the words at one inserted, deleted or replaced code point;
    ``form`` is the most frequent of them (ties: the smallest in code-point order)
    if it is ``ratio`` times as frequent as the word, and ``root`` the end of the
    chain of forms. Null and empty texts have no words, an empty table no rows; a
    null id counts as an empty string before the colon; repeated rows count each
    time. Other columns are ignored.
    """
    scratch = Scratch(documents.sparkSession, "spelling")
    words = scratch.save(vocabulary(documents, settings, id_col, text_col), "words")
    return _with_roots(_forms(words, near_pairs(words, scratch), settings), scratch)


def near_pairs(words: DataFrame, scratch: Scratch) -> DataFrame:
    """(a, a_n, b, b_n) of words one edit apart, each pair at least once in one order."""
    shortest, longest = words.agg(
        F.min(F.char_length("word")), F.max(F.char_length("word"))
    ).first()
    if longest is None:
        shortest, longest = 0, 0
    depths = bounds(longest)
    entered = words.select(
        F.col("n"),
        F.explode(
            F.array(
                F.struct(F.lit(0).alias("dir"), F.col("word").alias("x")),
                F.struct(F.lit(1).alias("dir"), F.reverse("word").alias("x")),
            )
        ).alias("e"),
    ).select("e.dir", "e.x", "n")
    entered = entered.withColumn("start", _start(depths))
    entered = scratch.save(entered, "entered", partition_by="start")
    edges = scratch.save(_edges(entered, depths), "edges", partition_by="level")

    # Depths come from columns and not as numbers, so that all levels share their code.
    at = F.element_at(F.array(*[F.lit(d) for d in depths]), F.col("start") + 1)
    starts = entered.select(
        "dir", "x", "n", at.alias("i"), _node(at).alias("node"), F.lit(0).alias("edits"), "start"
    )
    first, last = _level_of(depths, shortest // 2), _level_of(depths, longest // 2)
    frontier, reached = None, []
    for level in range(first, len(depths) - 1):
        states = starts.where(F.col("start") == level).drop("start")
        if frontier is not None:
            states = states.union(frontier)
        step = _step(states, edges.where(F.col("level") == level), depths, level)
        reached.append(scratch.save(step, f"level-{level}"))
        frontier = (
            reached[-1]
            .where("other is null")
            .select("dir", "x", "n", "i", "node", "edits")
        )
        if level >= last and frontier.isEmpty():
            break
    paths = [frame._scratch_path for frame in reached]
    found = words.sparkSession.read.schema(reached[0].schema).parquet(*paths)
    found = found.where("other is not null")
    spelled = lambda c: F.when(F.col("dir") == 1, F.reverse(c)).otherwise(F.col(c))
    return found.select(
        spelled("x").alias("a"),
        F.col("n").alias("a_n"),
        spelled("other").alias("b"),
        F.col("other_n").alias("b_n"),
    ).where(F.levenshtein("a", "b", 1) == 1)


def _level_of(depths: list[int], depth: int) -> int:
    """Level of the deepest bound that is not beyond ``depth``."""
    return max(level for level, bound in enumerate(depths) if bound <= depth)


def _start(depths: list[int]) -> Column:
    """Level of the deepest bound within the word's first half."""
    half = F.floor(F.char_length("x") / 2).cast("int")
    out = F.least(half, F.lit(SINGLE))
    for level in range(SINGLE + 1, len(depths)):
        out = F.when(half >= depths[level], level).otherwise(out)
    return out.cast("int")


def _node(depth: Column) -> Column:
    return F.xxhash64("dir", F.substring("x", F.lit(1), depth))


def _bit(rest: Column) -> Column:
    """The sketch's bit of a rest: a word below sets it, a state looks it up."""
    place = F.pmod(F.xxhash64(rest), F.lit(64)).cast("int")
    return F.call_function("shiftleft", F.lit(1).cast("long"), place)


def _edges(entered: DataFrame, depths: list[int]) -> DataFrame:
    """(level, parent, label, child, below, word, word_n) of both tries.

    A word has edges from the level at which its walk starts. ``word`` is set on
    tails: a word that ends within the label, or the only one that goes on.
    """
    ends = F.array(*[F.lit(d) for d in depths])
    last = sum(
        (F.when(F.char_length("x") > d, 1).otherwise(0) for d in depths[SINGLE + 1 :]),
        F.least(F.char_length("x"), F.lit(SINGLE + 1)),
    )
    passed = entered.select(
        "dir", "x", "n", F.explode(F.sequence(F.col("start"), (last - 1).cast("int"))).alias("level")
    ).select(
        "dir",
        "x",
        "n",
        "level",
        F.element_at(ends, F.col("level") + 1).alias("depth"),
        F.element_at(ends, F.col("level") + 2).alias("next"),
    )
    ended = F.char_length("x") <= F.col("next")
    child = F.when(~ended, _node(F.col("next")))
    rest = F.substring("x", F.col("next") + 1, F.char_length("x"))
    grouped = (
        passed.select(
            "level",
            _node(F.col("depth")).alias("parent"),
            F.substring("x", F.col("depth") + 1, F.col("next") - F.col("depth")).alias("label"),
            child.alias("child"),
            # A word that ends here stands alone even if two nodes share a hash.
            F.when(ended, F.col("x")).alias("ending"),
            "x",
            "n",
            _bit(rest).alias("bit"),
        )
        .groupBy("level", "parent", "label", "child", "ending")
        .agg(
            F.min("x").alias("x"),
            F.min("n").alias("n"),
            F.bit_or("bit").alias("below"),
            F.count("*").alias("n_words"),
        )
    )
    alone = F.col("n_words") == 1
    return grouped.select(
        "parent",
        "label",
        F.when(~alone, F.col("child")).alias("child"),
        "below",
        F.when(alone, F.col("x")).alias("word"),
        F.when(alone, F.col("n")).alias("word_n"),
        "level",
    )


def _step(states: DataFrame, edges: DataFrame, depths: list[int], level: int) -> DataFrame:
    """States one level deeper, and the neighbours met on tails (``other`` is set).

    What a state compares is cut out of its word before the join, and the joins keep
    only the edges that lead on: most children of a node are met and left there.
    """
    width = depths[level + 1] - depths[level]
    following = F.element_at(F.array(*[F.lit(d) for d in depths]), F.col("level") + 2)
    edges = edges.withColumns(
        {
            "tail": F.substring("word", following + 1, F.char_length("word")),
            "word_size": F.char_length("word"),
        }
    ).drop("level")
    size, at = F.char_length("x"), F.col("i")
    states = states.withColumns(
        {
            "size": size,
            "own": F.substring("x", at + 1, F.lit(width)),
            "rest": F.substring("x", at + 1 + width, size),
            "bit": F.when(at + width <= size, _bit(F.substring("x", at + 1 + width, size))),
        }
    )
    is_tail = F.col("word").isNotNull()
    below = F.col("below").bitwiseAND(F.col("bit")) != 0

    def state(i: Column, edits: int) -> Column:
        return F.struct(
            i.cast("int").alias("i"),
            F.col("child").alias("node"),
            F.lit(edits).alias("edits"),
            F.lit(None).cast("string").alias("other"),
            F.lit(None).cast("long").alias("other_n"),
        )

    pair = F.struct(
        F.lit(None).cast("int").alias("i"),
        F.lit(None).cast("long").alias("node"),
        F.lit(None).cast("int").alias("edits"),
        F.col("word").alias("other"),
        F.col("word_n").alias("other_n"),
    )

    def out(rows: DataFrame, *options: tuple[Column, Column]) -> DataFrame:
        found = F.array_compact(F.array(*[F.when(test, made) for test, made in options]))
        return rows.select("dir", "x", "n", F.explode(found).alias("to")).select(
            "dir", "x", "n", "to.i", "to.node", "to.edits", "to.other", "to.other_n"
        )

    # One edit spent: only the edge that spells the next label.
    met = (F.col("node") == F.col("parent")) & (F.col("own") == F.col("label"))
    leads = (is_tail & (F.col("rest") == F.col("tail"))) | (~is_tail & below)
    spent = out(
        states.where("edits = 1").join(edges, met & leads).drop("node"),
        (is_tail, pair),
        (~is_tail, state(at + width, 1)),
    )

    # None spent: every edge of the node.
    fresh = states.where("edits = 0").withColumns(
        {
            "longer": F.substring("x", at + 1, F.lit(width + 1)),
            "second": F.substring("x", at + 2, F.lit(width)),
            "rest_2": F.substring("x", at + 2 + width, size),
            "bit_2": F.when(at + 1 + width <= size, _bit(F.substring("x", at + 2 + width, size))),
        }
    )
    below_2 = F.col("below").bitwiseAND(F.col("bit_2")) != 0
    same = F.col("label") == F.col("own")
    greater = F.col("label") > F.col("own")
    equal_size = F.col("word_size") == F.col("size")
    shorter = F.col("word_size") == F.col("size") - 1
    if width == 1:
        replaced, deleted = greater, ~same & (F.col("label") == F.col("second"))
        on_tail = (
            (same & (equal_size | shorter))
            | (replaced & equal_size & (F.col("tail") == F.col("rest")))
            | (deleted & shorter & (F.col("tail") == F.col("rest_2")))
        )
    else:
        # A label ends early where its word does; such a word is a tail.
        full = F.char_length("label") == width
        replaced = greater & full & (F.levenshtein("label", "own", 1) == 1)
        deleted = ~same & full & (F.levenshtein("label", "longer", 1) == 1)
        on_tail = equal_size | shorter
    leads = (is_tail & on_tail) | (
        ~is_tail & (same | (replaced & below) | (deleted & below_2))
    )
    fresh = fresh.join(edges, (F.col("node") == F.col("parent")) & leads).drop("node")
    left = F.substring("x", at + 1, F.col("size"))
    theirs = F.substring("word", at + 1, F.col("size"))
    larger = equal_size & (F.col("word") > F.col("x"))
    fresh = out(
        fresh,
        (is_tail & (larger | shorter) & (F.levenshtein(theirs, left, 1) == 1), pair),
        (~is_tail & same, state(at + width, 0)),
        (~is_tail & replaced & below, state(at + width, 1)),
        (~is_tail & deleted & below_2, state(at + width + 1, 1)),
    )
    return spent.union(fresh)


def _forms(words: DataFrame, pairs: DataFrame, settings: SpellingSettings) -> DataFrame:
    """(word, n, n_near, form, form_n): one shuffle of the words and both ways of a pair.

    A word's neighbours are gathered as a set: at most one per position and code
    point of the alphabet, however many words there are.
    """
    near = lambda n, b: F.struct((-F.col(n)).alias("neg"), F.col(b).alias("b"))
    ways = [
        F.struct(F.col(a).alias("word"), near(f"{b}_n", b).alias("near"))
        for a, b in (("a", "b"), ("b", "a"))
    ]
    both = pairs.select(F.explode(F.array(*ways)).alias("p")).select(
        "p.word", F.lit(None).cast("long").alias("n"), "p.near"
    )
    near_type = both.schema["near"].dataType
    own = words.select("word", "n", F.lit(None).cast(near_type).alias("near"))
    grouped = (
        own.union(both)
        .groupBy("word")
        .agg(
            F.max("n").alias("n"),
            F.collect_set("near.b").alias("set"),
            F.min("near").alias("best"),
        )
    )
    best_n = -F.col("best.neg")
    strong = best_n >= settings.ratio * F.col("n")
    return grouped.select(
        "word",
        "n",
        F.size("set").cast("long").alias("n_near"),
        F.when(strong, F.col("best.b")).alias("form"),
        F.when(strong, best_n).alias("form_n"),
    )


def _with_roots(forms: DataFrame, scratch: Scratch) -> DataFrame:
    """Follows forms by doubling the jump: each is several times as frequent as the
    one before, so the chains are short and have no loops."""
    forms = scratch.save(forms, "forms")
    jumps = forms.where("form is not null").select("word", F.col("form").alias("root"))
    while True:
        onward = jumps.select(F.col("word").alias("root"), F.col("root").alias("further"))
        met = jumps.join(onward, "root", "left")
        jumps = scratch.save(
            met.select("word", F.coalesce("further", "root").alias("root"), "further"), "jumps"
        )
        if jumps.where("further is not null").isEmpty():
            break
        jumps = jumps.drop("further")
    return forms.join(jumps.drop("further"), "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )
