"""Spelling variants against all pairs of words."""

import random
import zlib
from collections import Counter

import odd_rows
import pytest
import regex

from loomcast.llm.common import Scratch
from loomcast.llm.spelling import SINGLE, SpellingSettings, bounds, near_pairs, spelling_variants

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def one_edit(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    short, long = sorted((a, b), key=len)
    return len(long) - len(short) == 1 and any(
        long[:i] + long[i + 1 :] == short for i in range(len(long))
    )


def expected(rows, s=SpellingSettings()):
    counts = Counter()
    for doc_id, text in rows:
        for run in regex.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(LOWER)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if s.typo_every and h % s.typo_every == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            counts[run] += 1
    words = {w: n for w, n in counts.items() if len(w) >= s.min_length and n >= s.min_count}
    form, near = {}, {}
    for word, n in words.items():
        near[word] = [v for v in words if one_edit(word, v)]
        best = min(near[word], key=lambda v: (-words[v], v), default=None)
        form[word] = best if best and words[best] >= s.ratio * n else None
    out = []
    for word, n in words.items():
        root = word
        while form[root]:
            root = form[root]
        out.append((word, form[word], root, n, len(near[word]), words.get(form[word])))
    return sorted(out)


def found(spark, rows, settings=SpellingSettings()):
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    result = spelling_variants(docs, settings)
    assert result.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    return sorted(tuple(row) for row in result.collect())


def test_every_place_and_kind_of_edit(spark):
    pick = random.Random(3)
    rows, alphabet = [], "abéÿ"
    for i in range(60):
        word = "".join(pick.choice(alphabet) for _ in range(pick.randint(6, 9)))
        variants = [word]
        for _ in range(4):
            at = pick.randrange(len(word))
            variants.append(word[:at] + word[at + 1 :])
            variants.append(word[:at] + pick.choice(alphabet) + word[at:])
            variants.append(word[:at] + pick.choice(alphabet) + word[at + 1 :])
        rows += [(i, " ".join([*variants, *[word.upper()] * 30])), (1000 + i, "-".join(variants))]
    settings = SpellingSettings(typo_every=0)
    result = found(spark, rows, settings)
    assert result == expected(rows, settings)
    assert any(row[1] for row in result) and any(row[4] > 5 for row in result)


def test_long_words_and_words_within_words(spark):
    pick = random.Random(5)
    long = "".join(pick.choice("abcdefgh") for _ in range(3 * SINGLE))
    words = [long, long[:-1], long[1:], long + "x", long[:70] + "z" + long[71:], long[:40] + long[41:]]
    words += ["a" * n for n in range(7, 60)]
    words += [("ab" * 40)[:n] for n in (30, 31, 32, 33, 34, 35, 61, 62, 63, 64, 65)]
    giant = "".join(pick.choice("abcdefghijkl") for _ in range(9000))
    words += [giant, giant[:5000] + giant[5001:], giant[:8000] + "y" + giant[8000:]]
    rows = [(1, " ".join(words)), (2, " ".join(words))]
    settings = SpellingSettings(typo_every=0)
    assert found(spark, rows, settings) == expected(rows, settings)


def test_planted_typos_and_odd_rows(spark):
    base = [(row[0], row[1]) for row in odd_rows.ROWS]
    rows = base + [(i, "Fernsehen wichtige Nachrichten Übertragung, Fernsehen") for i in range(400)]
    rows += [(None, "Nachrichten Nachrichtem Nachrichtem")]
    result = found(spark, rows)
    assert result == expected(rows)
    assert {row[1] for row in result} >= {"nachrichten", "fernsehen"}


def test_chains_of_forms(spark):
    words = {"abcdefgh": 2, "abcdefgx": 20, "abcdefyx": 200, "abcdezyx": 2000}
    rows = [(1, " ".join(w for w, n in words.items() for _ in range(n)))]
    result = {row[0]: row for row in found(spark, rows, SpellingSettings(typo_every=0))}
    assert result["abcdefgh"][1:3] == ("abcdefgx", "abcdezyx")


def test_hot_beginnings_meet_no_square(spark):
    words = [f"anfang{a}{b}{c}" for a in "abcdefghijkl" for b in "mnopqrst" for c in "uvwxyz"]
    rows = [(1, " ".join(words * 2))]
    settings = SpellingSettings(typo_every=0)
    assert found(spark, rows, settings) == expected(rows, settings)
    table = spark.createDataFrame([(w, 2) for w in words], "word string, n long")
    pairs = near_pairs(table, Scratch(spark, "test"))
    assert pairs.count() == sum(one_edit(a, b) for a in words for b in words) // 2


def test_empty_table_and_clashing_columns(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert spelling_variants(empty).collect() == []
    docs = odd_rows.documents(spark)
    rows = [(row.doc_id, row.text) for row in docs.select("doc_id", "text").collect()]
    assert sorted(tuple(r) for r in spelling_variants(docs).collect()) == expected(rows)


@pytest.mark.parametrize("longest", [0, 7, SINGLE, SINGLE + 1, 100, 10_000])
def test_bounds_reach_beyond_the_longest(longest):
    depths = bounds(longest)
    assert depths[-1] > longest and depths == sorted(set(depths))
    assert len(depths) < SINGLE + 16
