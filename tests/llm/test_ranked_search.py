"""Ranked search against the score of every document."""

import math
import random
import re
from collections import Counter

import numpy as np
import odd_rows
import pytest

from loomcast.llm.ranked_search import SearchSettings, block_best, inverted, ranked_search

TERM = re.compile(rb"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def terms(text):
    return TERM.findall(text.encode().lower()) if text else []


def expected(docs, items, k):
    held = [(i, Counter(terms(t)), len(terms(t))) for i, t in docs if terms(t)]
    n_docs, n_terms = len(held), sum(n for _, _, n in held)
    df = Counter(t for _, counts, _ in held for t in counts)
    asked = {}
    for item, text in items:
        asked.setdefault(item, set()).update(terms(text))
    out = []
    for item, wanted in asked.items():
        found = []
        for doc, counts, n in held:
            m = 50 + (50 * n * n_docs) // n_terms
            score = 0
            for t in wanted & counts.keys():
                w = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1)))
                score += w * ((1_000_000_000 * counts[t]) // (1000 * counts[t] + 20 * m))
            if score > 0:
                found.append((-score, doc is None, doc if doc is not None else 0))
        for rank, (score, missing, doc) in enumerate(sorted(found)[:k], 1):
            out.append((item, rank, None if missing else doc, -score))
    return sorted(out, key=repr)


def corpus(n, seed=1, words=60):
    pick = random.Random(seed)
    common = ["der", "the", "été", "x1"]
    vocabulary = common * 8 + [f"t{i}" for i in range(words)]
    return [
        (i, " ".join(pick.choice(vocabulary) for _ in range(pick.randint(1, 40)))) for i in range(n)
    ]


def check(spark, docs, items, settings):
    found = ranked_search(
        spark.createDataFrame(docs, "doc_id long, text string"),
        spark.createDataFrame(items, "item_id long, text string"),
        settings,
    )
    assert found.columns == ["item_id", "rank", "doc_id", "score"]
    assert sorted((tuple(r) for r in found.collect()), key=repr) == expected(docs, items, settings.k)


ITEMS = [
    (1, "The t1, t2; t3 DER"),
    (2, "the der x1 été"),
    (3, "t9 t9 T9"),
    (4, None),
    (5, ""),
    (6, "absent entirely"),
    (7, " ".join(f"t{i}" for i in range(60)) + " the der"),
]


@pytest.mark.parametrize(
    "settings",
    [
        SearchSettings(k=5),
        SearchSettings(k=5, block_docs=64, window_docs=16, short=0.1),
        SearchSettings(k=3, block_docs=50, window_docs=7, short=0.0),
        SearchSettings(k=4, block_postings=100, window_docs=10, short=2.0),
        SearchSettings(k=1000, batch_terms=30),
    ],
)
def test_every_score(spark, settings):
    check(spark, corpus(700), ITEMS, settings)


def test_ties_repeats_and_missing_ids(spark):
    docs = [(i % 7, "the t1 t2") for i in range(40)] + [(None, "the t1 t2")] * 3
    docs += [(100 + i, "t1") for i in range(30)] + [(200, None), (201, ""), (202, ". - _")]
    items = [(1, "t1"), (1, "the"), (None, "t2"), (2, "the t1 t2")]
    for settings in (SearchSettings(k=9), SearchSettings(k=60, block_docs=8, window_docs=4)):
        check(spark, docs, items, settings)


def test_odd_rows_and_empty_tables(spark):
    docs = odd_rows.documents(spark)
    items = odd_rows.benchmark(spark, [(1, "w1 x2 fox"), (2, "ärger ÄRGER words")])
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    asked = [(r.item_id, r.text) for r in items.collect()]
    found = ranked_search(docs, items, SearchSettings(k=5))
    assert sorted((tuple(r) for r in found.collect()), key=repr) == expected(rows, asked, 5)
    none = spark.createDataFrame([], "item_id long, text string")
    assert ranked_search(docs, none).collect() == []
    assert ranked_search(spark.createDataFrame([], "doc_id long, text string"), items).collect() == []


def test_windows_out_of_reach_are_skipped(monkeypatch):
    """One rare term decides: most postings of the common lists are never summed."""
    import loomcast.llm.ranked_search as module

    n = 4096
    sizes = np.full(n, 2)
    sizes[: 64] = 3
    terms_ = np.concatenate([np.repeat([[0, 1, 2]], 64, axis=0).ravel(), np.tile([0, 1], n - 64)])
    weights = np.array([10, 12, 9000])
    block = inverted(np.full(n, 20), sizes, terms_, np.ones(len(terms_), dtype=int), weights, n, 20 * n)
    walked = []
    real = module._window

    def counted(lists, low, high, floor):
        docs, scores = real(lists, low, high, floor)
        walked.append(len(docs))
        return docs, scores

    monkeypatch.setattr(module, "_window", counted)
    docs, scores = block_best(block, np.array([0, 1, 2]), 0, SearchSettings(k=10, window_docs=256))
    assert set(docs) == set(range(64)) and len(set(scores.tolist())) == 1
    assert sum(walked) == 64
