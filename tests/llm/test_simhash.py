"""SimHash groups against all pairs of fingerprints."""

import random

import numpy as np
import odd_rows
import pytest
from pyspark.sql import functions as F

from loomcast.llm.common import Scratch
from loomcast.llm.components import connected_components
from loomcast.llm.simhash import decoder, fingerprint, links, point_keys, simhash_groups


def components(prints, ids):
    """Smallest id reachable over pairs at two bits or less, all pairs compared."""
    parent = list(range(len(prints)))

    def find(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    prints = np.array(prints, dtype=np.uint64)
    for i in range(len(prints)):
        for j in np.flatnonzero(np.bitwise_count(prints ^ prints[i]) <= 2):
            a, b = find(i), find(int(j))
            parent[max(a, b)] = min(a, b)
    least = {}
    for i, own in enumerate(ids):
        if own is not None:
            root = find(i)
            least[root] = min(least.get(root, own), own)
    return [least.get(find(i)) for i in range(len(ids))]


def test_every_word_is_near_one_codeword():
    table = decoder()
    assert np.all(np.bincount(table, minlength=4096) == 2048)
    # The code is linear and has no word of weight 1 to 6.
    words = np.flatnonzero(table == table[0])
    assert np.bitwise_count(words).max() == 3


def test_fingerprints_two_bits_apart_share_a_key():
    draw = np.random.default_rng(1)
    prints = draw.integers(0, 2**64, 300, dtype=np.uint64)
    _, keys = point_keys(prints)
    assert max(len(set(row)) for row in keys.tolist()) <= 16
    for i in range(300):
        a, b = draw.choice(64, 2, replace=False).tolist()
        other = prints[i : i + 1] ^ np.uint64(1 << a) ^ np.uint64(1 << b)
        assert set(keys[i]) & set(point_keys(other)[1][0])


@pytest.mark.parametrize("text", ["A b", "a B c", "one two three four two three four", " \t", ""])
def test_fingerprint_is_the_majority_of_spark_hashes(spark, text):
    words = text.lower().split()
    n = max(1, len(words) - 2)
    shingles = [" ".join(words[i : i + 3]) for i in range(n)] if words else []
    rows = spark.createDataFrame([(s,) for s in shingles], "s string")
    hashes = [r[0] % 2**64 for r in rows.select(F.xxhash64("s")).collect()]
    bits = [sum(h >> i & 1 for h in hashes) * 2 > len(hashes) for i in range(64)]
    assert fingerprint(text.encode(), 3) == sum(1 << i for i, bit in enumerate(bits) if bit)


def test_groups_match_all_pairs(spark):
    pick = random.Random(2)
    words = [f"w{i}" for i in range(400)]
    rows = []
    for i in range(120):
        text = [pick.choice(words) for _ in range(pick.randint(1, 300))]
        rows.append((i, " ".join(text)))
        for j in range(pick.randint(0, 4)):
            copy = list(text)
            copy[pick.randrange(len(copy))] = pick.choice(words)
            rows.append((1000 + 10 * i + j, " ".join(copy)))
    check(spark, spark.createDataFrame(rows, "doc_id long, text string"))


def test_odd_rows_and_clashing_columns(spark):
    check(spark, odd_rows.documents(spark))
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert simhash_groups(empty).collect() == []


def check(spark, docs):
    rows = docs.select("doc_id", "text").collect()
    prints = [fingerprint(r.text.encode() if r.text else None, 3) for r in rows]
    roots = components(prints, [r.doc_id for r in rows])
    want = sorted(
        ((r.doc_id, f"{p:016x}", c) for r, p, c in zip(rows, prints, roots, strict=True)), key=repr
    )
    assert sorted((tuple(r) for r in simhash_groups(docs).collect()), key=repr) == want


def test_many_fingerprints_around_one_lose_no_link(spark):
    """A ball of fingerprints, most of which share keys: rows stay linear in them."""
    draw = np.random.default_rng(4)
    center = int(draw.integers(0, 2**63))
    ball = {center}
    while len(ball) < 1500:
        moved = center
        for bit in draw.choice(64, draw.integers(1, 5), replace=False).tolist():
            moved ^= 1 << bit
        ball.add(moved)
    far = {int(x) for x in draw.integers(0, 2**63, 50)}
    prints = sorted(ball | far)
    signed = np.array(prints, dtype=np.uint64).view(np.int64).tolist()
    scratch = Scratch(spark, "test")
    table = spark.createDataFrame([(p,) for p in signed], "print long")
    edges = links(table, scratch)
    assert edges.count() < 66 * len(prints)
    roots = {r.v: r.root for r in connected_components(edges, scratch).collect()}
    want = components(prints, signed)
    assert [roots.get(p, p) for p in signed] == want
