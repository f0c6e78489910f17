import random

import numpy as np
import pytest
from odd_rows import documents

from loomcast.llm import common, near_dup
from loomcast.llm.common import Scratch, row_keys
from loomcast.llm.components import connected_components
from loomcast.llm.near_dup import (
    NearDupSettings,
    distinct_documents,
    near_duplicates,
    shingle_set,
    super_minhash,
)


def brute(rows, width=2, percent=80):
    """Components by comparing every pair of shingle sets made of strings."""
    sets = {}
    for i, text in rows:
        words = text.encode().lower().split() if text else []
        n = min(width, len(words))
        sets[i] = {tuple(words[j : j + n]) for j in range(len(words) - n + 1)} if n else set()
    root = {i: i for i in sets}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    ids = sorted(sets)
    for i, a in enumerate(ids):
        for b in ids[i + 1 :]:
            both = len(sets[a] & sets[b])
            if sets[a] and 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both):
                x, y = sorted((find(a), find(b)))
                root[y] = x
    return {i: (len(sets[i]), find(i)) for i in ids}


def edited(rng, words, share):
    return " ".join(w if rng.random() > share else f"n{rng.randrange(10**6)}" for w in words)


@pytest.fixture(scope="module")
def family(spark):
    """A large family of copies, light and heavy edits, and unrelated texts."""
    rng = random.Random(5)
    base = [f"b{rng.randrange(400)}" for _ in range(160)]
    rows = [(i, edited(rng, base, rng.choice([0.0, 0.01, 0.03, 0.06, 0.12]))) for i in range(150)]
    rows += [(200 + i, edited(rng, base, 1.0)) for i in range(20)]
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("shingles", [100_000, 700])
def test_components_equal_brute_force(spark, family, monkeypatch, shingles):
    # Without random pivots every leftover pair goes through the blocks.
    monkeypatch.setattr(near_dup, "BLOCK_SHINGLES", shingles)
    df = documents(spark, [(i, t, "en", "a") for i, t in family])
    found = near_duplicates(df, NearDupSettings(width=2)).collect()
    want = brute(family)
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in found} == want
    assert all(r.kept == (r.doc_id == r.component_id) for r in found)
    assert len({c for _, c in want.values()}) > 21  # heavy edits stay apart


@pytest.mark.parametrize("shingles", [100_000, 700])
def test_an_id_with_several_texts(spark, family, monkeypatch, shingles):
    monkeypatch.setattr(near_dup, "BLOCK_SHINGLES", shingles)
    want = brute(family)
    # Unrelated texts and further copies under ids that are taken already.
    rng = random.Random(9)
    taken = [i for i, _ in family if i < 200][:25]
    more = [(1000 + k, f"{k} " + " ".join(f"m{k}x{j}" for j in range(90 + k))) for k in range(25)]
    more += [(2000 + k, edited(rng, text.split(), 0.002)) for k, (_, text) in enumerate(more)]
    own = dict(zip([i for i, _ in more], taken * 2, strict=True))
    rows = [(i, t, "en", "a") for i, t in family]
    rows += [(own[i], t, "en", "a") for i, t in more]
    df = documents(spark, rows, clashes=False)
    settings = NearDupSettings(width=2)
    keys = df.select("text", *[k.alias(n) for n, k in zip(["k1", "k2"], row_keys("doc_id", "text"))])
    grouped = near_dup._grouped(df, settings, Scratch(spark, "several"))
    found = grouped.join(keys.distinct(), ["k1", "k2"]).collect()
    # Every text is in the component that its own words give it.
    plain = brute(family + more)
    ids = {t: i for i, t in family + more}
    name = {}
    for i, (_, root) in plain.items():
        known = own.get(i, i)
        name[root] = min(name.get(root, known), known)
    assert len(found) == len(rows)
    assert {i: plain[i] for i in want} == want
    for r in found:
        n, root = plain[ids[r.text]]
        assert (r.n_shingles, r.component_id) == (n, name[root])
    # Unrelated texts of one id are not dropped for each other.
    kept = distinct_documents(df, settings).collect()
    assert len(kept) == len({root for _, root in plain.values()})


def test_odd_rows(spark):
    df = documents(spark)
    found = near_duplicates(df, NearDupSettings(width=2)).collect()
    assert len(found) == df.count()
    by_id = {r.doc_id: r for r in found if r.doc_id is not None}
    assert by_id[2].component_id == 1 and not by_id[2].kept
    assert by_id[7].component_id == 6 and by_id[7].n_shingles == 1
    assert by_id[9].component_id == 8
    assert all(by_id[i].n_shingles == 0 and by_id[i].component_id == i for i in (3, 4, 5))
    assert all(r.kept and r.component_id is None for r in found if r.doc_id is None)
    assert near_duplicates(df.limit(0)).collect() == []


def test_near_copies_without_an_id_are_linked(spark):
    words = [f"w{i}" for i in range(200)]
    near = " ".join([*words[:199], "other"])
    rows = [(None, " ".join(words)), (None, near), (7, " ".join([*words[:198], "x", "y"]))]
    alone = [(None, " ".join(f"v{i}" for i in range(n))) for n in (200, 199)]
    df = spark.createDataFrame(rows + alone, "doc_id long, text string")
    found = near_duplicates(df, NearDupSettings(width=2)).collect()
    assert sorted((r.component_id or 0) for r in found) == [0, 0, 7, 7, 7]
    assert distinct_documents(df, NearDupSettings(width=2)).count() == 2


def test_one_of_each_group_stays(spark):
    df = documents(spark)
    kept = distinct_documents(df)
    assert kept.columns == df.columns
    ids = sorted((r.doc_id is None, r.doc_id or 0) for r in kept.collect())
    assert [i for null, i in ids if not null] == [1, 3, 4, 5, 6, 8, 10, 11]
    assert sum(null for null, _ in ids) == 2


def test_signature_estimates_similarity():
    one = shingle_set(" ".join(f"a{i}" for i in range(1000)).encode(), 1)
    two = shingle_set(" ".join(f"a{i}" for i in range(200, 1200)).encode(), 1)
    same = super_minhash(one, 255) == super_minhash(two, 255)
    assert abs(same.mean() - 800 / 1200) < 0.1
    whole = super_minhash(one, 64)
    parts = np.minimum(super_minhash(one[:300], 64), super_minhash(one[300:], 64))
    assert (whole == parts).all()  # early stopping loses nothing


def test_workers_hold_few_texts_and_sets_at_a_time(spark, monkeypatch):
    def watched(function):
        def outer(*given):
            run = function(*given)

            def checked(batches):
                def small():
                    for batch in batches:
                        assert batch.num_rows <= 256
                        yield batch

                yield from run(small())

            return checked

        return outer

    for name in ("_signatures", "_sets"):
        monkeypatch.setattr(near_dup, name, watched(getattr(near_dup, name)))
    rng = random.Random(3)
    words = [f"b{i}" for i in range(60)]
    rows = [(i, edited(rng, words, 0.004)) for i in range(700)]
    rows += [(1000 + i, f"alone c{i} d{i} e{i}") for i in range(700)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)
    rows_per_batch = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    found = {r.doc_id: r for r in near_duplicates(docs, NearDupSettings(width=2)).collect()}
    assert spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch") == rows_per_batch
    assert sum(r.kept for i, r in found.items() if i >= 1000) == 700
    assert sum(r.kept for i, r in found.items() if i < 1000) < 20


def test_small_tables_of_many_partitions_get_few_tasks(spark, monkeypatch):
    names = []

    def save(self, df, name="step", partition_by=""):
        saved = plain(self, df, name, partition_by)
        names.append((name, saved.select("_metadata.file_path").distinct().count()))
        return saved

    plain = Scratch.save
    monkeypatch.setattr(Scratch, "save", save)
    monkeypatch.setattr(common, "LEAST_TASKS", 3)
    rng = random.Random(11)
    words = [f"b{rng.randrange(400)}" for _ in range(90)]
    rows = [(i, edited(rng, words, rng.choice([0.0, 0.01, 0.06]))) for i in range(60)]
    held = {
        "spark.sql.shuffle.partitions": "23",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
    }
    before = {k: spark.conf.get(k) for k in held}
    try:
        for k, v in held.items():
            spark.conf.set(k, v)
        out = near_duplicates(documents(spark, [(i, t, "en", "a") for i, t in rows], clashes=False))
        found = {r.doc_id: (r.n_shingles, r.component_id) for r in out.collect()}
        assert out.rdd.getNumPartitions() <= 3
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert found == brute(rows, width=5)
    # The first table has the partitions of the input; the forest those of its links.
    assert max(files for name, files in names if name != "signatures") <= 6
    # Links to one pivot need no round, and no later round confirms the last one.
    ends = [i for i, (name, _) in enumerate(names) if name == "forest"]
    assert names[ends[0] + 1][0] == "near" and names[ends[0] + 2][0] not in ("large", "near")


def test_components_of_a_chain_that_no_batch_holds(spark):
    rng = random.Random(2)
    ids = rng.sample(range(-500, 500), 120)
    edges = list(zip(ids, ids[1:], strict=False))
    edges = [e for k, e in enumerate(edges) if k != 70] * 2 + [(9000, 9000)]
    rng.shuffle(edges)
    df = spark.createDataFrame(edges, "a long, b long").repartition(4)
    with near_dup._records_per_batch(spark, 10):
        found = connected_components(df, Scratch(spark, "chain")).collect()
    parts = [set(ids[:71]), set(ids[71:])]
    assert sorted(found) == sorted((v, min(p)) for p in parts for v in p if v != min(p))
