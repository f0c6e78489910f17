"""Shards, mixtures, licences, decontamination, search and files: small fixtures."""

import random
import struct
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from odd_rows import LONG, benchmark, documents
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from loomcast.llm.decontaminate import DecontaminateSettings, clean_documents, contamination
from loomcast.llm.license_scan import LicenseSettings, scan_licenses
from loomcast.llm.mixing import MixSettings, mixed_documents, mixture
from loomcast.llm.sharding import ShardSettings, shard_assignment, sharded_documents
from loomcast.llm.token_files import Encoder, ShardReader, TokenFileSettings, token_files, write_index
from loomcast.llm.topk import TopKSettings, top_k

TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")


def test_shards_hold_every_row_once_in_proportion(spark):
    rows = [(i, f"text {i}", "en", "hot" if i % 3 else f"s{i % 5}") for i in range(300)]
    found = shard_assignment(documents(spark, rows), ShardSettings(shards=7)).collect()
    sizes = Counter(r.shard for r in found)
    assert sorted(r.doc_id for r in found) == list(range(300))
    assert max(sizes.values()) - min(sizes.values()) <= 1
    for s, n in sizes.items():
        assert sorted(r.slot for r in found if r.shard == s) == list(range(n))
        assert abs(sum(r.source == "hot" for r in found if r.shard == s) - 200 / 7) <= 2
    assert all(r.text_crc32 == zlib.crc32(f"text {r.doc_id}".encode()) for r in found)


def test_shards_of_odd_rows(spark):
    df = documents(spark)
    out = sharded_documents(df, ShardSettings(shards=4))
    assert set(out.columns) == set(df.columns) | {"shard", "slot"}
    rows = out.collect()
    assert Counter(r.text for r in rows) == Counter(r.text for r in df.collect())
    assert len({(r.shard, r.slot) for r in rows}) == len(rows)
    null = [r for r in shard_assignment(df).collect() if r.doc_id == 3][0]
    assert (null.size, null.text_crc32) == (1, 0)
    assert shard_assignment(df.limit(0)).collect() == []
    assert sharded_documents(df.limit(0)).collect() == []


def test_mixture_follows_the_limits(spark):
    rows = [(i, "one two three", "en", "big") for i in range(400)]
    rows += [(1000 + i, "one two", "en", "small") for i in range(20)]
    found = mixture(documents(spark, rows), MixSettings(entropy=1.0, max_epochs=3.0)).collect()
    counts = Counter((r.source, r.block) for r in found)
    assert counts["big", 0] == 400 and counts["small", 0] == counts["small", 1] == 20
    assert 19 <= counts["small", 2] <= 20 and ("small", 3) not in counts
    orders = [sorted(r.order for r in found if (r.source, r.block) == ("small", b)) for b in (0, 1)]
    assert orders[0] != orders[1]
    less = mixture(documents(spark, rows), MixSettings(budget=600)).collect()
    assert 600 <= sum(r.n_tokens for r in less) <= 606


def test_mixture_of_odd_rows(spark):
    df = documents(spark)
    out = mixed_documents(df)
    assert out.columns == df.columns
    assert {r.doc_id for r in out.collect()} == {r.doc_id for r in df.collect()}
    assert mixture(df.limit(0)).collect() == []
    assert mixed_documents(df.limit(0)).collect() == []


def test_licenses(spark):
    rows = [
        (1, "some text\nReleased under the MIT License.", "en", "a"),
        (2, "RELEASED, under the 'mit' license\r\nAll rights reserved", "en", "a"),
        (3, "released under the mit\nlicense\n\nother paragraph here", "en", "a"),
        (4, "released under no license that anyone has ever seen", "en", "a"),
    ]
    odd = [tuple(r) for r in documents(spark, clashes=False).drop("n_chars").collect()]
    found = {r.doc_id: r for r in scan_licenses(documents(spark, rows)).collect()}
    assert found[1].licenses == "MIT" and found[1].best_dice == 1.0
    assert found[2].licenses == "MIT,all-rights-reserved" and found[2].n_licenses == 2
    assert found[3].licenses == "MIT"
    assert found[4].n_licenses == 0 and found[4].best_license is None
    rest = scan_licenses(documents(spark, odd)).collect()
    assert len(rest) == len(odd) and all(r.licenses == "" for r in rest)
    with pytest.raises(ValueError):
        scan_licenses(documents(spark, rows), LicenseSettings(templates=(("x", "!"),)))


def best_windows(text, templates, t=0.8):
    """Best coefficient of each licence over every window of admissible size."""
    words = "".join(c if c.isalnum() else " " for c in text.lower()).split()
    pairs, out = list(zip(words, words[1:], strict=False)), {}
    for name, template in templates:
        own = "".join(c if c.isalnum() else " " for c in template.lower()).split()
        own = list(zip(own, own[1:], strict=False))
        span, own = -int(-len(own) * (2 - t) // t), set(own)
        for i in range(len(pairs)):
            for j in range(i + 1, min(i + span, len(pairs)) + 1):
                window = set(pairs[i:j])
                dice = round(2 * len(window & own) / (len(window) + len(own)), 6)
                if dice >= t:
                    out[name] = max(dice, out.get(name, 0))
    return out


def test_licenses_inside_longer_passages(spark):
    templates = LicenseSettings().templates
    grant = next(text for name, text in templates if name == "MIT" and len(text) > 200)
    cut = grant.split()
    lines = [" ".join(cut[i : i + 9]) for i in range(0, len(cut), 9)]
    start = "Copyright (c) 2020 Jane Doe and others, who wrote this long ago. "
    rows = [
        (1, "Copyright (c) 2020 Jane Doe. All rights reserved.", "en", "a"),
        (2, start + "Released under the MIT License.", "en", "a"),
        (3, "Copyright 2020 Foo Inc. Licensed under the Apache License, Version 2.0.", "en", "a"),
        (4, "/*\n * " + start + "\n *\n" + "".join(f" * {x}\n" for x in lines) + " */", "en", "a"),
        (5, "# " + "x y z " * 40 + "\n# ".join(lines) + " and so on" * 30, "en", "a"),
        (6, "mit license " * 9 + "released under the mit license " + "under the " * 9, "en", "a"),
        (7, "all of the rights are reserved under the license of the software", "en", "a"),
        (8, "a word", "en", "a"),
    ]
    found = {r.doc_id: r for r in scan_licenses(documents(spark, rows)).collect()}
    for i, text, *_ in rows:
        want = best_windows(text, templates)
        assert found[i].licenses == ",".join(sorted(want)), i
        assert found[i].best_dice == max(want.values(), default=None)
    assert [found[i].licenses for i in (1, 2, 3, 4, 7)] == [
        "all-rights-reserved", "MIT", "Apache-2.0", "MIT", ""
    ]
    assert found[5].best_dice == found[4].best_dice == 1.0
    one = LicenseSettings(templates=(("x", "Zlib!"),))
    held = scan_licenses(documents(spark, [(1, "the zlib terms", "en", "a"), rows[7]]), one)
    assert {r.doc_id: r.licenses for r in held.collect()} == {1: "x", 8: ""}


def words_of(text):
    import re

    lower = re.sub("[A-Z]", lambda m: m.group().lower(), text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower)


def brute_contamination(docs, items, window=13, share=20):
    out = {}
    for i, text in docs:
        words, hit, names = words_of(text), set(), set()
        for item, passage in items:
            own = words_of(passage)
            n = min(window, len(own))
            windows = {tuple(own[j : j + n]) for j in range(len(own) - n + 1)} if n else set()
            for j in range(len(words) - n + 1 if n else 0):
                if tuple(words[j : j + n]) in windows:
                    hit.update(range(j, j + n))
                    names.add(str(item))
        n, h = len(words), len(hit)
        out[i] = (n, h, len(names), h > 0 and share * h >= n)
    return out


def test_contamination_equals_brute_force(spark):
    rng = random.Random(3)
    word = lambda: f"W{rng.randrange(30)}é" if rng.random() < 0.2 else f"w{rng.randrange(30)}"
    items = [(i, " ".join(word() for _ in range(rng.choice([3, 7, 12, 13, 14, 30])))) for i in range(30)]
    items += [(90, items[5][1].upper()), (91, None), (92, "?!"), (93, items[7][1])]
    docs = []
    for i in range(60):
        parts = [word() for _ in range(rng.randrange(5, 80))]
        if i % 2:
            own = items[rng.randrange(30)][1].split()
            at = rng.randrange(len(own))
            parts[3:3] = own[at:] if i % 4 == 1 else own
        docs.append((i, ", ".join(parts)))
    docs += [(100, None), (101, ""), (102, "--"), (103, LONG)]
    df = documents(spark, [(i, t, "en", "a") for i, t in docs])
    marks = benchmark(spark, items)
    found = contamination(df, marks, DecontaminateSettings()).collect()
    want = brute_contamination(docs, items)
    assert {r.doc_id: (r.n_words, r.n_hit, r.n_items, r.contaminated) for r in found} == want
    kept = clean_documents(df, marks)
    assert kept.columns == df.columns
    assert {r.doc_id for r in kept.collect()} == {i for i, x in want.items() if not x[3]}


def test_contamination_of_odd_rows(spark):
    df = documents(spark)
    passage = "quick brown fox jumps over the lazy dog"
    rows = contamination(df, benchmark(spark, [(1, passage), (1, passage)])).collect()
    assert len(rows) == df.count()
    assert {r.doc_id for r in rows if r.contaminated} == {1, 2}
    assert {r.n_items for r in rows} == {0, 1}
    assert contamination(df.limit(0), benchmark(spark, [(1, passage)])).collect() == []
    assert not any(r.n_hit for r in contamination(df, benchmark(spark, [])).collect())


def brute_top_k(vectors, k, every):
    rows = [
        (i, np.floor(256 * np.array(v, dtype=float)).astype(int))
        for i, v in vectors
        if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)
    ]
    out = []
    for q, a in rows:
        if q % every == 0:
            best = sorted((-int(a @ b), i) for i, b in rows if i != q)[:k]
            out += [(q, n + 1, i, -s) for n, (s, i) in enumerate(best)]
    return sorted(out)


@pytest.mark.parametrize("seed,blocks", [(0, 4096), (1, 16)])
def test_top_k_equals_brute_force(spark, seed, blocks):
    rng = np.random.default_rng(seed)
    vectors = [(i, rng.normal(size=9).tolist()) for i in range(120)]
    vectors += [(200 + i, vectors[10][1]) for i in range(30)]  # ties
    vectors += [(300, None), (301, [None] * 9), (302, [float("nan")] * 9), (None, [1.0] * 9)]
    vectors += [(303, [float("inf")] * 9), (305, [0.0] * 9)]
    df = spark.createDataFrame(vectors, "vec_id long, embedding array<float>")
    vectors = [(r.vec_id, r.embedding) for r in df.collect()]
    settings = TopKSettings(k=5, every=5, query_block=blocks, vector_block=blocks)
    found = top_k(df.withColumn("score", F.lit(1)).withColumn("rank", F.lit(1)), settings)
    assert sorted(map(tuple, found.collect())) == brute_top_k(vectors, 5, 5)


def test_top_k_of_few_rows(spark):
    df = spark.createDataFrame([(0, [1.0]), (1, [2.0]), (5, [2.0])], "vec_id long, embedding array<float>")
    found = sorted(map(tuple, top_k(df, TopKSettings(k=5, every=5)).collect()))
    assert found == brute_top_k([(r.vec_id, r.embedding) for r in df.collect()], 5, 5)
    assert top_k(df.limit(0)).collect() == []
    assert top_k(df.where("vec_id = 1"), TopKSettings(every=5)).collect() == []


ODD_TEXTS = [
    "", " ", "  a", "a  b ", "a\n\nb", "x \n y", "it's  don't ", "ab cd　 e", "é́ ü",
    "<|endoftext|> x <|endoftext|>", "a\x1c b\x00 c", "1,234.5  !!", "\r\n z", "end.\nNext, word.",
]


def test_pieces_encode_like_the_whole(sf_dir):
    import duckdb

    sql = f"select text from read_parquet('{sf_dir}/documents.parquet') limit 150"
    texts = ODD_TEXTS + [r[0] for r in duckdb.connect().execute(sql).fetchall()]
    encoder, plain = Encoder(TOKENIZER), Tokenizer.from_file(TOKENIZER)
    for text, ids in zip(texts, encoder.encode(texts), strict=True):
        want = plain.encode(text, add_special_tokens=False).ids
        assert np.frombuffer(ids, encoder.dtype).tolist() == want


def test_token_files_round_trip(spark, tmp_path):
    df = documents(spark)
    folder = str(tmp_path / "shards")
    rows = token_files(df, TokenFileSettings(TOKENIZER, shard_bytes=50_000), folder).collect()
    plain = Tokenizer.from_file(TOKENIZER)
    source = sorted(
        ((r.doc_id if r.doc_id is not None else -1, r.text or "") for r in df.collect())
    )
    start = 0
    rows = sorted(rows, key=lambda r: r.start)
    for (doc_id, text), r in zip(source, rows, strict=True):
        ids = plain.encode(text, add_special_tokens=False).ids + [0]
        assert (r.doc_id if r.doc_id is not None else -1) == doc_id
        assert (r.start, r.n_tokens) == (start, len(ids))
        assert r.ids_crc32 == zlib.crc32(struct.pack(f"<{len(ids)}I", *ids))
        start += len(ids)
    assert token_files(df.limit(0), TokenFileSettings(TOKENIZER)).collect() == []


def test_index_finds_its_keys_and_no_others():
    keys = np.sort(np.random.default_rng(1).integers(-(2**62), 2**62, 5000))
    keys[10:13] = keys[10]
    ids = np.arange(5000, dtype="<u2")
    reader = ShardReader(write_index(keys, np.arange(1, 5001), 2), ids.tobytes())
    assert [x.tolist() for x in reader.get(int(keys[10]))] == [[10], [11], [12]]
    assert all(reader.get(int(k))[0][0] == i for i, k in list(enumerate(keys))[20:200])
    first, _ = reader.find(keys + 1)
    assert (first >= 0).sum() <= 2
