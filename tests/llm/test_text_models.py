"""Operators that learn: held-out accuracy and defined results for odd rows."""

import hashlib
import zlib

import numpy as np
import pytest
from odd_rows import documents, labels
from pyspark.sql import functions as F

from loomcast.llm import quality
from loomcast.llm.language_id import (
    BITS,
    LanguageSettings,
    _counted,
    identify_languages,
    kneser_ney,
    ngram_hash,
    ngrams,
)
from loomcast.llm.language_id import encode as encode_letters
from loomcast.llm.pii import base_spans, label_model, personal_data, span_classifier, span_code
from loomcast.llm.quality import features, good_documents, quality_scores
from loomcast.llm.queries import QUERIES


def test_quality_on_held_out_rows(spark, sf_dir):
    scores = QUERIES["op3_ftrl_quality"](spark, sf_dir)
    marks = spark.read.parquet(f"{sf_dir}/labels.parquet")
    rows = scores.where("held_out").join(marks, "doc_id").collect()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in rows)
    assert np.mean([r.predicted == r.quality for r in rows]) > 0.95


def test_quality_of_odd_rows(spark):
    df = documents(spark)
    marks = labels(spark, [(1, 1, 0), (6, 0, 0), (8, 1, 0), (10, None, 0), (None, 1, 0)])
    rows = quality_scores(df, marks).collect()
    assert len(rows) == df.count() and all(0 <= r.score <= 1 for r in rows)
    assert len({r.score for r in rows if r.doc_id in (3, 4, 5)}) == 1
    assert {r.score for r in quality_scores(df, marks.limit(0)).collect()} == {0.5}
    assert quality_scores(df.limit(0), marks).collect() == []
    assert good_documents(df, marks).columns == df.columns


def test_languages_on_held_out_rows(spark, sf_dir):
    found = QUERIES["op10_kneser_ney_language"](spark, sf_dir)
    known = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "lang")
    rows = found.where("held_out").join(known, "doc_id").collect()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in rows)
    assert np.mean([r.lang_pred == r.lang for r in rows]) > 0.97


def test_languages_of_odd_rows(spark):
    df = documents(spark).withColumn(
        "text", F.when(F.col("doc_id") == 6, "12 + 3!").otherwise(F.col("text"))
    )
    rows = {r.doc_id: r for r in identify_languages(df).collect()}
    assert all(rows[i].lang_pred == "und" and rows[i].score == 0 for i in (3, 4, 5, 6))
    assert rows[8].lang_pred in ("en", "de") and 0 <= rows[8].score <= 1
    nothing = identify_languages(df.withColumn("lang", F.lit(None).cast("string"))).collect()
    assert {r.lang_pred for r in nothing} == {"und"}
    assert identify_languages(df.limit(0)).collect() == []


WORDS = {
    "uk": "і він ївши їжу від ліс місто яких були після її дівчина вітер сніг рік",
    "ru": "и он ещё был лес город которые было после её девушка ветер снег год мы",
    "ja": "これは とても ながい みち です やま かわ そら うみ ひと カタカナ",
    "ko": "나는 오늘 학교에 갔다 바람이 분다 우리 나라 사람 하늘 바다 산",
    "zh": "我们 今天 学校 天空 大海 山水 人民 国家 城市 森林 春风",
}


def scripts(spark):
    """Short texts, 40 a language; the language of every third is held out by its id."""
    rng = np.random.default_rng(7)
    rows = []
    for k, (lang, words) in enumerate(WORDS.items()):
        for i in range(40):
            rows.append((100 * k + i, " ".join(rng.choice(words.split(), 3)), lang, "a"))
    return documents(spark, rows, clashes=False)


def test_languages_of_other_scripts(spark):
    df = scripts(spark)
    rows = identify_languages(df).join(df.select("doc_id", "lang"), "doc_id").collect()
    held = [r for r in rows if r.held_out]
    assert len(held) > 40 and all(r.lang_pred == r.lang for r in held)


def test_joined_and_broadcast_tables_give_the_same(spark):
    df = scripts(spark).unionByName(documents(spark, clashes=False))
    one = identify_languages(df).collect()
    two = identify_languages(df, LanguageSettings(broadcast_bytes=0)).collect()
    assert len(one) == len(two) == df.count()
    key = lambda r: (r.doc_id is None, r.doc_id, r.bits if r.bits == r.bits else -1)
    for a, b in zip(sorted(one, key=key), sorted(two, key=key)):
        assert (a.doc_id, a.lang_pred, a.rejected) == (b.doc_id, b.lang_pred, b.rejected)
        assert a.score == pytest.approx(b.score, abs=1e-4)


def test_counts_of_many_letters_and_short_texts():
    rng = np.random.default_rng(3)
    texts = [np.r_[0, rng.permutation(100_000) + 1, 0], np.array([0, 97, 0]), np.array([0, 98, 97, 0])]
    key, head, last, n = _counted(texts * 2)
    want = {}
    for text in texts:
        for gram in zip(*(x.tolist() for x in ngrams(text))):
            want[gram] = want.get(gram, 0) + 2
    assert dict(zip(zip(head.tolist(), last.tolist()), n.tolist())) == want
    assert (key == ngram_hash(head, last)).all()


def plain_kneser_ney(text):
    """Probabilities by dictionaries over tuples of characters."""
    from collections import Counter, defaultdict

    head, last = ngrams(encode_letters(text))
    mask = (1 << BITS) - 1
    grams = [(h >> 2 * BITS, h >> BITS & mask, h & mask, z)
             for h, z in zip(head.tolist(), last.tolist())]
    levels = {4: Counter(grams)}
    for order in (3, 2, 1):
        levels[order] = Counter(g[1:] for g in levels[order + 1])
    alphabet = len(levels[1]) + 1

    def rate(gram):
        if not gram:
            return 1 / alphabet
        counts = levels[len(gram)]
        ones, twos = (sum(n == k for n in counts.values()) for k in (1, 2))
        d = ones / (ones + 2 * twos) if ones and twos else 0.5
        mine = {g[-1]: n for g, n in counts.items() if g[:-1] == gram[:-1]}
        if not mine:
            return rate(gram[1:])
        total = sum(mine.values())
        own = (mine[gram[-1]] - d) / total if gram[-1] in mine else 0.0
        return own + d * len(mine) / total * rate(gram[1:])

    return grams, sorted(levels[1]), rate


def test_kneser_ney_equals_dictionaries_and_sums_to_one(spark):
    text = "the cat sat on the mat, та пес і кіт the dog sat on the log"
    grams, letters, rate = plain_kneser_ney(text)
    letters = [x[0] for x in letters] + [0x3042]  # the last one for all that are unseen
    contexts = {g[:3] for g in grams[::7]} | {(1, 2, 3), grams[5][1:], (7, *grams[9][2:])}
    pack = lambda c: c[0] << 2 * BITS | c[1] << BITS | c[2]
    counted = {}
    for g in grams:
        counted[g] = counted.get(g, 0) + 1
    counts = spark.createDataFrame(
        [(0, pack(g), g[3], n) for g, n in counted.items()],
        "model int, head long, last long, n long",
    )
    asked = [(0, pack(c), z) for c in contexts for z in letters]
    found = kneser_ney(counts, spark.createDataFrame(asked, "model int, head long, last long"))
    found = {(r["head"], r["last"]): r["p"] for r in found.collect()}
    assert len(found) == len(asked)
    for c in contexts:
        for z in letters:
            assert found[pack(c), z] == pytest.approx(rate((*c, z)), abs=1e-12)
        assert sum(found[pack(c), z] for z in letters) == pytest.approx(1, abs=1e-9)


SPANS = [
    ("a.b@c.de, x@y and @z.com q@r.s@t.uv", ["email:0:8", "email:25:30"]),
    ("1.2.3.4 256.1.1.1 1.2.3.4.5.6.7.8 001.2.3.4", None),
    ("4111 1111 1111 1111 and 4111-1111-1111-1112", ["card:0:19"]),
    ("+1 (385) 555-1563 +12 345 +49 30 1234567.", ["phone:0:17", "phone:26:40"]),
]


def plain_base(text):
    """The definition with the patterns as they stand."""
    import re

    kinds = ["email", "ip", "card", "phone"]
    patterns = [
        r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
        r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
        r"[0-9]([\x20-]?[0-9])+",
        r"\+[0-9][\x20().0-9-]+[0-9]",
    ]

    def luhn(d):
        digits = [int(x) for x in d][::-1]
        return sum(x if i % 2 == 0 else sum(divmod(2 * x, 10)) for i, x in enumerate(digits)) % 10

    out = []
    for k, pattern in enumerate(patterns):
        for m in re.finditer(pattern, text):
            d = re.sub("[^0-9]", "", m.group())
            ok = [
                True,
                all(int(x) <= 255 for x in m.group().split(".")) if k == 1 else True,
                k == 2 and 14 <= len(d) <= 19 and luhn(d) == 0,
                10 <= len(d) <= 15,
            ][k]
            if ok:
                out.append((m.start(), k, m.end()))
    return [f"{kinds[k]}:{s}:{e}" for s, k, e in sorted(out)]


def test_base_spans_follow_the_patterns(sf_dir):
    import duckdb

    names = ["email", "ip", "card", "phone"]
    texts = [t for t, _ in SPANS] + ["é+1 (385) 555-1563", "a@b.c@d.e@f", "1" * 5000, "++1 2", "@"]
    sql = f"select text from read_parquet('{sf_dir}/documents.parquet')"
    texts += [r[0] for r in duckdb.connect().execute(sql).fetchall()]
    for text in texts:
        found = [f"{names[k]}:{s}:{e}" for s, k, e in base_spans(text)]
        if not text.startswith("1" * 5000):
            assert found == plain_base(text)
    for text, want in SPANS:
        if want:
            assert [f"{names[k]}:{s}:{e}" for s, k, e in base_spans(text)] == want


def test_personal_data_of_odd_rows(spark):
    extra = [(20, "call (385) 555-1563 or write to jo [at] example [dot] com", "en", "a")]
    many = [(100 + i, f"tel +1 (385) 555-15{i:02d}, mail a{i}@b.com", "en", "a") for i in range(40)]
    df = documents(spark, documents(spark, clashes=False).select(
        "doc_id", "text", "lang", "source").collect() + extra + many)
    rows = {r.doc_id: r for r in personal_data(df).collect()}
    assert rows[3].spans == "" and rows[4].n_email == 0
    assert rows[10].n_email == 1 and rows[10].n_phone == 1
    assert rows[20].n_added == 2 and rows[20].n_phone == 0
    assert rows[20].spans == "phone:5:19,email:32:57"
    assert personal_data(df.limit(0)).collect() == []


def test_spans_are_counted_by_their_own_kind(spark):
    texts = [
        "a@b.com",
        "10.0.0.1 and 10.0.0.2, not 300.1.1.1",
        "card 4111 1111 1111 1111",
        "+1 (385) 555-1563 or +1 (385) 555-1564",
        "10.0.0.3 c@d.org +1 (385) 555-1565 e@f.org 4111-1111-1111-1111 g@h.org 10.0.0.4",
        "nothing",
        None,
    ]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    rows = {r.doc_id: r for r in personal_data(df).collect()}
    for i, text in enumerate(texts):
        base = plain_base(text or "")
        kinds = [s.split(":")[0] for s in base]
        counts = (rows[i].n_email, rows[i].n_ip, rows[i].n_card, rows[i].n_phone)
        assert counts == tuple(kinds.count(k) for k in ("email", "ip", "card", "phone"))
        assert rows[i].base_sha256 == hashlib.sha256(",".join(base).encode()).hexdigest()
    assert (rows[4].n_email, rows[4].n_ip, rows[4].n_card, rows[4].n_phone) == (3, 2, 1, 1)


def test_label_model_trusts_agreeing_labelers():
    good = span_code("mail a@b.com now", (5, 0, 12))
    bad = span_code("xid 1-2-3-4x", (4, 3, 11))
    p = label_model(np.array([good, bad]), np.array([90.0, 10.0]))
    assert p[0] > 0.9 > 0.2 > p[1]


def test_evidence_for_a_rare_form_grows_with_its_spans():
    plain, spaced = span_code("mail a@b.org now", (5, 0, 12)), span_code("xa(at)b.org", (1, 0, 11))
    codes, truth = np.array([plain, spaced]), np.array([1.0, 0.0])
    few = span_classifier(codes, np.array([1e6, 1.0]), truth)
    many = span_classifier(codes, np.array([1e6, 1e4]), truth)
    assert few[0] > 0.99 and many[0] > 0.99
    assert many[1] < 0.01 < few[1]


def test_a_label_model_that_does_not_settle_is_an_error():
    codes = np.array([span_code("mail a@b.org now", (5, 0, 12)), span_code("xa(at)b.org", (1, 0, 11))])
    with pytest.raises(RuntimeError):
        label_model(codes, np.array([9.0, 1.0]), rounds=1)


def test_words_kept_between_texts_are_few():
    words = [f"w{i}" for i in range(80_000)]
    first = features([" ".join(words)], 18)
    assert len(quality._words) <= 1 << 16
    again = features([" ".join(words)], 18)
    assert all((a == b).all() for a, b in zip(first, again, strict=True))


def test_long_words_count_to_their_last_letter():
    shapes = [features(["a1" * 20 + end], 18)[1] for end in ("-", "+")]
    assert (shapes[0] != shapes[1]).all()
