"""Documents with nulls, blanks, repeats, long texts and clashing columns."""

from pyspark.sql import functions as F

LONG = " ".join(f"w{i % 977} x{i}" for i in range(9000))
ROWS = [
    (1, "the quick brown fox jumps over the lazy dog again and again", "en", "a"),
    (2, "the quick brown fox jumps over the lazy dog again and again", "en", "a"),
    (3, None, None, None),
    (4, "", "en", "a"),
    (5, " \t\n ", "de", "b"),
    (6, "word", "de", "b"),
    (7, "WORD", None, None),
    (8, LONG, "en", "a"),
    (9, LONG + " tail", "en", "b"),
    (10, "Ärger über ÉTÉ; mail an x.y@example.org oder +49 (30) 1234567", "de", "b"),
    (None, "a text without an id that has several words in it", "en", None),
    (None, None, None, None),
    (11, "repeated row with some words", "en", "a"),
    (11, "repeated row with some words", "en", "a"),
]
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
CLASHES = (
    "score kept rank block shard slot k1 _k1 k2 print bands _source _tokens _digest _own_0 g "
    "item n_words held_out root v count tokens weight blocks rest _bucket h"
).split()


def documents(spark, rows=ROWS, clashes=True):
    df = spark.createDataFrame(
        [(*row, len(row[1]) if row[1] is not None else None) for row in rows], SCHEMA
    )
    for i, name in enumerate(CLASHES if clashes else []):
        df = df.withColumn(name, F.lit(i))
    return df


def labels(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int")


def benchmark(spark, rows):
    return spark.createDataFrame(rows, "item_id long, text string")
