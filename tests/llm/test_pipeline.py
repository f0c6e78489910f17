"""The pipeline against the same stages done by hand on plain rows."""

import os

import corpus_pipeline
from odd_rows import documents, labels


def write(spark, path, **tables):
    for name, df in tables.items():
        df.write.parquet(f"{path}/{name}.parquet")
    return str(path)


def test_stages_keep_columns_and_follow_each_other(spark, sf_dir):
    sf_dir = os.path.join(os.path.dirname(sf_dir), "sf0.001")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    first = docs
    for name, stage in corpus_pipeline.STAGES:
        after = stage(spark, docs, sf_dir)
        if name != "sharding":
            assert after.columns == docs.columns, name
        after = spark.createDataFrame(after.collect(), after.schema)
        before_ids = {r.doc_id for r in docs.select("doc_id").collect()}
        ids = {r.doc_id for r in after.select("doc_id").collect()}
        assert ids <= before_ids and ids, name
        if name in ("mixing", "sharding"):
            assert ids == before_ids
        docs = after
    assert docs.count() > 0.5 * first.count()
    rows = corpus_pipeline.run(spark, sf_dir)
    key = lambda r: (r.doc_id, r.shard, r.slot)
    assert sorted(map(key, rows.collect())) == sorted(map(key, docs.collect()))


def test_odd_rows_and_empty_tables(spark, tmp_path):
    df = documents(spark).drop("shard", "slot")
    marks = labels(spark, [(1, 1, 0), (6, 0, 0), (8, 1, 0), (None, 1, 0), (2, None, 0)])
    items = spark.createDataFrame([(1, "no such passage"), (2, None)], "item_id long, text string")
    for label, docs in (("odd", df), ("empty", df.limit(0))):
        folder = write(
            spark, tmp_path / label, documents=docs, labels=marks, benchmark=items
        )
        out = corpus_pipeline.run(spark, folder)
        assert set(out.columns) == set(df.columns) | {"shard", "slot"}
        assert (out.count() == 0) == (label == "empty")
