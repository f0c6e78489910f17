"""Helpers shared by the operators of this package."""

from __future__ import annotations

import uuid
from collections.abc import Iterator, Sequence

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from loomcast.session import ensure_checkpoint_dir

GOLDEN = np.uint64(0x9E3779B97F4A7C15)
#: Tasks that short steps get at least, and the rows for each task of longer ones.
LEAST_TASKS = 36
ROWS_PER_TASK = 5000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


class Scratch:
    """Tables of one run in the shared folder that ``spark.checkpoint.dir`` names.

    A written table cuts the lineage: a lost executor costs the tasks that read
    it, not the work before it. Tables stay until ``drop`` or until the folder is
    cleaned, because results are lazy and read them later.
    """

    def __init__(self, spark: SparkSession, name: str):
        self.spark = spark
        base = spark.conf.get("spark.checkpoint.dir", None)
        if not base:
            ensure_checkpoint_dir(spark)
            base = spark.sparkContext._jsc.sc().getCheckpointDir().get()
        self.path = f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"
        self._count = 0

    def save(self, df: DataFrame, name: str = "step", partition_by: str = "") -> DataFrame:
        """``partition_by`` names the last column: readers that filter on it open no other part."""
        self._count += 1
        path = f"{self.path}/{self._count:03d}-{name}"
        writer = df.write.partitionBy(partition_by) if partition_by else df.write
        writer.parquet(path)
        saved = self.spark.read.schema(df.schema).parquet(path)
        saved._scratch_path = path
        return saved

    def drop(self, saved: DataFrame) -> None:
        """Delete a table that no later plan reads."""
        jvm = self.spark.sparkContext._jvm
        path = jvm.org.apache.hadoop.fs.Path(saved._scratch_path)
        path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def few_tasks(df: DataFrame, rows: int, rows_per_task: int = ROWS_PER_TASK) -> DataFrame:
    """The frame in tasks that suit work on so many rows; never more than it has.

    A short step over many shuffle partitions spends its time on starting tasks and
    on small files, where adaptive execution does not merge the partitions.
    """
    return df.coalesce(max(LEAST_TASKS, -(-rows // rows_per_task)))


def set_aside(df: DataFrame) -> tuple[DataFrame, dict[str, str]]:
    """The frame under neutral column names, and the new name of each column.

    Work columns then cannot clash with a column of the caller.
    """
    own = {c: f"_own_{i}" for i, c in enumerate(df.columns)}
    return df.toDF(*own.values()), own


def put_back(df: DataFrame, own: dict[str, str]) -> DataFrame:
    return df.select(*[F.col(new).alias(old) for old, new in own.items()])


def row_keys(id_col: str, text_col: str) -> tuple[Column, Column]:
    """128 bits of id and text: equal for equal rows, never null."""
    return F.xxhash64(id_col, text_col), F.xxhash64(F.lit(1), text_col, id_col)


def mix64(x: np.ndarray) -> np.ndarray:
    """Finaliser that turns 64-bit integers into well spread 64-bit integers."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def slices(texts: Sequence, limit: int = 1 << 20) -> Iterator[tuple[int, int]]:
    """Index ranges that hold about ``limit`` characters each, at least one text.

    Python objects made from a batch of texts then stay small however long the
    texts are.
    """
    start = total = 0
    for i, text in enumerate(texts):
        size = len(text) if text is not None else 0
        if i > start and total + size > limit:
            yield start, i
            start, total = i, 0
        total += size
    if start < len(texts):
        yield start, len(texts)


def held_out(doc_id: str, folds: int, fold: int):
    """Whether crc32 of the id as text falls into the fold; null counts as no."""
    digest = F.crc32(F.col(doc_id).cast("string").cast("binary"))
    return F.coalesce(F.pmod(digest, F.lit(folds)) == fold, F.lit(False))
