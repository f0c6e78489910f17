"""Stamping and writing results."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loomcast.sources.tables import is_path, quote_name


def stamp(df: DataFrame, run_id: str) -> DataFrame:
    """Add the run's id and time; both are one value for the whole job."""
    return df.withColumns(
        {"run_id": F.lit(run_id), "forecast_timestamp": F.current_timestamp()}
    )


def write_frame(df: DataFrame, target: str, fmt: str = "parquet", mode: str = "overwrite") -> None:
    writer = df.write.format(fmt).mode(mode)
    if is_path(target):
        writer.save(target)
    else:
        writer.saveAsTable(quote_name(target))


def write_together(outputs: Sequence[tuple[DataFrame, str]], fmt: str = "parquet") -> None:
    """Replace all targets by their frames, or none of them.

    Every frame is written beside its target first. Only when all are complete are they
    moved into place, each by a rename; a rename that fails takes the earlier ones back.
    A driver lost between two renames leaves the old state under the name with ``_old``.
    """
    if not outputs:
        return
    spark, run = outputs[0][0].sparkSession, uuid.uuid4().hex
    moves = [
        (target, beside(target, f"staged_{run}"), beside(target, f"old_{run}"))
        for _, target in outputs
    ]
    undo = []
    try:
        for (df, _), (_, staged, _) in zip(outputs, moves, strict=True):
            write_frame(df, staged, fmt)
        for target, staged, old in moves:
            if exists(spark, target):
                rename(spark, target, old)
                undo.append((old, target))
            rename(spark, staged, target)
            undo.append((target, staged))
    except BaseException:
        for now, before in reversed(undo):
            rename(spark, now, before)
        for _, staged, _ in moves:
            remove(spark, staged)
        raise
    for _, _, old in moves:
        remove(spark, old)


def beside(target: str, what: str) -> str:
    """Table or path next to ``target``: its name with a suffix."""
    if is_path(target):
        folder = "" if "/" in target else "./"
        return f"{folder}{target.rstrip('/')}_{what}"
    if target.endswith("`"):
        return f"{target[:-1]}_{what}`"
    return f"{target}_{what}"


def exists(spark: SparkSession, target: str) -> bool:
    if is_path(target):
        files, path = _path(spark, target)
        return files.exists(path)
    return spark.catalog.tableExists(quote_name(target))


def remove(spark: SparkSession, target: str) -> None:
    """Delete what is there; nothing is no error."""
    if is_path(target):
        files, path = _path(spark, target)
        files.delete(path, True)
    else:
        spark.sql(f"DROP TABLE IF EXISTS {quote_name(target)}")


def rename(spark: SparkSession, source: str, target: str) -> None:
    """Move a path or table to a name in the same folder or schema."""
    if is_path(source):
        files, path = _path(spark, source)
        if not files.rename(path, _path(spark, target)[1]):
            raise OSError(f"{source} could not be renamed to {target}")
        return
    # The new name stands without the catalog.
    within = ".".join(_parts(quote_name(target))[-2:])
    spark.sql(f"ALTER TABLE {quote_name(source)} RENAME TO {within}")


def _parts(quoted: str) -> list[str]:
    return [f"`{part}`" for part in quoted.strip("`").split("`.`")]


def _path(spark: SparkSession, name: str):
    context = spark.sparkContext
    path = context._jvm.org.apache.hadoop.fs.Path(name)
    return path.getFileSystem(context._jsc.hadoopConfiguration()), path
