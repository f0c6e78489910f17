"""Connected components of a graph given as a table of edges.

Union-find merges what one partition sees; large-star and small-star steps
(Kiveris et al., "Connected Components in MapReduce and Beyond", 2014) join the
partitions' forests. No step holds a whole component: each row is an edge, each
aggregate a minimum with map-side combine.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomcast.llm.common import Scratch, few_tasks


def _forest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Edges from every vertex of a batch to the smallest vertex it reaches there."""
    for batch in batches:
        left, right = batch.column(0).to_numpy(), batch.column(1).to_numpy()
        ids, codes = np.unique(np.concatenate([left, right]), return_inverse=True)
        parent = list(range(len(ids)))

        def find(x: int, parent=parent) -> int:
            while parent[x] != x:
                parent[x] = parent[parent[x]]
                x = parent[x]
            return x

        half = len(left)
        for a, b in zip(codes[:half].tolist(), codes[half:].tolist(), strict=True):
            a, b = find(a), find(b)
            if a != b:
                parent[max(a, b)] = min(a, b)
        roots = np.array([find(x) for x in range(len(ids))], dtype=np.int64)
        moved = roots != np.arange(len(ids))
        yield pa.RecordBatch.from_arrays(
            [pa.array(ids[moved]), pa.array(ids[roots[moved]])], names=["v", "root"]
        )


def connected_components(edges: DataFrame, scratch: Scratch) -> DataFrame:
    """(v, root) for every vertex of an edge except the roots themselves.

    ``edges`` has two long columns without nulls; loops and repeats are fine. The
    root is the smallest vertex of the component. Empty edges give no rows.
    """
    left, right = edges.columns
    current = scratch.save(
        edges.select(F.col(left).alias("v"), F.col(right).alias("root")).mapInArrow(
            _forest, "v long, root long"
        ),
        "forest",
    )
    rows = current.count()
    # Roots are smaller than their vertices in every step, so a vertex has parents
    # below it and children above it.
    while True:
        down = current.select(F.col("root").alias("v"), F.col("v").alias("child"))
        both = current.select("v", F.col("root").alias("parent"), F.lit(None).alias("child")).union(
            down.select("v", F.lit(None), "child")
        )
        near = scratch.save(
            few_tasks(
                both.groupBy("v").agg(
                    F.min("parent").alias("parent"),
                    F.max("parent").alias("last"),
                    (F.count("child") > 0).alias("inner"),
                ),
                rows,
            ),
            "near",
        )
        # Done as soon as each vertex hangs on one root and nothing hangs on it.
        if near.where("parent <> last or (parent is not null and inner)").isEmpty():
            return near.where("parent is not null").select("v", F.col("parent").alias("root"))
        large = scratch.save(
            few_tasks(
                down.join(near, "v").select(
                    F.col("child").alias("v"), F.coalesce("parent", "v").alias("root")
                ),
                rows,
            ),
            "large",
        )
        least = scratch.save(
            few_tasks(large.groupBy("v").agg(F.min("root").alias("m")), rows), "least"
        )
        small = (
            large.join(least, "v")
            .where(F.col("root") != F.col("m"))
            .select(F.col("root").alias("v"), F.col("m").alias("root"))
            .union(least)
            .distinct()
        )
        after = scratch.save(few_tasks(small, rows), "small")
        for old in (current, near, large, least):
            scratch.drop(old)
        current = after
