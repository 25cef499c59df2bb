"""Connected components of links that are too many for one machine."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import drop, stored_at, with_group


#: Links that one task takes, 16 bytes each.
TOGETHER = 1 << 20


def forest(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Every node of the links but one per component, and the least node of its component."""
    nodes, at = np.unique(np.concatenate([a, b]), return_inverse=True)
    x, y = at[: len(a)], at[len(a) :]
    root = np.arange(len(nodes))
    while True:
        least = np.minimum(root[x], root[y])
        new = root.copy()
        np.minimum.at(new, root[x], least)
        np.minimum.at(new, root[y], least)
        while not np.array_equal(new[new], new):
            new = new[new]
        if np.array_equal(new, root):
            break
        root = new
    own = root != np.arange(len(nodes))
    return nodes[own], nodes[root[own]]


def _locally(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links within each batch, cut down to a forest."""
    for batch in batches:
        a, b = (np.asarray(column.to_numpy(zero_copy_only=False), np.int64) for column in batch.columns)
        a, b = forest(a, b)
        yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], ["a", "b"])


def _all_at_once(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """All links of a task, cut down to a forest."""
    held = [tuple(np.asarray(column.to_numpy(zero_copy_only=False), np.int64) for column in batch.columns) for batch in batches]
    if held:
        a, b = forest(*(np.concatenate(x) for x in zip(*held)))
        yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], ["a", "b"])


def components(links: DataFrame) -> DataFrame:
    """node, root for every node that has a link: the least node it is connected to, itself included.

    ``links`` has two columns of longs.  Star contraction: in turns, every node hands its larger neighbours,
    then its smaller ones, to the least of them, until nothing changes.  The rounds grow with the
    logarithm of the longest path; once no more than ``TOGETHER`` links are left, one task settles them.  Each round is written, and a node with very many neighbours
    gets the same treatment as any hot key.  Links of a node with itself make it a node.
    """
    spark = links.sparkSession
    a, b = links.columns
    alone = links.filter(F.col(a) == F.col(b)).select(F.col(a).alias("node")).distinct()
    pairs, path = stored_at(links.select(F.col(a).alias("a"), F.col(b).alias("b")).filter("a <> b").mapInArrow(_locally, "a long, b long"), "components")
    before = None
    while True:
        state = pairs.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if state[0] == 0 or state == before:
            break
        before = state
        if state[0] <= TOGETHER:
            last_path = path
            pairs, path = stored_at(pairs.repartition(1).mapInArrow(_all_at_once, "a long, b long"), "components")
            drop(spark, last_path)
            break
        # larger neighbours go to the least neighbour or the node itself
        both = pairs.unionByName(pairs.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"), F.count("*").alias("n"))
        large, next_path = stored_at(
            with_group(both, least, ["a"], "n").filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct(), "components"
        )
        drop(spark, path)
        # smaller neighbours, and the node itself, go to the least of them
        least = large.groupBy("a").agg(F.min("b").alias("m"), F.count("*").alias("n"))
        small = with_group(large, least, ["a"], "n").select(F.explode(F.array("a", "b")).alias("a"), F.col("m").alias("b"))
        pairs, path = stored_at(small.filter("a <> b").distinct(), "components")
        drop(spark, next_path)
    found = pairs.select(F.col("a").alias("node"), F.col("b").alias("root"))
    roots = found.select("root").distinct().select(F.col("root").alias("node"), "root")
    rest = alone.join(found.select("node"), "node", "left_anti").join(roots.select("node"), "node", "left_anti")
    return found.unionByName(roots).unionByName(rest.select("node", F.col("node").alias("root")))
