"""Connected components of a distributed list of links."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import arrow_schema, let_go, slices, written

#: Links that a task joins up at a time.
HELD = 1 << 18
LINKS = "a long, b long"


def least_nodes(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The nodes of some links, and the least node that these links lead each to."""
    nodes, at = np.unique(np.concatenate([a, b]), return_inverse=True)
    x, y = at[:len(a)], at[len(a):]
    root = np.arange(len(nodes))
    while len(x):
        # Roots point at smaller ones that a link leads to, then each node at its root.
        high, low = np.maximum(root[x], root[y]), np.minimum(root[x], root[y])
        np.minimum.at(root, high, low)
        while (root[root] != root).any():
            root = root[root]
        apart = root[x] != root[y]
        x, y = x[apart], y[apart]
    return nodes, nodes[root]


def forest(held: int):
    """Links (a, b) -> fewer links between the same nodes, at most ``held`` at a time: each node with its least one."""
    out = arrow_schema(LINKS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        a, b = np.empty(0, np.int64), np.empty(0, np.int64)

        def made() -> pa.RecordBatch:
            apart = a != b
            return pa.RecordBatch.from_arrays([pa.array(a[apart], pa.int64()), pa.array(b[apart], pa.int64())], schema=out)

        for batch in slices(batches, 16 * held):
            a, b = (np.concatenate([x, c.to_numpy()]) for x, c in zip((a, b), batch.columns))
            if len(a) >= held:
                a, b = least_nodes(a, b)
                if len(a) >= held // 2:
                    yield made()
                    a, b = a[:0], b[:0]
        if len(a):
            a, b = least_nodes(a, b)
            yield made()

    return run


def state(links: DataFrame) -> tuple:
    r = links.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
    return tuple(r)


def components(links: DataFrame, held: int = HELD) -> DataFrame:
    """(node, component) of each node in ``links`` (a, b); a component is its smallest node.

    Each task first joins up the links it has, so that copies and rings of links go.  While
    more are left than a task holds, large-star and small-star steps in turn point neighbours at
    the least node seen, until every link leads to its component.  Minima are combined before
    they are shuffled, and each round is written out.
    """
    def fewer(found: DataFrame) -> DataFrame:
        return written(found.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
                       .where(F.col("a") != F.col("b")).mapInArrow(forest(held), LINKS), "links")

    links = fewer(links)
    before = state(links)
    while before[0] > held:
        both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = (both.join(least, "a").where(F.col("b") > F.col("a"))
                 .select(F.col("b").alias("a"), F.col("m").alias("b")).where(F.col("a") != F.col("b")).distinct())
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = (large.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
                 .unionByName(least.select("a", F.col("m").alias("b")))
                 .where(F.col("a") != F.col("b")).distinct())
        last, links = links, written(small, "links")
        after = state(links)
        let_go(last)
        if after == before:
            break
        before = after
    else:
        # So few links are joined up by one task.
        last, links = links, written(links.coalesce(1).mapInArrow(forest(2 * held), LINKS), "links")
        let_go(last)
    return (links.select(F.col("a").alias("node"), F.col("b").alias("component"))
            .unionByName(links.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()))
