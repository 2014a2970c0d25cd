"""Connected components of a table of links."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from minuteflow.llm.common import few_tasks, kept


def find(parent: dict, x):
    root = x
    while (up := parent.get(root, root)) != root:
        root = up
    while x != root:
        parent[x], x = root, parent.get(x, x)
    return root


def local_union(links: DataFrame) -> DataFrame:
    """Union-find over the links of each task: every node linked with its task's smallest."""
    names = links.columns

    def united(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parent: dict = {}
        for batch in batches:
            for a, b in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                a, b = find(parent, a), find(parent, b)
                if a != b:
                    parent[max(a, b)] = min(a, b)
        nodes = [n for n in parent if find(parent, n) != n]
        roots = [find(parent, n) for n in nodes]
        kind = pa.binary()
        yield pa.RecordBatch.from_arrays([pa.array(nodes, kind), pa.array(roots, kind)], names=names)

    return links.mapInArrow(united, links.schema)


def components(links: DataFrame) -> DataFrame:
    """(``node``, ``root``): the smallest node that every linked node reaches.

    ``links`` has two binary columns. Each task unites its own links first; what
    is left is united across tasks by alternating stars: every node hands its
    smallest neighbour to its larger ones, then to its smaller ones, until no
    link changes. Only links of a node to a smaller one are kept, so a hub is a
    key of plain counts and joins. A hub's links meet in one task of a join, one row each.
    """
    a, b = links.columns
    named = links.select(F.col(a).alias("node"), F.col(b).alias("root"))
    stars = kept(few_tasks(local_union(named)), "stars")
    before = None
    while True:
        both = stars.unionByName(
            stars.select(F.col("root").alias("node"), F.col("node").alias("root"))
        )
        least = both.groupBy("node").agg(F.min("root").alias("low"))
        low = F.least("low", "node")
        large = both.join(least, "node").where("root > node")
        large = large.select(F.col("root").alias("node"), low.alias("root"))
        large = kept(few_tasks(large.where("node != root").distinct()), "large-stars")
        least = large.groupBy("node").agg(F.min("root").alias("low"))
        small = large.join(least, "node")
        small = small.select(F.col("root").alias("node"), F.col("low").alias("root")).unionByName(
            least.select("node", F.col("low").alias("root"))
        )
        stars = kept(few_tasks(small.where("node != root").distinct()), "small-stars")
        seen = stars.agg(
            F.count("*").alias("n"), F.sum(F.xxhash64("node", "root").cast("decimal(38,0)")).alias("h")
        ).first()
        if seen == before:
            return stars
        before = seen
