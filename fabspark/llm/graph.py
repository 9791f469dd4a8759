"""Connected components of a table of links, by alternating large and small stars.

Each task first replaces its links by a spanning set. While more than one batch of links is left,
a round of stars follows: an aggregation and a join, both of which split a node with many links,
hang every node below the smallest one it sees, and the number of rounds grows with the logarithm
of the links. Nothing is gathered per component, and nothing on the driver.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fabspark.session import cut_lineage

BATCH = 1 << 20  # links that one task holds


def local_roots(u: np.ndarray, v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Nodes of some links and the smallest node that each reaches by them."""
    nodes, place = np.unique(np.concatenate([u, v]), return_inverse=True)
    a, b = place[:len(u)], place[len(u):]
    root = np.arange(len(nodes))
    while True:
        low = np.minimum(root[a], root[b])
        new = root.copy()
        np.minimum.at(new, root[a], low)
        np.minimum.at(new, root[b], low)
        while True:
            jump = new[new]
            if np.array_equal(jump, new):
                break
            new = jump
        if np.array_equal(new, root):
            return nodes, nodes[root]
        root = new


def thin(links: DataFrame) -> DataFrame:
    """Links (u, v) replaced, in each bounded batch, by as few that connect the same nodes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray]] = []

        def flush() -> pa.RecordBatch:
            nodes, roots = local_roots(*(np.concatenate(x) for x in zip(*held)))
            held.clear()
            keep = nodes != roots
            return pa.RecordBatch.from_arrays([pa.array(nodes[keep]), pa.array(roots[keep])], ["u", "v"])

        for batch in batches:
            if batch.num_rows:
                held.append((np.asarray(batch.column("u")), np.asarray(batch.column("v"))))
            if sum(len(x) for x, _ in held) >= BATCH:
                yield flush()
        if held:
            yield flush()

    return links.select("u", "v").filter("u != v").mapInArrow(run, "u long, v long")


def _large_star(links: DataFrame) -> DataFrame:
    both = links.union(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
    low = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
    return both.join(low, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(links: DataFrame) -> DataFrame:
    down = links.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    low = down.groupBy("u").agg(F.min("v").alias("m"))
    hung = down.join(low, "u").filter("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return hung.union(low.select("u", F.col("m").alias("v"))).distinct()


def components(links: DataFrame) -> DataFrame:
    """``node``, ``root`` for every node of ``links`` (u, v: long) but the roots themselves."""
    links, seen = cut_lineage(thin(links).distinct()), None
    while True:
        mark = links.agg(F.count("*"), F.sum(F.pmod(F.xxhash64("u", "v"), F.lit(1 << 40)))).first()
        if mark[0] < BATCH:  # what is left fits one batch, which settles it
            return thin(links.coalesce(1)).select(F.col("u").alias("node"), F.col("v").alias("root"))
        if mark == seen:
            return links.select(F.col("u").alias("node"), F.col("v").alias("root"))
        seen, links = mark, cut_lineage(thin(_small_star(_large_star(links))).distinct())
