"""Cosine near-duplicates by int8 tile products with exact error bounds.

Equal vectors are one representative. Representatives are dealt to tiles, and each pair of tiles
is one group: vectors in both are scaled to length one and rounded to int8, and one matrix
product of the whole numbers gives every cosine to within a bound known for each vector. A pair
whose product plus bound stays below the threshold is settled; every other pair is computed in
double precision from the values given. A group returns sums of links and a few links that
connect the same vectors, so a dense group costs its rows, not its pairs.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fabspark.llm.graph import components, local_roots
from fabspark.session import cut_lineage

THRESHOLD = 0.95
TILE = 4096
STEP = 1024


def quantise(unit: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Int8 codes, scale, length of the decoded vector and of the rounding error, per row."""
    scale = np.maximum(np.abs(unit).max(axis=1), 1e-300) / 127
    codes = np.rint(unit / scale[:, None]).astype(np.int8)
    decoded = codes * scale[:, None]
    return codes, scale, np.linalg.norm(decoded, axis=1), np.linalg.norm(unit - decoded, axis=1)


def near(left: np.ndarray, right: np.ndarray, threshold: float, step: int = STEP, same: bool = False):
    """Yield index pairs (i, j) of rows with a cosine of ``threshold`` or more; ``same``: i < j only.

    With x = q + e (decoded and error), |xy - qr| <= |q||f| + |e||r| + |e||f|. Products of int8
    codes up to 1,040 dimensions are exact in single precision, beyond that in double.
    """
    sides = []
    for rows in (left, right):
        norm = np.linalg.norm(rows, axis=1)
        unit = rows / norm[:, None]
        codes, scale, size, error = quantise(unit)
        sides.append((norm, codes.astype(np.float32 if rows.shape[1] <= 1040 else np.float64), scale, size, error))
    (norm_a, code_a, scale_a, size_a, error_a), (norm_b, code_b, scale_b, size_b, error_b) = sides
    for a in range(0, len(left), step):
        for b in range(a if same else 0, len(right), step):
            sa, sb = slice(a, a + step), slice(b, b + step)
            product = (code_a[sa] @ code_b[sb].T).astype(np.float64)
            bound = size_a[sa, None] * error_b[sb] + error_a[sa, None] * (size_b[sb] + error_b[sb])
            i, j = np.nonzero(product * (scale_a[sa, None] * scale_b[sb]) + bound >= threshold - 1e-9)
            i, j = i + a, j + b
            if same:
                i, j = i[i < j], j[i < j]
            for k in range(0, len(i), 1 << 16):
                x, y = i[k:k + (1 << 16)], j[k:k + (1 << 16)]
                cosine = np.einsum("ij,ij->i", left[x], right[y]) / (norm_a[x] * norm_b[y])
                yield x[cosine >= threshold], y[cosine >= threshold]


def near_duplicates(vectors: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding",
                    threshold: float = THRESHOLD, tile: int = TILE) -> DataFrame:
    """One row per row of ``vectors``: ``vec_id``, ``n_links``, ``component_id``, ``kept``.

    Null, empty and zero vectors and those with null or non-finite components link with nothing;
    vectors of different lengths do not link. ``n_links`` counts other rows, equal vectors
    included. Rows that share an id are one node of the components. Other columns are ignored.
    """
    values = F.col(embedding).cast("array<double>")
    sane = F.coalesce(F.forall(values, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
                      & F.exists(values, lambda x: x != 0), F.lit(False))
    rows = vectors.select(F.col(vec_id).cast("long").alias("vec_id"), F.when(sane, values).alias("v"))
    rows = rows.withColumns({"k1": F.when(F.col("v").isNotNull(), F.xxhash64("v")),
                             "k2": F.when(F.col("v").isNotNull(), F.xxhash64(F.lit(1), "v"))})
    whole = rows.filter("v IS NOT NULL").groupBy("k1", "k2").agg(
        F.min("vec_id").alias("node"), F.count("*").alias("copies"), F.first("v").alias("v"))
    whole = cut_lineage(whole.withColumn("width", F.size("v")))
    count = whole.count()
    tiles = max(1, -(-count // tile))
    dealt = whole.select("node", "copies", "v", "k1", "k2", "width", F.pmod(F.xxhash64("k1", "k2"), F.lit(tiles)).cast("int").alias("t"))
    # Each tile meets every tile once: with its own, one copy of it is enough.
    other = F.explode(F.sequence(F.lit(0), F.lit(tiles - 1))).alias("o")
    placed = dealt.select("*", other).select(
        "width", F.least("t", "o").alias("x"), F.greatest("t", "o").alias("y"), "t", "node", "copies", "k1", "k2", "v")

    def links(table: pa.Table) -> pa.Table:
        table = table.combine_chunks()
        own = np.asarray(table["t"])
        x, y = table["x"][0].as_py(), table["y"][0].as_py()
        width = table["width"][0].as_py()
        block = np.asarray(table["v"].combine_chunks().flatten()).reshape(-1, width)
        a, b = np.flatnonzero(own == x), np.flatnonzero(own == y)
        copies, total = np.asarray(table["copies"]), np.zeros(len(own), np.int64)
        edges: list[tuple[np.ndarray, np.ndarray]] = []
        for i, j in near(block[a], block[b], threshold, same=x == y):
            u, v = a[i], b[j]
            np.add.at(total, u, copies[v])
            np.add.at(total, v, copies[u])
            nodes, roots = local_roots(u, v)
            edges.append((nodes[nodes != roots], roots[nodes != roots]))
        u, v = (np.concatenate(p) for p in zip(*edges)) if edges else (np.zeros(0, np.int64),) * 2
        if len(u):
            nodes, roots = local_roots(u, v)
            u, v = nodes[nodes != roots], roots[nodes != roots]
        node, some = np.asarray(table["node"]), np.flatnonzero(total)
        pick = np.concatenate([some, u])
        none = np.full(len(some), -1)
        return pa.table({
            "k1": np.asarray(table["k1"])[pick], "k2": np.asarray(table["k2"])[pick], "node": node[pick],
            "peer": pa.array(np.concatenate([np.zeros(len(some), np.int64), node[v]]), pa.int64(),
                             mask=np.concatenate([none < 0, np.zeros(len(u), bool)])),
            "links": np.concatenate([total[some], np.zeros(len(u), np.int64)]),
        })

    found = cut_lineage(placed.groupBy("width", "x", "y").applyInArrow(links, "k1 long, k2 long, node long, peer long, links long"))
    sums = found.filter("peer IS NULL").groupBy("k1", "k2").agg(F.sum("links").alias("links"))
    # Rows of one representative hang on it, and so do their other vectors if an id repeats.
    keyed = rows.drop("v")
    kin = keyed.filter("k1 IS NOT NULL").join(whole.select("k1", "k2", "node", "copies"), ["k1", "k2"])
    hung = kin.filter("vec_id != node").select(F.col("vec_id").alias("u"), F.col("node").alias("v"))
    roots = components(found.filter("peer IS NOT NULL").select(F.col("node").alias("u"), F.col("peer").alias("v")).union(hung))
    counted = keyed.join(whole.select("k1", "k2", "copies").join(sums, ["k1", "k2"], "left"), ["k1", "k2"], "left")
    named = counted.join(roots, F.col("vec_id") == F.col("node"), "left")
    return named.select(
        "vec_id", (F.coalesce(F.col("copies") - 1, F.lit(0)) + F.coalesce("links", F.lit(0))).cast("long").alias("n_links"),
        F.coalesce("root", "vec_id").alias("component_id"),
    ).withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))


COSINE_SQL = """
WITH RECURSIVE v AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings),
n AS (SELECT vec_id, e, sqrt(list_dot_product(e, e)) AS s FROM v),
p AS (SELECT a.vec_id AS a, b.vec_id AS b FROM n a JOIN n b ON a.vec_id <> b.vec_id
      WHERE a.s > 0 AND b.s > 0 AND list_dot_product(a.e, b.e) / (a.s * b.s) >= 0.95),
r AS (SELECT vec_id, vec_id AS root FROM v UNION SELECT p.b, r.root FROM r JOIN p ON p.a = r.vec_id),
c AS (SELECT vec_id, min(root) AS component_id FROM r GROUP BY vec_id),
k AS (SELECT a AS vec_id, count(*) AS n_links FROM p GROUP BY a)
SELECT v.vec_id, coalesce(k.n_links, 0) AS n_links, c.component_id, v.vec_id = c.component_id AS kept
FROM v JOIN c USING (vec_id) LEFT JOIN k USING (vec_id)
"""
