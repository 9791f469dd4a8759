"""Mixing sources to target weights with exact budgets, in DataFrame expressions only.

Every row gets a hash-random key. A source's rows are cut into key ranges; sums per range and
their running totals give each range's place in the source, and a window inside the range gives
each row's. No task sorts a whole source, and no row is moved more than once.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fabspark.llm.text import WORD

WEIGHTS = (3.0, 1.0, 2.0)
SHARE = 1.5
CAP = 2.0
SEED = "mix"


def word_count(text: Column) -> Column:
    """Words of a text; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def source_targets(sizes: DataFrame, weights: Sequence[float] = WEIGHTS, share: float = SHARE,
                   cap: float = CAP) -> DataFrame:
    """Add ``target`` to one row per source with ``source`` and ``source_size``.

    Sources in code-point order, null last, weigh ``weights`` in turn. They share ``share`` times
    all sizes; none gets more than ``cap`` times its own size, and what it leaves goes to the
    others by weight. Sources that stop at their cap are those with the smallest size per weight,
    so running sums in that order find the level at which the rest share. One row per source
    passes through the window. ``share`` above ``cap`` leaves every source at its cap.
    """
    ranked = sizes.withColumn("_rank", F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1)
    ranked = ranked.withColumn("_w", F.element_at(F.array(*[F.lit(float(w)) for w in weights]),
                                                  (F.col("_rank") % len(weights) + 1).cast("int")))
    limit = F.lit(float(cap)) * F.col("source_size")
    order = Window.orderBy(limit / F.col("_w"), "_rank")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    after = order.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    everything = Window.partitionBy(F.lit(0))
    ranked = ranked.withColumns({
        "_level": (F.lit(float(share)) * F.sum("source_size").over(everything)
                   - F.coalesce(F.sum(limit).over(before), F.lit(0.0))) / F.sum("_w").over(after),
    })
    ranked = ranked.withColumn("_open", limit > F.col("_level") * F.col("_w"))
    first = F.when(F.col("_open"), F.struct((limit / F.col("_w")).alias("ratio"), "_rank", "_level"))
    ranked = ranked.withColumn("_first", F.min(first).over(everything)).withColumn("_common", F.col("_first._level"))
    return ranked.select("source", "source_size", F.when(F.col("_common").isNull() | ~F.col("_open"), limit)
                         .otherwise(F.col("_common") * F.col("_w")).alias("target"))


def mix(docs: DataFrame, text: str = "text", source: str = "source", doc_id: str = "doc_id",
        weights: Sequence[float] = WEIGHTS, share: float = SHARE, cap: float = CAP, seed: str = SEED,
        ranges: int | None = None) -> DataFrame:
    """``docs`` with ``size``, ``source_size``, ``target``, ``taken`` and ``copies``.

    ``taken`` is the number of words that the mix takes of the row: whole passes over the source
    first, then rows in key order until the source's budget, the last row only in part.
    ``copies`` counts whole rows: the row at the border counts if at least half of it is taken.
    Columns of these names in ``docs`` are replaced. Rows that are equal in id, size and text are
    interchangeable; a null id has a key too. A source without words takes nothing. Without rows
    the result is empty. ``ranges`` are the key ranges per source, by default the number of
    shuffle partitions.
    """
    session = docs.sparkSession
    ranges = ranges or int(session.conf.get("spark.sql.shuffle.partitions"))
    docs = docs.drop("size", "source_size", "target", "taken", "copies")
    key = F.md5(F.concat_ws(":", F.lit(seed), F.coalesce(F.col(doc_id).cast("string"), F.lit(""))))
    keyed = docs.withColumns({"size": word_count(F.col(text)), "_key": key}).withColumn(
        "_range", F.floor(F.conv(F.substring("_key", 1, 8), 16, 10).cast("long") * ranges / F.lit(2**32)).cast("int"))

    sums = keyed.groupBy(F.col(source).alias("source"), "_range").agg(F.sum("size").alias("_sum"))
    targets = source_targets(sums.groupBy("source").agg(F.sum("_sum").alias("source_size")), weights, share, cap)
    running = Window.partitionBy("source").orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    places = sums.withColumn("_before", F.coalesce(F.sum("_sum").over(running), F.lit(0)))
    places = places.join(targets.withColumnRenamed("source", "_source"), F.col("source").eqNullSafe(F.col("_source")))
    places = places.select(F.col("source").alias("_source"), F.col("_range").alias("_place"), "_before", "source_size", "target")

    inside = Window.partitionBy(source, "_range").orderBy(
        "_key", doc_id, "size", F.xxhash64(text)).rowsBetween(Window.unboundedPreceding, -1)
    placed = keyed.withColumn("_inside", F.coalesce(F.sum("size").over(inside), F.lit(0)))
    placed = placed.join(places, F.col(source).eqNullSafe(F.col("_source")) & (F.col("_range") == F.col("_place")))
    budget = F.floor("target").cast("long")
    whole = F.when(F.col("source_size") > 0, F.floor(budget / F.col("source_size"))).otherwise(0).cast("long")
    rest = budget - whole * F.col("source_size")
    part = F.greatest(F.lit(0).cast("long"), F.least(F.col("size"), rest - F.col("_before") - F.col("_inside")))
    counted = placed.withColumns({
        "taken": whole * F.col("size") + part,
        "copies": (whole + F.when((part > 0) & (part * 2 >= F.col("size")), 1).otherwise(0)).cast("int"),
    })
    return counted.drop("_key", "_range", "_inside", "_source", "_place", "_before")


def expand(mixed: DataFrame) -> DataFrame:
    """The mix itself: every row as often as ``copies`` says."""
    return mixed.filter(F.col("copies") > 0).withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("copies")))).drop("_copy")


MIX_SQL = r"""
WITH d AS (SELECT doc_id, source, CAST(coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS BIGINT) AS size,
                  md5('mix:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS k FROM documents),
s AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size, row_number() OVER (ORDER BY encode(source) NULLS LAST) - 1 AS r
      FROM d GROUP BY source),
w AS (SELECT *, CAST([3, 1, 2][CAST(r % 3 AS INT) + 1] AS DOUBLE) AS w, 2.0 * CAST(source_size AS DOUBLE) AS cap FROM s),
l AS (SELECT *, (1.5 * CAST(sum(source_size) OVER () AS DOUBLE)
        - coalesce(sum(cap) OVER (ORDER BY cap / w, r ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
        / sum(w) OVER (ORDER BY cap / w, r ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level FROM w),
c AS (SELECT arg_min(level, cap / w) AS common FROM l WHERE cap > level * w),
t AS (SELECT source, source_size, CASE WHEN common IS NULL OR cap <= level * w THEN cap ELSE common * w END AS target
      FROM l CROSS JOIN c),
p AS (SELECT d.doc_id, d.size, t.source_size, t.target, CAST(floor(t.target) AS BIGINT) AS budget,
        coalesce(sum(d.size) OVER (PARTITION BY d.source ORDER BY d.k, d.doc_id, d.size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
      FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size, source_size, target,
  CAST(CASE WHEN source_size = 0 THEN 0 ELSE (budget // source_size) * size
    + greatest(0, least(size, budget % source_size - before)) END AS BIGINT) AS taken FROM p
"""
