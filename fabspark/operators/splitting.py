"""Stratified splits, class weights and resampling by id hash.

All draws are functions of the row id and a seed, so they do not depend on partitioning and
a task that runs again draws the same.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fabspark.operators.joins import null_safe_join
from fabspark.operators.ordered import top_k
from fabspark.session import broadcast_if_small, settled

_CELL_BITS = 16
CELL_ROWS = 20_000
MAX_CELLS = 1 << 20


def uniform(*keys: Column | str) -> Column:
    """Uniform double in [0, 1) from a hash of the keys."""
    return F.shiftrightunsigned(F.xxhash64(*keys), 11) / F.lit(float(2**53))


def _share(table: DataFrame, total: Column, size: str, out: str, order: str) -> DataFrame:
    """Add ``out``: ``total`` shared in proportion to ``size``, in whole numbers that add up to it.

    What rounding down leaves goes to the largest remainders. One row per class passes through
    the window.
    """
    everything = Window.partitionBy()
    exact = total * F.col(size) / F.sum(size).over(everything)
    table = table.withColumns({"_exact": F.coalesce(exact, F.lit(0.0)), "_total": total})
    table = table.withColumn("_whole", F.floor("_exact"))
    rank = F.row_number().over(Window.orderBy(F.col("_whole") - F.col("_exact"), F.col(order).cast("string")))
    extra = (rank <= F.col("_total") - F.sum("_whole").over(everything)).cast("long")
    return table.withColumn(out, (F.col("_whole") + extra).cast("long")).drop("_exact", "_whole", "_total")


def split_sizes(df: DataFrame, class_col: str, ratios=(0.70, 0.15, 0.15)) -> DataFrame:
    """Exact rows of ``train``, ``val`` and ``test`` per class, as a table of any number of classes."""
    sizes = df.groupBy(class_col).agg(F.count("*").alias("n"))
    whole = F.sum("n").over(Window.partitionBy())
    sizes = sizes.withColumn("_held", F.ceil(F.round(whole * (1 - ratios[0]), 6)))
    sizes = sizes.withColumn("_kept", whole - F.col("_held"))
    sizes = _share(sizes, F.col("_kept"), "n", "train", class_col).withColumn("_rest", F.col("n") - F.col("train"))
    n_test = F.ceil(F.round(F.col("_held") * ratios[2] / (ratios[1] + ratios[2]), 6))
    sizes = _share(sizes, n_test, "_rest", "test", class_col)
    return sizes.select(class_col, "n", "train", (F.col("_rest") - F.col("test")).alias("val"), "test")


def id_hash(key: Column, seed: int) -> Column:
    """64-bit hash that draws are ordered by."""
    return F.xxhash64(key, F.lit(seed))


def stratified_split(
    df: DataFrame, id_col: str, class_col: str, ratios=(0.70, 0.15, 0.15), seed: int = 42,
    draw: Callable[[Column, int], Column] = id_hash,
) -> DataFrame:
    """Add ``split`` with exact sizes per class; the rows themselves are not shuffled.

    ``draw`` is the 64-bit hash of id and seed that orders the rows of a class.

    Rows of a class are ordered by id hash. Counting hash cells finds the cells that hold the
    two cut ranks, and only rows of those cells are ranked. The cut keys, two per class, then
    decide every row in a map-only pass.
    """
    h = draw(F.col(id_col), seed)
    keyed = df.select(
        F.col(class_col).alias("_c"), F.col(id_col).alias("_id"), h.alias("_h"),
        F.shiftright(h, 64 - _CELL_BITS).cast("int").alias("_cell"),
    )
    sizes = split_sizes(df, class_col, ratios).withColumnRenamed(class_col, "_c")
    cut = F.explode(F.array(*[F.struct(F.lit(k).alias("_cut"), r.cast("long").alias("_rank")) for k, r in (
        (1, F.col("train")), (2, F.col("train") + F.col("val")))]))
    ranks = sizes.select("_c", cut.alias("x")).select("_c", "x.*").filter("_rank > 0")
    # At most 65,536 cells per class.
    upto = Window.partitionBy("_c").orderBy("_cell")
    cells = keyed.groupBy("_c", "_cell").agg(F.count("*").alias("_n")).withColumn("_upto", F.sum("_n").over(upto))
    c_equal = F.col("cells._c").eqNullSafe(F.col("ranks._c"))
    targets = (
        cells.alias("cells").join(broadcast_if_small(ranks).alias("ranks"), c_equal)
        .filter((F.col("_rank") > F.col("_upto") - F.col("_n")) & (F.col("_rank") <= F.col("_upto")))
        .select("cells._c", "_cell", "_cut", (F.col("_rank") - F.col("_upto") + F.col("_n")).alias("_at"))
    )
    targets = broadcast_if_small(targets)
    in_cell = Window.partitionBy("t._c", "t._cell", "_cut").orderBy("_h", "_id")
    cuts = (
        keyed.alias("k").join(
            targets.alias("t"),
            F.col("k._c").eqNullSafe(F.col("t._c")) & (F.col("k._cell") == F.col("t._cell")),
        )
        .withColumn("_rn", F.row_number().over(in_cell))
        .filter(F.col("_rn") == F.col("_at"))
        .select("k._c", "_cut", "_h", "_id")
    )
    table = sizes.select("_c").join(
        cuts.groupBy(F.col("_c").alias("_k")).agg(*[
            F.max(F.when(F.col("_cut") == k, F.col(c))).alias(f"{c}{k}") for k in (1, 2) for c in ("_h", "_id")]),
        F.col("_c").eqNullSafe(F.col("_k")), "left").drop("_k")
    table = broadcast_if_small(table)  # one row per class; beyond the limit the rows are shuffled once

    def before(cut: int) -> Column:
        hc, ic = F.col(f"_h{cut}"), F.col(f"_id{cut}")
        return F.coalesce((h < hc) | ((h == hc) & (F.col(id_col) <= ic)), F.lit(False))

    return (
        df.join(table, F.col(class_col).eqNullSafe(F.col("_c")))
        .withColumn("split", F.when(before(1), "train").when(before(2), "val").otherwise("test"))
        .select(*[c for c in df.columns if c != "split"], "split")
    )


def splits_ok(parts: Sequence[DataFrame], whole: DataFrame, id_col: str) -> DataFrame:
    """One row: rows in the parts, distinct ids, rows in the whole, and ids in more than one part."""
    tagged = None
    for i, part in enumerate(parts):
        ids = part.select(id_col, F.lit(i).alias("part"))
        tagged = ids if tagged is None else tagged.unionByName(ids)
    per_id = (
        tagged.withColumn("whole", F.lit(0))
        .unionByName(whole.select(id_col, F.lit(None).cast("int").alias("part"), F.lit(1).alias("whole")))
        .groupBy(id_col)
        .agg(F.count("part").alias("in_parts"), F.sum("whole").alias("in_whole"))
    )
    return per_id.agg(
        F.sum("in_parts").alias("part_rows"), F.sum("in_whole").alias("whole_rows"),
        F.count_if(F.col("in_parts") > 1).alias("overlapping"),
        F.count_if((F.col("in_parts") == 0) & (F.col("in_whole") > 0)).alias("missing"),
    )


def class_weights(df: DataFrame, class_col: str, kind: str = "balanced") -> DataFrame:
    """Weight per class. ``balanced``: n / (K count); ``inverse``: 1 / (count + 1), normalised to
    sum K; ``balanced_norm``: balanced, normalised to sum K. Windows run over one row per class."""
    all_classes = Window.partitionBy()
    counts = df.groupBy(class_col).agg(F.count("*").alias("n"))
    k = F.count("*").over(all_classes)
    balanced = F.sum("n").over(all_classes) / (k * F.col("n"))
    if kind == "balanced":
        return counts.withColumn("weight", balanced)
    raw = balanced if kind == "balanced_norm" else 1 / (F.col("n") + 1)
    return counts.withColumn("_raw", raw).select(
        class_col, "n", (F.col("_raw") / F.sum("_raw").over(all_classes) * k).alias("weight")
    )


def _place(ascending: Column, value: Column) -> Column:
    """How many entries of an ascending array are at most ``value``, by halving steps."""
    steps = F.array(*[F.lit(1 << p) for p in range(20, -1, -1)])
    return F.aggregate(steps, F.lit(0), lambda at, step: F.when(
        (at + step <= F.size(ascending)) & (F.get(ascending, at + step - 1) <= value), at + step).otherwise(at))


def weighted_resample(
    df: DataFrame, id_col: str, class_col: str, weights: dict | None = None, draws: int | None = None, seed: int = 42,
    draw: Callable[[Column, int], Column] = id_hash, cell_rows: int = CELL_ROWS,
) -> DataFrame:
    """Exactly ``draws`` rows, drawn with replacement by class weight.

    By default classes weigh the same in total and ``draws`` is the number of rows. Each draw goes
    to a class, and in it down a tree over hash cells: every fork sends it left or right in
    proportion to the rows below, which splits the number of draws binomially and so loses none.
    What is left is a place within a cell. Only draws' cells and places are shuffled, added up
    before, and the rows once, by class and cell; no task holds more than a cell. Rows of one id
    and class share their draws in no fixed order. ``draw`` is the hash of a key and a seed.
    """
    spark = df.sparkSession
    counts = df.groupBy(F.col(class_col).alias("_c")).agg(F.count("*").alias("_n"))
    if weights is None:
        own = 1.0 / F.col("_n")
    else:
        given = [x for c, w in weights.items() for x in (F.lit(c), F.lit(float(w)))]
        own = F.coalesce(F.create_map(*given)[F.col("_c")], F.lit(0.0)) if given else F.lit(0.0)
    order = Window.orderBy(F.col("_c").cast("string"))  # one row per class
    sizes = counts.withColumn("_w", own * F.col("_n")).filter("_w > 0")
    share = F.sum("_w").over(order.rowsBetween(Window.unboundedPreceding, 0)) / F.sum("_w").over(Window.partitionBy())
    sizes, _ = settled(sizes.select("_c", "_n", (F.row_number().over(order) - 1).alias("_class"), share.alias("_upto")))
    all_rows, most, classes = counts.agg(F.sum("_n")).first()[0], *sizes.agg(F.max("_n"), F.count("*")).first()
    if not classes:
        return df.limit(0)
    bits = max(0, min(_CELL_BITS, math.ceil(math.log2(max(1.0, most / cell_rows))), int(math.log2(max(1, MAX_CELLS // classes)))))

    h = draw(F.col(id_col), seed)
    cell = (F.shiftright(h, 64 - bits) if bits else F.lit(0)).cast("int")
    rows = df.select("*", F.col(class_col).alias("_c"), cell.alias("_cell"), h.alias("_h"))
    cells = rows.groupBy("_c", "_cell").agg(F.count("*").alias("_m"))
    ahead = Window.partitionBy("_c").orderBy("_cell").rowsBetween(Window.unboundedPreceding, -1)
    cells = cells.withColumn("_before", F.coalesce(F.sum("_m").over(ahead), F.lit(0)))
    tree = cells.groupBy("_c").agg(F.sort_array(F.collect_list(F.struct("_before", "_cell"))).alias("_cells"))
    tree = null_safe_join(sizes.select("_c", "_class", "_n"), tree, ["_c"]).select(
        "*", F.col("_cells._before").alias("_starts"), F.col("_cells._cell").alias("_names")).drop("_cells")
    tree = broadcast_if_small(tree)

    def uniform_of(shift: int) -> Column:
        return draw(F.col("_t"), seed + shift).bitwiseAND(F.lit(2**53 - 1)) / F.lit(float(2**53))

    shares = sizes.agg(F.sort_array(F.collect_list("_upto")).alias("_shares")).withColumn("_one", F.lit(0))
    tickets = spark.range(draws if draws is not None else all_rows).select(F.col("id").alias("_t"), F.lit(0).alias("_one"))
    tickets = tickets.join(F.broadcast(shares), "_one").withColumn("_class", F.least(_place(F.col("_shares"), uniform_of(1)), F.lit(classes - 1)))
    tickets = tickets.select("_t", "_class").join(tree, "_class")
    tickets = tickets.withColumn("_r", F.least(F.floor(uniform_of(2) * F.col("_n")), F.col("_n") - 1))
    tickets = tickets.withColumn("_at", _place(F.col("_starts"), F.col("_r")) - 1)
    taken = tickets.select("_c", F.get("_names", F.col("_at")).alias("_cell"), (F.col("_r") - F.get("_starts", F.col("_at")) + 1).alias("_rank"))
    taken = taken.groupBy("_c", "_cell", "_rank").agg(F.count("*").alias("_k"))

    # Rows and draws of a cell meet in one window: rows are numbered, draws know their number.
    both = rows.withColumn("_flag", F.lit(0)).unionByName(taken.withColumn("_flag", F.lit(1)), allowMissingColumns=True)
    numbered = Window.partitionBy("_c", "_cell").orderBy("_flag", "_h", id_col)
    both = both.withColumn("_rank", F.when(F.col("_flag") == 0, F.row_number().over(numbered)).otherwise(F.col("_rank")))
    both = both.withColumn("_k", F.sum("_k").over(Window.partitionBy("_c", "_cell", "_rank")))
    hit = both.filter("_flag = 0 AND _k > 0")
    return hit.withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("_k")))).select(*df.columns)


def class_sample(
    df: DataFrame, id_col: str, class_col: str, n: int, seed: int = 42, draw: Callable[[Column, int], Column] = id_hash
) -> DataFrame:
    """At most ``n`` rows per class, the first by id hash; two rounds, so no task gets a whole class."""
    hashed = df.withColumn("_h", draw(F.col(id_col), seed))
    return top_k(hashed, [class_col], [F.asc("_h"), F.asc(id_col)], n, "_r").drop("_h", "_r")
