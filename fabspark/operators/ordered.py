"""Work over one global order, without sorting everything in one task.

A plain ``Window.orderBy(id)`` moves the whole table to one partition. Here the order
column is cut into value ranges ("buckets") of bounded size. Frames that look back a few
rows get copies of the rows just before their bucket (``halo_frames``); running totals
get the combined result of all earlier buckets (``running``). Both are exact.

The order column may be a number, a date, a timestamp or text, and must be unique within a
series, as ids are. Ranges are cut on a double that never reverses the column's own order;
values with equal doubles share a range, and inside a range the column itself orders.
Operators on an aggregate can be given ``cuts`` taken from its raw input, which saves
computing the aggregate just to place the cut points.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fabspark.operators.joins import null_safe_join
from fabspark.operators.sketches import SIZE, SMALLEST, number, quantiles, rank_error
from fabspark.session import settled

ROWS_PER_BUCKET = 1_000_000
MIN_ROWS_PER_BUCKET = 20_000
MAX_BUCKETS = 10_000  # the driver and each task hold this many cut points at most
SAMPLES_PER_BUCKET = 500
RANKED_WHOLE = 20_000
BUCKET = "_bucket"
_KEY = "_order_key"


class Cuts(list):
    """Ascending inner cut points; for text, ``skip`` is the length of the prefix that all values share."""

    skip = 0


def _text_key(text: Column, skip: int) -> Column:
    """Six bytes after the first ``skip`` as a number: ascends with the text's byte order."""
    part = F.substring(F.substring(text.cast("binary"), skip + 1, 6), 1, 6)
    return F.conv(F.rpad(F.hex(part), 12, "0"), 16, 10).cast("double")


def _shared_prefix(df: DataFrame, col: str) -> int:
    """Bytes that all values of a text column start with."""
    low, high = df.agg(F.min(col).cast("binary"), F.max(col).cast("binary")).first()
    if low is None:
        return 0
    return next((i for i, (a, b) in enumerate(zip(low, high)) if a != b), min(len(low), len(high)))


def _order_key(df: DataFrame, order_col: str, skip: int = 0) -> Column:
    kind = df.schema[order_col].dataType
    if isinstance(kind, T.StringType):
        return _text_key(F.col(order_col), skip)
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        return F.unix_micros(F.col(order_col).cast("timestamp")).cast("double")
    if isinstance(kind, T.DateType):
        return F.unix_date(order_col).cast("double")
    return F.col(order_col).cast("double")


def bucket_count(df: DataFrame, rows_per_bucket: int) -> tuple[int, int]:
    """Rows, and the ranges to cut them into: bounded size, and work for every core."""
    n_rows = df.count()
    cores = df.sparkSession.sparkContext.defaultParallelism
    wanted = max(math.ceil(n_rows / rows_per_bucket), min(cores, n_rows // min(MIN_ROWS_PER_BUCKET, rows_per_bucket)))
    return n_rows, min(MAX_BUCKETS, wanted)


def _cut_points(keys: DataFrame, n_rows: int, n_buckets: int) -> list[list[float]]:
    # A sample places the cuts, as for any range partitioning. Their exact position only
    # affects how even the ranges are.
    fraction = min(1.0, SAMPLES_PER_BUCKET * n_buckets / max(n_rows, 1))
    sample = keys if fraction == 1.0 else keys.sample(fraction, seed=42)
    probs = [i / n_buckets for i in range(1, n_buckets)]
    return [sorted(set(cuts)) for cuts in sample.approxQuantile(keys.columns, probs, 0.1 / n_buckets)]


def range_cuts(df: DataFrame, order_col: str, rows_per_bucket: int = ROWS_PER_BUCKET) -> Cuts:
    """Ascending inner cut points that split ``df`` into ranges of about ``rows_per_bucket``.

    One scan of one column; only the cut points reach the driver. Equal values fall in one
    range.
    """
    n_rows, n_buckets = bucket_count(df, rows_per_bucket)
    cuts = Cuts()
    if n_buckets > 1:
        if isinstance(df.schema[order_col].dataType, T.StringType):
            cuts.skip = _shared_prefix(df, order_col)
        cuts += _cut_points(df.select(_order_key(df, order_col, cuts.skip).alias(_KEY)), n_rows, n_buckets)[0]
    return cuts


def with_buckets(df: DataFrame, order_col: str, cuts: Sequence[float]) -> DataFrame:
    """Add ``_bucket``: the index of the range that holds the order value."""
    if not cuts:
        return df.withColumn(BUCKET, F.lit(0))
    splits = [-math.inf, *cuts, math.inf]
    keyed = df.withColumn(_KEY, _order_key(df, order_col, getattr(cuts, "skip", 0)))
    bucketizer = Bucketizer(splits=splits, inputCol=_KEY, outputCol="_bucket_d", handleInvalid="keep")
    return (
        bucketizer.transform(keyed)
        .withColumn(BUCKET, F.coalesce(F.col("_bucket_d").cast("int"), F.lit(0)))
        .drop(_KEY, "_bucket_d")
    )


def halo_frames(
    df: DataFrame,
    order_col: str,
    preceding: int,
    series: Sequence[str] = (),
    rows_per_bucket: int = ROWS_PER_BUCKET,
    cuts: Sequence[float] | None = None,
) -> tuple[DataFrame, Window]:
    """Rows plus halo copies, and the window to use on them.

    Returns ``(frame, window)``. ``window`` is partitioned by series and bucket and ordered;
    any frame of at most ``preceding`` rows back is the same as over the whole series for
    rows with ``_halo = false``. Callers drop the ``_halo`` rows afterwards.

    A row among the last ``preceding`` of its series in a bucket is copied to every later
    bucket that still needs it, so buckets may hold fewer rows than the frame.
    """
    series = list(series)
    if cuts is None:
        cuts = range_cuts(df, order_col, rows_per_bucket)
    rows = with_buckets(df, order_col, cuts)
    window = Window.partitionBy(*series, BUCKET).orderBy(order_col)
    if not cuts:
        return rows.withColumn("_halo", F.lit(False)), window

    # Later non-empty buckets of the series, at most ``preceding`` of them. Without a
    # series this window has one row per bucket.
    per_bucket = rows.groupBy(*series, BUCKET).agg(F.count("*").alias("_n"))
    ahead = Window.partitionBy(*(series or [F.lit(0)])).orderBy(BUCKET).rowsBetween(1, preceding)
    following = per_bucket.select(
        *series, BUCKET, F.collect_list(F.struct(BUCKET, "_n")).over(ahead).alias("_next")
    )
    # Rank-and-filter keeps only the last few rows per bucket before the shuffle.
    from_end = Window.partitionBy(*series, BUCKET).orderBy(F.desc(order_col))
    tails = rows.withColumn("_after", F.row_number().over(from_end)).filter(F.col("_after") <= preceding)

    start = F.struct((F.col("_after") - 1).cast("long").alias("gap"), F.array().cast("array<int>").alias("to"))
    targets = F.aggregate(
        "_next",
        start,
        lambda acc, nxt: F.struct(
            (acc["gap"] + nxt["_n"]).alias("gap"),
            F.when(acc["gap"] < preceding, F.concat(acc["to"], F.array(nxt[BUCKET])))
            .otherwise(acc["to"]).alias("to"),
        ),
        lambda acc: acc["to"],
    )
    halo = (
        null_safe_join(tails, following, [*series, BUCKET])
        .withColumn(BUCKET, F.explode(targets))
        .select(*rows.columns, F.lit(True).alias("_halo"))
    )
    return rows.withColumn("_halo", F.lit(False)).unionByName(halo), window


def rolling_mean(
    df: DataFrame,
    order_col: str,
    cols: Sequence[str],
    width: int = 25,
    series: Sequence[str] = (),
    rows_per_bucket: int = ROWS_PER_BUCKET,
    cuts: Sequence[float] | None = None,
) -> DataFrame:
    """Mean of the last ``width`` rows of each column, as ``<col>_roll<width>``; NULLs are skipped."""
    frame, window = halo_frames(df, order_col, width - 1, series, rows_per_bucket, cuts)
    last = window.rowsBetween(-(width - 1), 0)
    return (
        frame.select("*", *[F.avg(c).over(last).alias(f"{c}_roll{width}") for c in cols])
        .filter(~F.col("_halo"))
        .drop(BUCKET, "_halo")
    )


_KINDS = {"sum": F.sum, "max": F.max, "min": F.min, "total": F.sum}


def running(
    df: DataFrame,
    order_col: str,
    exprs: dict[str, tuple[str, Column]],
    series: Sequence[str] = (),
    descending: bool = False,
    cuts: Sequence[float] | None = None,
    rows_per_bucket: int = ROWS_PER_BUCKET,
) -> DataFrame:
    """Running ``sum``, ``max`` or ``min`` up to and including each row; ``total`` of its series.

    ``exprs`` maps an output name to ``(kind, column)``. Each bucket is reduced first; the
    reduced values of earlier buckets (one row per series and bucket) are carried in.
    """
    if cuts is None:
        cuts = range_cuts(df, order_col, rows_per_bucket)
    rows = with_buckets(df, order_col, cuts)
    return running_in_buckets(rows, order_col, exprs, series, descending, carried=bool(cuts)).drop(BUCKET)


def running_in_buckets(
    rows: DataFrame,
    order_col: str,
    exprs: dict[str, tuple[str, Column]],
    series: Sequence[str] = (),
    descending: bool = False,
    carried: bool = True,
) -> DataFrame:
    """``running`` for rows that have their ``_bucket``; ``carried=False`` if there is only one.

    The carried values come in as one extra first row per series and bucket, so the window
    adds them by itself and no join is needed.
    """
    keys = [*series, BUCKET]
    direction = F.desc if descending else F.asc
    inputs = rows.select("*", *[value.alias(f"_in_{out}") for out, (_, value) in exprs.items()])
    local = Window.partitionBy(*keys)
    upto = local.orderBy("_real", direction(order_col)).rowsBetween(Window.unboundedPreceding, 0)
    frame = inputs.withColumn("_real", F.lit(True))
    if carried:
        whole = Window.partitionBy(*(series or [F.lit(0)]))
        before = whole.orderBy(direction(BUCKET)).rowsBetween(Window.unboundedPreceding, -1)
        carry = (
            inputs.groupBy(*keys)
            .agg(*[_KINDS[kind](f"_in_{out}").alias(f"_in_{out}") for out, (kind, _) in exprs.items()])
            .select(*keys, *[
                _KINDS[kind](f"_in_{out}").over(whole if kind == "total" else before).alias(f"_in_{out}")
                for out, (kind, _) in exprs.items()
            ], F.lit(False).alias("_real"))
        )
        totals = [out for out, (kind, _) in exprs.items() if kind == "total"]
        frame = frame.withColumns({f"_in_{out}": F.lit(None).cast(frame.schema[f"_in_{out}"].dataType) for out in totals})
        frame = frame.unionByName(carry, allowMissingColumns=True)
    return (
        frame.select("*", *[
            _KINDS[kind](f"_in_{out}").over(local if kind == "total" else upto).alias(out)
            for out, (kind, _) in exprs.items()
        ])
        .filter("_real")
        .select(*rows.columns, *exprs)
    )


def value_counts(df: DataFrame, keys: Sequence[str], value_col: str, *extra: Column) -> DataFrame:
    """Rows per key and distinct value, with ``n``; shrinks the data before any ordering."""
    return (
        df.filter(F.col(value_col).isNotNull())
        .groupBy(*keys, value_col)
        .agg(F.count("*").alias("n"), *extra)
    )


def long_value_counts(
    df: DataFrame,
    keys: Sequence[str],
    cols: Sequence[str],
    extra: dict[str, Column] | None = None,
    rows_per_bucket: int = ROWS_PER_BUCKET,
) -> tuple[DataFrame, bool]:
    """``(keys, param, _bucket, value, n, extra...)`` for several columns, and whether there are cuts.

    Every column gets its own cut points; they all come from one scan, and the counts from
    one more. ``extra`` maps output names to aggregates over the rows of a value.
    """
    n_rows, n_buckets = bucket_count(df, rows_per_bucket)
    key_cols = [f"_k_{c}" for c in cols]
    wide = df.select("*", *[_order_key(df, c).alias(k) for c, k in zip(cols, key_cols)])
    at: dict[str, Column] = {c: F.lit(0) for c in cols}
    if n_buckets > 1:
        cuts = dict(zip(cols, _cut_points(wide.select(key_cols), n_rows, n_buckets)))
        some = [c for c in cols if cuts[c]]  # a column without values has no cut points
        if some:
            wide = Bucketizer(
                splitsArray=[[-math.inf, *cuts[c], math.inf] for c in some], inputCols=[f"_k_{c}" for c in some],
                outputCols=[f"_b_{c}" for c in some], handleInvalid="keep",
            ).transform(wide)
        at |= {c: F.coalesce(F.col(f"_b_{c}").cast("int"), F.lit(0)) for c in some}
    # Whole numbers and decimals keep their own type: as doubles, large ones would fall together.
    own = len({df.schema[c].dataType.simpleString() for c in cols}) == 1
    items = F.array(*[
        F.struct(F.lit(c).alias("param"), at[c].alias(BUCKET), F.col(c if own else f"_k_{c}").alias("value")) for c in cols
    ])
    long = wide.withColumn("_item", F.explode(items)).filter(F.col("_item.value").isNotNull())
    counts = long.groupBy(*keys, *[F.col(f"_item.{c}").alias(c) for c in ("param", BUCKET, "value")]).agg(
        F.count("*").alias("n"), *[agg.alias(name) for name, agg in (extra or {}).items()]
    )
    return counts, n_buckets > 1


def exact_quantiles(
    df: DataFrame,
    keys: Sequence[str],
    cols: str | Sequence[str],
    probs: dict[str, float],
    rows_per_bucket: int = ROWS_PER_BUCKET,
    discrete: bool = False,
) -> DataFrame:
    """Exact quantiles: one row per key, or per key and ``param`` for a list of columns.

    Interpolated, or with ``discrete`` the first value at or above the wanted share. Two scans, see
    :func:`summarised_quantiles`. A column without values has no row.
    """
    single = isinstance(cols, str)
    _, out = summarised_quantiles(df, keys, [cols] if single else list(cols), probs, {}, rows_per_bucket, discrete)
    return out.drop("param") if single else out


def summarised_quantiles(
    df: DataFrame,
    keys: Sequence[str],
    cols: Sequence[str],
    probs: dict[str, float],
    extra: dict[str, Callable[[str], Column]],
    rows_per_bucket: int = ROWS_PER_BUCKET,
    discrete: bool = False,
    margin: float = 4.0,
) -> tuple[DataFrame, DataFrame]:
    """``(keys, param, n, extra...)`` and ``(keys, param, quantiles...)``, computed.

    The first scan makes one quantile sketch per key and column, with the ``extra`` aggregates, and
    a little below and above each wanted share (``margin`` times the sketch's rank error) it reads
    the ends of a bracket. The second scan counts rows between brackets as one and inside them per
    value, so ranks are exact and only the few values inside are ordered. Should a wanted rank lie
    outside its bracket after all, its group is done again with a wider one. A group of up to
    ``RANKED_WHOLE`` rows (or ``rows_per_bucket``, if that is less) is its own bracket.
    """
    names, keys = list(cols), list(keys)
    limit = max(SMALLEST, min(rows_per_bucket, RANKED_WHOLE))
    size = min(limit, SIZE)
    spread = margin * rank_error(size)
    shares = list(probs.values())
    by = keys or ["_all"]
    rows = df.select(*keys, *names) if keys else df.select(F.lit(0).alias("_all"), *names)
    at = [min(max(p + sign * spread, 0.0), 1.0) for sign in (-1, 1) for p in shares]

    def ends(i: int, c: str) -> list[Column]:
        value = number(rows, c)
        read = F.when(F.count(c) > limit, quantiles(F.kll_sketch_agg_double(value, F.lit(size)), at))
        low, high = F.min(value), F.max(value)
        return [F.count(c).alias(f"_n{i}"), *[F.array(*[
            end if not 0 < p + sign * spread < 1 else F.coalesce(F.get(read, F.lit(j + first)), end)
            for j, p in enumerate(shares)]).alias(f"{name}{i}") for name, sign, first, end in (("_lo", -1, 0, low), ("_hi", 1, len(shares), high))]]

    more = [F.struct(*[make(c).alias(name) for name, make in extra.items()]).alias(f"_x{i}") for i, c in enumerate(names)] if extra else []
    bounds, small = settled(rows.groupBy(*by).agg(*[f for i, c in enumerate(names) for f in ends(i, c)], *more))
    basics = F.array(*[F.struct(F.lit(c).alias("param"), F.col(f"_n{i}").alias("n"), *[F.col(f"_x{i}.{name}").alias(name) for name in extra])
                       for i, c in enumerate(names)])
    basics = bounds.select(*by, F.explode(basics).alias("b")).select(*by, "b.*")

    edges = bounds.select(*by, *[f"{e}{i}" for i in range(len(names)) for e in ("_lo", "_hi")])
    bounded = null_safe_join(rows, F.broadcast(edges) if small else edges, by)
    own = len({df.schema[c].dataType.simpleString() for c in names}) == 1
    items = []
    for i, c in enumerate(names):
        value = number(rows, c)
        pairs = [(F.get(f"_lo{i}", F.lit(j)), F.get(f"_hi{i}", F.lit(j))) for j in range(len(shares))]
        # How many ends a value has passed never falls as it grows, so these codes are ranges in order.
        code = reduce(lambda a, b: a + b, [(value >= lo).cast("int") + (value > hi).cast("int") for lo, hi in pairs])
        inside = reduce(lambda a, b: a | b, [value.between(lo, hi) for lo, hi in pairs])
        items.append(F.when(F.col(c).isNotNull(), F.struct(
            F.lit(c).alias("param"), code.alias(BUCKET), F.when(inside, F.col(c) if own else value).alias("value"))))
    long = bounded.select(*by, F.explode(F.array(*items)).alias("x")).filter("x IS NOT NULL").select(*by, "x.*")
    counts = long.groupBy(*by, "param", BUCKET, "value").agg(F.count("*").alias("n"))
    found, _ = settled(quantiles_of_counts(counts, True, [*by, "param"], probs, discrete))
    lost = found.filter(reduce(lambda a, b: a | b, [F.col(p).isNull() for p in probs]))
    if spread < 1 and not lost.isEmpty():
        again = null_safe_join(rows, lost.select(*by).distinct(), by, "left_semi")
        _, wider = summarised_quantiles(again, by, names, probs, {}, rows_per_bucket, discrete, 8 * margin)
        found = null_safe_join(found, lost.select(*by).distinct(), by, "left_anti").unionByName(wider)
    return (basics, found) if keys else (basics.drop("_all"), found.drop("_all"))


def quantiles_of_counts(
    counts: DataFrame, cut: bool, by: Sequence[str], probs: dict[str, float], discrete: bool = False
) -> DataFrame:
    """Quantiles from a ``long_value_counts`` table."""
    ranked = running_in_buckets(
        counts, "value", {"_upto": ("sum", F.col("n")), "_total": ("total", F.col("n"))}, by, carried=cut)
    return _values_at(ranked, by, probs, discrete)


def _values_at(ranked: DataFrame, by: Sequence[str], probs: dict[str, float], discrete: bool) -> DataFrame:
    """Quantiles from values with ``n``, ``_upto`` and ``_total``."""
    def holds(rank: Column) -> Column:
        return (rank >= F.col("_upto") - F.col("n")) & (rank < F.col("_upto"))

    def position(p: float) -> Column:
        if discrete:
            return F.greatest(F.ceil(p * F.col("_total")) - 1, F.lit(0)).cast("double")
        return p * (F.col("_total") - 1)

    wanted = [holds(f(position(p))) for p in probs.values() for f in (F.floor, F.ceil)]
    condition = wanted[0]
    for w in wanted[1:]:
        condition = condition | w
    picked = (
        ranked.filter(condition)
        .groupBy(*by)
        .agg(
            F.first("_total").alias("_total"),
            *[F.max(F.when(holds(f(position(p))), F.col("value"))).alias(f"_{end}_{name}")
              for end, f in (("lo", F.floor), ("hi", F.ceil)) for name, p in probs.items()],
        )
    )
    return picked.select(*by, *[
        (F.col(f"_lo_{name}").cast("double") + (F.col(f"_hi_{name}") - F.col(f"_lo_{name}")).cast("double")
         * (position(p) - F.floor(position(p)))).alias(name)
        for name, p in probs.items()
    ])


def average_ranks(counts: DataFrame, series: Sequence[str], carried: bool) -> DataFrame:
    """Add ``avg_rank`` (ties share their mean rank) to a ``long_value_counts`` table."""
    upto = running_in_buckets(counts, "value", {"_upto": ("sum", F.col("n"))}, series, carried=carried)
    return upto.withColumn("avg_rank", F.col("_upto") - F.col("n") + (F.col("n") + 1) / F.lit(2.0)).drop("_upto")


def top_k(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[Column],
    k: int,
    rank_col: str = "rank",
    salts: int = 32,
) -> DataFrame:
    """First ``k`` rows per key under a total order.

    Two rounds: the best ``k`` of each salted share of a key, then the best ``k`` of those,
    so no task receives a whole hot key.
    """
    keys = list(keys)
    plain = [f.name for f in df.schema.fields if isinstance(f.dataType, T.AtomicType) and f.dataType != T.BinaryType()]
    salted = df.withColumn("_salt", F.pmod(F.xxhash64(*plain), F.lit(salts)))
    first = Window.partitionBy(*keys, "_salt").orderBy(*order)
    final = Window.partitionBy(*(keys or [F.lit(0)])).orderBy(*order)
    return (
        salted.withColumn("_r", F.row_number().over(first)).filter(F.col("_r") <= k).drop("_r", "_salt")
        .withColumn(rank_col, F.row_number().over(final)).filter(F.col(rank_col) <= k)
    )
