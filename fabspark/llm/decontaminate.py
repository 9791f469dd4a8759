"""Benchmark decontamination by templates: questions that come back with other numbers and names.

Texts become sequences of tokens in which numbers, units after numbers and names inside sentences
are typed placeholders. Windows of eight tokens, at least half of them plain words, are hash-joined
with those of the benchmark items. What stood in the placeholders must fit: along one alignment,
equal values of the item must meet equal values in the document; windows over a value that meets
two do not count, unless all their values are the item's own. Beside them, literal windows of
eight lower-cased words are joined, whatever the words are; a place of the item is found if either
kind matches. A document that holds a sufficient share of an item's windows, or a literal run of
``RUN`` words of it at any length, is contaminated.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fabspark.llm.storage import saved
from fabspark.llm.text import buffers, column, mix, pieces, spans, windows, word_hashes
from fabspark.session import cut_lineage

WIDTH = 8
COVERAGE = 0.3
RUN = 13  # consecutive words of an item that are enough
FILTER_BITS = 24
# Words that read as numbers, and units that may follow a number.
NUMBER_WORDS = "two three four five six seven eight nine ten eleven twelve twenty thirty forty fifty hundred thousand million".split()
UNITS = ("mm cm m km inch inches foot feet yard yards mile miles mg g kg ton tons pound pounds ounce ounces ml l liter liters litre "
         "litres gallon gallons second seconds minute minutes hour hours day days week weeks month months year years dollar "
         "dollars euro euros cent cents percent degree degrees mph kmh watt watts volt volts joule joules").split()
LITERAL = np.uint64(0x5851F42D4C957F2D)  # keeps the hashes of literal windows apart from those of templates
WINDOWS = "id long, literal boolean, place int, spot int, width int, window long, slots array<long>"

_CLASSES = np.zeros(256, np.uint8)
_CLASSES[128:] = 1
_CLASSES[[*range(65, 91), *range(97, 123)]] = 1
_CLASSES[48:58] = 2
_STOPS = np.zeros(256, bool)
_STOPS[list(b".!?:;\n\r\"")] = True
_JOINS = np.zeros(256, bool)
_JOINS[list(b".,/:-")] = True


def _hash_of(words: list[str]) -> np.ndarray:
    data, offsets = buffers(pa.array(words, pa.string()))
    starts, ends, _ = spans(data, offsets)
    return np.sort(word_hashes(data, starts, ends, gaps=True))


def _within(values: np.ndarray, known: np.ndarray) -> np.ndarray:
    return known[np.minimum(np.searchsorted(known, values), len(known) - 1)] == values


def canonical(texts: pa.Array, numbers: np.ndarray, units: np.ndarray):
    """Token hashes with placeholders, tokens before each row, which tokens are placeholders, and their values;

    then the hashes of the plain lower-cased words, words before each row, each word's token, and
    which words begin a line.
    """
    data, offsets = buffers(texts)
    starts, ends, first = spans(data, offsets, _CLASSES)
    count = len(starts)
    if not count:
        none = np.zeros(0, np.uint64)
        return none, first, np.zeros(0, bool), none, none, first, np.zeros(0, np.int64), np.zeros(0, bool)
    value = word_hashes(data, starts, ends, gaps=True)
    opens = np.zeros(count, bool)
    opens[first[:-1][np.diff(first) > 0]] = True
    before = np.concatenate([[0], ends[:-1]])
    gap = np.where(opens, 1, starts - before)
    number = (_CLASSES[data[starts]] == 2) | _within(value, numbers)
    follows = ~opens & np.concatenate([[False], number[:-1]])
    more_digits = number & follows & (gap == 1) & _JOINS[data[np.maximum(starts - 1, 0)]]
    unit = ~number & follows & _within(value, units)
    stops = np.concatenate([[0], np.cumsum(_STOPS[data])])
    begins = opens | (stops[starts] > stops[before])
    lead, second = data[starts], data[np.minimum(starts + 1, len(data) - 1)]
    upper = ((lead >= 65) & (lead <= 90)) | ((lead == 0xC3) & (second >= 0x80) & (second <= 0x9E))
    small = (second >= 97) & (second <= 122) | (second >= 128)
    name = upper & (ends - starts > 1) & small & ~begins & ~number
    more_name = name & ~opens & np.concatenate([[False], name[:-1]]) & (gap == 1)
    head = ~(more_digits | more_name)
    group = np.cumsum(head) - 1
    at = np.flatnonzero(head)
    whole = np.add.reduceat(value * (np.arange(count) - at[group] + 1).astype(np.uint64), at)
    slot = (number | unit | name)[at]
    kinds = mix(np.array([101, 102, 103], np.uint64))
    token = np.where(number[at], kinds[0], np.where(unit[at], kinds[1], np.where(name[at], kinds[2], value[at])))
    breaks = np.concatenate([[0], np.cumsum((data == 10) | (data == 13))])
    return token, np.searchsorted(at, first), slot, whole, value, first, group, opens | (breaks[starts] > breaks[before])


def template_windows(rows: DataFrame, widths: list[int] | None, bits: np.ndarray | None, width: int) -> DataFrame:
    """Windows of (id, text) rows, of templates and literal ones; ``spot`` is the token where a window begins.

    ``widths`` None: one width per row, the text's length if that is smaller; texts without two
    plain words have no literal windows. ``bits``: a bit per leading hash bits of the wanted
    windows; only windows with their bit set come out.
    """
    context = rows.sparkSession.sparkContext
    shared = context.broadcast(bits) if bits is not None else None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        numbers, units = _hash_of(NUMBER_WORDS), _hash_of(UNITS)
        wanted = shared.value if shared is not None else None
        for batch in batches:
            for start, texts in pieces(column(batch.column("text"))):
                token, heads, slot, value, word, opens, group, line = canonical(texts, numbers, units)
                head = np.flatnonzero(np.diff(group, prepend=-1)) if len(group) else group
                plain, own = np.concatenate([[0], np.cumsum(~slot)]), np.concatenate([[0], slot.cumsum()])
                for literal in (False, True):
                    parts, first = (word, opens) if literal else (token, heads)
                    lengths = np.diff(first)
                    for size in widths or [width]:
                        found, before = windows(parts, first, size)
                        row = np.repeat(np.arange(len(texts)), np.diff(before))
                        place = np.arange(len(found)) - before[row]
                        begin = first[row] + place
                        took = np.minimum(lengths[row], size)
                        if literal:
                            found = found ^ LITERAL
                            keep = (plain[heads[1:]] - plain[heads[:-1]] >= 2)[row] if not widths else np.ones(len(found), bool)
                            spot = group[begin] - heads[row]
                        else:
                            keep = plain[begin + took] - plain[begin] >= np.maximum(2, (took + 1) // 2)
                            spot = place
                        if widths:
                            keep &= took == size
                        if widths and size < width:  # a short item counts as a line of its own only
                            edge = np.append(line if literal else line[head], True)
                            keep &= edge[begin] & edge[begin + took]
                        if wanted is not None:
                            top = found >> np.uint64(64 - FILTER_BITS)
                            keep &= (wanted[(top >> np.uint64(6)).astype(np.int64)] >> (top & np.uint64(63))) & np.uint64(1) == 1
                        pick = np.flatnonzero(keep)
                        a, b = (own[begin[pick]], own[begin[pick] + took[pick]]) if not literal else (np.zeros(len(pick), np.int64),) * 2
                        after = np.concatenate([[0], np.cumsum(b - a)])
                        slots = value[slot][np.arange(after[-1]) - np.repeat(after[:-1] - a, b - a)]
                        yield pa.RecordBatch.from_arrays([
                            batch.column("id").slice(start, len(texts)).take(pa.array(row[pick])), pa.array(np.full(len(pick), literal)),
                            pa.array(place[pick], pa.int32()), pa.array(spot[pick], pa.int32()),
                            pa.array(took[pick], pa.int32()), pa.array(found[pick].view(np.int64)),
                            pa.ListArray.from_arrays(pa.array(after, pa.int32()), pa.array(slots.view(np.int64))),
                        ], ["id", "literal", "place", "spot", "width", "window", "slots"])

    return rows.select("id", "text").mapInArrow(run, WINDOWS)


def window_filter(items: DataFrame) -> np.ndarray:
    """One bit per leading bits of the windows' hashes: 2 MB at any number of windows."""
    top = F.shiftrightunsigned("window", 64 - FILTER_BITS)
    words = items.select((top / 64).cast("long").alias("word"), F.expr(f"shiftleft(1L, cast(shiftrightunsigned(window, {64 - FILTER_BITS}) % 64 AS int))").alias("bit"))
    table = words.groupBy("word").agg(F.bit_or("bit").alias("bits")).toArrow()
    bits = np.zeros(1 << (FILTER_BITS - 6), np.uint64)
    bits[np.asarray(table["word"])] = np.asarray(table["bits"]).view(np.uint64)
    return bits


def contaminated(docs: DataFrame, benchmark: DataFrame, text: str = "text", doc_id: str = "doc_id", item_id: str = "item_id",
                 item_text: str = "text", width: int = WIDTH, coverage: float = COVERAGE, run: int = RUN) -> DataFrame:
    """Contaminated documents with the items they hold.

    ``doc_id``, ``item_id``, ``windows`` (distinct places of the item where a window of either kind
    is found), ``coverage`` (their share, or that of the template windows alone if that is
    larger; below ``coverage`` for documents with ``run`` consecutive words), ``slots`` (placeholders along the alignments), ``changed`` (how many of those hold
    another value than the item does).

    An item shorter than ``width`` tokens is one window of its own length and matches only as a
    whole line, since short phrases occur in any text; an item without two plain words, a null or
    an empty one never matches. Equal ids count as one document or item;
    null ids are one too. Other columns are ignored.
    """
    docs = docs.select(F.col(doc_id).cast("long").alias("id"), F.col(text).alias("text"))
    items = benchmark.select(F.col(item_id).cast("long").alias("id"), F.col(item_text).alias("text"))
    theirs = cut_lineage(template_windows(items, None, None, width))
    widths = sorted(r[0] for r in theirs.select("width").distinct().collect())  # at most ``width`` numbers
    form = F.when(~F.col("literal"), F.col("spot"))
    sizes = theirs.groupBy(F.col("id").alias("_item")).agg(F.count_distinct("spot").alias("all_windows"), F.count_distinct(form).alias("all_forms"))
    ours = template_windows(docs, widths or [width], window_filter(theirs), width).drop("spot").dropDuplicates()
    hits = ours.select(F.col("id").alias("doc_id"), F.col("place").alias("at"), "window", F.col("slots").alias("ours")).join(
        theirs.select(F.col("id").alias("item_id"), "literal", "place", "spot", "window", F.col("slots").alias("theirs")), "window")
    line = ["doc_id", "item_id", "literal", "offset"]
    hits = cut_lineage(hits.select("doc_id", "item_id", "literal", (F.col("at") - F.col("place")).alias("offset"), "place", "spot", "ours", "theirs"))
    pairs = hits.filter(F.size("theirs") > 0).select(*line, F.explode(F.arrays_zip("theirs", "ours")).alias("x"))
    pairs = pairs.select(*line, F.col("x.theirs").alias("theirs"), F.col("x.ours").alias("ours")).distinct()
    values = pairs.groupBy(*line, "theirs").agg(F.count("*").alias("n"), F.count_if(F.col("ours") != F.col("theirs")).alias("other"))
    fits = values.groupBy(*line).agg(F.collect_list(F.when(F.col("n") > 1, F.col("theirs"))).alias("clash"),
                                     F.count("*").alias("slots"), F.count_if(F.col("other") > 0).alias("changed"))
    fits = fits.withColumnsRenamed({c: f"_{c}" for c in line})
    kept = hits.join(fits, [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in line], "left").filter(
        "clash IS NULL OR theirs = ours OR NOT arrays_overlap(theirs, clash)")
    lines = kept.groupBy(*line).agg(F.collect_set("spot").alias("spots"), F.max("slots").alias("slots"), F.max("changed").alias("changed"),
                                    F.sort_array(F.collect_set(F.when(F.col("literal"), F.col("place")))).alias("places"))
    ahead = max(1, run - width + 1) - 1  # consecutive windows after the first that hold ``run`` words
    ends = F.zip_with(F.expr(f"slice(places, {ahead + 1}, greatest(size(places) - {ahead}, 0))"),
                      F.expr(f"slice(places, 1, greatest(size(places) - {ahead}, 0))"), lambda b, a: b - a)
    lines = lines.withColumn("long", F.array_contains(ends, F.lit(ahead)))

    def distinct(spots: Column) -> Column:
        return F.size(F.array_distinct(F.flatten(F.collect_list(spots))))

    found = lines.groupBy("doc_id", "item_id").agg(
        F.bool_or("long").alias("long"), distinct(F.col("spots")).alias("windows"), distinct(F.when(~F.col("literal"), F.col("spots"))).alias("forms"),
        F.coalesce(F.max("slots"), F.lit(0)).alias("slots"), F.coalesce(F.max("changed"), F.lit(0)).alias("changed"))
    found = found.join(sizes, F.col("item_id").eqNullSafe(F.col("_item")))
    share = F.greatest(F.col("windows") / F.col("all_windows"), F.try_divide("forms", "all_forms"))
    return found.withColumn("coverage", share).filter((F.col("coverage") >= coverage) | F.col("long")).select(
        "doc_id", "item_id", F.col("windows").cast("long").alias("windows"), "coverage", "slots", "changed")


def clean(docs: DataFrame, benchmark: DataFrame, **settings) -> DataFrame:
    """``docs`` without the contaminated ones; rows with a null id stay."""
    key = settings.get("doc_id", "doc_id")
    bad = saved(contaminated(docs, benchmark, **settings).select(F.col("doc_id").alias(key)).distinct(), "contaminated")
    return docs.join(bad, key, "left_anti")
