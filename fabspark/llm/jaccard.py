"""Jaccard join on word shingles: rare-first prefix filtering, each pair verified once.

1. Every document's set of shingle hashes gives its size and its class: equal sets are one class.
2. Shingles that repeat inside a task are counted; the most frequent go last in the order of
   every set, all others stand by hash. The order only steers the work: any order that all sets
   share gives the same links.
3. The first ``n - ceil(t n) + 1`` shingles of a set are its prefix; sets that reach the
   threshold share one of them. Prefix entries are sorted by shingle and set size, and each entry
   is paired with the one before it and the first of its list, after length and positional filter.
4. Candidate pairs go through the suffix filter (shingles per hash slot bound the overlap) and
   are verified on the texts; pairs inside one component need no check.
5. In lists of which the sets are not all in one component yet, every set is compared, after the
   same filters, with those of other components. Sets that are candidates of each other by any
   chain form clusters, and a cluster is cut into blocks; a set visits the blocks that hold its
   candidates, and there its overlap with all of them is counted in one go. So no link between
   components is missed, and what moves is one row per set and block, not one per pair.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fabspark.llm.graph import components
from fabspark.llm.storage import saved
from fabspark.llm.text import column, mix, shingle_sets
from fabspark.session import cut_lineage, local_frame

WIDTH = 5
PERCENT = 75
SLOTS = 1024
FREQUENT = 1 << 21  # shingles that the order puts last; any number gives the same links
BLOCK = 128  # sets of a cluster that are verified together
VISITORS = 512  # sets that visit a block in one group
HELD = 4_000_000  # shingles that a task holds to count the repeated ones
PACKED = 100_000  # prefix entries that a task sends at once
SUFFIX_ROWS = 512  # pairs whose slot counts stand side by side
BITS = 1 << 24  # bits of the map that rows pass before they are shuffled for a join
_FLIP = np.uint64(1 << 63)


def _signed(x: np.ndarray) -> np.ndarray:
    return (x ^ _FLIP).view(np.int64)


def class_of(found: np.ndarray) -> int:
    """64-bit name of a set of shingles."""
    with np.errstate(over="ignore"):
        total = np.add.reduce(mix(found + np.uint64(0x9E3779B97F4A7C15))) + np.uint64(len(found))
    return int(mix(np.array([total]))[:1].view(np.int64)[0])


def prefix_length(n: int, percent: int) -> int:
    return n - -(-percent * n // 100) + 1


def _batch(schema: list[tuple[str, pa.DataType]], *columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, (_, t) in zip(columns, schema)], [n for n, _ in schema])


def _repeated(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Values that occur more than once, and how often; ``values`` is sorted in place."""
    values.sort()
    same = np.zeros(len(values) + 1, bool)  # a value equals the one before it
    np.equal(values[1:], values[:-1], out=same[1:-1])
    edges = np.flatnonzero(same[1:] != same[:-1])
    return values[edges[::2]], edges[1::2] - edges[::2] + 1


def describe(docs: DataFrame, width: int) -> DataFrame:
    """Per document (doc_id, row, n, class), and per task its repeated shingles (shingle, count)."""
    schema = [("doc_id", pa.int64()), ("row", pa.int64()), ("n", pa.int64()), ("class", pa.int64()), ("shingle", pa.int64()), ("count", pa.int64())]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = np.empty(HELD, np.uint64), 0  # memory is taken as it is filled

        def repeated() -> pa.RecordBatch:
            found, count = _repeated(held[:size])
            none = pa.nulls(len(found), pa.int64())
            return _batch(schema, none, none, none, none, _signed(found), count)

        seen: set[int] = set()
        for batch in batches:
            sizes, classes = [], []
            for found in shingle_sets(column(batch.column("text")), width):
                sizes.append(len(found))
                name = class_of(found) if len(found) else None
                classes.append(name)
                if name is not None and name not in seen:  # copies count once
                    if size + len(found) > HELD:
                        yield repeated()
                        seen.clear()
                        size = 0
                    seen.add(name)
                    if len(found) <= HELD:  # a larger set repeats nothing in itself
                        held[size:size + len(found)] = found
                        size += len(found)
            none = pa.nulls(len(sizes), pa.int64())
            yield _batch(schema, batch.column("doc_id"), batch.column("row"), sizes, classes, none, none)
        if size:
            yield repeated()

    return docs.select("doc_id", "row", "text").mapInArrow(run, "doc_id long, row long, n long, class long, shingle long, count long")


def frequent_shingles(described: DataFrame) -> np.ndarray:
    """The most frequent shingles, rarest first; at most ``FREQUENT`` of them reach the driver."""
    counts = described.filter("shingle IS NOT NULL").groupBy("shingle").agg(F.sum("count").alias("count"))
    top = counts.orderBy(F.desc("count"), "shingle").limit(FREQUENT).toArrow()
    order = np.lexsort((np.asarray(top["shingle"]), np.asarray(top["count"])))
    return np.asarray(top["shingle"])[order].view(np.uint64) ^ _FLIP


def prefixes(docs: DataFrame, frequent: np.ndarray, width: int, percent: int) -> DataFrame:
    """Prefix entries (shingle, n, class, place) of every set; a task gives a set once."""
    ranked = np.argsort(frequent, kind="stable")
    known, rank = frequent[ranked], ranked.astype(np.int32)
    context = docs.sparkSession.sparkContext.broadcast((known, rank))
    schema = [("shingle", pa.int64()), ("n", pa.int32()), ("class", pa.int64()), ("place", pa.int32())]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, rank = context.value
        seen: set[int] = set()
        for batch in batches:
            keys, sizes, names, counts, held = [], [], [], [], 0
            for found in shingle_sets(column(batch.column("text")), width):
                if not len(found):
                    continue
                name = class_of(found)
                if name in seen:
                    continue
                if len(seen) > 500_000:
                    seen.clear()
                seen.add(name)
                spot = np.searchsorted(known, found)
                hot = known[np.minimum(spot, len(known) - 1)] == found if len(known) else np.zeros(len(found), bool)
                take = prefix_length(len(found), percent)
                head = found[~hot][:take]
                if len(head) < take:
                    late = found[hot]
                    head = np.concatenate([head, late[np.argsort(rank[spot[hot]])][:take - len(head)]])
                keys.append(head)
                sizes.append(len(found))
                names.append(name)
                counts.append(take)
                held += take
                if held > PACKED:
                    yield pack(keys, sizes, names, counts)
                    keys, sizes, names, counts, held = [], [], [], [], 0
            if keys:
                yield pack(keys, sizes, names, counts)

    def pack(keys, sizes, names, counts) -> pa.RecordBatch:
        before = np.cumsum(counts) - counts
        return _batch(schema, _signed(np.concatenate(keys)), np.repeat(sizes, counts), np.repeat(names, counts),
                      np.arange(sum(counts)) - np.repeat(before, counts))

    return docs.select("text").mapInArrow(run, "shingle long, n int, class long, place int")


def overlap_needed(a: np.ndarray, b: np.ndarray, percent: int) -> np.ndarray:
    """Least common shingles of sets of sizes ``a`` and ``b`` at the threshold."""
    return -(-percent * (a + b) // (100 + percent))


def _possible(n1, p1, n2, p2, percent: int) -> np.ndarray:
    """Length and positional filter for entries of one list, the first set being the smaller."""
    most = np.minimum(p1, p2) + np.minimum(n1 - p1, n2 - p2)
    return (100 * n1 >= percent * n2) & (most >= overlap_needed(n1, n2, percent))


PAIR = [("kind", pa.int8()), ("a", pa.int64()), ("b", pa.int64()), ("n", pa.int32()), ("place", pa.int32())]
PAIR_SQL = "kind byte, a long, b long, n int, place int"


def neighbours(entries: DataFrame, percent: int) -> DataFrame:
    """Kind 0: candidate pairs (a, b) of neighbours. Kind 1: entries (a: shingle, b: class) of lists of three or more."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tail = None  # the last two entries and the first of the open list
        for batch in batches:
            if not batch.num_rows:
                continue
            cols = [np.asarray(batch.column(c)).astype(np.int64) for c in ("shingle", "n", "class", "place")]
            carried = 0
            if tail is not None:
                carried = len(tail[0])
                cols = [np.concatenate(x) for x in zip(tail, cols)]
            key, n, name, place = cols
            new = np.concatenate([[True], key[1:] != key[:-1]])
            same = ~new & np.concatenate([[False], name[1:] == name[:-1]])  # a copy from another task
            keep = ~same
            keep[:carried] = True
            key, n, name, place, new = key[keep], n[keep], name[keep], place[keep], new[keep]
            first = np.maximum.accumulate(np.where(new, np.arange(len(key)), 0))
            rank = np.arange(len(key)) - first
            own = np.arange(len(key)) >= carried
            later = np.flatnonzero(own & (rank >= 1))
            left = np.concatenate([later - 1, first[later]])
            right = np.concatenate([later, later])
            ok = (left != right) & (name[left] != name[right]) & _possible(n[left], place[left], n[right], place[right], percent)
            left, right = left[ok], right[ok]
            a, b = np.minimum(name[left], name[right]), np.maximum(name[left], name[right])
            none = np.zeros(len(a), np.int32)
            yield _batch(PAIR, none.astype(np.int8), a, b, none, none)
            # The third entry of a list brings its two predecessors along.
            third = np.flatnonzero(own & (rank == 2))
            more = np.concatenate([third - 2, third - 1, np.flatnonzero(own & (rank >= 2))])
            yield _batch(PAIR, np.ones(len(more), np.int8), key[more], name[more], n[more], place[more])
            size = int(rank[-1]) + 1
            pick = np.arange(len(key) - size, len(key)) if size <= 3 else np.array([first[-1], len(key) - 2, len(key) - 1])
            tail = [x[pick] for x in (key, n, name, place)]

    ordered = entries.repartition("shingle").sortWithinPartitions("shingle", "n", "class")
    return ordered.mapInArrow(run, PAIR_SQL)


def across(entries: DataFrame, percent: int, block: int = 512) -> DataFrame:
    """(class, blocks): for entries (shingle, n, class, place, root, block), the blocks of their candidates
    in other components.

    Lists come sorted by set size; an entry is compared with those held that are large enough.
    """
    schema = [("class", pa.int64()), ("blocks", pa.list_(pa.int64()))]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] | None = None
        for batch in batches:
            cols = [np.asarray(batch.column(c)).astype(np.int64) for c in ("shingle", "n", "class", "place", "root", "block")]
            for start in range(0, batch.num_rows, block):
                now = [c[start:start + block] for c in cols]
                both = now if held is None else [np.concatenate(x) for x in zip(held, now)]
                fresh = len(both[0]) - len(now[0])
                key, n, name, place, root, home = both
                visits: dict[int, list[np.ndarray]] = {}
                for i in range(fresh, len(key)):
                    begin = int(np.searchsorted(key[:i], key[i], "left"))
                    begin += int(np.searchsorted(n[begin:i], -(-percent * n[i] // 100), "left"))
                    other = slice(begin, i)
                    ok = (root[other] != root[i]) & _possible(n[other], place[other], n[i], place[i], percent)
                    if ok.any():
                        visits.setdefault(int(name[i]), []).append(np.unique(home[other][ok]))
                if visits:
                    yield _batch(schema, list(visits), [np.unique(np.concatenate(v)) for v in visits.values()])
                keep = (key == key[-1]) & (100 * n >= percent * n[-1])
                held = [c[keep] for c in both]

    ordered = entries.repartition("shingle").sortWithinPartitions("shingle", "n", "class")
    return ordered.mapInArrow(run, "class long, blocks array<long>")


def placed_sets(classes: DataFrame, pairs: DataFrame, roots: DataFrame) -> DataFrame:
    """(class, root, block) of all ``classes``: the component so far and the block of the cluster."""
    nodes = classes
    for table, name in ((components(pairs.select(F.col("a").alias("u"), F.col("b").alias("v"))), "cluster"), (roots, "root")):
        nodes = nodes.join(table.select(F.col("node").alias("class"), F.col("root").alias(name)), "class", "left")
    nodes = nodes.select("class", F.coalesce("root", "class").alias("root"), F.coalesce("cluster", "class").alias("cluster"))
    sizes = nodes.groupBy("cluster").agg(F.count("*").alias("size"))
    cell = F.pmod(F.xxhash64("class"), F.ceil(F.col("size") / BLOCK))
    return nodes.join(sizes, "cluster").select(
        "class", "root", F.xxhash64("cluster", cell).alias("block"))


def among(table: DataFrame, keys: DataFrame, key: str) -> DataFrame:
    """Rows of ``table`` whose ``key``, a 64-bit hash, is among ``keys``, and some others: a join comes after.

    A bitmap of at most 2 MB is broadcast, so most rows that the join would drop are not shuffled for it.
    """
    spot = F.pmod(F.col(key), F.lit(BITS)) + 1
    marks = keys.select(spot.alias("spot")).groupBy(F.bitmap_bucket_number("spot").alias("_bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("spot")).alias("_bits"))
    place = F.bitmap_bit_position(spot).cast("int")
    byte = F.conv(F.hex(F.substring("_bits", F.floor(place / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("long")
    near = table.withColumn("_bucket", F.bitmap_bucket_number(spot)).join(F.broadcast(marks), "_bucket")
    return near.filter(F.getbit(byte, place % 8) == 1).select(*table.columns)


def outlines(classes: DataFrame, docs: DataFrame, owner: DataFrame, width: int) -> DataFrame:
    """(class, row, n, slots) of one document for each of ``classes``, as a table.

    ``slots`` counts the set's shingles per hash slot. The document is found by the hash of its id
    and text, so null and repeated ids lose none; the class that a text gives is checked. Slots are
    counted where a text is read, so no text is shuffled.
    """
    nodes = cut_lineage(classes.join(owner, "class").select("class", "row"))
    schema = [("row", pa.int64()), ("class", pa.int64()), ("n", pa.int32()), ("slots", pa.binary())]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[tuple[int, int]] = set()
        for batch in batches:
            out = [], [], [], []
            for row, found in zip(batch.column("row").to_pylist(), shingle_sets(column(batch.column("text")), width)):
                if not len(found) or (own := (row, class_of(found))) in seen:
                    continue
                if len(seen) > 100_000:
                    seen.clear()
                seen.add(own)
                for c, x in zip(out, (*own, len(found), np.bincount(_slot(found), minlength=SLOTS).clip(0, 255).astype(np.uint8).tobytes())):
                    c.append(x)
            yield _batch(schema, *out)

    found = among(docs.select("row", "text"), nodes, "row").mapInArrow(run, "row long, class long, n int, slots binary")
    return saved(found.join(nodes.hint("shuffle_hash"), ["row", "class"]).distinct(), "sets")


def texts_of(docs: DataFrame, rows: DataFrame, repeats: bool) -> DataFrame:
    """(row, text) of the documents in ``rows`` and some others, read from ``docs`` again; ``repeats`` if rows may be equal
    in id and text, of which one is kept."""
    near = among(docs.select("row", "text"), rows, "row")
    return saved(near.distinct(), "texts") if repeats else near


def _slot(found: np.ndarray) -> np.ndarray:
    return ((found >> np.uint64(50)) % np.uint64(SLOTS)).astype(np.int64)


def _counts(slots: pa.Array) -> np.ndarray:
    """Slot counts as a matrix. A count at the top of its type stands for any larger one."""
    if isinstance(slots, pa.ChunkedArray):
        slots = slots.combine_chunks()
    rows = np.frombuffer(b"".join(slots.to_pylist()), np.uint8).reshape(-1, SLOTS).astype(np.int32)
    rows[rows == 255] = 1 << 20
    return rows


def visit(visits: DataFrame, placed: DataFrame, outlined: DataFrame, docs: DataFrame, width: int, percent: int, repeats: bool) -> DataFrame:
    """Links (u, v) between sets of (class, block) visits and the sets of the blocks, one per component they reach.

    Slot counts, which bound the overlap, go first; only sets that they let through, of the visitors and of the block, move texts.
    """
    members = placed.join(visits.select("block").distinct(), "block")
    shares = visits.groupBy("block").agg(F.ceil(F.count("*") / VISITORS).cast("int").alias("shares"))
    members = members.join(shares, "block")
    visitors = visits.join(placed.select("class", "root"), "class").join(shares, "block")
    share = F.pmod(F.xxhash64("class"), F.col("shares")).cast("int")
    visitors = visitors.select("class", "root", "block", share.alias("share"))
    members = members.select("class", "root", "block", F.explode(F.sequence(F.lit(0), F.col("shares") - 1)).alias("share"))

    def bound(guests: pa.Table, hosts: pa.Table) -> pa.Table:
        keep, wanted = np.zeros(guests.num_rows, bool), np.zeros(hosts.num_rows, bool)
        if guests.num_rows and hosts.num_rows:
            own, sizes, roots = _counts(hosts["slots"]), np.asarray(hosts["n"]).astype(np.int64), np.asarray(hosts["root"])
            rows = zip(_counts(guests["slots"]), np.asarray(guests["n"]).astype(np.int64), np.asarray(guests["root"]))
            for i, (slots, n, root) in enumerate(rows):
                most = np.minimum(own, slots).sum(axis=1)
                ok = (most >= overlap_needed(sizes, n, percent)) & (roots != root)
                keep[i] = ok.any()
                wanted |= ok
        return pa.concat_tables(
            pa.table({c: side[c].filter(pa.array(mask)) for c in ("class", "root", "block", "share", "row")} | {"guest": pa.array([guest] * int(mask.sum()), pa.bool_())})
            for side, mask, guest in ((guests, keep, True), (hosts, wanted, False)))

    def sets(rows: pa.Table) -> tuple[list[np.ndarray], np.ndarray, np.ndarray]:
        """Sets, classes and components of the rows whose text gives their class."""
        found = list(shingle_sets(column(rows["text"]), width))
        own = np.array([len(f) > 0 and class_of(f) == name for f, name in zip(found, rows["class"].to_pylist())], bool)
        return [f for f, ok in zip(found, own) if ok], np.asarray(rows["class"])[own], np.asarray(rows["root"])[own]

    def compare(guests: pa.Table, hosts: pa.Table) -> pa.Table:
        u, v = [], []
        own, names, roots = sets(hosts)
        if own:
            sizes = np.array([len(f) for f in own], np.int64)
            before, every = np.cumsum(sizes) - sizes, np.concatenate(own)
            for found, name, root in zip(*sets(guests)):
                spot = np.minimum(np.searchsorted(found, every), len(found) - 1)
                common = np.add.reduceat((found[spot] == every).astype(np.int64), before)
                ok = (100 * common >= percent * (sizes + len(found) - common)) & (roots != root)
                _, first = np.unique(roots[ok], return_index=True)
                v += names[ok][first].tolist()
                u += [int(name)] * len(first)
        return pa.table({"u": pa.array(u, pa.int64()), "v": pa.array(v, pa.int64())})

    def meet(guests: DataFrame, hosts: DataFrame, extra: DataFrame, key: str, fn, schema: str) -> DataFrame:
        left, right = guests.join(extra, key), hosts.join(extra, key)
        right = right.toDF(*right.columns)
        return left.groupBy("block", "share").cogroup(right.groupBy("block", "share")).applyInArrow(fn, schema)

    slots = among(outlined.select("class", "row", "n", "slots"), visits.select("class").union(members.select("class")), "class")
    likely = cut_lineage(meet(visitors, members, slots, "class", bound, "class long, root long, block long, share int, row long, guest boolean"))
    guests, hosts = (likely.filter(side).drop("guest") for side in ("guest", "NOT guest"))
    return meet(guests, hosts, texts_of(docs, likely.select("row"), repeats), "row", compare, "u long, v long")


def verify(pairs: DataFrame, outlined: DataFrame, width: int, percent: int,
           narrow: Callable[[DataFrame], tuple[DataFrame, DataFrame]] | None = None) -> DataFrame:
    """Those of the class pairs (a, b) that reach the threshold: slot counts first, then the texts.

    ``narrow`` may cut the pairs that the slot counts let through from their plan, and gives the table with their texts
    by row; else ``outlined`` holds them.
    """
    ends = ["a", "b", "row_a", "row_b"]

    def suffix(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in (b.slice(k, SUFFIX_ROWS) for b in batches for k in range(0, b.num_rows, SUFFIX_ROWS)):
            most = np.minimum(_counts(rows.column("slots_a")), _counts(rows.column("slots_b"))).sum(axis=1)
            sizes = [np.asarray(rows.column(c)).astype(np.int64) for c in ("n_a", "n_b")]
            yield rows.select([c for c in ends if c in rows.schema.names]).filter(pa.array(most >= overlap_needed(*sizes, percent)))

    def exact(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ok = [False] * batch.num_rows
            sets = zip(shingle_sets(column(batch.column("text_a")), width), shingle_sets(column(batch.column("text_b")), width))
            names = zip(batch.column("a").to_pylist(), batch.column("b").to_pylist())
            for i, ((x, y), own) in enumerate(zip(sets, names)):
                common = len(np.intersect1d(x, y, assume_unique=True))
                ok[i] = 100 * common >= percent * (len(x) + len(y) - common) and (class_of(x), class_of(y)) == own
            yield batch.select(["a", "b"]).filter(pa.array(ok, pa.bool_()))

    def both(rows: DataFrame, table: DataFrame, key: str, detail: list[str]) -> DataFrame:
        for side in "ab":
            name = side if key == "class" else f"{key}_{side}"
            rows = rows.join(table.select(F.col(key).alias(name), *[F.col(c).alias(f"{c}_{side}") for c in detail]), name)
        return rows

    likely = both(pairs.select("a", "b"), outlined, "class", ["row", "n", "slots"]).mapInArrow(suffix, "a long, b long, row_a long, row_b long")
    likely, texts = narrow(likely) if narrow else (likely, outlined)
    return both(likely, texts, "row", ["text"]).mapInArrow(exact, "a long, b long")


def _open(pairs: DataFrame, roots: DataFrame) -> DataFrame:
    """Pairs whose classes are in different components so far."""
    for c in ("a", "b"):
        own = roots.select(F.col("node").alias(c), F.col("root").alias(f"root_{c}"))
        pairs = pairs.join(own, c, "left").withColumn(f"root_{c}", F.coalesce(f"root_{c}", c))
    return pairs.filter("root_a != root_b").drop("root_a", "root_b")


def _settle(pairs: DataFrame, outlined: DataFrame, docs: DataFrame, width: int, percent: int, repeats: bool) -> DataFrame:
    """Links among ``pairs``; best pair of each class first, then what is still open."""

    def narrow(likely: DataFrame) -> tuple[DataFrame, DataFrame]:
        likely = cut_lineage(likely)
        return likely, texts_of(docs, likely.select(F.explode(F.array("row_a", "row_b")).alias("row")), repeats)

    links = local_frame(pairs.sparkSession, [], "u long, v long")
    for last in (False, True):
        if not last:
            best = pairs.select(F.col("a").alias("own"), "a", "b", "votes").union(pairs.select("b", "a", "b", "votes"))
            now = best.groupBy("own").agg(F.max(F.struct("votes", "a", "b")).alias("x")).select("x.a", "x.b").distinct()
        else:
            now = pairs
        if not now.take(1):
            break
        checked = cut_lineage(now.select("a", "b"))
        some = among(outlined, checked.select(F.explode(F.array("a", "b")).alias("class")), "class")
        found = verify(checked, some, width, percent, narrow)
        found = cut_lineage(found.select(F.col("a").alias("u"), F.col("b").alias("v")))
        links = links.union(found)
        if not last:
            pairs = cut_lineage(_open(pairs.join(checked, ["a", "b"], "left_anti"), components(links)))
    return links


def jaccard_components(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", width: int = WIDTH,
                       percent: int = PERCENT) -> DataFrame:
    """One row per row of ``docs``: ``doc_id``, ``n_shingles``, ``component_id``.

    Words are lower-cased (A-Z); a text with fewer than ``width`` words is one shingle; a null or
    empty text links with nothing. ``component_id`` is the smallest id reachable by links of
    ``percent`` or more, or the row's own id. Rows that share an id keep their own sets. A null id
    never names a component while another id is there. Other columns are ignored.
    """
    return jaccard_rows(docs, text, doc_id, width, percent).select("doc_id", "n_shingles", "component_id")


def row_key(doc_id: Column, text: Column) -> Column:
    """Hash of a row's id and text; rows equal in both share it."""
    return F.xxhash64(doc_id.cast("long"), text)


def jaccard_rows(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", width: int = WIDTH, percent: int = PERCENT) -> DataFrame:
    """:func:`jaccard_components` with ``row``, the :func:`row_key`, and ``root``, which names the component also
    where ids repeat or are null; null for a row without words."""
    docs = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"), row_key(F.col(doc_id), F.col(text)).alias("row"))
    described = saved(describe(docs, width), "described")
    rows = described.filter("shingle IS NULL").select("doc_id", "row", "n", "class")
    owner = cut_lineage(rows.filter("class IS NOT NULL").groupBy("class").agg(F.min("doc_id").alias("owner"), F.min("row").alias("row")))
    frequent = frequent_shingles(described)
    found = saved(neighbours(prefixes(docs, frequent, width, percent), percent), "neighbours")
    pairs = cut_lineage(found.filter("kind = 0").groupBy("a", "b").agg(F.count("*").alias("votes")))
    lists = found.filter("kind = 1").select(F.col("a").alias("shingle"), "n", F.col("b").alias("class"), "place")
    listed = lists.select("class").distinct()
    outlined = outlines(pairs.select(F.explode(F.array("a", "b")).alias("class")).union(listed).distinct(), docs, owner, width)
    repeats = bool(rows.groupBy("row").count().filter("count > 1").take(1))
    links = _settle(pairs, outlined, docs, width, percent, repeats)

    placed = cut_lineage(placed_sets(listed, pairs, components(links)))
    lists = lists.join(placed, "class")
    split = lists.groupBy("shingle").agg(F.min("root").alias("x"), F.max("root").alias("y")).filter("x != y").select("shingle")
    visits = across(lists.join(split, "shingle"), percent).groupBy("class").agg(F.array_distinct(F.flatten(F.collect_list("blocks"))).alias("x"))
    visits = cut_lineage(visits.select("class", F.explode("x").alias("block")))
    if visits.take(1):
        links = links.union(cut_lineage(visit(visits, placed, outlined, docs, width, percent, repeats)))
    roots = components(links).select(F.col("node").alias("class"), "root")
    named = owner.join(roots, "class", "left").withColumn("root", F.coalesce("root", "class"))
    least = named.groupBy("root").agg(F.min("owner").alias("component_id"))
    named = named.join(least, "root").select("class", "root", "component_id")
    return rows.join(named, "class", "left").select(
        "row", "doc_id", F.col("n").alias("n_shingles"), "root", F.coalesce("component_id", "doc_id").alias("component_id"))
