"""Spelling variants: frequent words one letter apart, each led to its most frequent neighbour.

Letters fall into groups, the most frequent ones alone and the others together, and a word is the
vector of its letters' counts per group. Words one edit apart differ by at most one surplus and one
deficit in these counts. Vectors form a trie, a level per group. Its top levels are cells that
Spark deals: a word stays in its own cell and visits those that its budget reaches, in one
direction per pair. In a cell a depth-first search takes blocks of visitors down the other levels,
with what is left of the budget, and words met at the leaves are compared letter by letter.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fabspark.llm.storage import saved
from fabspark.session import broadcast_if_small, cut_lineage

LETTERS = "[A-Za-zÀ-ÿ]"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
SHORTEST, FEWEST, FACTOR, EVERY = 6, 5, 5, 199
GROUPS = 16
CELL, VISITORS = 20_000, 100_000
PIECE = 1 << 16
MATRIX = 48  # longest word that is compared in a matrix
RESIDENT, OWN, DEFICIT, SPENT = range(4)


# ---- words --------------------------------------------------------------------------------
def count_words(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", shortest: int = SHORTEST,
                fewest: int = FEWEST, every: int = EVERY) -> DataFrame:
    """``word``, ``n``: letter runs of all texts, A-Z lower-cased, that occur at least ``fewest`` times.

    A run whose hash with the document's id ``every`` divides loses one letter, as a typing error
    would. A null text has no words, a null id counts as an empty one. DataFrame functions only.
    """
    runs = F.explode(F.regexp_extract_all(text, F.lit(f"({LETTERS}{{{shortest},}})"))).alias("run")
    rows = docs.select(F.concat(F.coalesce(F.col(doc_id).cast("string"), F.lit("")), F.lit(":")).alias("id"), runs)
    rows = rows.select("id", F.when(F.col("run").rlike("[A-Z]"), F.translate("run", UPPER, LOWER)).otherwise(F.col("run")).alias("run"))
    rows = rows.select("run", F.crc32(F.concat("id", "run")).alias("h"))
    place = (F.col("h") % F.length("run")).cast("int")
    typo = F.concat(F.substr("run", F.lit(1), place), F.substr("run", place + 2))
    rows = rows.select(F.when(F.col("h") % every == 0, typo).otherwise(F.col("run")).alias("word"))
    return rows.filter(F.length("word") >= shortest).groupBy("word").agg(F.count("*").alias("n")).filter(F.col("n") >= fewest)


def letter_groups(words: DataFrame, groups: int = GROUPS) -> np.ndarray:
    """Group of each code point: the ``groups`` most frequent letters of ``words`` alone, the rest in one more.

    The driver fetches one row per letter of the alphabet.
    """
    letters = words.select(F.explode(F.split("word", "")).alias("letter")).filter("letter != ''")
    found = letters.groupBy("letter").count().orderBy(F.desc("count"), "letter").limit(groups).collect()
    out = np.full(256, len(found))
    for g, r in enumerate(found):
        out[ord(r["letter"])] = g
    return out


def letters_of(words: pa.Array) -> tuple[list[bytes], np.ndarray, np.ndarray]:
    """Words as Latin-1 bytes, all letters in a row, and where each word starts."""
    raw = [w.encode("latin-1") for w in words.to_pylist()]
    lengths = np.fromiter(map(len, raw), np.int64, len(raw))
    return raw, np.frombuffer(b"".join(raw), np.uint8), np.concatenate([[0], np.cumsum(lengths)])


def vectors(flat: np.ndarray, starts: np.ndarray, group: np.ndarray) -> np.ndarray:
    """Count of letters per word and group."""
    width = int(group.max()) + 1
    row = np.repeat(np.arange(len(starts) - 1), np.diff(starts))
    return np.bincount(row * width + group[flat], minlength=(len(starts) - 1) * width).reshape(-1, width)


# ---- cells --------------------------------------------------------------------------------
def cell_rows(words: DataFrame, group: np.ndarray, depth: int, visits: bool) -> DataFrame:
    """``cell``, ``role``, ``word``, ``n``: each word in its cell of the first ``depth`` counts and, if asked, its visits.

    A visit has the budget that the way to the cell leaves: OWN one surplus and one deficit,
    DEFICIT one deficit, SPENT none. Of two words of one length in different cells only the one
    with the smaller cell visits; a longer word visits a shorter one.
    """

    def run(batches):
        for batch in batches:
            _, flat, starts = letters_of(batch.column("word"))
            top = vectors(flat, starts, group)[:, :depth]
            every = np.arange(batch.num_rows)
            parts = [(every, top, RESIDENT)]
            if visits:
                parts.append((every, top, OWN))
                for g in range(depth):
                    more, fewer = top.copy(), top.copy()
                    more[:, g] += 1
                    parts.append((every, more, DEFICIT))
                    some = np.flatnonzero(top[:, g])
                    fewer[:, g] -= 1
                    parts.append((some, fewer[some], SPENT))
                    for h in range(g):
                        moved = fewer[some].copy()
                        moved[:, h] += 1
                        parts.append((some, moved, SPENT))
            for rows, key, role in parts:
                cell = pc.binary_join_element_wise(*[pc.cast(pa.array(key[:, d]), pa.string()) for d in range(key.shape[1])], ".")
                yield pa.RecordBatch.from_arrays(
                    [cell, pa.array(np.full(len(rows), role, np.int32)), batch.column("word").take(pa.array(rows)),
                     batch.column("n").take(pa.array(rows))], ["cell", "role", "word", "n"])

    return words.select("word", "n").mapInArrow(run, "cell string, role int, word string, n long")


class Trie:
    """Vectors of words, sorted; a level's nodes are numbered in order and looked up by parent and count."""

    def __init__(self, counts: np.ndarray) -> None:
        self.order = np.lexsort(counts.T[::-1]) if counts.shape[1] else np.arange(len(counts))
        rows, node = counts[self.order], np.zeros(len(counts), np.int64)
        self.base, self.keys = int(counts.max(initial=0)) + 3, []
        for level in range(counts.shape[1]):
            keys, node = np.unique(node * self.base + rows[:, level] + 1, return_inverse=True)
            self.keys.append(keys)
        self.first = np.searchsorted(node, np.arange(int(node.max(initial=-1)) + 2))

    def search(self, counts: np.ndarray, surplus: np.ndarray, deficit: np.ndarray):
        """Yield (row of ``counts``, word) for words within each row's budget, depth first and a bounded piece at a time."""
        stack = [(0, np.arange(len(counts)), np.zeros(len(counts), np.int64), surplus, deficit)]
        while stack:
            level, who, node, more, fewer = stack.pop()
            if len(who) > PIECE:
                cut = len(who) // 2
                stack += [(level, *(x[:cut] for x in (who, node, more, fewer))), (level, *(x[cut:] for x in (who, node, more, fewer)))]
            elif level == len(self.keys):
                yield from self.leaves(who, node)
            elif len(who):
                steps = []
                for change, may in ((0, slice(None)), (1, more > 0), (-1, fewer > 0)):
                    w, wanted = who[may], node[may] * self.base + np.minimum(counts[who[may], level] + change, self.base - 2) + 1
                    child = np.minimum(np.searchsorted(self.keys[level], wanted), len(self.keys[level]) - 1)
                    hit = self.keys[level][child] == wanted
                    steps.append((w[hit], child[hit], (more[may] - (change == 1))[hit], (fewer[may] - (change == -1))[hit]))
                stack.append((level + 1, *(np.concatenate(x) for x in zip(*steps))))

    def leaves(self, who: np.ndarray, node: np.ndarray):
        size = self.first[node + 1] - self.first[node]
        done, before = 0, np.concatenate([[0], np.cumsum(size)])
        while done < len(who):
            upto = max(done + 1, int(np.searchsorted(before, before[done] + 4 * PIECE, "right")) - 1)
            n = size[done:upto]
            place = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
            yield np.repeat(who[done:upto], n), self.order[np.repeat(self.first[node[done:upto]], n) + place]
            done = upto


def one_apart(longer: bytes, shorter: bytes) -> bool:
    """Equal lengths: one letter replaced; otherwise one letter of ``longer`` left out."""
    low, high = 0, len(shorter)
    while low < high:  # length of the common beginning
        mid = (low + high + 1) // 2
        low, high = (mid, high) if longer[:mid] == shorter[:mid] else (low, mid - 1)
    if len(longer) == len(shorter):
        return low < len(shorter) and longer[low + 1:] == shorter[low + 1:]
    return longer[low + 1:] == shorter[low:]


def matrix(flat: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """The first ``MATRIX`` letters of each word, zeros behind."""
    lengths = np.minimum(np.diff(starts), MATRIX)
    out = np.zeros((len(lengths), MATRIX), np.uint8)
    place = np.arange(MATRIX) < lengths[:, None]
    out[place] = flat[(starts[:-1, None] + np.arange(MATRIX))[place]]
    return out


def near_words(cells: DataFrame, group: np.ndarray, depth: int) -> DataFrame:
    """``word``, ``near``, ``near_n`` both ways for every pair of words one letter apart."""
    sizes = cells.groupBy("cell").agg(F.count_if(F.col("role") == RESIDENT).alias("r"), F.count_if(F.col("role") != RESIDENT).alias("v"))
    heavy = sizes.filter(f"r > 0 AND v > 0 AND (r > {CELL} OR v > {VISITORS})").select(
        "cell", F.ceil(F.col("r") / CELL).cast("int").alias("rs"), F.ceil(F.col("v") / VISITORS).cast("int").alias("vs"))
    split = cells.join(broadcast_if_small(heavy), "cell", "left").withColumns({"rs": F.coalesce("rs", F.lit(1)), "vs": F.coalesce("vs", F.lit(1))})
    resident = F.col("role") == RESIDENT
    own = F.pmod(F.xxhash64("word"), F.when(resident, F.col("rs")).otherwise(F.col("vs"))).cast("int")
    other = F.explode(F.sequence(F.lit(0), F.when(resident, F.col("vs")).otherwise(F.col("rs")) - 1))
    split = split.withColumn("own", own).withColumn("other", other).select(
        "cell", F.when(resident, F.col("own")).otherwise(F.col("other")).alias("r"),
        F.when(resident, F.col("other")).otherwise(F.col("own")).alias("v"), "role", "word", "n")

    def run(table: pa.Table) -> pa.Table:
        role = np.asarray(table["role"].combine_chunks())
        there, here = np.flatnonzero(role == RESIDENT), np.flatnonzero(role != RESIDENT)
        found: list[tuple[np.ndarray, np.ndarray]] = []
        if len(there) and len(here):
            raw, flat, starts = letters_of(table["word"].combine_chunks())
            counts, lengths, letters = vectors(flat, starts, group)[:, depth:], np.diff(starts), matrix(flat, starts)
            budget = (role[here] == OWN).astype(np.int64), (role[here] <= DEFICIT).astype(np.int64)
            for who, what in Trie(counts[there]).search(counts[here], *budget):
                a, b = here[who], there[what]
                gap = lengths[a] - lengths[b]
                fit = (gap == 0) | (gap == 1)
                a, b, gap = a[fit], b[fit], gap[fit]
                short = lengths[a] <= MATRIX
                x, y, long_a, long_b = a[short], b[short], a[~short], b[~short]
                left, right, gap = letters[x], letters[y], gap[short]
                differ = left != right
                begin = np.where(differ.any(axis=1), differ.argmax(axis=1), MATRIX)
                shifted = left[:, 1:] != right[:, :-1]
                after = np.where(shifted.any(axis=1), MATRIX - 2 - shifted[:, ::-1].argmax(axis=1), -1)
                good = np.where(gap == 0, differ.sum(axis=1) == 1, after < begin)
                pairs = list(zip(x[good].tolist(), y[good].tolist()))
                pairs += [(i, j) for i, j in zip(long_a.tolist(), long_b.tolist()) if one_apart(raw[i], raw[j])]
                # In one cell two words of one length meet twice; the smaller one counts.
                pairs = [(i, j) for i, j in pairs if role[i] != OWN or lengths[i] != lengths[j] or raw[i] < raw[j]]
                if pairs:
                    found.append(tuple(np.array(pairs).T))
        i, j = (np.concatenate(p) for p in zip(*found)) if found else (np.zeros(0, np.int64),) * 2
        one, two = pa.array(np.concatenate([i, j])), pa.array(np.concatenate([j, i]))
        return pa.table({"word": table["word"].take(one), "near": table["word"].take(two), "near_n": table["n"].take(two)})

    return split.groupBy("cell", "r", "v").applyInArrow(run, "word string, near string, near_n long")


# ---- result -------------------------------------------------------------------------------
def roots(forms: DataFrame) -> DataFrame:
    """``word``, ``root``: the end of each chain of ``word`` to ``form``, by doubling the steps.

    A form is at least ``FACTOR`` times as frequent as its word, so chains are short and never loop.
    """
    at = cut_lineage(forms.select("word", F.col("form").alias("root")))
    while True:
        ahead = at.select(F.col("word").alias("root"), F.col("root").alias("_next"))
        step = at.join(ahead, "root", "left")
        if step.filter("_next IS NOT NULL").limit(1).count() == 0:
            return at
        at = cut_lineage(step.select("word", F.coalesce("_next", "root").alias("root")))


def variants(words: DataFrame, factor: int = FACTOR) -> DataFrame:
    """One row per row of ``words`` (``word`` distinct, of letters up to U+00FF; ``n``).

    ``n_near`` counts the words one inserted, deleted or replaced letter apart. ``form`` is the
    most frequent of them (ties: the first in code-point order) if it is at least ``factor`` times
    as frequent, else null; ``root`` is the last word of the chain of forms.
    """
    words = saved(words.select("word", "n"), "variant-words")
    group, depth = letter_groups(words), 2
    levels = int(group.max()) + 1
    while depth < min(8, levels):  # cells of bounded size; what is left beyond the last level is split by near_words
        largest = cell_rows(words, group, depth, False).groupBy("cell").count().agg(F.max("count")).first()[0]
        if not largest or largest <= CELL:
            break
        depth += 1
    depth = min(depth, levels)
    pairs = near_words(cell_rows(words, group, depth, True), group, depth)
    best = F.min(F.struct((-F.col("near_n")).alias("m"), F.col("near").alias("near"))).alias("best")
    near = words.join(pairs.groupBy("word").agg(F.count("*").alias("n_near"), best), "word", "left")
    strong = -F.col("best.m") >= factor * F.col("n")
    near = saved(near.select("word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
                             F.when(strong, F.col("best.near")).alias("form"), F.when(strong, -F.col("best.m")).alias("form_n")), "variants")
    ends = roots(near.filter("form IS NOT NULL"))
    return near.join(ends, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


VARIANTS_SQL = """
WITH RECURSIVE crc_table AS (
  SELECT list(c ORDER BY i) AS t FROM (SELECT i, list_reduce(list_prepend(i::BIGINT, range(8)::BIGINT[]),
    lambda c, k: CASE WHEN c % 2 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS c FROM range(256) r(i))),
runs AS (SELECT doc_id, translate(unnest(regexp_extract_all(text, '[A-Za-zÀ-ÿ]{6,}')),
         'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run FROM documents),
counted AS (SELECT run, hex(encode(doc_id::VARCHAR || ':' || run)) AS x, count(*) AS m FROM runs GROUP BY ALL),
hashed AS (SELECT run, m, xor(4294967295, list_reduce(list_prepend(4294967295::BIGINT, list_transform(range(length(x) // 2),
    lambda i: ('0x' || substring(x, 2 * i::INT + 1, 2))::BIGINT)),
    lambda c, b: xor(c >> 8, t[(xor(c, b) & 255)::INT + 1]))) AS h FROM counted, crc_table),
words AS (SELECT CASE WHEN h % 199 = 0 THEN left(run, (h % length(run))::INT) || substring(run, (h % length(run))::INT + 2) ELSE run END AS word,
          sum(m)::BIGINT AS n FROM hashed GROUP BY 1 HAVING length(word) >= 6 AND n >= 5),
holes AS (SELECT word, n, i, left(word, i::INT) AS a, substring(word, i::INT + 2) AS b FROM words, range(1000) r(i) WHERE i < length(word)),
pairs AS (SELECT x.word, y.word AS near, y.n AS near_n FROM holes x JOIN holes y ON x.i = y.i AND x.a = y.a AND x.b = y.b AND x.word <> y.word
          UNION SELECT x.word, y.word, y.n FROM holes x JOIN words y ON y.word = x.a || x.b
          UNION SELECT y.word, x.word, x.n FROM holes x JOIN words y ON y.word = x.a || x.b),
best AS (SELECT word, count(*) AS n_near, min(struct_pack(m := -near_n, near := near)) AS b FROM pairs GROUP BY word),
forms AS (SELECT w.word, w.n, coalesce(n_near, 0) AS n_near, CASE WHEN -b.m >= 5 * w.n THEN b.near END AS form,
          CASE WHEN -b.m >= 5 * w.n THEN -b.m END AS form_n FROM words w LEFT JOIN best USING (word)),
chain AS (SELECT word, word AS root, form AS next FROM forms UNION ALL SELECT c.word, f.word, f.form FROM chain c JOIN forms f ON f.word = c.next)
SELECT f.word, f.form, c.root, f.n, f.n_near, f.form_n FROM forms f JOIN chain c ON c.word = f.word AND c.next IS NULL
"""
