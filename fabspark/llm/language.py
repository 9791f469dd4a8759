"""Language identification by fusing evidence in Bayes' rule.

Four kinds of evidence meet per row: the likelihood of its letters under a trigram model of each
language, the language that its markup declares, the host's prior, and the address suffix's and
the corpus's, towards which the host's is smoothed. Likelihoods are computed once per row; the
priors and the reliability of declarations are grouped sums of the rows' own text posteriors, and
a row's share is taken out of its host's and its declaration's sums before these speak about it.

Beside the languages stands the hypothesis that the text is in none of them. Its trigrams come at a
fixed rate, ``SURPRISE`` below what the most varied language gives its own texts on average, and
its prior shrinks with the letters at hand: of one letter nobody can tell.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fabspark.llm.text import buffers, column, pieces
from fabspark.session import cut_lineage, local_frame

SAMPLE_ROWS = 20_000  # labelled rows that fit the trigram model, in expectation
LEAST_ROWS = 5  # labelled rows of a language that is fitted
LEAST_SHARE = 100  # rows of a language that the sample takes at least, in expectation, if it has them
BUCKETS = 1 << 16
DAMPING = 4.0  # trigrams overlap and repeat, so each counts as a quarter of independent evidence
STRENGTH = 20.0  # rows that a suffix's (or the corpus's) prior weighs in a host's (or suffix's)
ACCEPT = 0.5
SURPRISE = 3.0  # nats per trigram by which a text of no language falls behind
FLOOR = 2.0  # nats by which a trigram is less likely in a language than in none at most
DOUBT = 2.0  # letters at which a text's language is as doubtful as not

_FOLD = np.arange(256, dtype=np.uint32)
_FOLD[65:91] += 32
_FOLD[[b for b in range(128) if not (97 <= b <= 122 or 65 <= b <= 90)]] = 32


def trigrams(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of all byte trigrams with a letter in the middle, and how many come before each row.

    A-Z are lower-cased and every other ASCII byte that is no letter is a blank.
    """
    data, offsets = buffers(texts)
    fold = np.concatenate([[32], _FOLD[data], [32]]).astype(np.uint32)
    edge = np.zeros(len(fold), bool)  # a row's first byte must not see the row before
    edge[offsets[:-1]] = True
    left = np.where(edge[:len(data)], 32, fold[:-2])
    right = np.where(edge[1:len(data) + 1], 32, fold[2:])
    code = (left * np.uint32(0x9E3779B1)) ^ (fold[1:-1] * np.uint32(0x85EBCA77)) ^ (right * np.uint32(0xC2B2AE3D))
    code = (code ^ (code >> np.uint32(15))) * np.uint32(0x2C1B3C6D)
    keep = fold[1:-1] != 32
    before = np.concatenate([[0], np.cumsum(keep)])[offsets]
    return (code >> np.uint32(16))[keep], before


def train(labelled: DataFrame, text: str = "text", language: str = "lang", doc_id: str = "doc_id",
          sample_rows: int = SAMPLE_ROWS) -> tuple[list[str], np.ndarray]:
    """Languages and their log-probabilities per trigram bucket, from a bounded sample of labelled rows.

    Every language with ``LEAST_ROWS`` labelled rows is fitted, at any size of the table. The
    sample is bounded per language: all rows of a rare one, and of the others those whose hash of
    id and text is below a language's own share, so that ``sample_rows`` are taken in expectation,
    or ``LEAST_SHARE`` per language if there are many. The same rows are taken at every run.
    """
    labelled = labelled.select(F.lower(language).alias("lang"), F.col(text).alias("text"), F.col(doc_id).alias("id")).filter(
        "lang IS NOT NULL AND lang != '' AND text IS NOT NULL")
    counts = labelled.groupBy("lang").agg(F.count("*").alias("n")).filter(F.col("n") >= LEAST_ROWS).collect()
    counts = {r["lang"]: r["n"] for r in counts}
    names, left, fair = sorted(counts), sample_rows, 0.0
    for k, n in enumerate(sorted(counts.values())):
        fair = max(LEAST_SHARE, left / (len(counts) - k))
        if n > fair:
            break
        left -= n

    def sampled(whole: set[str]) -> DataFrame:
        cuts = [(k, name, 1 << 20 if name in whole else math.ceil(min(1.0, fair / counts[name]) * (1 << 20))) for k, name in enumerate(names)]
        cuts = local_frame(labelled.sparkSession, cuts, "name int, lang string, cut long")
        return labelled.join(F.broadcast(cuts), "lang").filter(F.pmod(F.xxhash64("id", "text"), F.lit(1 << 20)) < F.col("cut"))

    taken = {r["lang"]: r["count"] for r in sampled(set()).groupBy("lang").count().collect()}
    # Only many copies of few rows can leave a language short, as equal rows have one hash.
    sample = sampled({name for name in names if taken.get(name, 0) < LEAST_ROWS})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[int, np.ndarray] = {}
        for batch in batches:
            labels = batch.column("name").to_pylist()
            for start, some in pieces(column(batch.column("text"))):
                code, before = trigrams(some)
                for r in range(len(some)):
                    own = counts.setdefault(labels[start + r], np.zeros(BUCKETS, np.int64))
                    own += np.bincount(code[before[r]:before[r + 1]], minlength=BUCKETS)
        for lang, own in counts.items():
            bucket = np.flatnonzero(own)
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(bucket), lang, np.int32)), pa.array(bucket, pa.int32()), pa.array(own[bucket])],
                                             ["lang", "bucket", "n"])

    table = sample.select("name", "text").mapInArrow(run, "lang int, bucket int, n long").groupBy("lang", "bucket").agg(
        F.sum("n").alias("n")).toArrow()  # at most languages x buckets rows
    counts = np.full((len(names), BUCKETS), 0.1)
    counts[np.asarray(table["lang"]), np.asarray(table["bucket"])] += np.asarray(table["n"])
    return names, np.log(counts / counts.sum(axis=1, keepdims=True))


def other_rate(table: np.ndarray) -> float:
    """Log-probability of a trigram of no language: ``SURPRISE`` below the largest mean of a language over its own texts."""
    return float(min((np.exp(t) * t).sum() for t in table)) - SURPRISE


def identify(rows: DataFrame, model: tuple[list[str], np.ndarray], key: str, text: str = "text", declared: Column | None = None,
             host: Column | None = None, suffix: Column | None = None) -> DataFrame:
    """One row per row of ``rows``: ``key``, ``declared``, ``host``, ``suffix``, ``letters``,
    ``text_language``, ``language``, ``posterior``, ``accepted``.

    ``declared`` counts by its first subtag in lower case; missing evidence is an empty string,
    which is evidence as any other value is. A row without letters has no language and is
    rejected, and so is one whose best language has a posterior below ``ACCEPT``, be it for another
    language or for none. Equal rows agree; ids may repeat or be null. Without languages in the
    model every row is rejected.
    """
    names, table = model
    if not names:
        names, table = ["und"], np.zeros((1, BUCKETS))
    rate = other_rate(table)
    # A key or an address inside a text counts against it, but no trigram by more than FLOOR.
    table = np.maximum(table, rate - FLOOR)
    shared = rows.sparkSession.sparkContext.broadcast(table.astype(np.float32))
    tag = F.lower(F.regexp_extract(F.coalesce(declared if declared is not None else F.lit(""), F.lit("")), "^([A-Za-z]*)", 1))
    rows = rows.select(
        F.col(key).cast("long").alias("key"), F.col(text).alias("text"), tag.alias("declared"),
        F.coalesce(host if host is not None else F.lit(""), F.lit("")).alias("host"),
        F.coalesce(suffix if suffix is not None else F.lit(""), F.lit("")).alias("suffix"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights = shared.value
        for batch in batches:
            out, letters = np.zeros((batch.num_rows, len(names))), np.zeros(batch.num_rows, np.int64)
            for start, some in pieces(column(batch.column("text"))):
                code, before = trigrams(some)
                part = slice(start, start + len(some))
                letters[part] = np.diff(before)
                full = np.flatnonzero(letters[part])
                for k in range(len(names)):
                    if len(full):
                        out[start + full, k] = np.add.reduceat(weights[k][code].astype(np.float64), before[full]) / DAMPING
            lists = pa.FixedSizeListArray.from_arrays(pa.array(out.ravel()), len(names)).cast(pa.list_(pa.float64()))
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in ("key", "declared", "host", "suffix")), pa.array(letters), lists],
                ["key", "declared", "host", "suffix", "letters", "likelihood"])

    scored = rows.mapInArrow(run, "key long, declared string, host string, suffix string, letters long, likelihood array<double>")
    top = F.array_max("likelihood")
    raw = F.transform("likelihood", lambda x: F.exp(x - top))
    total = F.aggregate(raw, F.lit(0.0), lambda a, x: a + x)
    # A row without letters says nothing: every language equally.
    scored = cut_lineage(scored.withColumn("p", F.transform(raw, lambda x: x / total)))

    span = range(len(names))

    def sums(by: list[str], name: str) -> DataFrame:
        heard = [F.sum(F.when(F.col("letters") > 0, F.get("p", F.lit(k))).otherwise(0.0)) for k in span]
        return scored.groupBy(*by).agg(F.array(*heard).alias(name))

    everything = sums([], "all_sum").select(F.coalesce("all_sum", F.array(*[F.lit(0.0)] * len(names))).alias("all_sum"))
    corpus = everything.first()["all_sum"]
    size = sum(x or 0.0 for x in corpus)
    world = [((x or 0.0) + 1.0) / (size + len(names)) for x in corpus]
    world_prior = F.array(*[F.lit(x) for x in world])
    tags = sums(["declared"], "tag_sum")
    tag_count = max(1, tags.count())

    def smooth(heard: Column, prior: Column) -> Column:
        n = F.aggregate(heard, F.lit(0.0), lambda a, x: a + x)
        return F.zip_with(heard, prior, lambda h, q: (F.greatest(h, F.lit(0.0)) + STRENGTH * q) / (F.greatest(n, F.lit(0.0)) + STRENGTH))

    suffixes = sums(["suffix"], "suffix_sum").select("suffix", smooth(F.col("suffix_sum"), world_prior).alias("suffix_prior"))
    hosts = sums(["suffix", "host"], "host_sum")
    known = scored.join(hosts, ["suffix", "host"]).join(suffixes, "suffix").join(tags, "declared")
    own = F.zip_with("host_sum", "p", lambda s, x: F.when(F.col("letters") > 0, s - x).otherwise(s))
    spoke = F.when(F.col("letters") > 0, F.col("p")).otherwise(F.array(*[F.lit(0.0)] * len(names)))
    known = known.withColumns({"prior": smooth(own, F.col("suffix_prior")), "_spoke": spoke})
    known = known.withColumn("tag_likelihood", F.array(*[
        (F.greatest(F.get("tag_sum", F.lit(k)) - F.get("_spoke", F.lit(k)), F.lit(0.0)) + 1.0)
        / (F.greatest(F.lit(corpus[k] or 0.0) - F.get("_spoke", F.lit(k)), F.lit(0.0)) + tag_count) for k in span]))
    evidence = F.zip_with("prior", "tag_likelihood", lambda a, b: F.log(a) + F.log(b))
    known = known.withColumn("fused", F.zip_with("likelihood", evidence, lambda a, b: a + b))
    best = F.array_max("fused")
    in_any = F.aggregate("fused", F.lit(0.0), lambda a, x: a + F.exp(x - best))
    # The same evidence as the languages have, but for the text, whose odds are those of the doubt.
    around = F.aggregate(F.zip_with("prior", "tag_likelihood", lambda a, b: a * b), F.lit(0.0), lambda a, x: a + x)
    in_none = DOUBT / F.col("letters") * around * F.exp(F.least(F.col("letters") * (rate / DAMPING) - best, F.lit(700.0)))
    norm = in_any + F.when(F.col("letters") > 0, in_none).otherwise(0.0)
    labels = F.array(*[F.lit(n) for n in names])
    has = (F.col("letters") > 0) & F.lit(bool(model[0]))
    return known.select(
        F.col("key").alias(key), "declared", "host", "suffix", "letters",
        F.when(has, F.get(labels, F.array_position("likelihood", F.array_max("likelihood")).cast("int") - 1)).alias("text_language"),
        F.when(has, F.get(labels, F.array_position("fused", best).cast("int") - 1)).alias("language"),
        (1.0 / norm).alias("posterior"), (has & (1.0 / norm >= ACCEPT)).alias("accepted"))


def page_text(html: Column) -> Column:
    """Visible text of a page: without scripts, styles, comments, tags and entities."""
    steps = [r"(?is)<(script|style)\b.*?</\1\s*>", r"(?s)<!--.*?-->", r"(?s)<[^>]*>", r"&[#A-Za-z0-9]+;"]
    return reduce(lambda h, s: F.regexp_replace(h, s, " "), steps, F.coalesce(html, F.lit("")))


def page_evidence(pages: DataFrame, url: str = "url", html: str = "html") -> DataFrame:
    """``pages`` with ``text``, ``declared`` (of the html tag), ``host`` and ``suffix`` (its last label)."""
    host = F.lower(F.regexp_extract(F.coalesce(url, F.lit("")), r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)", 1))
    return pages.withColumns({
        "text": page_text(F.col(html)),
        "declared": F.regexp_extract(F.coalesce(html, F.lit("")), r"""(?is)<html\b[^>]*?\blang\s*=\s*["']?([A-Za-z-]+)""", 1),
        "host": host, "suffix": F.substring_index(host, ".", -1)})
