"""A training corpus in five stages: language, near-duplicates, benchmark passages, source weights, shards.

Each stage reads the Parquet table that the one before wrote and works on all of it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fabspark.llm import decontaminate, jaccard, language, mixing, sharding
from fabspark.llm.storage import saved
from fabspark.llm.text import WORD


def packed(docs: DataFrame, *own: str) -> DataFrame:
    """The columns that a stage reads, and all others as one struct: no name of theirs can clash."""
    rest = [F.col(f"`{c}`") for c in docs.columns if c not in own]
    return docs.select(*own, F.struct(*(rest or [F.lit(0)])).alias("_rest"))


def unpacked(docs: DataFrame, *own: str) -> list[Column]:
    """The columns of ``docs`` out of ``packed`` rows."""
    return [F.col(c) if c in own else F.col("_rest")[c].alias(c) for c in docs.columns]


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a recognisable language go; the others carry the language that was found.

    ``lang`` is replaced, other columns are not read or changed. A null or empty text has no
    letters and goes. Rows equal in id, text, language and source are decided alike; rows with one
    id and other texts are told apart. Ties between languages go to the first by name.
    """
    own = ("doc_id", "text", "lang", "source")
    named = packed(docs, *own).withColumn("_row", F.xxhash64(*own))
    found = language.identify(named, language.train(named), "_row", declared=F.col("lang"), host=F.col("source"))
    # Only rows that go or change are joined; as a table their size is known, so texts move only if they are many.
    changes = found.filter("NOT accepted OR language != declared").select("_row", F.col("accepted").alias("_accepted"), F.col("language").alias("_language"))
    changes = saved(changes.dropDuplicates(["_row"]), "language-changes")
    joined = named.join(changes, "_row", "left").filter(F.coalesce("_accepted", F.lit(True)))
    return joined.withColumn("lang", F.coalesce("_language", "lang")).select(*unpacked(docs, *own))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each component of documents with similar shingles one row stays: that with the smallest id.

    A null id comes last; of texts under one id the one with the smaller hash, of rows equal in id
    and text the first by a hash of all columns stays. Rows without words have no component and
    all stay. Every row is decided by its own text, whatever other rows share its id.
    """
    whole = docs.select(F.struct("*").alias("_row"), jaccard.row_key(F.col("doc_id"), F.col("text")).alias("_key"),
                        F.xxhash64("*").alias("_hash"), F.coalesce(F.col("text").rlike(WORD), F.lit(False)).alias("_words"))
    found = jaccard.jaccard_rows(docs).filter("root IS NOT NULL")
    first = found.groupBy("root").agg(F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "row")).alias("first"))
    keep = first.select(F.col("first.row").alias("_key"))
    # Which of the rows of a key stays is found from hashes; whole rows move only where all their columns are equal.
    counted = whole.filter("_words").groupBy("_key", "_hash").agg(F.count("*").alias("_n"))
    counted = counted.groupBy("_key").agg(F.min(F.struct("_hash", "_n")).alias("_first"))
    chosen = saved(keep.join(counted, "_key").select("_key", "_first._hash", "_first._n"), "kept-rows")
    # Whole rows pass by the few columns of the chosen ones and are not sorted.
    kept = whole.filter("_words").join(chosen.hint("shuffle_hash"), ["_key", "_hash"])
    copies = kept.filter("_n > 1").groupBy("_key").agg(F.first("_row").alias("_row"))
    rows = kept.filter("_n = 1").select("_row").unionByName(copies.select("_row"))
    return rows.unionByName(whole.filter("NOT _words").select("_row")).select("_row.*")


def drop_benchmark_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item, also with other numbers and names, go.

    Every row is decided by its own text, with a null or repeated id too. A null or empty text and
    a null item match nothing.
    """
    own = ("doc_id", "text")
    rows = packed(docs, *own).withColumn("_key", jaccard.row_key(F.col("doc_id"), F.col("text")))
    kept = decontaminate.clean(rows, spark.read.parquet(f"{sf_dir}/benchmark.parquet"), doc_id="_key")
    return kept.select(*unpacked(docs, *own))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources at their target weights: rows beyond a budget go, rows of later epochs come again.

    A null source is a source, null ids and texts have a key and a size of their own. Rows equal in
    id, size and text are interchangeable.
    """
    own = ("doc_id", "text", "source")
    mixed = mixing.expand(mixing.mix(packed(docs, *own)))
    return mixed.select(*unpacked(docs, *own))


def make_shards(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All rows with their ``size``, ``shard`` and ``slot``; equal texts share a shard, null and empty ones too.

    If ``docs`` has a column of such a name, the new one has underscores before it.
    """
    own = ("doc_id", "text")
    placed = sharding.shard(packed(docs, *own), 24)
    new = []
    for c in ("size", "shard", "slot"):
        name = c
        while name in docs.columns:
            name = f"_{name}"
        new.append(F.col(c).alias(name))
    return placed.select(*unpacked(docs, *own), *new)


STAGES = [
    ("language", identify_language),
    ("near_duplicates", drop_near_duplicates),
    ("benchmark", drop_benchmark_passages),
    ("mix", mix_sources),
    ("shards", make_shards),
]

# Trigram models, likelihoods and best-fit packing are beyond SQL; tests compare each stage with a plain twin.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = saved(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
