"""Cases of the second review: what an operator did less than whole."""

import random

from pyspark.sql import functions as F

from fabspark.llm import decontaminate, language, sharding


# ---- sharding -----------------------------------------------------------------------------
def test_one_group_with_a_third_of_the_bytes(spark):
    """And a second one with a tenth: each is a shard, the other shards are near equal."""
    rest = spark.range(17_000).select("id", F.concat(F.lit("row "), F.col("id"), F.repeat(F.lit("x"), (F.col("id") % 70).cast("int"))).alias("text"))
    total = rest.agg(F.sum(F.octet_length("text") + 8)).first()[0]
    hot = spark.range(int(total * 0.59 / 108)).select("id", F.repeat(F.lit("h"), 100).alias("text"))
    warm = spark.range(int(total * 0.18 / 58)).select("id", F.repeat(F.lit("w"), 50).alias("text"))
    docs = rest.union(hot).union(warm).withColumnRenamed("id", "doc_id")
    out = sharding.shard(docs, 24).groupBy("shard").agg(F.sum("size").alias("s"), F.count_distinct(F.left("text", F.lit(1))).alias("kinds"),
                                                        F.first("text").alias("t")).collect()
    assert sorted(r["shard"] for r in out) == list(range(24))
    plain = [r["s"] for r in out if r["t"].startswith("row")]
    assert len(plain) == 22 and max(plain) < 1.02 * min(plain) and {r["kinds"] for r in out} == {1}
    assert max(r["s"] for r in out) > 0.3 * sum(r["s"] for r in out)


def test_bins_of_large_groups():
    sums = lambda sizes, n: [sum(s for s, b in zip(sizes, sharding.fit_bins(sizes, n)) if b == k) for k in range(n)]
    assert sorted(sums([800, *[1] * 230], 24)) == [10] * 23 + [800]
    assert sorted(sums([8000, 900, *[1] * 220], 24)) == [10] * 22 + [900, 8000]  # the second only by the new mean
    assert sorted(sums([6] * 40, 24)) == [6] * 8 + [12] * 16
    assert sharding.fit_bins([], 5) == [] and sorted(sharding.fit_bins([5, 5], 5)) == [0, 1]
    assert sums([3, 4, 5], 1) == [12]


# ---- templates ------------------------------------------------------------------------------
APPLES = "Yesterday the farmer Miller sold 12 apples and 7 pears to the old shop near Paris for 19 dollars, then gave 12 apples away."


def hits(spark, items, rows):
    bench = spark.createDataFrame(list(enumerate(items)), "item_id int, text string")
    docs = spark.createDataFrame(list(enumerate(rows)), "doc_id int, text string").repartition(2)
    return {(r["doc_id"], r["item_id"]): r for r in decontaminate.contaminated(docs, bench).collect()}


def test_one_altered_slot_costs_its_windows_only(spark):
    wait = "After the long walk we had to sit and wait for 20 minutes by the cold river and then for 30 minutes in the old hut on the hill."
    none = "Of 12 apples or 12 pears give 12 plums to 12 boys."
    got = hits(spark, [APPLES, wait, none], [
        "Text. " + APPLES.replace("12 apples and", "45 apples and"), wait.replace("20 minutes", "20 minute"),
        none.replace("12 pears", "13 pears").replace("12 plums", "14 plums").replace("12 boys", "15 boys")])
    assert set(got) == {(0, 0), (1, 1)}
    assert got[0, 0]["changed"] == 1 and 0.5 < got[0, 0]["coverage"] < 1 and 0.4 < got[1, 1]["coverage"] < 1


def test_exact_copies_whatever_their_words(spark):
    numbers = "Sort the numbers 9, 4, 7, 1, 8, 3, 2, 6"
    digits = "1 2 3 4 5 6 7 8 9"  # no two plain words: stays out
    got = hits(spark, [numbers, APPLES, digits], [
        "Task: " + numbers + ".", "so " + APPLES.lower(), APPLES.replace(" Miller", "\nMiller").replace(" Paris", "\nParis"), digits,
        "Sort the numbers 1, 2, 3, 4, 5, 6, 7, 8"])
    assert set(got) == {(0, 0), (1, 1), (2, 1)}
    assert {got[k]["coverage"] for k in got} == {1.0} and got[1, 1]["changed"] == 0


def test_thirteen_words_of_a_long_item(spark):
    rng = random.Random(5)
    fresh = lambda n: ["".join(rng.choice("abcdefgh") for _ in range(7)) for _ in range(n)]
    passage = fresh(300)
    part = lambda a, n: [*fresh(20), *passage[a:a + n], *fresh(20)]
    rows = [part(100, 13), part(287, 13), part(100, 12), part(0, 12) + part(40, 12), [w.upper() for w in part(7, 14)]]
    got = hits(spark, [" ".join(passage)], [" ".join(r) for r in rows])
    assert set(got) == {(0, 0), (1, 0), (4, 0)} and all(r["coverage"] < 0.05 for r in got.values())


# ---- language -------------------------------------------------------------------------------
def test_rare_language_of_a_large_table_is_fitted(spark):
    common = spark.range(30_000).select("id", F.concat(F.lit("the thing with words "), F.col("id")).alias("text"), F.lit("aa").alias("lang"))
    rare = spark.range(30_000, 30_006).select("id", F.lit("sch und ich ein schein").alias("text"), F.lit("BB").alias("lang"))
    four = spark.range(40_000, 40_004).select("id", F.lit("quo qua qui").alias("text"), F.lit("cc").alias("lang"))
    copies = spark.range(5000).select(F.lit(7).cast("long").alias("id"), F.lit("zo zu za").alias("text"), F.lit("dd").alias("lang"))
    docs = common.union(rare).union(four).union(copies).withColumnRenamed("id", "doc_id")
    model = language.train(docs, sample_rows=2000)
    assert model[0] == ["aa", "bb", "dd"] and model[1].std(axis=1).min() > 0
    out = language.identify(rare.withColumnRenamed("id", "doc_id"), model, "doc_id", declared=F.col("lang")).collect()
    assert {(r["language"], r["accepted"]) for r in out} == {("bb", True)}
    assert (language.train(docs.repartition(5), sample_rows=2000)[1] == model[1]).all()
