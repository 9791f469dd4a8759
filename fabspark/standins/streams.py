"""Windowed rates and drift over the event stream, compared in their final state."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from fabspark.session import shared_dir
from fabspark.standins.common import Registry, round_all, table
from fabspark.streaming import drift, rates

R = Registry()


def _flagged():
    return F.col("event_type") == "error"


def _stream(spark, d):
    schema = table(spark, d, "events").schema
    return rates.read_stream(spark, d, schema, "ts", "events.parquet")


def _final(spark, result, keys):
    """Run the stream over what is there and read the last version of each row."""
    folder = f"{shared_dir(spark)}/stream-{uuid.uuid4().hex}"
    rates.start_updates(result, f"{folder}/table", f"{folder}/state").awaitTermination()
    return rates.latest(spark, f"{folder}/table", keys)


SLIDE_SQL = "(SELECT e.*, date_trunc('hour', ts) - to_hours(CAST(k AS BIGINT)) AS start FROM events e, range(6) s(k))"


@R.add("""SELECT CAST(epoch(date_trunc('day', ts)) AS BIGINT) AS window_start, count(*) AS n, count(*) FILTER (event_type = 'error') AS n_flagged,
  round(count(*) FILTER (event_type = 'error') / count(*), 6) AS rate FROM events GROUP BY 1""")
def tumbling_rate(spark, d):
    result = rates.windowed_rate(_stream(spark, d), "ts", _flagged(), "1 day", watermark="60 days")
    final = _final(spark, result, ["window_start", "window_end"])
    return round_all(final.select(F.unix_seconds("window_start").alias("window_start"), "n", "n_flagged", "rate"))


@R.add(f"""SELECT CAST(epoch(start) AS BIGINT) AS window_start, count(*) AS n, count(*) FILTER (event_type = 'error') AS n_flagged,
  round(count(*) FILTER (event_type = 'error') / count(*), 6) AS rate,
  CAST(CASE WHEN count(*) FILTER (event_type = 'error') / count(*) >= 0.3 THEN 3 WHEN count(*) FILTER (event_type = 'error') / count(*) >= 0.2 THEN 2
       WHEN count(*) FILTER (event_type = 'error') / count(*) >= 0.1 THEN 1 ELSE 0 END AS INTEGER) AS level
  FROM {SLIDE_SQL} GROUP BY start""")
def sliding_rate(spark, d):
    result = rates.windowed_rate(_stream(spark, d), "ts", _flagged(), "6 hours", "1 hour", watermark="60 days")
    final = _final(spark, result, ["window_start", "window_end"])
    return round_all(final.select(
        F.unix_seconds("window_start").alias("window_start"), "n", "n_flagged", "rate",
        rates.alarm_level(F.col("rate")).alias("level")))


@R.add("""WITH r AS (SELECT event_type, date_trunc('day', ts) AS ws, count(*) FILTER (value > 60) / count(*) AS rate FROM events GROUP BY 1, 2),
  b AS (SELECT *, avg(rate) OVER (PARTITION BY event_type ORDER BY ws ROWS BETWEEN 7 PRECEDING AND 1 PRECEDING) AS baseline FROM r)
  SELECT event_type, CAST(epoch(ws) AS BIGINT) AS window_start, round(rate, 6) AS rate, round(baseline, 6) AS baseline,
    CAST(coalesce(rate >= 1.2 * baseline, false) AS INTEGER) AS drift FROM b""")
def drift_alarm(spark, d):
    result = rates.windowed_rate(_stream(spark, d), "ts", F.col("value") > 60, "1 day", keys=["event_type"], watermark="60 days")
    final = _final(spark, result, ["window_start", "window_end", "event_type"])
    out = drift.rate_drift(final, "event_type", 7, 1.2)
    return round_all(out.select("event_type", F.unix_seconds("window_start").alias("window_start"), "rate", "baseline", "drift"))


CLASS_OF = {"error": "Scratch", "purchase": "Edge-Ring", "signup": "Edge-Loc"}


@R.add("""WITH r AS (SELECT CASE event_type WHEN 'error' THEN 'Scratch' WHEN 'purchase' THEN 'Edge-Ring' WHEN 'signup' THEN 'Edge-Loc' ELSE event_type END AS cls,
    date_trunc('day', ts) AS ws, count(*) AS n, count(*) FILTER (value > 60) / count(*) AS rate FROM events GROUP BY 1, 2),
  b AS (SELECT *, avg(rate) OVER (PARTITION BY cls ORDER BY ws ROWS BETWEEN 7 PRECEDING AND 1 PRECEDING) AS baseline FROM r)
  SELECT cls, CAST(epoch(ws) AS BIGINT) AS window_start, n, round(rate, 6) AS rate, round(baseline, 6) AS baseline, round(rate / baseline, 6) AS ratio,
    CAST(coalesce(rate >= 1.2 * baseline, false) AS INTEGER) AS drift,
    CASE WHEN rate >= 1.2 * baseline THEN CASE cls WHEN 'Scratch' THEN 'inspect wafer handler for wear' WHEN 'Edge-Ring' THEN 'check furnace temperature profile'
      WHEN 'Edge-Loc' THEN 'check polishing pressure drift' END END AS suggestion
  FROM b WHERE ws + INTERVAL 1 DAY <= (SELECT max(ts) FROM events) - INTERVAL 2 DAY""")
def drift_stream(spark, d):
    """Closed windows, drift state and maintenance hint as one stateful stream, resumed once from its state folder."""
    names = F.create_map(*[F.lit(x) for pair in CLASS_OF.items() for x in pair])
    folder = f"{shared_dir(spark)}/drift-{uuid.uuid4().hex}"
    for _ in range(2):  # the second run finds no new events and must add nothing
        events = _stream(spark, d).withColumn("cls", F.coalesce(names[F.col("event_type")], "event_type"))
        live = drift.drift_stream(events, "ts", F.col("value") > 60, "cls", "1 day", "2 days", 7, 1.2)
        drift.start_drift(live, f"{folder}/table", f"{folder}/state").awaitTermination()
    out = drift.with_suggestion(spark.read.parquet(f"{folder}/table"), "cls")
    out = out.withColumn("suggestion", F.when(F.col("drift") == 1, F.col("suggestion")))
    return round_all(out.withColumn("window_start", F.unix_seconds("window_start")))
