"""Views of the event table as tracks, spans and regions, in Spark and as SQL for comparison."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trackspark.session import table

#: Channel, kind and length in seconds of the spans an event type stands for.
SPANS = {"signup": ("coarse", "interval", 14_400), "view": ("mid", "interval", 3_600), "click": ("fine", "interval", 600), "purchase": ("mark", "point", None)}


def _us():
    return F.expr("timestampdiff(MICROSECOND, TIMESTAMP_NTZ '2024-01-01 00:00:00', CAST(ts AS TIMESTAMP_NTZ))")


def track(spark: SparkSession, d: str) -> DataFrame:
    """(ep, ord, us, t_s, x, y, valid): one track per user."""
    e = table(spark, d, "events").select("user_id", "event_id", _us().alias("us"), "value", "event_type", F.get_json_object("props", "$.k").cast("double").alias("k"))
    return e.select(F.col("user_id").alias("ep"), F.col("event_id").alias("ord"), "us", (F.col("us") / 1e6).alias("t_s"), F.col("value").alias("x"), F.col("k").alias("y"), (F.col("event_type") != "error").alias("valid"))


def span(spark: SparkSession, d: str) -> DataFrame:
    """(ep, channel, kind, ord, s, e, p, text): spans in µs; points have ``p`` only."""
    e = table(spark, d, "events").select("user_id", "event_id", _us().alias("us"), "event_type", F.get_json_object("props", "$.k").alias("k")).filter(F.col("event_type").isin(*SPANS))
    channel = F.create_map(*[F.lit(v) for k, (c, _, _) in SPANS.items() for v in (k, c)])[F.col("event_type")]
    length = F.create_map(*[F.lit(v) for k, (_, _, n) in SPANS.items() if n for v in (k, n * 1_000_000)])[F.col("event_type")]
    point = F.col("event_type") == "purchase"
    return e.select(
        F.col("user_id").alias("ep"), channel.alias("channel"), F.when(point, "point").otherwise("interval").alias("kind"), F.col("event_id").alias("ord"),
        F.when(~point, F.col("us")).alias("s"), F.when(~point, F.col("us") + length).alias("e"), F.when(point, F.col("us")).alias("p"),
        F.concat("event_type", "k").alias("text"), (F.col("k").cast("int") % 2 == 0).alias("interesting"),
    )


TRACK_SQL = """track AS (SELECT user_id ep, event_id ord, epoch_us(ts) - epoch_us(TIMESTAMP '2024-01-01') us, (epoch_us(ts) - epoch_us(TIMESTAMP '2024-01-01')) / 1e6 t_s, value x,
 CAST(json_extract(props, '$.k') AS DOUBLE) y, event_type <> 'error' valid FROM events)"""
SPAN_SQL = """span AS (SELECT user_id ep, CASE event_type WHEN 'signup' THEN 'coarse' WHEN 'view' THEN 'mid' WHEN 'click' THEN 'fine' ELSE 'mark' END channel,
 CASE event_type WHEN 'purchase' THEN 'point' ELSE 'interval' END kind, event_id ord, CASE WHEN event_type <> 'purchase' THEN u END s,
 CASE event_type WHEN 'signup' THEN u + 14400000000 WHEN 'view' THEN u + 3600000000 WHEN 'click' THEN u + 600000000 END e, CASE event_type WHEN 'purchase' THEN u END p,
 event_type || (props->>'$.k') AS text, CAST(props->>'$.k' AS INT) % 2 = 0 interesting FROM (SELECT *, epoch_us(ts) - epoch_us(TIMESTAMP '2024-01-01') u FROM events) WHERE event_type IN ('signup', 'view', 'click', 'purchase'))"""
