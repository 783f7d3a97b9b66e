"""As-of joins: the neighbours in time of each probe, nearest neighbour, interpolation.

Both sides are cut into time shards per source; inside a shard one ordered pass finds both
neighbours, and prefix scans over one summary row per shard carry those that lie in other shards.
Sources without a partner keep their probes. Keys and times are not null; readings at one instant
are represented by the first in file order.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trackspark.operators.scan import prefix_scan


def bracket(probes: DataFrame, readings: DataFrame, keys: list[str], t: str, cols: list[str], length: float) -> DataFrame:
    """Probes with ``prev`` (last reading at or before) and ``next`` (first after), structs of t, ord, cols.

    Rows are shuffled once, by source and shard, and both neighbours come from one sort; the summary of
    a shard is aggregated before its shuffle.
    """
    r = readings.select(*keys, t, F.struct(F.col(t).alias("t"), "ord", *cols).alias("r"))
    left = probes.select(*keys, t, F.struct(*probes.columns).alias("__l"))
    u = left.withColumn("r", F.lit(None)).unionByName(r.withColumn("__l", F.lit(None)))
    part = [*keys, "__shard"]
    u = u.withColumn("__shard", F.floor(F.col(t) / F.lit(length)).cast("long"))
    # at one instant readings come first, in file order; only the first of them counts
    u = u.withColumn("__side", F.col("__l").isNotNull()).withColumn("__ord", F.col("r.ord"))
    by = ", ".join(f"`{c}`" for c in part)
    over = f"OVER (PARTITION BY {by} ORDER BY `{t}`, __side, __ord)"
    u = u.withColumn("__one", F.expr(f"CASE WHEN NOT __side AND NOT coalesce(lag(`{t}`) {over} = `{t}`, false) THEN r END"))
    past = f"OVER (PARTITION BY {by} ORDER BY `{t}`, __side, __ord ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"
    near = u.withColumn("__p", F.expr(f"last(__one) IGNORE NULLS {past}")).withColumn("__n", F.expr(f"lead(__one) IGNORE NULLS {over}")).filter("__side")
    time = F.when(~F.col("__side"), F.col(t))
    ends = u.groupBy(*part).agg(F.min_by("r", F.when(time.isNotNull(), F.struct(time, "__ord"))).alias("first"), F.max_by("r", F.when(time.isNotNull(), F.struct(time, -F.col("__ord")))).alias("last"))
    ends = prefix_scan(ends, keys, "__shard", "last", "__back")
    ends = prefix_scan(ends, keys, "__shard", "first", "__ahead", reverse=True).select(*part, "__back", "__ahead")
    out = near.join(ends, part)
    return out.select("__l.*", F.coalesce("__p", "__back").alias("prev"), F.coalesce("__n", "__ahead").alias("next"))


def nearest(found: DataFrame, t: str) -> Column:
    """The nearer of ``prev`` and ``next``; of two equally near the earlier."""
    take_next = F.col("next").isNotNull() & (F.col("prev").isNull() | ((F.col("next.t") - F.col(t)) < (F.col(t) - F.col("prev.t"))))
    return F.when(take_next, F.col("next")).otherwise(F.col("prev"))


def lerp(v: str, t: str, max_gap: float | None = None) -> Column:
    """Value at ``t`` between the neighbours; an exact hit wins, nothing is extrapolated."""
    p, n = F.col("prev.t"), F.col("next.t")
    share = (F.col(t) - p) / (n - p)
    inside = p.isNotNull() & n.isNotNull()
    if max_gap is not None:
        inside = inside & ((n - p) <= F.lit(max_gap))
    return F.when(p == F.col(t), F.col(f"prev.{v}")).when(inside, F.col(f"prev.{v}") + (F.col(f"next.{v}") - F.col(f"prev.{v}")) * share)


def either(v: str, t: str, max_gap: float | None = None) -> Column:
    """Whether a flag holds at ``t``: that of an exact hit, else of any of the two neighbours; false without both."""
    p, n = F.col("prev.t"), F.col("next.t")
    inside = p.isNotNull() & n.isNotNull()
    if max_gap is not None:
        inside = inside & ((n - p) <= F.lit(max_gap))
    flag = lambda side: F.coalesce(F.col(f"{side}.{v}"), F.lit(False))
    return F.when(p == F.col(t), flag("prev")).when(inside, flag("prev") | flag("next")).otherwise(F.lit(False))


def grid(sources: DataFrame, keys: list[str], hz_num: int, hz_den: int, duration: str, chunk: int = 4096) -> DataFrame:
    """(keys, frame_index, i): frames 0..floor(duration * num / den) of each source.

    Long sources are first exploded into chunks of frames, then into frames.
    """
    last = F.floor(F.col(duration) * F.lit(hz_num) / F.lit(hz_den)).cast("long")
    d = sources.filter(F.col(duration) >= 0).withColumn("__last", last).withColumn("__c", F.explode(F.sequence(F.lit(0).cast("long"), F.floor(F.col("__last") / chunk))))
    d = d.withColumn("frame_index", F.explode(F.sequence(F.col("__c") * chunk, F.least(F.col("__last"), F.col("__c") * chunk + (chunk - 1)))))
    return d.drop("__last", "__c")
