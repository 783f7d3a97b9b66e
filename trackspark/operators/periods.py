"""Overlapping and gapped intervals into continuous periods and the gaps between them.

Method, for entities of any size: intervals are put into time shards by their start and merged in
each shard. Of the coverage that earlier shards hand over, clipped to a shard, only the furthest
end matters (all clipped pieces begin at the shard's border), so one summary row per shard and a
prefix scan replace the pieces: an interval over a million shards costs one row. Each shard is
merged on its own with that row in front, and periods that reach over borders are stitched by a
second scan that hands the next period's predecessor end back.

Defined results
* null, NaN or infinite bounds, and ends not later than the start, do not count;
* repeated rows and ties change nothing; null entity columns form an entity of their own;
* a null ``gap`` means 0 (touching intervals merge); an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from trackspark.operators.scan import join_null_safe, prefix_scan
from trackspark.session import durable

#: Length of a shard in ms.
SHARD_MS = 600_000


def ms(c: Column) -> Column:
    """Whole milliseconds of seconds; null for what is no finite number."""
    ok = c.isNotNull() & ~F.isnan(c) & (F.abs(c) < F.lit(9e12))
    return F.when(ok, F.round(c * 1000)).cast("long")


def periods(intervals: DataFrame, entity: list[str], start: str = "s", end: str = "e", gap: str = "gap", shard_len: int = SHARD_MS) -> DataFrame:
    """(entity, s, e, gap_from): each period, and the end of the period before it (null: none).

    ``start``/``end``/``gap`` are integers of one unit. Intervals merge if they overlap, touch or
    lie at most ``gap`` apart from the latest end so far.
    """
    iv = intervals.select(*entity, F.col(start).alias("s"), F.col(end).alias("e"), F.coalesce(F.col(gap), F.lit(0)).alias("gap"))
    iv = iv.filter("e > s").withColumn("shard", F.floor(F.col("s") / F.lit(shard_len)).cast("long"))
    reach = iv.groupBy(*entity, "shard").agg(F.max("e").alias("reach"), F.first("gap").alias("gap"))
    reach = durable(prefix_scan(reach, entity, "shard", "reach", "carry", how="max"))  # a row per shard
    handed = reach.filter("carry IS NOT NULL").select(*entity, F.lit(None).cast("long").alias("s"), F.col("carry").alias("e"), "gap", "shard")
    # equal starts are reduced behind the shuffle: a shard holds at most shard_len rows, however hot
    rows = iv.unionByName(handed).repartition(*entity, "shard").groupBy(*entity, "shard", "gap", "s").agg(F.max("e").alias("e"))
    w = Window.partitionBy(*entity, "shard").orderBy(F.col("s").asc_nulls_first()).rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.withColumn("far", F.max("e").over(w)).filter("s IS NOT NULL AND (far IS NULL OR s > far + gap)")
    # rows now begin periods; a period ends where the next one says its predecessor ended
    w2 = Window.partitionBy(*entity, "shard").orderBy("s")
    # one row a period: three steps read it
    begun = durable(rows.select(*entity, "shard", "s", F.col("far").alias("gap_from")).withColumn("e", F.lead("gap_from").over(w2)))
    total = reach.groupBy(*entity).agg(F.max("reach").alias("total"))
    firsts = begun.groupBy(*entity, "shard").agg(F.min("gap_from").alias("first_far"))
    nxt = prefix_scan(firsts, entity, "shard", "first_far", "next_far", reverse=True).drop("first_far")
    last = begun.filter("e IS NULL").drop("e")
    last = join_null_safe(join_null_safe(last, nxt, [*entity, "shard"]), total, entity).withColumn("e", F.coalesce("next_far", "total"))
    cols = [*entity, "s", "e", "gap_from"]
    return begun.filter("e IS NOT NULL").select(*cols).unionByName(last.select(*cols))
