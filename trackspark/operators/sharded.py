"""Ordered window functions over sources of any size.

A plain window over a source sorts the whole source in one task. These run in time shards of the
source and take from a prefix scan what reaches a shard from those before it. ``t`` and ``tie``
order the rows; ``t`` is numeric and not null, ``length`` is the length of a shard in its unit.

Source and shard form one struct, which is never null and compares null fields as equal: window,
summary and join then share one partitioning, and the rows are shuffled once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from trackspark.operators.scan import prefix_scan


def _shard(df: DataFrame, keys: list[str], t: str, length: float) -> DataFrame:
    shard = F.floor(F.col(t) / F.lit(length)).cast("long").alias("__shard")
    return df.withColumn("__key", F.struct(*keys, shard))


def _carried(d: DataFrame, keys: list[str], summary: Column, how: str) -> DataFrame:
    """(__key, __carry): what reaches each shard from the shards before it."""
    ends = d.groupBy("__key").agg(summary.alias("__end")).select("__key.*", "__end")
    carry = prefix_scan(ends, keys, "__shard", "__end", "__carry", how=how)
    return carry.select(F.struct(*keys, "__shard").alias("__key"), "__carry")


def lag_over(df: DataFrame, keys: list[str], t: str, tie: str, value: Column, out: str, length: float) -> DataFrame:
    """Add ``out``: the value of the row before, null for the first row of a source."""
    d = _shard(df, keys, t, length).withColumn("__v", F.struct(value.alias("v")))
    w = Window.partitionBy("__key").orderBy(t, tie)
    carry = _carried(d, keys, F.max_by("__v", F.struct(t, tie)), "last")
    d = d.withColumn("__lag", F.lag("__v").over(w)).join(carry, "__key", "left")
    return d.withColumn(out, F.coalesce("__lag", "__carry")["v"]).drop("__v", "__lag", "__carry", "__key")


def last_over(df: DataFrame, keys: list[str], t: str, tie: str, value: Column, out: str, length: float) -> DataFrame:
    """Add ``out``: the last non-null value up to and with this row."""
    d = _shard(df, keys, t, length).withColumn("__v", value)
    w = Window.partitionBy("__key").orderBy(t, tie).rowsBetween(Window.unboundedPreceding, 0)
    carry = _carried(d, keys, F.max_by("__v", F.when(F.col("__v").isNotNull(), F.struct(t, tie))), "last")
    d = d.withColumn("__here", F.last("__v", ignorenulls=True).over(w)).join(carry, "__key", "left")
    return d.withColumn(out, F.coalesce("__here", "__carry")).drop("__v", "__here", "__carry", "__key")


def number_over(df: DataFrame, keys: list[str], t: str, tie: str, out: str, length: float) -> DataFrame:
    """Add ``out``: the row's position in its source, from 0."""
    d = _shard(df, keys, t, length)
    w = Window.partitionBy("__key").orderBy(t, tie)
    base = _carried(d, keys, F.count(F.lit(1)), "sum")
    d = d.withColumn("__rn", F.row_number().over(w) - 1).join(base, "__key", "left")
    return d.withColumn(out, F.col("__rn").cast("long") + F.coalesce("__carry", F.lit(0)).cast("long")).drop("__rn", "__carry", "__key")
