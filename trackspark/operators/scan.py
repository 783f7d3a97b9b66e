"""Prefix scans over shard summaries, in two levels.

A sharded operator summarises each shard in one row and needs, for each shard, the state that
reaches it from the shards before it. A window over all summaries of a key would put a huge key's
summaries into one task, so the scan first runs inside blocks of ``fan`` neighbouring shard
numbers and then over one row per block; a task sees at most ``fan`` rows of a block, and a key
with 10**12 slots in shards of 4096 leaves 60,000 block rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

FAN = 4096


def same_keys(a: DataFrame, b: DataFrame, keys: list[str]) -> Column:
    """Null-safe equality of the key columns."""
    cond = F.lit(True)
    for k in keys:
        cond = cond & a[k].eqNullSafe(b[k])
    return cond


def join_null_safe(a: DataFrame, b: DataFrame, keys: list[str], how: str = "left") -> DataFrame:
    """Join on keys that may be null; the right side's keys are dropped."""
    right = b.select(*[F.col(k).alias(f"__r_{k}") for k in keys], *[c for c in b.columns if c not in keys])
    cond = F.lit(True)
    for k in keys:
        cond = cond & F.col(k).eqNullSafe(F.col(f"__r_{k}"))
    return a.join(right, cond, how).drop(*[f"__r_{k}" for k in keys])


def prefix_scan(df: DataFrame, keys: list[str], pos: str, value: str, out: str, how: str = "last", reverse: bool = False, fan: int = FAN) -> DataFrame:
    """Add ``out``: the running ``how`` of ``value`` over all rows strictly before this one.

    ``df`` has one row per (keys, pos). ``how`` is "last" (the nearest earlier non-null value) or
    "max" or "sum". ``reverse`` scans from the end. No earlier row, or only null values: null.
    """
    block = F.floor(F.col(pos) / F.lit(fan)).cast("long")
    if how == "last":
        fold = lambda c: F.last(c, ignorenulls=True)
        total = (F.min_by if reverse else F.max_by)(F.col(value), F.when(F.col(value).isNotNull(), F.col(pos)))
    elif how == "max":
        fold = F.max
        total = F.max(value)
    elif how == "sum":
        fold = F.sum
        total = F.sum(value)
    else:
        raise ValueError(f"unknown scan {how!r}")
    side = (lambda c: F.col(c).desc()) if reverse else (lambda c: F.col(c).asc())
    before = (Window.unboundedPreceding, -1)
    inner = df.withColumn("__block", block)
    w = Window.partitionBy(*keys, "__block").orderBy(side(pos)).rowsBetween(*before)
    inner = inner.withColumn("__in", fold(F.col(value)).over(w))
    wb = Window.partitionBy(*keys).orderBy(side("__block")).rowsBetween(*before)
    blocks = df.withColumn("__block", block).groupBy(*keys, "__block").agg(total.alias("__total")).withColumn("__far", fold(F.col("__total")).over(wb)).drop("__total")
    joined = join_null_safe(inner, blocks, [*keys, "__block"])
    got = {"last": F.coalesce("__in", "__far"), "max": F.greatest("__in", "__far"), "sum": F.coalesce(F.col("__in") + F.col("__far"), "__in", "__far")}[how]
    return joined.withColumn(out, got).drop("__block", "__in", "__far")
