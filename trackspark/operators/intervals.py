"""Interval joins. Ranges are binned, so that every join has an equi-key of (source, bin).

An interval costs one row per bin it touches; choose ``width`` near the usual length. Closure is a
parameter because it differs by use: "[)" half-open, "[]" closed, "()" strict overlap.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _bins(s: Column, e: Column, width: float) -> Column:
    lo, hi = F.floor(s / F.lit(width)).cast("long"), F.floor(e / F.lit(width)).cast("long")
    return F.sequence(lo, F.greatest(lo, hi))


def stab(points: DataFrame, spans: DataFrame, keys: list[str], t: str, width: float, closure: str = "[)", how: str = "inner", s: str = "s", e: str = "e") -> DataFrame:
    """Points with the spans that hold them. Names of the two sides, keys apart, must differ."""
    p = points.withColumn("__bin", F.floor(F.col(t) / F.lit(width)).cast("long"))
    q = spans.filter(F.col(e) >= F.col(s)).withColumn("__qbin", F.explode(_bins(F.col(s), F.col(e), width)))
    q = q.select(*[F.col(k).alias(f"__q_{k}") for k in keys], *[c for c in q.columns if c not in keys])
    cond = (F.col("__bin") == F.col("__qbin")) & (F.col(t) >= F.col(s)) & ((F.col(t) < F.col(e)) if closure == "[)" else (F.col(t) <= F.col(e)))
    for k in keys:
        cond = cond & (F.col(k) == F.col(f"__q_{k}"))
    return p.join(q, cond, how).drop("__bin", "__qbin", *[f"__q_{k}" for k in keys])


def overlaps(a: DataFrame, b: DataFrame, keys: list[str], width: float, a_s: str = "a_s", a_e: str = "a_e", b_s: str = "b_s", b_e: str = "b_e") -> DataFrame:
    """Pairs of strictly overlapping intervals, each once: in the bin where the overlap begins."""
    x = a.withColumn("__bin", F.explode(_bins(F.col(a_s), F.col(a_e), width)))
    y = b.withColumn("__bin", F.explode(_bins(F.col(b_s), F.col(b_e), width)))
    both = x.join(y, [*keys, "__bin"])
    begin = F.greatest(a_s, b_s)
    return both.filter((F.least(a_e, b_e) > begin) & (F.floor(begin / F.lit(width)) == F.col("__bin"))).drop("__bin")


def overlapping(a: DataFrame, b: DataFrame, keys: list[str], ident: str, width: float, **names: str) -> DataFrame:
    """Rows of ``a`` that strictly overlap any of ``b``; ``ident`` identifies a row of ``a`` within the keys."""
    hit = overlaps(a.select(*keys, ident, names.get("a_s", "a_s"), names.get("a_e", "a_e")), b, keys, width, **names).select(*keys, ident).distinct()
    return a.join(hit, [*keys, ident], "left_semi")


def in_regions(spans: DataFrame, regions: DataFrame, keys: list[str], ident: str, width: float) -> DataFrame:
    """Spans (keys, channel, s, e, ident) that strictly overlap an interesting region of their own channel.

    ``regions`` is (keys, channel, r_s, r_e, interesting). Where no region of a source names a channel,
    regions of the source count for all its channels. Sources without interesting regions keep nothing.
    """
    r = regions.filter("interesting AND r_s IS NOT NULL AND r_e IS NOT NULL").select(*keys, F.col("channel").alias("r_channel"), F.col("r_s").alias("b_s"), F.col("r_e").alias("b_e"))
    named = r.groupBy(*keys).agg(F.max(F.col("r_channel").isNotNull()).alias("named"))
    r = r.join(named, keys)
    a = spans.select(*keys, ident, "channel", F.col("s").alias("a_s"), F.col("e").alias("a_e"))
    both = overlaps(a, r, keys, width).filter(~F.col("named") | (F.col("channel") == F.col("r_channel")))
    return spans.join(both.select(*keys, ident).distinct(), [*keys, ident], "left_semi")
