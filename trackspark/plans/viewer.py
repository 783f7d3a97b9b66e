"""Rows for looking at results: per-frame points, role-tagged annotations, index, triplets."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trackspark.operators.sharded import number_over


def frame_rows(clips: DataFrame) -> DataFrame:
    """(id, frame, t, x, y, valid) of nested clip rows; masked frames have null coordinates."""
    z = clips.select("id", F.posexplode(F.arrays_zip("timestamps", "points")).alias("frame", "f"))
    return z.select("id", "frame", F.col("f.timestamps").alias("t"), F.col("f.points.x").alias("x"), F.col("f.points.y").alias("y"), F.col("f.points").isNotNull().alias("valid"))


def annotation_rows(clips: DataFrame) -> DataFrame:
    """(id, role, channel, start, end, text): final (if it differs), source, auxiliary."""
    length = F.col("e") - F.col("s")
    a = lambda role, ch, s, e, t: F.struct(F.lit(role).alias("role"), ch.alias("channel"), s.cast("long").alias("start"), e.cast("long").alias("end"), t.alias("text"))
    zero = F.lit(0)
    source = F.array(a("source", F.col("channel"), zero, length, F.col("text")))
    final = F.when(~F.col("final_text").eqNullSafe(F.col("text")), F.array(a("final", F.col("channel"), zero, length, F.col("final_text"))))
    aux = F.transform("aux", lambda x: a("auxiliary", x["channel"], x["start"], x["end"], x["text"]))
    none = F.array().cast("array<struct<role:string,channel:string,start:bigint,end:bigint,text:string>>")
    return clips.select("id", F.inline(F.concat(F.coalesce(final, none), source, aux)))


def index_rows(clips: DataFrame) -> DataFrame:
    return clips.select("id", ((F.col("e") - F.col("s")) / 1e6).alias("duration_s"), F.size("points").alias("frames"), "valid_points")


def thinned(rows: DataFrame, keys: list[str], t: str, tie: str, most: int, length: float) -> DataFrame:
    """Every k-th row of sources with more than ``most`` rows, others whole."""
    n = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("__n"))
    d = number_over(rows, keys, t, tie, "__i", length).join(n, keys)
    return d.filter(F.col("__i") % F.greatest(F.ceil(F.col("__n") / F.lit(most)), F.lit(1)) == 0).drop("__i", "__n")


def triplets(df: DataFrame, ids: list[str], column: str) -> DataFrame:
    """(ids, i, t, x, y) of arrays of [t, x, y]; shorter ones are left out."""
    z = df.select(*ids, F.posexplode(column).alias("i", "v")).filter("size(v) >= 3")
    return z.select(*ids, "i", F.get("v", F.lit(0)).alias("t"), F.get("v", F.lit(1)).alias("x"), F.get("v", F.lit(2)).alias("y"))
