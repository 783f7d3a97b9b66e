"""Canonical tables: tracks, depth and annotations of all episodes on one regular grid.

Input rows are normalised first (column families, units, pixel or normalised coordinates); then the
grid, the interpolated track and the labels of each instant are one plan over all episodes.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trackspark.functions.text import compose
from trackspark.functions.time import guess_seconds
from trackspark.operators import asof, intervals

KEYS = ["dataset", "episode_id"]
# fixed values: names under which exports carry time, in order
TIME_NAMES = ("time_s", "timestamp_s", "timestamp_ns", "timestamp_ms", "timestamp", "time", "t", "video_time_s")
START_NAMES = ("start_s", "start_time_s", "start_time_ns", "start_time_ms", "start_time", "start", "start_timestamp")
END_NAMES = ("end_s", "end_time_s", "end_time_ns", "end_time_ms", "end_time", "end", "end_timestamp")


def first_present(df: DataFrame, names: tuple[str, ...]) -> Column:
    """The first non-null of the columns that exist, names without case."""
    have = {c.lower(): c for c in df.columns}
    cols = [F.col(f"`{have[n]}`") for n in names if n in have]
    return F.coalesce(*cols) if cols else F.lit(None)


def _seconds(df: DataFrame, names: tuple[str, ...]) -> Column:
    have = {c.lower(): c for c in df.columns}
    cols = [guess_seconds(F.col(f"`{have[n]}`"), n) for n in names if n in have]
    return F.coalesce(*cols) if cols else F.lit(None).cast("double")


def normalise_track(df: DataFrame) -> DataFrame:
    """(keys, ord, time_s, x_norm, y_norm, x_px, y_px); a pixel pair within [0, 1] is a normalised one."""
    num = lambda *n: first_present(df, n).cast("double")
    d = df.select(*KEYS, "ord", _seconds(df, TIME_NAMES).alias("time_s"), num("x_norm", "gaze_x_norm").alias("xn"), num("y_norm", "gaze_y_norm").alias("yn"), num("x_px", "gaze_x", "x").alias("xp"), num("y_px", "gaze_y", "y").alias("yp"))
    share = F.col("xn").isNull() & F.col("yn").isNull() & F.col("xp").between(0, 1) & F.col("yp").between(0, 1)
    flip = F.coalesce(share, F.lit(False))
    return d.select(*KEYS, "ord", "time_s", F.when(flip, F.col("xp")).otherwise(F.col("xn")).alias("x_norm"), F.when(flip, F.col("yp")).otherwise(F.col("yn")).alias("y_norm"), F.when(~flip, F.col("xp")).alias("x_px"), F.when(~flip, F.col("yp")).alias("y_px")).filter("time_s IS NOT NULL")


def normalise_depth(df: DataFrame) -> DataFrame:
    return df.select(*KEYS, "ord", _seconds(df, TIME_NAMES).alias("time_s"), first_present(df, ("depth_m", "depth", "z")).cast("double").alias("depth_m")).filter("time_s IS NOT NULL")


def normalise_intervals(df: DataFrame) -> DataFrame:
    """(keys, ord, start_s, end_s, label, text); rows with one bound only are left out."""
    have = {c.lower() for c in df.columns}
    verb = compose([first_present(df, (n,)) for n in ("verb", "noun") if n in have]) if have & {"verb", "noun"} else F.lit(None).cast("string")
    label = F.coalesce(first_present(df, ("label", "action")).cast("string"), F.nullif(verb, F.lit("")))
    text = F.coalesce(first_present(df, ("text", "narration", "description")).cast("string"), label)
    return df.select(*KEYS, "ord", _seconds(df, START_NAMES).alias("start_s"), _seconds(df, END_NAMES).alias("end_s"), label.alias("label"), text.alias("text")).filter("start_s IS NOT NULL AND end_s IS NOT NULL")


def durations(*tables: tuple[DataFrame, str]) -> DataFrame:
    """(keys, duration_s): the latest time in any of the tables."""
    parts = [t.select(*KEYS, F.col(c).alias("t")) for t, c in tables]
    u = parts[0]
    for p in parts[1:]:
        u = u.unionByName(p)
    return u.groupBy(*KEYS).agg(F.max("t").alias("duration_s"))


def timeline(episodes: DataFrame, hz: float, chunk: int = 4096) -> DataFrame:
    """(keys, frame_index, time_s, is_last): floor(duration * hz) + 1 instants."""
    last = F.floor((F.col("duration_s") + 1e-9) * F.lit(float(hz))).cast("long")
    d = episodes.filter("duration_s >= 0").select(*KEYS, last.alias("last")).withColumn("c", F.explode(F.sequence(F.lit(0).cast("long"), F.floor(F.col("last") / chunk))))
    i = F.explode(F.sequence(F.col("c") * chunk, F.least("last", F.col("c") * chunk + (chunk - 1))))
    return d.withColumn("frame_index", i).select(*KEYS, "frame_index", F.round(F.col("frame_index") / F.lit(float(hz)), 9).alias("time_s"), (F.col("frame_index") == F.col("last")).alias("is_last"))


def resample(grid: DataFrame, rows: DataFrame, values: list[str], max_gap_s: float | None = None, shard_s: float = 600.0) -> DataFrame:
    """Grid rows with interpolated values; each value is null outside its readings."""
    f = asof.bracket(grid, rows, KEYS, "time_s", values, shard_s)
    return f.select(*grid.columns, *[asof.lerp(v, "time_s", max_gap_s).alias(v) for v in values])


def label_instants(grid: DataFrame, spans: DataFrame, width: float = 60.0) -> DataFrame:
    """Grid rows with labels and texts of the intervals [start, end) that hold them, in file order.

    The episode's last instant also belongs to intervals that end there.
    """
    s = spans.select(*KEYS, F.col("ord").alias("s_ord"), "start_s", "end_s", "label", "text")
    hit = intervals.stab(grid, s, KEYS, "time_s", width, "[]", s="start_s", e="end_s").filter((F.col("time_s") < F.col("end_s")) | F.col("is_last"))
    both = F.sort_array(F.collect_list(F.struct("s_ord", "label", "text")))
    lab = hit.groupBy(*KEYS, "frame_index").agg(both.alias("h"))
    join = lambda c: F.array_join(F.filter(F.transform("h", lambda x: x[c]), lambda x: x.isNotNull()), "|")
    lab = lab.select(*KEYS, "frame_index", join("label").alias("labels"), join("text").alias("texts"))
    return grid.join(lab, [*KEYS, "frame_index"], "left").select(*grid.columns, F.coalesce("labels", F.lit("")).alias("labels"), F.coalesce("texts", F.lit("")).alias("texts"))


def label_nearest(grid: DataFrame, points: DataFrame, shard_s: float = 600.0) -> DataFrame:
    """Grid rows with label and text of the nearest point annotation (keys, ord, time_s, label, text)."""
    f = asof.bracket(grid, points, KEYS, "time_s", ["label", "text"], shard_s)
    n = asof.nearest(f, "time_s")
    return f.select(*grid.columns, n["label"].alias("labels"), n["text"].alias("texts"))


def rectify(track: DataFrame, spans: DataFrame | None, depth: DataFrame | None, hz: float, max_gap_s: float | None = None) -> dict[str, DataFrame]:
    """The canonical tables: timeline, gaze, and where given intervals, annotations and depth."""
    t = normalise_track(track)
    parts = [(t, "time_s")]
    iv = normalise_intervals(spans) if spans is not None else None
    dp = normalise_depth(depth) if depth is not None else None
    parts += [(iv, "end_s")] if iv is not None else []
    parts += [(dp, "time_s")] if dp is not None else []
    grid = timeline(durations(*parts), hz)
    out = {"timeline": grid.drop("is_last"), "gaze": resample(grid, t, ["x_norm", "y_norm", "x_px", "y_px"], max_gap_s).drop("is_last")}
    if iv is not None:
        out["intervals"] = iv
        out["annotations"] = label_instants(grid, iv).drop("is_last")
    if dp is not None:
        out["depth"] = resample(grid, dp, ["depth_m"], max_gap_s).drop("is_last")
    return out


def write(tables: dict[str, DataFrame], root: str) -> None:
    """Write canonical tables partitioned by dataset; a second run replaces the datasets it holds."""
    for name, df in tables.items():
        df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("dataset").parquet(f"{root}/{name}")
