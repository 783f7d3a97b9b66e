"""Sensor tracks from CSV, whitespace text, tracker exports and NumPy files.

Each reader takes a path or glob and returns (path, ord, t_s, valid, ch MAP<STRING, DOUBLE>) for all
files at once; a spec says which columns hold time, channels and validity.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from trackspark.functions.predicate import valid_when
from trackspark.functions.time import to_seconds
from trackspark.operators.sharded import number_over
from trackspark.sources.catalog import open_at
from trackspark.sources.lines import csv_records, lines


@dataclass
class TrackSpec:
    """``time`` None means row number over ``fps``; columns are names (CSV) or positions."""

    channels: dict[str, str | int]
    time: str | int | None = None
    units: str = "s"
    fps: float | None = None
    valid: str | int | None = None
    valid_when: str = "==1"
    extra: dict[str, str | int] = field(default_factory=dict)
    frames: tuple[int, int] | None = None
    variants: list[tuple[str, TrackSpec]] = field(default_factory=list)


def _finish(df: DataFrame, cell: Callable[[str | int], Column], spec: TrackSpec) -> DataFrame:
    number = lambda c: F.nanvl(F.trim(cell(c).cast("string")).try_cast("double"), F.lit(None))
    t = F.col("ord") / F.lit(float(spec.fps or 1.0)) if spec.time is None else to_seconds(cell(spec.time), spec.units, spec.fps)
    ok = F.lit(True) if spec.valid is None else valid_when(cell(spec.valid), "string", spec.valid_when)
    ch = F.create_map(*[x for name, c in {**spec.channels, **spec.extra}.items() for x in (F.lit(name), number(c))])
    return df.select("path", "ord", t.alias("t_s"), ok.alias("valid"), ch.alias("ch"))


def _at(cells: str) -> Callable[[str | int], Column]:
    """Cells by position; negative ones count from the end."""
    return lambda c: F.try_element_at(cells, F.lit(int(c) + 1 if int(c) >= 0 else int(c)))


def read_csv(spark: SparkSession, path: str, spec: TrackSpec) -> DataFrame:
    """CSV with a header in each file; header names are matched without case."""
    rows = csv_records(spark, path).withColumn("rec", F.map_from_entries(F.array_distinct(F.transform(F.map_entries("rec"), lambda e: F.struct(F.lower(e["key"]).alias("key"), e["value"].alias("value"))))))
    return _finish(rows, lambda c: F.try_element_at("rec", F.lit(str(c).strip().lower())), spec)


def read_whitespace(spark: SparkSession, path: str, spec: TrackSpec) -> DataFrame:
    """Columns split at blanks, no header; blank lines and comments are skipped, ord counts the others."""
    rows = lines(spark, path).filter((F.trim("line") != "") & ~F.ltrim("line").startswith("#"))
    rows = number_over(rows.withColumnRenamed("ord", "file_ord"), ["path"], "file_ord", "file_ord", "ord", 100_000)
    return _finish(rows.withColumn("cells", F.split(F.trim("line"), r"[\t ]+")), _at("cells"), spec)


def read_tracker_export(spark: SparkSession, path: str, spec: TrackSpec) -> DataFrame:
    """Tab-separated exports: rows whose first cell is a number, ord their frame.

    A file whose head holds a variant's mark is read by that variant. Frames are a column, or come from
    µs since the file's first row. With ``frames`` that range is cut out and begins at 0.
    """
    text = lines(spark, path)
    mark = F.lit(-1)
    for k, (match, _) in reversed(list(enumerate(spec.variants))):
        mark = F.when(F.col("line").startswith(match), k).otherwise(mark)
    form = text.groupBy("path").agg(F.max(mark).alias("form"))
    rows = text.withColumn("cells", F.split("line", "\t")).filter(F.get("cells", F.lit(0)).rlike(r"^-?\d"))
    out = None
    for k, s in [(-1, spec)] + [(k, v) for k, (_, v) in enumerate(spec.variants)]:
        mine = rows.join(form.filter(F.col("form") == k).select("path"), "path", "left_semi")
        raw = F.trim(_at("cells")(s.time)).try_cast("double")
        if s.units == "frame_index":
            mine = mine.withColumn("frame", raw.cast("long"))
        else:
            mine = mine.withColumn("__us", raw)
            t0 = mine.groupBy("path").agg(F.min_by("__us", "ord").alias("t0"))
            mine = mine.join(t0, "path").withColumn("frame", F.rint((F.col("__us") - F.col("t0")) / 1e6 * F.lit(float(s.fps or 1.0))).cast("long"))
        if spec.frames:
            mine = mine.filter(F.col("frame").between(*spec.frames))
            base = mine.groupBy("path").agg(F.min("frame").alias("base"))
            mine = mine.join(base, "path").withColumn("frame", F.col("frame") - F.col("base"))
        mine = mine.filter("frame IS NOT NULL").withColumn("ord", F.col("frame"))
        part = _finish(mine, _at("cells"), TrackSpec(s.channels, None, "s", s.fps or spec.fps, s.valid, s.valid_when, s.extra))
        out = part if out is None else out.unionByName(part)
    return out


def read_npy(spark: SparkSession, path: str, spec: TrackSpec) -> DataFrame:
    """NumPy arrays (n, k): a column per position, time from the row number. Decoded in Arrow batches."""
    names = {**spec.channels, **spec.extra}
    cols = sorted({int(c) for c in [*names.values(), *([spec.valid] if spec.valid is not None else []), *([spec.time] if spec.time is not None else [])]})

    def decode(it):
        import io

        import numpy as np
        import pandas as pd

        for pdf in it:
            for p in pdf["path"]:
                with open_at(p) as f:
                    a = np.load(io.BytesIO(f.read()), allow_pickle=False)
                a = a.reshape(len(a), -1)
                have = [c if -a.shape[1] <= c < a.shape[1] else None for c in cols]
                for lo in range(0, len(a), 65536):
                    part = a[lo : lo + 65536].astype(float)
                    values = {f"c{i}": np.full(len(part), np.nan) if c is None else part[:, c] for i, c in enumerate(have)}
                    yield pd.DataFrame({"path": p, "ord": np.arange(lo, lo + len(part)), **values})

    schema = ", ".join(["path string", "ord long", *[f"c{i} double" for i in range(len(cols))]])
    rows = spark.read.format("binaryFile").load(path).select("path").mapInPandas(decode, schema)
    return _finish(rows, lambda c: F.col(f"c{cols.index(int(c))}"), spec)


READERS: dict[str, Callable[[SparkSession, str, TrackSpec], DataFrame]] = {"csv": read_csv, "whitespace_txt": read_whitespace, "begaze_txt": read_tracker_export, "npy": read_npy}


def read_track(spark: SparkSession, reader: str, path: str, spec: TrackSpec) -> DataFrame:
    if reader == "tsv":
        return read_tracker_export(spark, path, spec)
    if reader not in READERS:
        raise ValueError(f"unknown track reader {reader!r}")
    return READERS[reader](spark, path, spec)


def read_poses(spark: SparkSession, path: str) -> DataFrame:
    """(path, ord, t_s, m): rows of a text file with time first and a 4×4 matrix in columns 3 to 18."""
    rows = lines(spark, path).withColumn("cells", F.transform(F.split(F.trim("line"), r"[\t ,]+"), lambda x: x.try_cast("double"))).filter("size(cells) >= 18")
    return rows.select("path", "ord", F.get("cells", F.lit(0)).alias("t_s"), F.slice("cells", 3, 16).alias("m"))


def read_intrinsics(spark: SparkSession, path: str) -> DataFrame:
    """(path, fx, fy, cx, cy, width, height) of 24 positional numbers: a 3×3 matrix first, the size last."""
    raw = spark.read.text(path, wholetext=True).select(F.col("_metadata.file_path").alias("path"), F.transform(F.filter(F.split("value", r"[\s,]+"), lambda x: x != ""), lambda x: x.try_cast("double")).alias("v"))
    g = lambda i: F.get("v", F.lit(i))
    return raw.filter("size(v) >= 24").select("path", g(0).alias("fx"), g(4).alias("fy"), g(2).alias("cx"), g(5).alias("cy"), g(22).cast("int").alias("width"), g(23).cast("int").alias("height"))
