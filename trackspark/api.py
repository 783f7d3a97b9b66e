"""One place for the commands a user runs; each returns DataFrames or writes tables."""

from __future__ import annotations

import platform
import sys
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trackspark import config
from trackspark.plans import classify, clips, extract, rectify, splits, validate, viewer
from trackspark.recipe import Recipe
from trackspark.sources import catalog, sinks
from trackspark.streaming.operators import watch as watch_folder


def doctor(spark: SparkSession) -> dict[str, Any]:
    """What this environment offers."""
    have = {}
    for m in ("pyarrow", "pandas", "numpy", "duckdb", "tiktoken"):
        try:
            have[m] = __import__(m).__version__
        except ImportError:
            have[m] = None
    return {"python": sys.version.split()[0], "spark": spark.version, "platform": platform.platform(), "timezone": spark.conf.get("spark.sql.session.timeZone"), "adaptive": spark.conf.get("spark.sql.adaptive.enabled"), "packages": have}


def inspect(spark: SparkSession, root: str) -> DataFrame:
    """Profile of a folder by sequence."""
    return catalog.profile(catalog.listing(spark, root))


def watch(spark: SparkSession, root: str, expected: DataFrame, **how: Any) -> bool:
    return watch_folder(spark, root, expected, **how)


def plan_downloads(assets: DataFrame, datasets: list[str] | None = None, modalities: list[str] | None = None, sequences: list[str] | None = None) -> DataFrame:
    """Assets of the wanted datasets, modalities and sequences, with the path they get; names without regard to case and signs."""
    a = assets
    if datasets:
        wanted = [r[0] for r in assets.sparkSession.createDataFrame([(d,) for d in datasets], "d string").select(catalog.dataset_name(F.col("d"))).collect()]  # the names given
        a = a.filter(catalog.dataset_name(F.col("dataset")).isin(wanted))
    if modalities:
        a = a.filter(F.when(F.lower("modality") == "annotations", "annotation").otherwise(F.lower("modality")).isin([catalog.asked_modality(m) for m in modalities]))
    if sequences:
        a = a.filter(F.lower(F.trim("sequence_id")).isin([s.strip().lower() for s in sequences]))
    return a.withColumn("target", F.concat_ws("/", "dataset", "sequence_id", "modality", "filename"))


def run_extract(spark: SparkSession, recipe: Recipe, root: str, episodes: DataFrame) -> dict[str, DataFrame]:
    return extract.run(spark, recipe, root, episodes)


def run_rectify(track: DataFrame, spans: DataFrame | None, depth: DataFrame | None, out: str, cfg: config.Config | None = None) -> dict[str, DataFrame]:
    """Canonical tables, written by dataset."""
    cfg = cfg or config.Config()
    tables = rectify.rectify(track, spans, depth, cfg.grid.hz, cfg.grid.max_gap_s)
    rectify.write(tables, out)
    return tables


def run_validate(spark: SparkSession, root: str, tables: dict[str, DataFrame], cfg: config.Config | None = None) -> DataFrame:
    """Recompute-and-diff: written canonical tables against fresh ones; (name, ok, differences) and "all"."""
    cfg = cfg or config.Config()
    keys = ["dataset", "episode_id", "frame_index"]
    out = None
    for name, fresh in tables.items():
        if name == "intervals":
            continue
        values = [c for c in fresh.columns if c not in keys]
        tol = {c: (cfg.tolerances.time_s if c == "time_s" else cfg.tolerances.value if dict(fresh.dtypes)[c] == "double" else None) for c in values}
        d = validate.differences(fresh, spark.read.parquet(f"{root}/{name}").select(*fresh.columns), keys, tol)
        n = d.agg(F.count(F.lit(1)).alias("differences")).select(F.lit(name).alias("name"), "differences")
        out = n if out is None else out.unionByName(n)
    return validate.report(out)


def episode_split(episodes: DataFrame, ratios: list[tuple[str, float]], seed: int, group: str = "dataset", datasets: list[str] | None = None, modalities: list[str] | None = None) -> DataFrame:
    """Episodes with all wanted modalities, split within their group."""
    e = episodes.filter(F.col("dataset").isin(datasets)) if datasets else episodes
    if modalities:
        e = e.filter(F.size(F.array_except(F.array(*[F.lit(m) for m in modalities]), F.coalesce("modalities", F.array().cast("array<string>")))) == 0)
    e = e.select(F.concat_ws(":", "dataset", "episode_id").alias("id"), F.col(group).alias("group")).distinct()
    return splits.proportional(e, "id", "group", ratios, seed).select("id", "group", "split")


def clip_rows(spans: DataFrame, track: DataFrame, sources: DataFrame, keys: list[str], spec: clips.ClipSpec) -> DataFrame:
    return clips.rows(spans, track, sources, keys, spec)


def clip_report(rows: DataFrame, keys: list[str]) -> DataFrame:
    """Of each source: clips, packed clips, frames (least, most, sum), share of frames with a point."""
    n = F.size("points")
    return rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("clips"), F.count_if(F.col("n") > 1).alias("packed"), F.min(n).alias("least"), F.max(n).alias("most"), F.sum(n).alias("frames"), F.round(F.sum("valid_points") / F.sum(n), 6).alias("valid"))


def viewer_tables(rows: DataFrame) -> dict[str, DataFrame]:
    return {"index": viewer.index_rows(rows), "frames": viewer.frame_rows(rows), "annotations": viewer.annotation_rows(rows)}


def export_annotations(spans: DataFrame, keys: list[str], rubric: str, size: int = 60) -> DataFrame:
    return classify.prompts(spans, keys, rubric, size)


def make_splits(manifest: DataFrame, ratios: list[tuple[str, float]], seed: int, out: str | None = None) -> DataFrame:
    """Clip pointers with exact quotas per dataset; written as JSON lines by split if ``out`` is given."""
    p = splits.pointers(manifest)
    p = p.groupBy("id").agg(F.min_by(F.struct("dataset", "video"), F.struct("dataset", "video")).alias("r")).select("id", "r.*")
    s = splits.stratified(p, "id", "dataset", ratios, seed)
    if out:
        s.write.mode("overwrite").partitionBy("split").json(out)
    return s


def write_clips(rows: DataFrame, root: str, keys: list[str]) -> DataFrame:
    """Clip rows as shards by episode; the manifest of all shards, those of earlier runs too, is written beside them."""
    sinks.write_shards(rows, root, keys)
    whole = sinks.read_shards(rows.sparkSession, root, rows.schema)
    sinks.write_manifest(whole, root, {"clips": whole.count()})
    return whole


def join_manifests(spark: SparkSession, sources: list[tuple[str, list[str] | None]], out: str, videos: str = "collected") -> DataFrame:
    """Manifests of several runs as one, written as JSON lines; returns what each gave and lost.

    ``videos``: "collected" (videos/dataset/name beside the manifest), "absolute" or "as_written".
    """
    parts = []
    for path, keep in sources:
        df = spark.read.option("mode", "DROPMALFORMED").json(path)
        for c in ("id", "dataset", "video", "error"):
            df = df if c in df.columns else df.withColumn(c, F.lit(None).cast("string"))
        df = df.withColumn("ord", F.monotonically_increasing_id())
        if videos == "absolute":
            df = df.withColumn("video", splits.absolute_video(F.col("video"), path.rsplit("/", 1)[0]))
        parts.append((df, keep))
    whole = splits.join_manifests(parts)
    if videos == "collected":
        whole = whole.withColumn("video", splits.collected_video(F.col("video"), F.col("dataset")))
    whole.drop("ord", "source_ord", "error").write.mode("overwrite").json(out)
    return splits.join_counts(parts)


def split_index(s: DataFrame) -> DataFrame:
    """Clips per split and dataset, with totals (null dataset, null split)."""
    return s.rollup("split", "dataset").agg(F.count(F.lit(1)).alias("clips"))
