"""Outputs: manifests in full and flat form, shards per episode with resume, splits with an index."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, MapType, StructType

from trackspark.sources.tables import exists

# fixed values: how a split index describes its pointers
INDEX = {"kind": "clip_pointer_split", "stratified_by": "dataset", "sample_level": "clip", "pointer_fields": ["id", "dataset", "video"], "join_key": "id"}


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """A small file in any store Hadoop knows, written beside its place and renamed."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = where.getFileSystem(spark._jsc.hadoopConfiguration())
    beside = where.suffix(".part")
    out = fs.create(beside, True)
    out.write(bytearray(text.encode()))
    out.close()
    fs.delete(where, False)
    fs.rename(beside, where)


def flat(rows: DataFrame) -> DataFrame:
    """Columns of simple types, and the sizes of lists and maps in place of them."""
    cols = []
    for f in rows.schema:
        if isinstance(f.dataType, (ArrayType, MapType)):
            cols.append(F.size(f.name).alias(f"n_{f.name}"))
        elif not isinstance(f.dataType, StructType):
            cols.append(F.col(f.name))
    return rows.select(*cols)


def write_manifest(rows: DataFrame, root: str, report: dict | None = None) -> None:
    """``manifest`` (JSON lines, all columns), ``manifest_flat`` (parquet), ``schema.json`` and ``report.json``."""
    rows.write.mode("overwrite").json(f"{root}/manifest")
    flat(rows).write.mode("overwrite").parquet(f"{root}/manifest_flat")
    write_text(rows.sparkSession, f"{root}/schema.json", rows.schema.json())
    write_text(rows.sparkSession, f"{root}/report.json", json.dumps(report or {}, indent=2, sort_keys=True, default=str))


def write_shards(rows: DataFrame, root: str, keys: list[str]) -> None:
    """One folder per episode; a run replaces the episodes it holds, whole, and leaves the others."""
    rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*keys).json(f"{root}/_shards")


def pending(episodes: DataFrame, root: str, keys: list[str]) -> DataFrame:
    """Episodes without a shard: what a run that was cut off still has to do."""
    spark = episodes.sparkSession
    if not exists(spark, f"{root}/_shards"):
        return episodes
    done = read_shards(spark, root).select(*[F.col(k).cast(t).alias(k) for k, t in episodes.select(*keys).dtypes]).distinct()
    return episodes.join(done, keys, "left_anti")


def read_shards(spark: SparkSession, root: str, schema: StructType | None = None) -> DataFrame:
    """All shards, those of earlier runs too; lines that are no JSON are left out."""
    r = spark.read.option("mode", "DROPMALFORMED").option("basePath", f"{root}/_shards")
    return (r.schema(schema) if schema is not None else r).json(f"{root}/_shards")


def manifest_digest(manifest: DataFrame) -> str:
    """A digest of a manifest's pointers, whatever their order."""
    each = F.conv(F.substring(F.sha2(F.concat_ws("\u0001", F.coalesce("id", F.lit("")), F.coalesce("dataset", F.lit("")), F.coalesce("video", F.lit(""))), 256), 1, 15), 16, 10).cast("decimal(38,0)")
    r = manifest.agg(F.sum(each).alias("s"), F.count(F.lit(1)).alias("n")).first()
    import hashlib

    return hashlib.sha256(f"{r.n}:{r.s}".encode()).hexdigest()


def write_splits(split: DataFrame, root: str, name: str, ratios: list[tuple[str, float]], seed: int, manifest: DataFrame | None = None, source: str = "") -> dict:
    """Pointers as JSON lines by split, and ``split_index.json`` with counts and the manifest's digest."""
    base = f"{root}/{name}"
    split.select("id", "dataset", "video", "split").write.mode("overwrite").partitionBy("split").json(base)
    counts: dict[str, dict] = {s: {"total": 0, "by_dataset": {}} for s, _ in ratios}
    for r in split.groupBy("split", "dataset").agg(F.count(F.lit(1)).alias("n")).orderBy("split", "dataset").collect():  # splits times datasets
        counts[r.split]["by_dataset"][r.dataset] = r.n
        counts[r.split]["total"] += r.n
    index = {"name": name, **INDEX, "ratios": dict(ratios), "seed": seed, "source_manifest": source, "source_manifest_sha256": None if manifest is None else manifest_digest(manifest), "files": {s: f"split={s}" for s, _ in ratios}, "counts": counts}
    write_text(split.sparkSession, f"{base}/split_index.json", json.dumps(index, indent=2, sort_keys=True))
    return index
