"""Queries through readers, sinks and recipes: tables are written to the shared folder and read back."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trackspark.functions import time as TM
from trackspark.operators.intervals import in_regions
from trackspark.plans import extract, project, rectify, splits
from trackspark.recipe import compile_recipe
from trackspark.session import shared_folder, table
from trackspark.sources import annotations, sinks, tables, tracks

EP = ["dataset", "episode_id"]


def _folder(spark: SparkSession, name: str) -> str:
    return f"{shared_folder(spark)}/{spark.sparkContext.applicationId}/{name}"


def _gaze(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "gaze_sample").select("sample_id", *EP, "t_s", "x", "y", "valid")


def read_tracks_csv(spark: SparkSession, d: str) -> DataFrame:
    """Gaze rows written as CSV by dataset and read with a track reader."""
    out = _folder(spark, "tracks_csv")
    _gaze(spark, d).select("sample_id", "t_s", "x", "y", F.col("valid").cast("int").alias("valid"), F.col("dataset").alias("part")).write.mode("overwrite").partitionBy("part").option("header", True).csv(out)
    t = tracks.read_track(spark, "csv", f"{out}/*/*.csv", tracks.TrackSpec({"x": "X", "y": "y"}, "t_s", valid="valid", valid_when="==1", extra={"id": "sample_id"}))
    return t.select(F.col("ch.id").cast("long").alias("sample_id"), F.nanvl("t_s", F.lit(None)).alias("t_s"), F.col("ch.x").alias("x"), F.col("ch.y").alias("y"), "valid")


def read_tracks_text(spark: SparkSession, d: str) -> DataFrame:
    """Usable gaze rows written as text split at blanks and read by position; validity is a column from the end."""
    out = _folder(spark, "tracks_text")
    g = _gaze(spark, d).filter("valid AND t_s >= 0 AND NOT isnan(t_s) AND x IS NOT NULL AND y IS NOT NULL AND NOT isnan(x) AND NOT isnan(y)")
    line = F.concat_ws(" \t", F.col("t_s").cast("string"), F.col("x").cast("string"), F.col("y").cast("string"), F.col("sample_id").cast("string"), F.pmod("sample_id", F.lit(2)).cast("string"))
    g.select(line.alias("value"), F.col("dataset").alias("part")).write.mode("overwrite").partitionBy("part").text(out)
    t = tracks.read_track(spark, "whitespace_txt", f"{out}/*/*.txt", tracks.TrackSpec({"x": 1, "y": 2}, 0, valid=-1, valid_when="==1", extra={"id": -2}))
    return t.select(F.col("ch.id").cast("long").alias("sample_id"), "t_s", F.col("ch.x").alias("x"), F.col("ch.y").alias("y"), "valid")


def read_segments_csv(spark: SparkSession, d: str) -> DataFrame:
    """Segments written as CSV and read as annotations, points dropped by a predicate."""
    out = _folder(spark, "segments_csv")
    s = table(spark, d, "segment").select("segment_id", "channel", "kind", (F.col("start_s") * 1000).alias("start (ms)"), (F.col("end_s") * 1000).alias("end (ms)"), "text")
    s.write.mode("overwrite").option("header", True).csv(out)
    got = annotations.read_csv(spark, f"{out}/*.csv", annotations.SegmentSpec("start", "end (ms)", units="ms", text=["channel", "text"], drop="kind == 'point'", extras=["segment_id"]))
    return got.select(F.col("extras.segment_id").cast("long").alias("segment_id"), F.round("start_s", 6).alias("start_s"), F.round("end_s", 6).alias("end_s"), "text")


def table_formats(spark: SparkSession, d: str) -> DataFrame:
    """One small table through every format of the table reader."""
    t, out = table(spark, d, "mix_target"), None
    for kind in ("parquet", "jsonl", "csv"):
        path = _folder(spark, f"formats.{kind}")
        tables.write_table(t, path)
        got = tables.read_table(spark, path).select(F.lit(kind).alias("format"), "source", F.col("target_share").cast("double").alias("target_share"), F.col("max_repeats").cast("int").alias("max_repeats"))
        out = got if out is None else out.unionByName(got)
    return out


RECIPE = {
    "dataset": "nymeria",
    "gaze": {"select": {"glob": "gaze/episode_id={episode_id}/part-*.csv"}, "gaze_format": {"reader": "csv", "columns": {"x": "x", "y": "y"}, "time": {"source": "t_us", "units": "us"}}},
    "annotations": [
        {"name": "segments", "select": {"glob": "text/*.csv"}, "time": {"start": "start_s", "end": "end_s"}, "text": {"primary": "text"}, "extras": ["segment_id", "channel"], "filter": {"keep_where": "kind=='interval'"}, "join": {"by": "row_field", "key_field": "episode"}},
    ],
    "epoch_sync": {"gaze": {"transform": "subtract_first_gaze"}, "annotations": {"transform": "subtract_first_gaze"}},
    "dataset_filters": {"exclude_episode_globs": ["*loft*"]},
}


def extract_rows(spark: SparkSession, d: str) -> DataFrame:
    """A dataset's segments by its recipe: on the clock of the recording's first gaze row, excluded episodes left out."""
    root, r = _folder(spark, "extract"), compile_recipe(RECIPE)
    g = _gaze(spark, d).filter(F.col("dataset") == r.dataset).filter("t_s IS NOT NULL AND NOT isnan(t_s)").select("episode_id", F.round(F.col("t_s") * 1e6).cast("long").alias("t_us"), "x", "y", "sample_id")
    g.repartition("episode_id").sortWithinPartitions("episode_id", "sample_id", "t_us").write.mode("overwrite").partitionBy("episode_id").option("header", True).csv(f"{root}/gaze")
    s = table(spark, d, "segment").filter(F.col("dataset") == r.dataset).select("segment_id", F.col("episode_id").alias("episode"), "channel", "kind", "start_s", "end_s", "text").distinct()
    s.write.mode("overwrite").option("header", True).csv(f"{root}/text")
    eps = table(spark, d, "episode").filter(F.col("dataset") == r.dataset).groupBy(*EP).agg(F.max("duration_s").alias("duration_s"))
    seg = extract.run(spark, r, root, eps)["segment"]
    return seg.select("episode_id", F.col("extras.segment_id").cast("long").alias("segment_id"), F.round("start_s", 5).alias("start_s"), F.round("end_s", 5).alias("end_s"), "text")


def time_guess(spark: SparkSession, d: str) -> DataFrame:
    """Seconds guessed from names and magnitudes of the same numbers."""
    a = table(spark, d, "asset").filter("size_bytes IS NOT NULL").select("asset_id", "size_bytes").distinct().withColumn("big", (F.col("size_bytes") * 100_000).cast("string"))
    g = lambda c, n: F.round(TM.guess_seconds(F.col(c).cast("string"), n), 6)
    return a.select("asset_id", g("size_bytes", "time").alias("plain"), g("size_bytes", "time_ms").alias("ms"), g("big", "start_time_ms").alias("big_ms"), g("size_bytes", "T_NS").alias("ns"), g("big", "t").alias("big"))


def clip_ids(spark: SparkSession, d: str) -> DataFrame:
    """Clip start and frame range out of ids of cut clips; other ids have none."""
    s = table(spark, d, "segment").select("segment_id", "episode_id", "ord").distinct()
    cut = F.concat_ws("-", "episode_id", (F.col("ord") * 500).cast("string"), (F.col("ord") * 500 + 400).cast("string"), F.concat(F.lit("F"), F.col("ord") * 12), F.concat(F.lit("F"), F.col("ord") * 12 + 9))
    s = s.withColumn("id", F.when(F.pmod("segment_id", F.lit(3)) > 0, cut).otherwise(F.col("episode_id")))
    return s.select("segment_id", "id", TM.clip_start(F.col("id")).alias("start_s"), TM.frame_range(F.col("id"))["first"].alias("first"), TM.frame_range(F.col("id"))["last"].alias("last"))


def normalise_columns(spark: SparkSession, d: str) -> DataFrame:
    """Gaze under an exporter's names as normalised rows: seconds, shares or pixels."""
    g = _gaze(spark, d).select("sample_id", *EP, F.col("sample_id").alias("ord"), F.round(F.col("t_s") * 1000).alias("timestamp_ms"), "x", "y").filter("NOT isnan(timestamp_ms) AND NOT isnan(x) AND NOT isnan(y)")
    n = rectify.normalise_track(g.drop("sample_id"))
    return n.select(F.col("ord").alias("sample_id"), F.round("time_s", 6).alias("time_s"), "x_norm", "y_norm", "x_px", "y_px")


def join_loss(spark: SparkSession, d: str) -> DataFrame:
    """What a join of two manifests keeps and loses of each."""
    m = table(spark, d, "documents").select(F.concat_ws(":", "source", F.coalesce("repo", F.lit("none")), "file_path").alias("id"), F.col("source").alias("dataset"), F.lit(None).cast("string").alias("video"), F.when(F.coalesce("text", F.lit("")) == "", "no text").alias("error"), "lang", F.col("doc_id").alias("ord"))
    return splits.join_counts([(m.filter("lang IN ('markdown', 'rst')"), None), (m, ["mono-mirror", "doc-site"])])


def region_channels(spark: SparkSession, d: str) -> DataFrame:
    """Segments that overlap an interesting region of their channel; every seventh segment is one."""
    s = table(spark, d, "segment").filter("end_s > start_s AND dataset IS NOT NULL AND episode_id IS NOT NULL").select(*EP, F.col("segment_id").alias("ord"), F.lower(F.trim("channel")).alias("channel"), F.round(F.col("start_s") * 1000).cast("long").alias("s"), F.round(F.col("end_s") * 1000).cast("long").alias("e")).distinct()
    channel = F.when(F.col("dataset") != "egome", F.col("channel"))  # one dataset's regions name no channel
    r = s.select(*EP, channel.alias("channel"), F.col("s").alias("r_s"), F.col("e").alias("r_e"), (F.pmod("ord", F.lit(7)) == 0).alias("interesting"))
    return in_regions(s, r, EP, "ord", 60_000).select(*EP, F.col("ord").alias("segment_id"), "channel")


def project_planar(spark: SparkSession, d: str) -> DataFrame:
    """Planar gaze on a film half as large as the recipe's frame."""
    rec = table(spark, d, "recipe").filter("coordinate_space = 'pixel_2d'").select("dataset", "width", "height")
    g = _gaze(spark, d).filter("x IS NOT NULL AND y IS NOT NULL AND NOT isnan(x) AND NOT isnan(y)").join(rec, "dataset")
    out = None
    for r in rec.collect():  # a row per dataset
        t = g.filter(F.col("dataset") == r.dataset).select(*EP, F.col("sample_id").alias("ord"), "t_s", F.coalesce("valid", F.lit(False)).alias("valid"), F.create_map(F.lit("x"), F.col("x"), F.lit("y"), F.col("y")).alias("ch"))
        films = t.select(*EP).distinct().withColumn("width", F.lit(r.width // 2)).withColumn("height", F.lit(r.height // 2))
        p = project.project(t, films, "already_2d", dims=(r.width, r.height)).select(*EP, F.col("ord").alias("sample_id"), F.round("px", 3).alias("px"), F.round("py", 3).alias("py"), "in_frame")
        out = p if out is None else out.unionByName(p)
    return out


def shard_resume(spark: SparkSession, d: str) -> DataFrame:
    """Episodes that a run cut off after those with segments still has to do."""
    root = _folder(spark, "shards")
    eps = table(spark, d, "episode").filter("dataset IS NOT NULL AND episode_id IS NOT NULL").select(*EP).distinct()
    done = table(spark, d, "segment").filter("end_s > start_s").groupBy(*EP).agg(F.count(F.lit(1)).alias("n"))
    sinks.write_shards(done.join(eps, EP, "left_semi"), root, EP)
    return sinks.pending(eps, root, EP)


def manifest_flat(spark: SparkSession, d: str) -> DataFrame:
    """Episodes as the flat form of a manifest: lists become their sizes."""
    return sinks.flat(table(spark, d, "episode").select("dataset", "episode_id", "take_uid", "modalities", "width"))


def frame_rates(spark: SparkSession, d: str) -> DataFrame:
    """Frame rates written as numbers and as fractions, with a zero denominator."""
    s = table(spark, d, "supplier").select("s_suppkey", "s_nationkey")
    n, m = (F.col("s_suppkey") * 1000).cast("string"), F.col("s_nationkey").cast("string")
    return s.select("s_suppkey", F.round(TM.frame_rate(F.concat(n, F.lit("/"), m)), 6).alias("fraction"), F.round(TM.frame_rate(n), 6).alias("number"))


QUERIES = {f.__name__: f for f in (read_tracks_csv, read_tracks_text, read_segments_csv, table_formats, extract_rows, time_guess, clip_ids, normalise_columns, join_loss, region_channels, project_planar, shard_resume, manifest_flat, frame_rates)}

_NAN = "CASE WHEN NOT isnan({0}) THEN {0} END"
ORACLES = {
    "read_tracks_csv": f"SELECT sample_id, {_NAN.format('t_s')} AS t_s, {_NAN.format('x')} AS x, {_NAN.format('y')} AS y, coalesce(valid, false) AS valid FROM gaze_sample",
    "read_tracks_text": "SELECT sample_id, t_s, x, y, sample_id % 2 = 1 AS valid FROM gaze_sample WHERE valid AND t_s >= 0 AND NOT isnan(t_s) AND x IS NOT NULL AND y IS NOT NULL AND NOT isnan(x) AND NOT isnan(y)",
    "read_segments_csv": "SELECT segment_id, round(start_s, 6) AS start_s, round(end_s, 6) AS end_s, concat_ws(' ', CASE WHEN lower(trim(channel)) NOT IN ('', 'none') THEN trim(channel) END, CASE WHEN lower(trim(text)) NOT IN ('', 'none') THEN trim(text) END) AS text FROM segment WHERE kind IS DISTINCT FROM 'point'",
    "table_formats": "SELECT f.format, source, target_share, max_repeats FROM mix_target, (VALUES ('parquet'), ('jsonl'), ('csv')) f(format)",
    "extract_rows": """WITH g AS (SELECT episode_id, arg_min(CAST(round(t_s * 1e6) AS BIGINT), (sample_id, CAST(round(t_s * 1e6) AS BIGINT))) / 1e6 t0 FROM gaze_sample WHERE dataset = 'nymeria' AND t_s IS NOT NULL AND NOT isnan(t_s) GROUP BY 1),
s AS (SELECT DISTINCT segment_id, episode_id, channel, kind, start_s, end_s, text FROM segment WHERE dataset = 'nymeria'), e AS (SELECT DISTINCT episode_id FROM episode WHERE dataset = 'nymeria' AND NOT (episode_id GLOB '*loft*'))
SELECT s.episode_id, segment_id, round(start_s - t0, 5) AS start_s, round(end_s - t0, 5) AS end_s, CASE WHEN lower(trim(coalesce(text, ''))) IN ('', 'none') THEN '' ELSE trim(text) END AS text FROM s JOIN e ON s.episode_id = e.episode_id LEFT JOIN g ON s.episode_id = g.episode_id WHERE kind = 'interval'""",
    "time_guess": """WITH a AS (SELECT DISTINCT asset_id, CAST(size_bytes AS DOUBLE) v, CAST(size_bytes AS DOUBLE) * 100000 b FROM asset WHERE size_bytes IS NOT NULL)
SELECT asset_id, round(CASE WHEN abs(v) > 1e12 THEN v / 1e9 WHEN abs(v) > 1e6 THEN v / 1e3 ELSE v END, 6) AS plain, round(CASE WHEN abs(v) > 1e12 THEN v / 1e9 ELSE v / 1e3 END, 6) AS ms, round(CASE WHEN abs(b) > 1e12 THEN b / 1e9 ELSE b / 1e3 END, 6) AS big_ms, round(v / 1e9, 6) AS ns,
 round(CASE WHEN abs(b) > 1e12 THEN b / 1e9 WHEN abs(b) > 1e6 THEN b / 1e3 ELSE b END, 6) AS big FROM a""",
    "clip_ids": """WITH s AS (SELECT DISTINCT segment_id, episode_id, ord FROM segment), i AS (SELECT *, CASE WHEN segment_id % 3 > 0 THEN concat_ws('-', episode_id, ord * 500, ord * 500 + 400, 'F' || ord * 12, 'F' || (ord * 12 + 9)) ELSE episode_id END id, segment_id % 3 > 0 cut FROM s)
SELECT segment_id, id, CASE WHEN cut THEN ord * 500 / 1000.0 END AS start_s, CASE WHEN cut THEN ord * 12 END AS "first", CASE WHEN cut THEN ord * 12 + 9 END AS "last" FROM i""",
    "normalise_columns": """WITH g AS (SELECT sample_id, round(t_s * 1000) ms, x, y, coalesce(x BETWEEN 0 AND 1 AND y BETWEEN 0 AND 1, false) share FROM gaze_sample WHERE NOT coalesce(isnan(t_s), false) AND t_s IS NOT NULL AND NOT coalesce(isnan(x), false) AND NOT coalesce(isnan(y), false))
SELECT sample_id, round(CASE WHEN abs(ms) > 1e12 THEN ms / 1e9 ELSE ms / 1000 END, 6) AS time_s, CASE WHEN share THEN x END AS x_norm, CASE WHEN share THEN y END AS y_norm, CASE WHEN NOT share THEN x END AS x_px, CASE WHEN NOT share THEN y END AS y_px FROM g""",
    "join_loss": """WITH m AS (SELECT concat_ws(':', source, coalesce(repo, 'none'), file_path) id, source dataset, coalesce(text, '') = '' bad, lang FROM documents), u AS (SELECT *, 0 k, true keep FROM m WHERE lang IN ('markdown', 'rst') UNION ALL SELECT *, 1, coalesce(coalesce(nullif(dataset, ''), CASE WHEN contains(id, ':') THEN split_part(id, ':', 1) ELSE 'unknown' END) IN ('mono-mirror', 'doc-site'), false) FROM m),
w AS (SELECT *, CASE WHEN bad THEN 1 WHEN id = '' THEN 2 WHEN NOT keep THEN 3 ELSE 0 END w FROM u), f AS (SELECT k, count(*) n FROM (SELECT id, min(k) k FROM w WHERE w = 0 GROUP BY 1) GROUP BY 1)
SELECT w.k AS source_ord, count(*) AS "rows", count(*) FILTER (w = 1) AS errors, count(*) FILTER (w = 2) AS without_id, count(*) FILTER (w = 3) AS other_dataset, count(*) FILTER (w = 0) - coalesce(any_value(f.n), 0) AS repeated, coalesce(any_value(f.n), 0) AS kept FROM w LEFT JOIN f ON w.k = f.k GROUP BY 1""",
    "region_channels": """WITH s AS (SELECT DISTINCT dataset, episode_id, segment_id, lower(trim(channel)) channel, CAST(round(start_s * 1000) AS BIGINT) s, CAST(round(end_s * 1000) AS BIGINT) e FROM segment WHERE end_s > start_s AND dataset IS NOT NULL AND episode_id IS NOT NULL),
r AS (SELECT dataset, episode_id, CASE WHEN dataset <> 'egome' THEN channel END channel, s, e FROM s WHERE segment_id % 7 = 0), n AS (SELECT dataset, episode_id, bool_or(channel IS NOT NULL) named FROM r GROUP BY 1, 2)
SELECT dataset, episode_id, segment_id, channel FROM s WHERE EXISTS (SELECT 1 FROM r JOIN n ON r.dataset = n.dataset AND r.episode_id = n.episode_id WHERE r.dataset = s.dataset AND r.episode_id = s.episode_id AND s.s < r.e AND s.e > r.s AND least(s.e, r.e) > greatest(s.s, r.s) AND (NOT n.named OR r.channel = s.channel))""",
    "project_planar": """SELECT g.dataset, g.episode_id, g.sample_id, round(x * (r.width // 2) / r.width, 3) AS px, round(y * (r.height // 2) / r.height, 3) AS py, coalesce(valid, false) AND x * (r.width // 2) / r.width >= 0 AND x * (r.width // 2) / r.width < r.width // 2 AND y * (r.height // 2) / r.height >= 0 AND y * (r.height // 2) / r.height < r.height // 2 AS in_frame
FROM gaze_sample g JOIN recipe r ON g.dataset = r.dataset AND r.coordinate_space = 'pixel_2d' WHERE x IS NOT NULL AND y IS NOT NULL AND NOT isnan(x) AND NOT isnan(y)""",
    "shard_resume": "SELECT DISTINCT dataset, episode_id FROM episode WHERE dataset IS NOT NULL AND episode_id IS NOT NULL AND NOT EXISTS (SELECT 1 FROM segment s WHERE s.dataset = episode.dataset AND s.episode_id = episode.episode_id AND s.end_s > s.start_s)",
    "manifest_flat": "SELECT dataset, episode_id, take_uid, CAST(len(modalities) AS INT) AS n_modalities, width FROM episode",
    "frame_rates": "SELECT s_suppkey, round(CASE WHEN s_nationkey <> 0 THEN s_suppkey * 1000.0 / s_nationkey END, 6) AS fraction, round(s_suppkey * 1000.0, 6) AS number FROM supplier",
}
