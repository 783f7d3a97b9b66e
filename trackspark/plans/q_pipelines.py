"""Queries of whole pipelines: clip rows, canonical tables, region prompts, streams."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trackspark.config import Grid
from trackspark.fixtures import SPAN_SQL, span
from trackspark.operators.grid import usable_samples
from trackspark.operators.periods import ms
from trackspark.plans import classify, clips, rectify, viewer
from trackspark.plans.q_spans import POINT, _ranges, span_export_index, widened
from trackspark.session import shared_folder, table
from trackspark.streaming import operators as S

EP = ["dataset", "episode_id"]


def _clip_rows(spark: SparkSession, d: str) -> DataFrame:
    """Nested training rows of the project's own recordings: segments, samples and episode sizes."""
    seg = table(spark, d, "segment").select(*EP, F.lower(F.trim("channel")).alias("channel"), F.col("segment_id").alias("ord"), (ms(F.col("start_s")) * 1000).alias("s"), (ms(F.col("end_s")) * 1000).alias("e"), (ms(F.col("point_s")) * 1000).alias("p"), "text").distinct()
    seg = widened(seg, 500_000).select(*EP, "channel", "ord", "s", "e", "text")
    s = usable_samples(table(spark, d, "gaze_sample"), ("x", "y")).select(*EP, F.round(F.col("t_s") * 1e6).cast("long").alias("us"), F.col("sample_id").alias("ord"), "x", "y")
    ends = s.groupBy(*EP).agg(F.max("us").alias("last"))
    size = table(spark, d, "recipe").select("dataset", "width", "height")
    spec = clips.ClipSpec(order=("coarse", "activity_summary", "expert", "narration", "fine", "action", "atomic_action", "atomic"), policy="coarse_fine")
    # the coarsest channel of each dataset starts the descent: it takes the first place
    lead = seg.groupBy("dataset", "channel").agg((F.sum(F.col("e") - F.col("s")) / F.count(F.lit(1))).alias("mean")).groupBy("dataset").agg(F.max_by("channel", F.struct("mean", "channel")).alias("lead"))
    seg = seg.join(lead, "dataset").withColumn("channel", F.when(F.col("channel") == F.col("lead"), "coarse").otherwise(F.when(F.col("channel") == "coarse", "fine").otherwise(F.col("channel")))).drop("lead")
    return clips.rows(seg, s, ends.join(size, "dataset"), EP, spec)


def clip_training_rows(spark: SparkSession, d: str) -> DataFrame:
    """Clip rows of all recordings, flattened to one line each."""
    r = _clip_rows(spark, d)
    return r.select("id", "channel", "s", "e", "n", "text", "final_text", F.size("aux").alias("aux"), F.size("points").alias("frames"), "valid_points", F.col("messages")[1]["content"].alias("reply"))


def viewer_frames(spark: SparkSession, d: str) -> DataFrame:
    """Per-frame rows of the clip rows."""
    return viewer.frame_rows(_clip_rows(spark, d))


def viewer_annotations(spark: SparkSession, d: str) -> DataFrame:
    """Role-tagged annotation rows of the clip rows."""
    return viewer.annotation_rows(_clip_rows(spark, d))


def canonical_tables(spark: SparkSession, d: str) -> DataFrame:
    """Canonical grids of all recordings at the default rate: instants, instants with gaze, labelled instants."""
    s = usable_samples(table(spark, d, "gaze_sample"), ("x", "y")).select(*EP, F.col("sample_id").alias("ord"), F.col("t_s").alias("time_s"), F.col("x").alias("x_norm"), F.col("y").alias("y_norm"))
    seg = table(spark, d, "segment").filter("end_s > start_s").select(*EP, F.col("segment_id").alias("ord"), "start_s", "end_s", F.col("channel").alias("label"), "text").distinct()
    t = rectify.rectify(s, seg, None, Grid().hz)
    keys = [*EP, "frame_index"]
    g = t["gaze"].select(*keys, F.col("x_norm").isNotNull().alias("gaze")).join(t["annotations"].select(*keys, (F.col("labels") != "").alias("lab")), keys)
    return g.groupBy(*EP).agg(F.count(F.lit(1)).alias("instants"), F.count_if("gaze").alias("with_gaze"), F.count_if("lab").alias("labelled"))


def region_prompts(spark: SparkSession, d: str) -> DataFrame:
    """Spans of each track as numbered prompts of 60."""
    w = widened(span(spark, d), POINT).select("ep", "ord", (F.col("s") / 1e6).alias("start_s"), (F.col("e") / 1e6).alias("end_s"), "text")
    s = span_export_index(spark, d).join(w, ["ep", "ord"])
    p = classify.prompts(s, ["ep"], "Mark the spans in which something is done with the hands.")
    return p.select("ep", "chunk", (F.length("prompt") - F.length(F.replace("prompt", F.lit("\n"), F.lit("")))).cast("long").alias("spans"))


def region_verdicts(spark: SparkSession, d: str) -> DataFrame:
    """Answers, some of them cut off, parsed and joined to their spans; what is missing counts as dull."""
    m = _ranges(spark, d).select("ep", "ord", F.col("interesting").alias("mark"), (F.col("s") / 1e6).alias("start_s"), (F.col("e") / 1e6).alias("end_s"))
    s = span_export_index(spark, d).join(m, ["ep", "ord"])
    item = F.struct("i", F.col("mark").alias("interesting"), F.lit("seen").alias("reason"))
    a = s.groupBy("ep").agg(F.to_json(F.sort_array(F.collect_list(item))).alias("answer"))
    cut = F.when(F.col("ep") % 2 == 0, F.concat(F.lit("Here: "), F.col("answer"))).otherwise(F.expr("left(answer, length(answer) - 3)"))
    r = classify.region_map(s, classify.verdicts(a.withColumn("answer", cut), ["ep"]), ["ep"])
    return r.groupBy("ep").agg(F.count(F.lit(1)).alias("spans"), F.count_if("interesting").alias("interesting"), F.count_if(F.col("reason") == "unlabeled").alias("unlabeled"))


def _folder(spark: SparkSession) -> str:
    return f"{shared_folder(spark).rstrip('/')}/streams/{uuid.uuid4().hex}"


def _stream(spark: SparkSession, d: str, name: str) -> DataFrame:
    return spark.readStream.schema(table(spark, d, name).schema).parquet(f"{d}/{name}*.parquet")


def stream_hourly_counts(spark: SparkSession, d: str) -> DataFrame:
    """Events per day and type, counted by a stream."""
    at = _folder(spark)
    e = _stream(spark, d, "events").withColumn("ts", F.col("ts").cast("timestamp"))
    w = S.windowed_counts(e, "ts", ["event_type"], "1 day")
    out = S.run_once(w, f"{at}/out", f"{at}/state", "complete")
    return out.select(F.date_format("start", "yyyy-MM-dd").alias("day"), "event_type", "n")


def stream_first_ids(spark: SparkSession, d: str) -> DataFrame:
    """Asset ids as a stream sees them first, each once."""
    at = _folder(spark)
    s = S.first_by_id(_stream(spark, d, "asset").select("asset_id", "dataset", "asset_key"), "asset_id")
    return S.run_once(s, f"{at}/out", f"{at}/state")


_Q = "clip_training_rows viewer_frames viewer_annotations canonical_tables region_prompts region_verdicts stream_hourly_counts stream_first_ids".split()
QUERIES = {n: globals()[n] for n in _Q}

ORACLES = {
    "region_prompts": f"WITH {SPAN_SQL}, i AS (SELECT ep, row_number() OVER (PARTITION BY ep ORDER BY ord) - 1 i FROM span) SELECT ep, i // 60 AS chunk, count(*) AS spans FROM i GROUP BY 1, 2",
    "region_verdicts": f"""WITH {SPAN_SQL}, i AS (SELECT *, row_number() OVER (PARTITION BY ep ORDER BY CASE channel WHEN 'coarse' THEN 0 WHEN 'mid' THEN 1 WHEN 'fine' THEN 2 ELSE 3 END, ord) k FROM span WHERE kind = 'interval'),
m AS (SELECT ep, interesting AND NOT (ep % 2 = 1 AND k = max(k) OVER (PARTITION BY ep)) seen, ep % 2 = 1 AND k = max(k) OVER (PARTITION BY ep) lost FROM i) SELECT ep, count(*) AS spans, count(*) FILTER (seen) AS interesting, count(*) FILTER (lost) AS unlabeled FROM m GROUP BY 1""",
    "stream_hourly_counts": "SELECT strftime(ts, '%Y-%m-%d') AS day, event_type, count(*) AS n FROM events GROUP BY 1, 2",
    "stream_first_ids": "SELECT DISTINCT asset_id, dataset, asset_key FROM asset",
    "canonical_tables": """WITH l AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY sample_id ORDER BY arrived_at DESC NULLS LAST) rn FROM gaze_sample) WHERE rn = 1), u AS (SELECT dataset, episode_id, t_s t FROM l WHERE valid AND t_s >= 0 AND NOT isnan(t_s) AND NOT isinf(t_s) AND x IS NOT NULL AND NOT isnan(x) AND y IS NOT NULL AND NOT isnan(y)),
s AS (SELECT DISTINCT dataset, episode_id, segment_id, start_s, end_s, channel FROM segment WHERE end_s > start_s), d AS (SELECT dataset, episode_id, max(t) dur FROM (SELECT * FROM u UNION ALL SELECT dataset, episode_id, end_s FROM s) GROUP BY 1, 2),
k AS (SELECT dataset, episode_id, unnest(generate_series(0, CAST(floor((dur + 1e-9) * 10) AS BIGINT))) k, CAST(floor((dur + 1e-9) * 10) AS BIGINT) m FROM d), g AS (SELECT dataset, episode_id, round(k / 10.0, 9) i, round(m / 10.0, 9) n FROM k), r AS (SELECT dataset, episode_id, min(t) lo, max(t) hi FROM u GROUP BY 1, 2)
SELECT g.dataset, g.episode_id, count(*) AS instants, count(*) FILTER (r.lo <= g.i AND g.i <= r.hi) AS with_gaze, count(*) FILTER (EXISTS (SELECT 1 FROM s WHERE s.dataset = g.dataset AND s.episode_id = g.episode_id AND s.start_s <= g.i AND (g.i < s.end_s OR (g.i = g.n AND g.i <= s.end_s)) AND s.channel <> '')) AS labelled FROM g LEFT JOIN r ON g.dataset = r.dataset AND g.episode_id = r.episode_id GROUP BY 1, 2""",
}
