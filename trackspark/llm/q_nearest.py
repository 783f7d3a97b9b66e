"""p2: each usable sample with the head pose nearest in time."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trackspark.llm.nearest import nearest
from trackspark.operators.grid import usable_samples
from trackspark.session import table

SOURCE = ["dataset", "episode_id"]


def _tolerance(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "recipe").filter("pose_tol_s IS NOT NULL").select("dataset", F.col("pose_tol_s").alias("tol"))


def _matched(spark: SparkSession, d: str) -> DataFrame:
    tol = _tolerance(spark, d)
    probes = usable_samples(table(spark, d, "gaze_sample")).join(tol, "dataset").select(*SOURCE, F.col("sample_id").alias("probe_id"), F.col("t_s").alias("t"), "tol")
    good = F.col("tracked") & F.col("t_s").isNotNull() & ~F.isnan("t_s") & (F.abs("t_s") < F.lit(float("inf"))) & (F.size("m") == 16)
    poses = table(spark, d, "pose").filter(good).join(tol, "dataset").select(*SOURCE, F.col("pose_id").alias("cand_id"), F.col("t_s").alias("t"), "tol")
    return nearest(probes, poses, SOURCE)


def p2_found(spark: SparkSession, d: str) -> DataFrame:
    """Usable samples that have an eligible pose within the tolerance, with the nearest one."""
    return _matched(spark, d).filter("match_id IS NOT NULL").select(F.col("probe_id").alias("sample_id"), F.col("match_id").alias("pose_id"))


def p2_offsets(spark: SparkSession, d: str) -> DataFrame:
    """Every usable sample of datasets with poses: the pose or null, and how far it is in time."""
    return _matched(spark, d).select(F.col("probe_id").alias("sample_id"), F.col("match_id").alias("pose_id"), F.round("dt", 6).alias("dt_s"))


QUERIES = {"p2_found": p2_found, "p2_offsets": p2_offsets}

_NEAR = """WITH latest AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY sample_id ORDER BY arrived_at DESC NULLS LAST) rn FROM gaze_sample) WHERE rn = 1),
s AS (SELECT l.sample_id, l.dataset, l.episode_id, l.t_s, r.pose_tol_s tol FROM latest l JOIN recipe r ON l.dataset = r.dataset WHERE r.pose_tol_s IS NOT NULL AND l.valid AND l.t_s >= 0 AND NOT isnan(l.t_s)
 AND NOT isinf(l.t_s) AND l.x IS NOT NULL AND NOT isnan(l.x) AND l.y IS NOT NULL AND NOT isnan(l.y)),
p AS (SELECT DISTINCT pose_id, dataset, episode_id, t_s FROM pose WHERE tracked AND t_s IS NOT NULL AND NOT isnan(t_s) AND len(m) = 16),
n AS (SELECT s.sample_id, arg_min(p.pose_id, abs(s.t_s - p.t_s)) pose_id, arg_min(p.t_s - s.t_s, abs(s.t_s - p.t_s)) dt FROM s JOIN p ON s.dataset = p.dataset AND s.episode_id = p.episode_id AND p.t_s BETWEEN s.t_s - tol - 1e-9 AND s.t_s + tol + 1e-9 WHERE abs(s.t_s - p.t_s) <= tol GROUP BY 1)"""
ORACLES = {
    "p2_found": f"{_NEAR} SELECT sample_id, pose_id FROM n",
    "p2_offsets": f"{_NEAR} SELECT s.sample_id, n.pose_id, round(n.dt, 6) AS dt_s FROM s LEFT JOIN n ON s.sample_id = n.sample_id",
}
