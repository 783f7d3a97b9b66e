"""Queries on tracks: resampling, nearest neighbours, statistics, sampling."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trackspark.fixtures import SPAN_SQL, TRACK_SQL, span, track
from trackspark.operators import asof
from trackspark.operators.grid import usable_samples
from trackspark.operators.sequence import thin
from trackspark.operators.sharded import lag_over, number_over
from trackspark.session import table

DAY = 86_400
HOUR_US = 3_600_000_000


def _valid(spark: SparkSession, d: str) -> DataFrame:
    return track(spark, d).filter("valid")


def _grid(spark: SparkSession, d: str) -> DataFrame:
    """Hourly frames up to the last reading of each track."""
    last = track(spark, d).groupBy("ep").agg(F.max("us").alias("last"))
    g = asof.grid(last, ["ep"], 1, HOUR_US, "last")
    return g.select("ep", "frame_index", (F.col("frame_index") * HOUR_US).alias("us"))


def resample_grid(spark: SparkSession, d: str) -> DataFrame:
    """Valid readings on an hourly grid, interpolated where neighbours are at most 6 h apart."""
    f = asof.bracket(_grid(spark, d), _valid(spark, d), ["ep"], "us", ["x", "y"], DAY * 1_000_000)
    gap = 6 * HOUR_US
    x, y = asof.lerp("x", "us", gap), asof.lerp("y", "us", gap)
    return f.select("ep", "frame_index", F.round(x, 6).alias("x"), F.round(y, 6).alias("y"), x.isNotNull().alias("valid"))


def rectify_interp(spark: SparkSession, d: str) -> DataFrame:
    """All readings on an hourly grid, interpolated over any gap, nothing beyond the ends."""
    f = asof.bracket(_grid(spark, d), track(spark, d), ["ep"], "us", ["x", "y"], DAY * 1_000_000)
    return f.select("ep", "frame_index", F.round(asof.lerp("x", "us"), 6).alias("x"), F.round(asof.lerp("y", "us"), 6).alias("y"))


def _purchases(spark: SparkSession, d: str) -> DataFrame:
    return span(spark, d).filter("kind = 'point'").select("ep", F.col("ord").alias("probe"), F.col("p").alias("us"))


def asof_nearest(spark: SparkSession, d: str) -> DataFrame:
    """Each point event with the nearest other valid reading of its track, however far."""
    readings = span(spark, d).filter("channel = 'fine'").select("ep", "ord", F.col("s").alias("us"), "text")
    f = asof.bracket(_purchases(spark, d), readings, ["ep"], "us", ["text"], DAY * 1_000_000)
    n = asof.nearest(f, "us")
    return f.select("ep", "probe", n["ord"].alias("ord"), (n["t"] - F.col("us")).alias("dt"))


def asof_nearest_tolerance_valid(spark: SparkSession, d: str) -> DataFrame:
    """Grid frames with the nearest valid reading within 30 minutes; invalid ones are never chosen."""
    f = asof.bracket(_grid(spark, d), _valid(spark, d), ["ep"], "us", ["x"], DAY * 1_000_000)
    n = asof.nearest(f, "us")
    near = F.abs(n["t"] - F.col("us")) <= HOUR_US // 2
    return f.select("ep", "frame_index", F.when(near, n["ord"]).alias("ord"), F.when(near, n["x"]).alias("x"))


def asof_default_first(spark: SparkSession, d: str) -> DataFrame:
    """Each point event with the nearest coarse span's text; without any, the first of the table."""
    coarse = span(spark, d).filter("channel = 'coarse'").select("ep", "ord", F.col("s").alias("us"), "text")
    first = coarse.agg(F.min_by("text", "ord").alias("first_text")).first()[0]
    f = asof.bracket(_purchases(spark, d), coarse, ["ep"], "us", ["text"], DAY * 1_000_000)
    return f.select("ep", "probe", F.coalesce(asof.nearest(f, "us")["text"], F.lit(first)).alias("text"))


def max_valid_gap(spark: SparkSession, d: str) -> DataFrame:
    """Longest time between neighbouring valid readings, and whether it exceeds 12 hours."""
    v = lag_over(_valid(spark, d), ["ep"], "us", "ord", F.col("us"), "before", DAY * 1_000_000)
    g = v.groupBy("ep").agg(F.coalesce(F.max(F.col("us") - F.col("before")), F.lit(0)).alias("gap_us"))
    return g.withColumn("exceeded", F.col("gap_us") > 12 * HOUR_US)


def estimate_frequency(spark: SparkSession, d: str) -> DataFrame:
    """Readings per second from the upper median of the steps between distinct times."""
    t = track(spark, d).groupBy("ep", "us").agg(F.min("ord").alias("ord"))
    step = lag_over(t, ["ep"], "us", "ord", F.col("us"), "before", DAY * 1_000_000).select("ep", (F.col("us") - F.col("before")).alias("step")).filter("step > 0")
    # the upper median by rank; ranks come from sharded numbering over the steps
    ranked = number_over(step.withColumn("tie", F.lit(0)), ["ep"], "step", "tie", "rank", DAY * 1_000_000)
    n = step.groupBy("ep").agg(F.count(F.lit(1)).alias("n"))
    mid = ranked.join(n, "ep").filter(F.col("rank") == F.floor(F.col("n") / 2))
    return mid.select("ep", "n", F.col("step").alias("median_us"), F.round(F.lit(1e6) / F.col("step"), 9).alias("hz"))


def track_stats(spark: SparkSession, d: str) -> DataFrame:
    """Of each track: readings, duration, rate n / duration, share of valid ones."""
    g = track(spark, d).groupBy("ep").agg(F.count(F.lit(1)).alias("n"), (F.max("us") - F.min("us")).alias("duration_us"), F.count_if("valid").alias("valid_n"))
    hz = F.when(F.col("duration_us") > 0, F.col("n") * 1e6 / F.col("duration_us"))
    return g.select("ep", "n", "duration_us", F.round(hz, 9).alias("hz"), F.round(F.col("valid_n") / F.col("n"), 6).alias("valid_fraction"))


def first_gaze_rebase(spark: SparkSession, d: str) -> DataFrame:
    """Times relative to the first reading in file order (not the smallest time)."""
    t = track(spark, d)
    first = t.groupBy("ep").agg(F.min_by("us", "ord").alias("t0"))
    return t.join(first, "ep").select("ep", "ord", (F.col("us") - F.col("t0")).alias("rel_us"))


def time_thinning(spark: SparkSession, d: str) -> DataFrame:
    """Readings at least 6 h behind the last kept one."""
    return thin(_valid(spark, d).select("ep", "us", "ord", "x"), ["ep"], "us", "ord", 6 * HOUR_US, DAY * 1_000_000).select("ep", "us", "ord", "x")


def thin_every_k(spark: SparkSession, d: str) -> DataFrame:
    """Every 7th reading of each track by time."""
    return number_over(track(spark, d), ["ep"], "us", "ord", "i", DAY * 1_000_000).filter("i % 7 = 0").select("ep", "ord", "i")


def even_indices(spark: SparkSession, d: str) -> DataFrame:
    """Five evenly spaced readings of each track (all, if it has fewer)."""
    k = 5
    n = track(spark, d).groupBy("ep").agg(F.count(F.lit(1)).alias("n"))
    want = F.when(F.col("n") <= k, F.sequence(F.lit(0).cast("long"), F.col("n") - 1)).otherwise(F.transform(F.sequence(F.lit(0), F.lit(k - 1)), lambda i: F.rint(i * (F.col("n") - 1) / (k - 1)).cast("long")))
    picks = n.select("ep", F.explode(want).alias("i")).distinct()
    return number_over(track(spark, d), ["ep"], "us", "ord", "i", DAY * 1_000_000).join(picks, ["ep", "i"]).select("ep", "i", "ord")


def fingerprint_samples(spark: SparkSession, d: str) -> DataFrame:
    """First, middle and last reading of each track, with its number of rows and time range."""
    t = number_over(track(spark, d), ["ep"], "us", "ord", "i", DAY * 1_000_000)
    n = track(spark, d).groupBy("ep").agg(F.count(F.lit(1)).alias("n"), F.min("us").alias("min_us"), F.max("us").alias("max_us"))
    return t.join(n, "ep").filter("i = 0 OR i = n div 2 OR i = n - 1").select("ep", "i", "ord", "n", "min_us", "max_us")


def _sliding(shift: int):
    def run(spark: SparkSession, d: str) -> DataFrame:
        n, stride = 16, 8
        last = track(spark, d).groupBy("ep").agg(F.floor(F.max("us") / HOUR_US).cast("long").alias("last"))
        a = last.withColumn("anchor", F.explode(F.sequence(F.lit(0).cast("long"), F.col("last"), F.lit(stride).cast("long"))))
        a = a.withColumn("first", F.col("anchor") - shift).filter(F.col("first") >= 0).filter(F.col("first") + (n - 1) <= F.col("last"))
        frames = F.sequence(F.col("first"), F.col("first") + (n - 1))
        return a.select("ep", "anchor", F.col("first").alias("first_frame"), F.element_at(frames, -1).alias("last_frame"), F.size(frames).cast("long").alias("frames"))

    return run


sliding_frames_causal = _sliding(15)
sliding_frames_centered = _sliding(8)
sliding_frames_future = _sliding(0)


def step_distances(spark: SparkSession, d: str) -> DataFrame:
    """Of each track: largest and mean distance between neighbouring readings, share inside a frame."""
    v = lag_over(track(spark, d), ["ep"], "us", "ord", F.struct("x", "y"), "b", DAY * 1_000_000)
    v = v.withColumn("step", F.round(F.hypot(F.col("x") - F.col("b.x"), F.col("y") - F.col("b.y")), 6))
    inside = (F.col("x") >= 0) & (F.col("x") < 60) & (F.col("y") >= 0) & (F.col("y") < 80)
    return v.groupBy("ep").agg(F.max("step").alias("max_step"), F.round(F.sum(F.col("step").cast("decimal(20,6)")).cast("double") / F.count("step"), 5).alias("mean_step"), F.round(F.count_if(inside) / F.count(F.lit(1)), 6).alias("in_frame"))


def even_median_row(spark: SparkSession, d: str) -> DataFrame:
    """The reading at position n div 2 of each track: its representative."""
    t = number_over(_valid(spark, d), ["ep"], "us", "ord", "i", DAY * 1_000_000)
    n = _valid(spark, d).groupBy("ep").agg(F.count(F.lit(1)).alias("n"))
    return t.join(n, "ep").filter("i = n div 2").select("ep", "ord", "us")


def sample_track_episodes(spark: SparkSession, d: str) -> DataFrame:
    """Of each recording: usable samples, covered seconds, the longest pause and whether it is too long."""
    s = usable_samples(table(spark, d, "gaze_sample"))
    keys = ["dataset", "episode_id"]
    s = s.withColumn("us", F.round(F.col("t_s") * 1e6).cast("long"))
    lag = lag_over(s, keys, "us", "sample_id", F.col("us"), "before", 600 * 1_000_000)
    g = lag.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"), F.min("us").alias("first_us"), F.max("us").alias("last_us"), F.coalesce(F.max(F.col("us") - F.col("before")), F.lit(0)).alias("gap_us"))
    limit = table(spark, d, "recipe").select("dataset", F.round(F.col("max_gaze_valid_gap_s") * 1e6).cast("long").alias("limit_us"))
    return g.join(limit, "dataset").select(*keys, "n", "first_us", "last_us", "gap_us", F.coalesce(F.col("gap_us") > F.col("limit_us"), F.lit(False)).alias("too_long"))


_Q = """resample_grid rectify_interp asof_nearest asof_nearest_tolerance_valid asof_default_first max_valid_gap estimate_frequency track_stats first_gaze_rebase time_thinning
thin_every_k even_indices fingerprint_samples sliding_frames_causal sliding_frames_centered sliding_frames_future step_distances even_median_row sample_track_episodes""".split()
QUERIES = {n: globals()[n] for n in _Q}

_GRID = f"g AS (SELECT ep, unnest(generate_series(0, max(us) // {HOUR_US})) frame_index FROM track GROUP BY ep), gp AS (SELECT ep, frame_index, frame_index * {HOUR_US} us FROM g)"


def _lerp_sql(rows: str, gap: str) -> str:
    near = "SELECT ep, us, arg_min(x, ord) x, arg_min(y, ord) y FROM {} GROUP BY ep, us".format(rows)
    v = lambda c: f"round(CASE WHEN a.us = p.us THEN a.{c} WHEN b.us - a.us {gap} THEN a.{c} + (b.{c} - a.{c}) * (CAST(p.us - a.us AS DOUBLE) / (b.us - a.us)) END, 6)"
    return f"WITH {TRACK_SQL}, {_GRID}, r AS ({near}), j AS (SELECT p.ep, p.frame_index, {v('x')} AS x, {v('y')} AS y FROM gp p ASOF LEFT JOIN r a ON p.ep = a.ep AND p.us >= a.us ASOF LEFT JOIN r b ON p.ep = b.ep AND p.us < b.us)"


def _near_sql(probes: str, readings: str) -> str:
    return f"""p AS ({probes}), r AS (SELECT ep, us, min(ord) ord, arg_min(v, ord) v FROM ({readings}) GROUP BY ep, us),
n AS (SELECT p.*, CASE WHEN a.us IS NULL OR b.us - p.us < p.us - a.us THEN b.ord ELSE a.ord END ord, CASE WHEN a.us IS NULL OR b.us - p.us < p.us - a.us THEN b.us ELSE a.us END rus,
 CASE WHEN a.us IS NULL OR b.us - p.us < p.us - a.us THEN b.v ELSE a.v END v FROM p ASOF LEFT JOIN r a ON p.ep = a.ep AND p.us >= a.us ASOF LEFT JOIN r b ON p.ep = b.ep AND p.us < b.us)"""


_PUR = "SELECT ep, ord probe, p us FROM span WHERE kind = 'point'"
_NUM = "SELECT *, row_number() OVER (PARTITION BY ep ORDER BY us, ord) - 1 i, count(*) OVER (PARTITION BY ep) n FROM track"


def _slide_sql(shift: int) -> str:
    return f"""WITH {TRACK_SQL}, l AS (SELECT ep, max(us) // {HOUR_US} AS last FROM track GROUP BY ep), a AS (SELECT ep, last, unnest(generate_series(0, last, 8)) anchor FROM l)
SELECT ep, anchor, anchor - {shift} AS first_frame, anchor - {shift} + 15 AS last_frame, CAST(16 AS BIGINT) AS frames FROM a WHERE anchor - {shift} >= 0 AND anchor - {shift} + 15 <= last"""


ORACLES = {
    "resample_grid": _lerp_sql("(SELECT * FROM track WHERE valid)", f"<= {6 * HOUR_US}") + " SELECT *, x IS NOT NULL AS valid FROM j",
    "rectify_interp": _lerp_sql("track", "> 0") + " SELECT * FROM j",
    "asof_nearest": f"WITH {SPAN_SQL}, {_near_sql(_PUR, 'SELECT ep, ord, s us, text v FROM span WHERE channel = ' + repr('fine'))} SELECT ep, probe, ord, rus - us AS dt FROM n",
    "asof_nearest_tolerance_valid": f"WITH {TRACK_SQL}, {_GRID}, {_near_sql('SELECT * FROM gp', 'SELECT ep, ord, us, x v FROM track WHERE valid')} SELECT ep, frame_index, CASE WHEN abs(rus - us) <= {HOUR_US // 2} THEN ord END AS ord, CASE WHEN abs(rus - us) <= {HOUR_US // 2} THEN v END AS x FROM n",
    "asof_default_first": f"WITH {SPAN_SQL}, {_near_sql(_PUR, 'SELECT ep, ord, s us, text v FROM span WHERE channel = ' + repr('coarse'))} SELECT ep, probe, coalesce(v, (SELECT arg_min(text, ord) FROM span WHERE channel = 'coarse')) AS text FROM n",
    "max_valid_gap": f"WITH {TRACK_SQL}, l AS (SELECT ep, us - lag(us) OVER (PARTITION BY ep ORDER BY us, ord) g FROM track WHERE valid) SELECT ep, coalesce(max(g), 0) AS gap_us, coalesce(max(g), 0) > {12 * HOUR_US} AS exceeded FROM l GROUP BY ep",
    "estimate_frequency": f"WITH {TRACK_SQL}, l AS (SELECT ep, us - lag(us) OVER (PARTITION BY ep ORDER BY us) g FROM (SELECT DISTINCT ep, us FROM track)), m AS (SELECT ep, list_sort(list(g)) s, count(*) n FROM l WHERE g > 0 GROUP BY ep) SELECT ep, n, s[n // 2 + 1] AS median_us, round(1e6 / s[n // 2 + 1], 9) AS hz FROM m",
    "track_stats": f"WITH {TRACK_SQL} SELECT ep, count(*) AS n, max(us) - min(us) AS duration_us, round(CASE WHEN max(us) > min(us) THEN count(*) * 1e6 / (max(us) - min(us)) END, 9) AS hz, round(count(*) FILTER (valid) / count(*), 6) AS valid_fraction FROM track GROUP BY ep",
    "first_gaze_rebase": f"WITH {TRACK_SQL} SELECT ep, ord, us - arg_min(us, ord) OVER (PARTITION BY ep) AS rel_us FROM track",
    "time_thinning": f"""WITH RECURSIVE {TRACK_SQL}, v AS (SELECT ep, us, ord, x, row_number() OVER (PARTITION BY ep ORDER BY us, ord) rn FROM track WHERE valid),
k(ep, rn, us, ord, x, kept, hit) AS (SELECT ep, rn, us, ord, x, us, true FROM v WHERE rn = 1 UNION ALL SELECT v.ep, v.rn, v.us, v.ord, v.x, CASE WHEN v.us - k.kept >= {6 * HOUR_US} THEN v.us ELSE k.kept END, v.us - k.kept >= {6 * HOUR_US} FROM k JOIN v ON v.ep = k.ep AND v.rn = k.rn + 1)
SELECT ep, us, ord, x FROM k WHERE hit""",
    "thin_every_k": f"WITH {TRACK_SQL}, r AS ({_NUM}) SELECT ep, ord, i FROM r WHERE i % 7 = 0",
    "even_indices": f"WITH {TRACK_SQL}, r AS ({_NUM}), w AS (SELECT DISTINCT ep, unnest(CASE WHEN n <= 5 THEN generate_series(0, n - 1) ELSE list_transform([0, 1, 2, 3, 4], lambda q: CAST(round_even(q * (n - 1) / 4, 0) AS BIGINT)) END) i FROM (SELECT DISTINCT ep, n FROM r)) SELECT r.ep, r.i, r.ord FROM r JOIN w ON r.ep = w.ep AND r.i = w.i",
    "fingerprint_samples": f"WITH {TRACK_SQL}, r AS ({_NUM}), m AS (SELECT ep, min(us) min_us, max(us) max_us FROM track GROUP BY ep) SELECT r.ep, r.i, r.ord, r.n, m.min_us, m.max_us FROM r JOIN m ON r.ep = m.ep WHERE i = 0 OR i = n // 2 OR i = n - 1",
    "sliding_frames_causal": _slide_sql(15),
    "sliding_frames_centered": _slide_sql(8),
    "sliding_frames_future": _slide_sql(0),
    "step_distances": f"""WITH {TRACK_SQL}, l AS (SELECT ep, x, y, round(sqrt((x - lag(x) OVER w) * (x - lag(x) OVER w) + (y - lag(y) OVER w) * (y - lag(y) OVER w)), 6) s FROM track WINDOW w AS (PARTITION BY ep ORDER BY us, ord))
SELECT ep, max(s) AS max_step, round(CAST(sum(CAST(s AS DECIMAL(20, 6))) AS DOUBLE) / count(s), 5) AS mean_step, round(count(*) FILTER (x >= 0 AND x < 60 AND y >= 0 AND y < 80) / count(*), 6) AS in_frame FROM l GROUP BY ep""",
    "even_median_row": f"WITH {TRACK_SQL}, r AS (SELECT *, row_number() OVER (PARTITION BY ep ORDER BY us, ord) - 1 i, count(*) OVER (PARTITION BY ep) n FROM track WHERE valid) SELECT ep, ord, us FROM r WHERE i = n // 2",
    "sample_track_episodes": """WITH latest AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY sample_id ORDER BY arrived_at DESC NULLS LAST) rn FROM gaze_sample) WHERE rn = 1),
u AS (SELECT dataset, episode_id, sample_id, CAST(round(t_s * 1e6) AS BIGINT) us FROM latest WHERE valid AND t_s >= 0 AND NOT isnan(t_s) AND NOT isinf(t_s) AND x IS NOT NULL AND NOT isnan(x) AND y IS NOT NULL AND NOT isnan(y)),
l AS (SELECT *, us - lag(us) OVER (PARTITION BY dataset, episode_id ORDER BY us, sample_id) g FROM u)
SELECT l.dataset, l.episode_id, count(*) AS n, min(us) AS first_us, max(us) AS last_us, coalesce(max(g), 0) AS gap_us, coalesce(coalesce(max(g), 0) > CAST(round(any_value(r.max_gaze_valid_gap_s) * 1e6) AS BIGINT), false) AS too_long FROM l JOIN recipe r ON l.dataset = r.dataset GROUP BY 1, 2""",
}
