"""Queries on spans: interval joins, coverage, cutting and packing, clip rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from trackspark.fixtures import SPAN_SQL, TRACK_SQL, span, track
from trackspark.functions import text as T
from trackspark.operators import asof, intervals, sequence
from trackspark.operators.periods import ms, periods
from trackspark.operators.sharded import lag_over, number_over
from trackspark.plans.q_tracks import ORACLES as TRACK_ORACLES
from trackspark.plans.q_tracks import resample_grid, sliding_frames_causal
from trackspark.session import table

DAY = 86_400_000_000
HOUR = 3_600_000_000
MIN = 60_000_000
WIDTH = 4 * HOUR
#: A point covers this much on both sides where it needs a length.
POINT = 2 * MIN


def _ranges(spark: SparkSession, d: str) -> DataFrame:
    return span(spark, d).filter("kind = 'interval'").select("ep", "channel", "ord", "s", "e", "text", "interesting")


def widened(s: DataFrame, w: int) -> DataFrame:
    """Spans with text and a length: an interval as it is, a point widened, an open start given 2w."""
    ok = F.col("s").isNotNull() & F.col("e").isNotNull() & (F.col("e") > F.col("s"))
    lo = F.when(ok, F.col("s")).when(F.col("p").isNotNull(), F.col("p") - w).when(F.col("s").isNotNull(), F.col("s"))
    hi = F.when(ok, F.col("e")).when(F.col("p").isNotNull(), F.col("p") + w).when(F.col("s").isNotNull(), F.col("s") + 2 * w)
    blank = F.coalesce(F.regexp_replace("text", r"^\s+|\s+$", ""), F.lit("")) == ""
    return s.filter(~blank).withColumn("lo", lo).withColumn("hi", hi).filter("hi > lo").withColumn("s", F.col("lo")).withColumn("e", F.col("hi")).drop("lo", "hi")


def _frames(spark: SparkSession, d: str) -> DataFrame:
    last = track(spark, d).groupBy("ep").agg(F.max("us").alias("last"))
    return asof.grid(last, ["ep"], 1, HOUR, "last").select("ep", "frame_index", (F.col("frame_index") * HOUR).alias("us"))


def interval_stab_halfopen_join_labels(spark: SparkSession, d: str) -> DataFrame:
    """Hourly frames with the labels of the spans that hold them, in file order, joined by "|"."""
    frames = _frames(spark, d)
    hit = intervals.stab(frames, _ranges(spark, d).select("ep", "ord", "s", "e", "text"), ["ep"], "us", WIDTH)
    lab = hit.groupBy("ep", "frame_index").agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("ord", "text"))), lambda x: x["text"]), "|").alias("labels"))
    return frames.join(lab, ["ep", "frame_index"], "left").select("ep", "frame_index", F.coalesce("labels", F.lit("")).alias("labels"))


def interval_stab_closed(spark: SparkSession, d: str) -> DataFrame:
    """Readings inside mid spans, both ends included."""
    t = track(spark, d).select("ep", F.col("ord").alias("reading"), "us")
    hit = intervals.stab(t, _ranges(spark, d).filter("channel = 'mid'").select("ep", "ord", "s", "e"), ["ep"], "us", WIDTH, "[]")
    return hit.select("ep", "reading", F.col("ord").alias("span"))


def point_nearest_tol(spark: SparkSession, d: str) -> DataFrame:
    """Hourly frames with the nearest point mark within 20 minutes."""
    marks = span(spark, d).filter("kind = 'point'").select("ep", "ord", F.col("p").alias("us"), "text")
    f = asof.bracket(_frames(spark, d), marks, ["ep"], "us", ["text"], DAY)
    n = asof.nearest(f, "us")
    return f.filter(F.abs(n["t"] - F.col("us")) <= 20 * MIN).select("ep", "frame_index", n["ord"].alias("ord"), n["text"].alias("text"))


def active_in_order(spark: SparkSession, d: str) -> DataFrame:
    """Readings with all spans active at them, intervals before points, then by start."""
    t = track(spark, d).select("ep", F.col("ord").alias("reading"), "us")
    w = widened(span(spark, d), POINT).select("ep", "channel", "kind", "ord", "s", "e")
    hit = intervals.stab(t, w, ["ep"], "us", WIDTH, "[]")
    return hit.groupBy("ep", "reading").agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct((F.col("kind") != "interval").alias("k"), "s", "ord", "channel"))), lambda x: x["channel"]), ",").alias("active"))


def _clips(spark: SparkSession, d: str) -> DataFrame:
    """Packed fine spans: clips of at most an hour, gaps of at most 30 minutes."""
    fine = widened(span(spark, d), POINT).filter("channel IN ('fine', 'mark')").select("ep", F.lit("fine").alias("channel"), "ord", "s", "e", "text")
    return sequence.coalesce(fine, ["ep"], HOUR, 30 * MIN, 10 * MIN, DAY)


def overlap_attach(spark: SparkSession, d: str) -> DataFrame:
    """Clips with the spans of other channels that overlap them by half of the span or fill the clip."""
    clips = _ranges(spark, d).filter("channel = 'fine'").select("ep", F.col("ord").alias("clip"), F.col("s").alias("a_s"), F.col("e").alias("a_e"), F.col("channel").alias("a_channel"), F.col("text").alias("a_text"))
    aux = widened(span(spark, d), POINT).select("ep", F.col("ord").alias("aux"), F.col("channel").alias("channel"), F.col("text").alias("text"), F.col("s").alias("b_s"), F.col("e").alias("b_e"))
    o = intervals.overlaps(clips, aux, ["ep"], WIDTH)
    ov = F.least("a_e", "b_e") - F.greatest("a_s", "b_s")
    o = o.withColumn("overlap", ov).withColumn("len", F.col("b_e") - F.col("b_s")).withColumn("clip_len", F.col("a_e") - F.col("a_s"))
    o = o.filter(~((F.col("overlap") * 2 < F.col("len")) & (F.col("overlap") < F.col("clip_len"))))
    o = o.filter(~((F.col("channel") == F.col("a_channel")) & F.col("a_text").contains(F.col("text"))))
    return o.select("ep", "clip", "aux", "channel", F.greatest(F.lit(0), F.col("b_s") - F.col("a_s")).alias("rel_start"), F.least("clip_len", F.col("b_e") - F.col("a_s")).alias("rel_end"), "overlap", F.col("len").alias("source_len"))


def final_annotation(spark: SparkSession, d: str) -> DataFrame:
    """Text of each fine clip, framed by the coarse span that overlaps it longest."""
    clips = _ranges(spark, d).filter("channel = 'fine'").select("ep", F.col("ord").alias("clip"), "channel", "text", F.col("s").alias("a_s"), F.col("e").alias("a_e"))
    coarse = _ranges(spark, d).filter("channel = 'coarse'").select("ep", F.col("ord").alias("b_ord"), F.col("text").alias("b_text"), F.col("s").alias("b_s"), F.col("e").alias("b_e"))
    o = intervals.overlaps(clips.select("ep", "clip", "a_s", "a_e"), coarse, ["ep"], WIDTH)
    best = o.groupBy("ep", "clip").agg(F.max_by("b_text", F.struct(F.least("a_e", "b_e") - F.greatest("a_s", "b_s"), -F.col("b_ord"))).alias("context"))
    return clips.join(best, ["ep", "clip"], "left").select("ep", "clip", T.final_text("coarse_fine", F.col("channel"), F.col("text"), F.col("context")).alias("final_text"))


def region_semijoin(spark: SparkSession, d: str) -> DataFrame:
    """Fine spans that overlap an interesting region of the mid channel."""
    fine = _ranges(spark, d).filter("channel = 'fine'").select("ep", "ord", F.col("s").alias("a_s"), F.col("e").alias("a_e"))
    region = _ranges(spark, d).filter("channel = 'mid' AND interesting").select("ep", F.col("s").alias("b_s"), F.col("e").alias("b_e"))
    return intervals.overlapping(fine, region, ["ep"], "ord", WIDTH).select("ep", "ord")


def interval_union_coverage(spark: SparkSession, d: str) -> DataFrame:
    """Of each channel of a track: spans, covered length, first and last bound, spans per hour."""
    r = _ranges(spark, d)
    covered = periods(r.withColumn("gap", F.lit(0)), ["ep", "channel"], shard_len=DAY).groupBy("ep", "channel").agg(F.sum(F.col("e") - F.col("s")).alias("covered_us"))
    n = r.groupBy("ep", "channel").agg(F.count(F.lit(1)).alias("n"), F.min("s").alias("first_us"), F.max("e").alias("last_us"))
    j = n.join(covered, ["ep", "channel"])
    return j.select("ep", "channel", "n", "first_us", "last_us", "covered_us", F.round(F.col("covered_us") / (F.col("last_us") - F.col("first_us")), 6).alias("coverage"), F.round(F.col("n") * float(HOUR) / (F.col("last_us") - F.col("first_us")), 6).alias("per_hour"))


def channel_granularity(spark: SparkSession, d: str) -> DataFrame:
    """Channels of each track from coarse to fine by mean length."""
    w = widened(span(spark, d), POINT)
    g = w.groupBy("ep", "channel").agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("e") - F.col("s")).alias("sum_us"))
    mean = F.col("sum_us") / F.col("n")
    order = Window.partitionBy("ep").orderBy(F.desc(mean), "channel")  # channels of one track: a handful
    return g.select("ep", "channel", "n", F.row_number().over(order).cast("long").alias("rank"))


def auto_window(spark: SparkSession, d: str) -> DataFrame:
    """Where a preview of two hours starts: shortly before the first span, inside the track."""
    first = span(spark, d).groupBy("ep").agg(F.min(F.coalesce("s", "p")).alias("first"))
    dur = track(spark, d).groupBy("ep").agg(F.max("us").alias("dur"))
    start = F.greatest(F.lit(0), F.least(F.coalesce("first", F.lit(0)) - 2 * MIN, F.col("dur") - 2 * HOUR))
    return dur.join(first, "ep", "left").select("ep", start.alias("start_us"), F.least(F.lit(2 * HOUR), F.col("dur") - start).alias("length_us"))


def greedy_coalesce(spark: SparkSession, d: str) -> DataFrame:
    """Fine spans and marks packed into clips of at most an hour, shorter than 10 minutes dropped."""
    return _clips(spark, d).select("ep", "channel", F.col("s").alias("start_us"), F.col("e").alias("end_us"), "n", "text")


def numbered_text(spark: SparkSession, d: str) -> DataFrame:
    """Texts of each track's coarse spans as one numbered list."""
    g = _ranges(spark, d).filter("channel = 'coarse'").groupBy("ep").agg(F.transform(F.sort_array(F.collect_list(F.struct("s", "ord", "text"))), lambda x: x["text"]).alias("texts"))
    return g.select("ep", T.numbered(F.col("texts")).alias("text"))


def hard_cut(spark: SparkSession, d: str) -> DataFrame:
    """Mid spans cut into pieces of at most 25 minutes; a rest under 5 minutes is dropped."""
    return sequence.hard_cut(_ranges(spark, d).filter("channel = 'mid'").select("ep", "ord", "s", "e"), "s", "e", 25 * MIN, 11 * MIN).select("ep", "ord", F.col("s").alias("start_us"), F.col("e").alias("end_us"))


def merge_then_split(spark: SparkSession, d: str) -> DataFrame:
    """Regions of activity cut into at most 5 hours at span borders."""
    return sequence.merge_then_split(_ranges(spark, d).select("ep", "s", "e"), ["ep"], 5 * HOUR, HOUR, 15 * MIN).select("ep", F.col("s").alias("start_us"), F.col("e").alias("end_us"))


def hierarchical_chop(spark: SparkSession, d: str) -> DataFrame:
    """Coarse spans longer than 50 minutes replaced by finer ones inside them, or cut hard."""
    c = sequence.descend(_ranges(spark, d), ["coarse", "mid", "fine"], ["ep"], 50 * MIN, 5 * MIN, WIDTH)
    return c.select("ep", "channel", F.col("s").alias("start_us"), F.col("e").alias("end_us"), "text")


def lead_intervals(spark: SparkSession, d: str) -> DataFrame:
    """Marks turned into intervals: each lasts to the next one, the last to the track's end."""
    dur = track(spark, d).groupBy("ep").agg(F.max("us").alias("dur"))
    p = span(spark, d).filter("kind = 'point'").select("ep", "ord", F.col("p").alias("us"), "text")
    # the lead is the lag of time reversed
    rev = p.withColumn("neg", -F.col("us")).withColumn("tie", -F.col("ord"))
    l = lag_over(rev, ["ep"], "neg", "tie", F.col("us"), "next", DAY)
    return l.join(dur, "ep").select("ep", "ord", F.col("us").alias("start_us"), F.coalesce("next", "dur").alias("end_us"), "text")


def span_export_index(spark: SparkSession, d: str) -> DataFrame:
    """Spans with text numbered within their track, in channel order and then by file order."""
    s = widened(span(spark, d), POINT)
    rank = F.when(F.col("channel") == "coarse", 0).when(F.col("channel") == "mid", 1).when(F.col("channel") == "fine", 2).otherwise(3)
    # one number orders channel and file position: channels have their own range of shards
    top = 1 << 40
    s = s.withColumn("pos", rank.cast("long") * F.lit(top) + F.col("ord"))
    return number_over(s, ["ep"], "pos", "ord", "i", 1 << 20).select("ep", "i", "ord", "channel")


def verdict_default_join(spark: SparkSession, d: str) -> DataFrame:
    """Spans with a reviewer's verdict by span number; without one: not interesting, "unlabeled"."""
    s = span_export_index(spark, d)
    v = _ranges(spark, d).filter("channel = 'mid'").select("ep", "ord", F.col("interesting").alias("verdict"))
    j = s.join(v, ["ep", "ord"], "left")
    return j.select("ep", "i", F.coalesce("verdict", F.lit(False)).alias("interesting"), F.when(F.col("verdict").isNull(), "unlabeled").otherwise("reviewed").alias("reason"))


def clip_rows_nested(spark: SparkSession, d: str) -> DataFrame:
    """Hourly frames of each coarse span with its interpolated points, nested, counted and joined up."""
    clips = _ranges(spark, d).filter("channel = 'coarse'").select("ep", F.col("ord").alias("clip"), "s", "e")
    base = F.rint(F.col("s") / float(HOUR)).cast("long")
    frames = clips.withColumn("j", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("e") - F.col("s")) / HOUR).cast("long")))).withColumn("frame_index", base + F.col("j"))
    pts = resample_grid(spark, d)
    rows = frames.join(pts, ["ep", "frame_index"], "left").withColumn("real", F.coalesce("valid", F.lit(False)))
    g = rows.groupBy("ep", "clip").agg(F.sort_array(F.collect_list(F.struct("j", "frame_index", F.when(F.col("real"), F.struct("x", "y")).alias("point")))).alias("frames"))
    return g.select("ep", "clip", F.size("frames").cast("long").alias("n_frames"), F.size(F.filter("frames", lambda f: f["point"].isNotNull())).cast("long").alias("n_real"), F.array_join(F.transform("frames", lambda f: f["frame_index"].cast("string")), ",").alias("frame_list"), F.round(F.aggregate("frames", F.lit(0.0), lambda a, f: a + F.coalesce(f["point"]["x"], F.lit(0.0))), 3).alias("sum_x"))


def sliding_examples(spark: SparkSession, d: str) -> DataFrame:
    """Sliding windows of 16 frames that end at a frame with a point, with the spans active there."""
    a = sliding_frames_causal(spark, d).join(resample_grid(spark, d).filter("valid").withColumnRenamed("frame_index", "anchor"), ["ep", "anchor"])
    a = a.withColumn("us", F.col("anchor") * HOUR)
    act = intervals.stab(a.select("ep", "anchor", "us"), _ranges(spark, d).select("ep", "ord", "s", "e", "text"), ["ep"], "us", WIDTH, "[]").groupBy("ep", "anchor").agg(F.min_by("text", F.struct("s", "ord")).alias("text"))
    return a.join(act, ["ep", "anchor"], "left").select("ep", "anchor", "first_frame", "x", "y", F.coalesce("text", F.lit("")).alias("text"))


def usable_spans(spark: SparkSession, d: str) -> DataFrame:
    """Segments of the project with text and a length, points widened by half a second."""
    s = table(spark, d, "segment").select("dataset", "episode_id", F.lower(F.trim("channel")).alias("channel"), "segment_id", ms(F.col("start_s")).alias("s"), ms(F.col("end_s")).alias("e"), ms(F.col("point_s")).alias("p"), "text").distinct()
    return widened(s, 500).select("dataset", "episode_id", "channel", "segment_id", F.col("s").alias("start_ms"), F.col("e").alias("end_ms"))


def segment_stats(spark: SparkSession, d: str) -> DataFrame:
    """Of each channel of a recording: segments, first and last bound, covered share."""
    u = usable_spans(spark, d)
    keys = ["dataset", "episode_id", "channel"]
    cov = periods(u.select(*keys, F.col("start_ms").alias("s"), F.col("end_ms").alias("e"), F.lit(0).alias("gap")), keys).groupBy(*keys).agg(F.sum(F.col("e") - F.col("s")).alias("covered_ms"))
    n = u.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"), F.min("start_ms").alias("first_ms"), F.max("end_ms").alias("last_ms"))
    return n.join(cov, keys)


_Q = """interval_stab_halfopen_join_labels interval_stab_closed point_nearest_tol active_in_order overlap_attach final_annotation region_semijoin interval_union_coverage channel_granularity
auto_window greedy_coalesce numbered_text hard_cut merge_then_split hierarchical_chop lead_intervals span_export_index verdict_default_join clip_rows_nested sliding_examples usable_spans segment_stats""".split()
QUERIES = {n: globals()[n] for n in _Q}

_WIDE = f"""wide AS (SELECT ep, channel, kind, ord, text, CASE WHEN e > s THEN s WHEN p IS NOT NULL THEN p - {POINT} ELSE s END s, CASE WHEN e > s THEN e WHEN p IS NOT NULL THEN p + {POINT} ELSE s + {2 * POINT} END e FROM span)"""
_FRAMES = f"gp AS (SELECT ep, frame_index, frame_index * {HOUR} us FROM (SELECT ep, unnest(generate_series(0, max(us) // {HOUR})) frame_index FROM track GROUP BY ep))"
_USABLE = """u AS (SELECT DISTINCT dataset, episode_id, channel, segment_id, CASE WHEN e > s THEN s WHEN p IS NOT NULL THEN p - 500 ELSE s END start_ms, CASE WHEN e > s THEN e WHEN p IS NOT NULL THEN p + 500 ELSE s + 1000 END end_ms
 FROM (SELECT dataset, episode_id, lower(trim(channel)) channel, segment_id, text, CAST(round(start_s * 1000) AS BIGINT) s, CAST(round(end_s * 1000) AS BIGINT) e, CAST(round(point_s * 1000) AS BIGINT) p FROM segment)
 WHERE regexp_replace(text, '^\\s+|\\s+$', '', 'g') <> '' AND (e > s OR p IS NOT NULL OR s IS NOT NULL))"""
_INDEX = "idx AS (SELECT ep, ord, channel, row_number() OVER (PARTITION BY ep ORDER BY CASE channel WHEN 'coarse' THEN 0 WHEN 'mid' THEN 1 WHEN 'fine' THEN 2 ELSE 3 END, ord) - 1 i FROM wide)"


_RESAMPLED = TRACK_ORACLES["resample_grid"]

ORACLES = {
    "interval_stab_halfopen_join_labels": f"WITH {TRACK_SQL}, {SPAN_SQL}, {_FRAMES} SELECT g.ep, g.frame_index, coalesce(string_agg(p.text, '|' ORDER BY p.ord), '') AS labels FROM gp g LEFT JOIN span p ON g.ep = p.ep AND p.kind = 'interval' AND g.us >= p.s AND g.us < p.e GROUP BY 1, 2",
    "interval_stab_closed": f"WITH {TRACK_SQL}, {SPAN_SQL} SELECT t.ep, t.ord AS reading, p.ord AS span FROM track t JOIN span p ON t.ep = p.ep AND p.channel = 'mid' AND t.us BETWEEN p.s AND p.e",
    "point_nearest_tol": f"""WITH {TRACK_SQL}, {SPAN_SQL}, {_FRAMES}, c AS (SELECT g.ep, g.frame_index, p.ord, p.text, row_number() OVER (PARTITION BY g.ep, g.frame_index ORDER BY abs(p.p - g.us), p.p, p.ord) k FROM gp g JOIN span p ON g.ep = p.ep AND p.kind = 'point' AND abs(p.p - g.us) <= {20 * MIN}) SELECT ep, frame_index, ord, text FROM c WHERE k = 1""",
    "active_in_order": f"WITH {TRACK_SQL}, {SPAN_SQL}, {_WIDE} SELECT t.ep, t.ord AS reading, string_agg(w.channel, ',' ORDER BY w.kind <> 'interval', w.s, w.ord) AS active FROM track t JOIN wide w ON t.ep = w.ep AND t.us BETWEEN w.s AND w.e GROUP BY 1, 2",
    "overlap_attach": f"""WITH {SPAN_SQL}, {_WIDE}, o AS (SELECT a.ep, a.ord clip, a.channel ac, a.text tx, b.ord aux, b.channel, b.text bt, a.s s1, a.e e1, b.s s2, b.e e2, least(a.e, b.e) - greatest(a.s, b.s) ov FROM span a JOIN wide b ON a.ep = b.ep AND a.channel = 'fine' AND least(a.e, b.e) > greatest(a.s, b.s))
SELECT ep, clip, aux, channel, greatest(0, s2 - s1) AS rel_start, least(e1 - s1, e2 - s1) AS rel_end, ov AS overlap, e2 - s2 AS source_len FROM o WHERE NOT (ov * 2 < e2 - s2 AND ov < e1 - s1) AND NOT (channel = ac AND contains(tx, bt))""",
    "final_annotation": f"""WITH {SPAN_SQL}, c AS (SELECT a.ep, a.ord clip, arg_max(b.text, (least(a.e, b.e) - greatest(a.s, b.s), -b.ord)) ctx FROM span a JOIN span b ON a.ep = b.ep AND a.channel = 'fine' AND b.channel = 'coarse' AND least(a.e, b.e) > greatest(a.s, b.s) GROUP BY 1, 2)
SELECT a.ep, a.ord AS clip, '<context: ' || coalesce(c.ctx, '') || '> <action: ' || a.text || '>' AS final_text FROM span a LEFT JOIN c ON a.ep = c.ep AND a.ord = c.clip WHERE a.channel = 'fine'""",
    "region_semijoin": f"WITH {SPAN_SQL} SELECT ep, ord FROM span a WHERE channel = 'fine' AND EXISTS (SELECT 1 FROM span b WHERE b.ep = a.ep AND b.channel = 'mid' AND b.interesting AND least(a.e, b.e) > greatest(a.s, b.s))",
    "interval_union_coverage": f"""WITH {SPAN_SQL}, f AS (SELECT *, max(e) OVER (PARTITION BY ep, channel ORDER BY s, e ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) m FROM span WHERE kind = 'interval'),
i AS (SELECT *, sum(CASE WHEN m IS NULL OR s > m THEN 1 ELSE 0 END) OVER (PARTITION BY ep, channel ORDER BY s, e ROWS UNBOUNDED PRECEDING) k FROM f), c AS (SELECT ep, channel, k, max(e) - min(s) n FROM i GROUP BY ALL), t AS (SELECT ep, channel, CAST(sum(n) AS BIGINT) covered_us FROM c GROUP BY ALL)
SELECT s.ep, s.channel, count(*) AS n, min(s.s) AS first_us, max(s.e) AS last_us, any_value(t.covered_us) AS covered_us, round(any_value(t.covered_us) / (max(s.e) - min(s.s)), 6) AS coverage, round(count(*) * {float(HOUR)!r} / (max(s.e) - min(s.s)), 6) AS per_hour FROM span s JOIN t ON s.ep = t.ep AND s.channel = t.channel WHERE s.kind = 'interval' GROUP BY 1, 2""",
    "channel_granularity": f"WITH {SPAN_SQL}, {_WIDE}, g AS (SELECT ep, channel, count(*) n, CAST(sum(e - s) AS BIGINT) t FROM wide GROUP BY 1, 2) SELECT ep, channel, n, row_number() OVER (PARTITION BY ep ORDER BY t / n DESC, channel) AS rank FROM g",
    "auto_window": f"WITH {TRACK_SQL}, {SPAN_SQL}, d AS (SELECT ep, max(us) dur FROM track GROUP BY ep), f AS (SELECT ep, min(coalesce(s, p)) fi FROM span GROUP BY ep), w AS (SELECT d.ep, dur, greatest(0, least(coalesce(fi, 0) - {2 * MIN}, dur - {2 * HOUR})) st FROM d LEFT JOIN f ON d.ep = f.ep) SELECT ep, st AS start_us, least({2 * HOUR}, dur - st) AS length_us FROM w",
    "greedy_coalesce": f"""WITH RECURSIVE {SPAN_SQL}, {_WIDE}, v AS (SELECT *, row_number() OVER (PARTITION BY ep ORDER BY s, ord) rn FROM wide WHERE channel IN ('fine', 'mark')),
k(ep, rn, cs, ce, c) AS (SELECT ep, rn, s, e, rn FROM v WHERE rn = 1 UNION ALL SELECT v.ep, v.rn, CASE WHEN v.s - k.ce <= {30 * MIN} AND v.e - k.cs <= {HOUR} THEN k.cs ELSE v.s END, v.e, CASE WHEN v.s - k.ce <= {30 * MIN} AND v.e - k.cs <= {HOUR} THEN k.c ELSE v.rn END FROM k JOIN v ON v.ep = k.ep AND v.rn = k.rn + 1),
g AS (SELECT k.ep, k.c, min(v.s) s, arg_max(v.e, v.rn) e, count(*) n, list(v.text ORDER BY v.rn) t FROM k JOIN v ON k.ep = v.ep AND k.rn = v.rn GROUP BY 1, 2), h AS (SELECT *, list_filter(t, lambda x, i: i = 1 OR t[i - 1] <> x) q FROM g)
SELECT ep, 'fine' AS channel, s AS start_us, e AS end_us, n, CASE WHEN len(q) = 1 THEN q[1] ELSE array_to_string(list_transform(q, lambda x, i: i || ') ' || x), ' ') END AS text FROM h WHERE e - s >= {10 * MIN}""",
    "numbered_text": f"WITH {SPAN_SQL}, g AS (SELECT ep, list(text ORDER BY s, ord) t FROM span WHERE channel = 'coarse' GROUP BY ep), h AS (SELECT ep, list_filter(t, lambda x, i: i = 1 OR t[i - 1] <> x) q FROM g) SELECT ep, CASE WHEN len(q) = 1 THEN q[1] ELSE array_to_string(list_transform(q, lambda x, i: i || ') ' || x), ' ') END AS text FROM h",
    "hard_cut": f"WITH {SPAN_SQL}, c AS (SELECT ep, ord, s, e, unnest(generate_series(0, CAST(ceil((e - s) / {25 * MIN}) AS BIGINT) - 1)) i FROM span WHERE channel = 'mid') SELECT ep, ord, s + i * {25 * MIN} AS start_us, least(e, s + (i + 1) * {25 * MIN}) AS end_us FROM c WHERE least(e, s + (i + 1) * {25 * MIN}) - (s + i * {25 * MIN}) >= {11 * MIN}",
    "merge_then_split": f"""WITH RECURSIVE {SPAN_SQL}, r AS (SELECT ep, s, e FROM span WHERE kind = 'interval'), f AS (SELECT *, max(e) OVER (PARTITION BY ep ORDER BY s, e ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) m FROM r),
i AS (SELECT *, sum(CASE WHEN m IS NULL OR s > m + {HOUR} THEN 1 ELSE 0 END) OVER (PARTITION BY ep ORDER BY s, e ROWS UNBOUNDED PRECEDING) k FROM f), g AS (SELECT ep, k, min(s) lo, max(e) hi FROM i GROUP BY 1, 2), b AS (SELECT DISTINCT ep, s b FROM r UNION SELECT DISTINCT ep, e FROM r),
w(ep, k, st, cut, hi) AS (SELECT ep, k, lo, CASE WHEN hi - lo > {5 * HOUR} THEN coalesce((SELECT max(b) FROM b WHERE b.ep = g.ep AND b.b BETWEEN g.lo + {15 * MIN} AND g.lo + {5 * HOUR}), lo + {5 * HOUR}) ELSE hi END, hi FROM g
 UNION ALL SELECT ep, k, cut, CASE WHEN hi - cut > {5 * HOUR} THEN coalesce((SELECT max(b) FROM b WHERE b.ep = w.ep AND b.b BETWEEN w.cut + {15 * MIN} AND w.cut + {5 * HOUR}), cut + {5 * HOUR}) ELSE hi END, hi FROM w WHERE cut < hi)
SELECT ep, st AS start_us, cut AS end_us FROM w WHERE cut - st >= {15 * MIN}""",
    "hierarchical_chop": f"""WITH {SPAN_SQL}, c AS (SELECT ep, ord, greatest(s, 0) s, e, text FROM span WHERE channel = 'coarse' AND e - greatest(s, 0) >= {5 * MIN}),
m AS (SELECT c.ep, c.ord co, b.ord mo, greatest(c.s, b.s) s, least(c.e, b.e) e, b.text FROM c JOIN span b ON b.ep = c.ep AND b.channel = 'mid' WHERE c.e - c.s > {50 * MIN} AND least(c.e, b.e) - greatest(c.s, b.s) >= {5 * MIN}),
f AS (SELECT m.ep, m.co, m.mo, greatest(m.s, b.s) s, least(m.e, b.e) e, b.text FROM m JOIN span b ON b.ep = m.ep AND b.channel = 'fine' WHERE m.e - m.s > {50 * MIN} AND least(m.e, b.e) - greatest(m.s, b.s) >= {5 * MIN}),
x AS (SELECT ep, 'coarse' channel, s, e, text FROM c WHERE e - s <= {50 * MIN} OR NOT EXISTS (SELECT 1 FROM m WHERE m.ep = c.ep AND m.co = c.ord) UNION ALL
 SELECT ep, 'mid', s, e, text FROM m WHERE e - s <= {50 * MIN} OR NOT EXISTS (SELECT 1 FROM f WHERE f.ep = m.ep AND f.co = m.co AND f.mo = m.mo) UNION ALL SELECT ep, 'fine', s, e, text FROM f),
y AS (SELECT *, unnest(generate_series(0, CAST(ceil((e - s) / {50 * MIN}) AS BIGINT) - 1)) i FROM x)
SELECT ep, channel, s + i * {50 * MIN} AS start_us, least(e, s + (i + 1) * {50 * MIN}) AS end_us, text FROM y WHERE least(e, s + (i + 1) * {50 * MIN}) - (s + i * {50 * MIN}) >= {5 * MIN}""",
    "lead_intervals": f"WITH {TRACK_SQL}, {SPAN_SQL}, d AS (SELECT ep, max(us) dur FROM track GROUP BY ep) SELECT s.ep, s.ord, s.p AS start_us, coalesce(lead(s.p) OVER (PARTITION BY s.ep ORDER BY s.p, s.ord), d.dur) AS end_us, s.text FROM span s JOIN d ON s.ep = d.ep WHERE s.kind = 'point'",
    "span_export_index": f"WITH {SPAN_SQL}, {_WIDE}, {_INDEX} SELECT ep, i, ord, channel FROM idx",
    "verdict_default_join": f"WITH {SPAN_SQL}, {_WIDE}, {_INDEX} SELECT x.ep, x.i, coalesce(v.interesting, false) AS interesting, CASE WHEN v.ord IS NULL THEN 'unlabeled' ELSE 'reviewed' END AS reason FROM idx x LEFT JOIN span v ON x.ep = v.ep AND x.ord = v.ord AND v.channel = 'mid'",
    "usable_spans": f"WITH {_USABLE} SELECT * FROM u",
    "segment_stats": f"""WITH {_USABLE}, f AS (SELECT *, max(end_ms) OVER (PARTITION BY dataset, episode_id, channel ORDER BY start_ms, end_ms ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) m FROM u),
i AS (SELECT *, sum(CASE WHEN m IS NULL OR start_ms > m THEN 1 ELSE 0 END) OVER (PARTITION BY dataset, episode_id, channel ORDER BY start_ms, end_ms ROWS UNBOUNDED PRECEDING) k FROM f), c AS (SELECT dataset, episode_id, channel, k, max(end_ms) - min(start_ms) n, count(*) r, min(start_ms) lo, max(end_ms) hi FROM i GROUP BY ALL)
SELECT dataset, episode_id, channel, CAST(sum(r) AS BIGINT) AS n, min(lo) AS first_ms, max(hi) AS last_ms, CAST(sum(n) AS BIGINT) AS covered_ms FROM c GROUP BY 1, 2, 3""",
}
ORACLES["clip_rows_nested"] = f"""WITH rs AS ({_RESAMPLED}), {SPAN_SQL}, c AS (SELECT ep, ord clip, CAST(round_even(s / {float(HOUR)!r}, 0) AS BIGINT) b, unnest(generate_series(0, (e - s) // {HOUR})) j FROM span WHERE channel = 'coarse')
SELECT c.ep, c.clip, count(*) AS n_frames, count(*) FILTER (coalesce(r.valid, false)) AS n_real, string_agg(CAST(c.b + c.j AS VARCHAR), ',' ORDER BY c.j) AS frame_list, round(sum(CASE WHEN r.valid THEN r.x ELSE 0 END), 3) AS sum_x FROM c LEFT JOIN rs r ON c.ep = r.ep AND r.frame_index = c.b + c.j GROUP BY 1, 2"""
ORACLES["sliding_examples"] = f"""WITH rs AS ({_RESAMPLED}), {TRACK_SQL}, {SPAN_SQL}, l AS (SELECT ep, max(us) // {HOUR} AS last FROM track GROUP BY ep), a AS (SELECT ep, unnest(generate_series(0, last, 8)) anchor, last FROM l), w AS (SELECT a.ep, anchor, anchor - 15 AS first_frame, r.x, r.y FROM a JOIN rs r ON a.ep = r.ep AND a.anchor = r.frame_index AND r.valid WHERE anchor - 15 >= 0 AND anchor <= last)
SELECT w.ep, w.anchor, w.first_frame, any_value(w.x) AS x, any_value(w.y) AS y, coalesce(arg_min(p.text, (p.s, p.ord)), '') AS text FROM w LEFT JOIN span p ON p.ep = w.ep AND p.kind = 'interval' AND w.anchor * {HOUR} BETWEEN p.s AND p.e GROUP BY 1, 2, 3"""
