"""Training rows: clips bounded by annotations with their gaze points, nested.

spans → hierarchical chop → greedy packing → frames joined to the resampled track → overlapping
annotations of other channels → one nested row per clip. Times are integers of microseconds.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trackspark.functions import geometry as G
from trackspark.functions import text as T
from trackspark.operators import asof, intervals, sequence
from trackspark.operators.sharded import lag_over, number_over
from trackspark.session import durable

US = 1_000_000


@dataclass(frozen=True)
class ClipSpec:
    order: tuple[str, ...]
    fps: int = 2
    side: int = 378
    max_clip_us: int = 55 * US
    min_clip_us: int = 3 * US
    drop_us: int = US
    gap_us: int = 3 * US
    max_gap_us: int = US
    coarse: str = "coarse"
    fine: tuple[str, ...] = ("fine",)
    policy: str = "source_only"
    shard_us: int = 600 * US


def clips(spans: DataFrame, keys: list[str], spec: ClipSpec) -> DataFrame:
    """(keys, clip, channel, s, e, n, text): chopped and packed, numbered in time order per source."""
    cut = sequence.descend(spans, list(spec.order), keys, spec.max_clip_us, spec.drop_us, spec.shard_us)
    # what one source holds at one start is told apart by its path and text
    cut = durable(cut.withColumn("ord", F.xxhash64("path", "channel", "text", "e")))
    packed = sequence.coalesce(cut, keys, spec.max_clip_us, spec.gap_us, spec.min_clip_us, spec.shard_us)
    packed = durable(packed.withColumn("tie", F.xxhash64("channel", "e", "text")))
    return number_over(packed, keys, "s", "tie", "clip", spec.shard_us).drop("tie")


def resampled(track: DataFrame, ends: DataFrame, keys: list[str], spec: ClipSpec) -> DataFrame:
    """(keys, frame_index, x, y) at ``fps`` up to each source's end (column ``last``, µs)."""
    g = asof.grid(ends, keys, spec.fps, US, "last").select(*keys, "frame_index", (F.col("frame_index") * US / spec.fps).cast("long").alias("us"))
    f = asof.bracket(g, track, keys, "us", ["x", "y"], spec.shard_us)
    return f.select(*keys, "frame_index", asof.lerp("x", "us", spec.max_gap_us).alias("x"), asof.lerp("y", "us", spec.max_gap_us).alias("y"))


def kept(spans: DataFrame, track: DataFrame, keys: list[str], spec: ClipSpec, widest_us: int | None = None, regions: DataFrame | None = None) -> DataFrame:
    """Spans to build clips from: without sources whose readings leave a gap over ``widest_us``, and, where
    ``regions`` are given, only those that overlap an interesting one (keys, channel, r_s, r_e, interesting)."""
    if widest_us is not None:
        d = lag_over(track, keys, "us", "ord", F.col("us"), "__before", spec.shard_us)
        wide = d.filter(F.col("us") - F.col("__before") > widest_us).select(*keys).distinct()
        spans = spans.join(wide, keys, "left_anti")
    return spans if regions is None else intervals.in_regions(spans, regions, keys, "ord", spec.shard_us)


def attach(c: DataFrame, spans: DataFrame, keys: list[str], spec: ClipSpec, min_overlap: float = 0.5) -> DataFrame:
    """(keys, clip, aux array): spans of which enough lies in the clip, or that fill it; the clip's own text is left out."""
    a = c.select(*keys, "clip", F.col("channel").alias("a_channel"), F.col("text").alias("a_text"), F.col("s").alias("a_s"), F.col("e").alias("a_e"))
    b = spans.select(*keys, F.col("channel").alias("channel"), F.col("text").alias("text"), F.col("s").alias("b_s"), F.col("e").alias("b_e"))
    o = intervals.overlaps(a, b, keys, spec.shard_us)
    ov, length, whole = F.least("a_e", "b_e") - F.greatest("a_s", "b_s"), F.col("b_e") - F.col("b_s"), F.col("a_e") - F.col("a_s")
    o = o.filter(~((ov < length * min_overlap) & (ov < whole)) & ~((F.col("channel") == F.col("a_channel")) & F.col("a_text").contains(F.col("text"))))
    item = F.struct("channel", F.greatest(F.lit(0), F.col("b_s") - F.col("a_s")).alias("start"), F.least(whole, F.col("b_e") - F.col("a_s")).alias("end"), "text", ov.alias("overlap"), length.alias("source_length"))
    return o.groupBy(*keys, "clip").agg(F.sort_array(F.collect_list(item)).alias("aux"))


def rows(spans: DataFrame, track: DataFrame, sources: DataFrame, keys: list[str], spec: ClipSpec) -> DataFrame:
    """Nested clip rows. ``sources`` has the keys, ``last`` (µs), ``width`` and ``height``.

    Points hold pixel of the padded square and bins; a frame without gaze on the picture keeps its
    place with a null point.
    """
    spans = durable(spans)
    c = durable(clips(spans, keys, spec))
    grid = resampled(track, sources.select(*keys, "last"), keys, spec)
    base = F.rint(F.col("s") * F.lit(float(spec.fps)) / US).cast("long")
    n = F.greatest(F.floor((F.col("e") - F.col("s")) * F.lit(spec.fps) / US).cast("long"), F.lit(1))
    frames = c.select(*keys, "clip", base.alias("base"), n.alias("n_frames")).withColumn("j", F.explode(F.sequence(F.lit(0).cast("long"), F.col("n_frames") - 1)))
    frames = frames.withColumn("frame_index", F.col("base") + F.col("j")).join(grid, [*keys, "frame_index"], "left").join(sources.select(*keys, "width", "height"), keys)
    box = G.Letterbox(F.col("width"), F.col("height"), spec.side)
    on = F.coalesce(F.col("x").isNotNull() & F.col("y").isNotNull() & box.holds(F.col("x"), F.col("y")), F.lit(False))
    px, py = box.padded(F.col("x"), F.col("y"))
    nx, ny = box.norm(F.col("x"), F.col("y"))
    point = F.when(on, F.struct(F.round(px, 1).alias("x"), F.round(py, 1).alias("y"), G.to_bins(nx).alias("x_bin"), G.to_bins(ny).alias("y_bin")))
    frame = F.struct("j", F.round(F.col("j") / float(spec.fps), 3).alias("t"), point.alias("point"))
    pts = frames.groupBy(*keys, "clip").agg(F.sort_array(F.collect_list(frame)).alias("frames"))
    aux = attach(c, spans, keys, spec)
    j = c.join(pts, [*keys, "clip"]).join(aux, [*keys, "clip"], "left").withColumn("aux", F.coalesce("aux", F.array().cast(dict(aux.dtypes)["aux"])))
    coarse = F.filter("aux", lambda a: (a["channel"] == spec.coarse) & (a["text"] != ""))
    context = F.array_max(F.transform(coarse, lambda a: F.struct(a["overlap"].alias("o"), a["text"].alias("text"))))["text"]
    final = T.final_text(spec.policy, F.col("channel"), F.col("text"), context, spec.coarse, spec.fine)
    prompt = F.concat(F.lit("Where does the wearer look in each frame?"), F.when(F.coalesce(final, F.lit("")) != "", F.concat(F.lit(" Context: "), final)).otherwise(F.lit("")))
    reply = T.answer(F.transform("frames", lambda f: F.struct(f["t"].alias("t"), f["point"]["x"].alias("x"), f["point"]["y"].alias("y"))))
    say = lambda who, what: F.struct(F.lit(who).alias("role"), what.alias("content"))
    return j.select(
        F.concat(F.concat_ws(":", *keys), F.lit("#"), F.col("clip").cast("string")).alias("id"), *keys, "clip", "channel", "s", "e", "n", "text", final.alias("final_text"), "aux",
        F.transform("frames", lambda f: f["t"]).alias("timestamps"), F.transform("frames", lambda f: f["point"]).alias("points"),
        F.size(F.filter("frames", lambda f: f["point"].isNotNull())).alias("valid_points"), F.array(say("user", prompt), say("assistant", reply)).alias("messages"),
    )
