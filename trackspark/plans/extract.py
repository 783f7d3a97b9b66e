"""Extraction of all episodes of a dataset by its recipe: tracks, segments, and who is emitted."""

from __future__ import annotations

from functools import partial

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from trackspark.functions.predicate import glob as matches
from trackspark.functions.text import fill_template
from trackspark.functions.time import align, clip_start, frame_range
from trackspark.operators.intervals import stab
from trackspark.operators.sharded import lag_over
from trackspark.recipe import Channel, Recipe, key_tokens
from trackspark.sources import annotations, discovery, tracks

KEYS = ["dataset", "episode_id"]
#: Frames in a bin of the join of a session's rows with its clips.
CLIP_FRAMES = 240


def _id_token(pattern: str) -> str | None:
    return next((n for n in key_tokens(pattern) if n in discovery.IDS), None)


def _pick(rows: DataFrame, spark: SparkSession, root: str, select: discovery.Select) -> DataFrame:
    """Rows of the chosen files only, where a selection leaves a choice."""
    if len(select.patterns()) < 2 and "*" not in select.patterns()[0]:
        return rows
    return rows.join(discovery.chosen_files(spark, root, select).select("path"), "path", "left_semi")


def _wanted(df: DataFrame, recipe: Recipe) -> DataFrame:
    return df.filter(~matches(F.col("episode_id"), recipe.exclude)) if recipe.exclude else df


def _episodes(episodes: DataFrame, recipe: Recipe) -> DataFrame:
    """The recipe's episodes with ``tokens`` (those of the id where none are given)."""
    e = _wanted(episodes.filter(F.col("dataset") == recipe.dataset), recipe)
    own = F.create_map(*[x for n in discovery.IDS for x in (F.lit(n), F.col("episode_id"))])
    given = F.col("tokens") if "tokens" in e.columns else F.create_map().cast("map<string,string>")
    given = F.map_filter(F.coalesce(given, F.create_map().cast("map<string,string>")), lambda k, v: ~k.isin(*discovery.IDS))
    return e.withColumn("tokens", F.map_concat(own, given))


def _rows(spark: SparkSession, root: str, select: discovery.Select, read) -> DataFrame | None:
    """Rows of all files of a selection with the tokens of their paths; None without any file."""
    out = None
    for pattern in select.patterns():
        glob = f"{root}/{discovery.template_glob(pattern)[0]}"
        if discovery.exists(spark, glob):
            part = read(glob).withColumn("tokens", discovery.tokens_of(F.col("path"), pattern)).filter("tokens IS NOT NULL")
            part = part.withColumn("episode_id", F.try_element_at("tokens", F.lit(_id_token(pattern))) if _id_token(pattern) else F.lit(None).cast("string"))
            out = part if out is None else out.unionByName(part)
    return None if out is None else _pick(out, spark, root, select)


def track(spark: SparkSession, recipe: Recipe, root: str, episodes: DataFrame) -> DataFrame:
    """(dataset, episode_id, ord, t_s, valid, ch, t0) on the video's clock; t0 is the first raw time."""
    t = _rows(spark, root, recipe.select, partial(lambda glob: tracks.read_track(spark, recipe.reader, glob, recipe.track)))
    if t is None:
        return spark.createDataFrame([], "dataset string, episode_id string, ord long, t_s double, valid boolean, ch map<string,double>, t0 double")
    eps = _episodes(episodes, recipe)
    if _id_token(recipe.select.patterns()[0]):
        t = _wanted(t.filter("episode_id <> ''"), recipe)
    else:  # a file of a whole session: its clips take their frames out of it
        names = key_tokens(recipe.select.patterns()[0])
        clips = eps.withColumn("r", frame_range(F.col("episode_id"))).select(F.col("episode_id").alias("clip"), *[F.try_element_at("tokens", F.lit(n)).alias(n) for n in names], F.col("r.first").alias("s"), F.col("r.last").alias("e"))
        t = t.drop("episode_id").select("*", *[F.try_element_at("tokens", F.lit(n)).alias(n) for n in names])
        t = stab(t, clips.filter("s IS NOT NULL"), names, "ord", CLIP_FRAMES, "[]").withColumnRenamed("clip", "episode_id")
        base = t.groupBy("episode_id").agg(F.min("ord").alias("base"), F.min_by("t_s", "ord").alias("base_t"))
        t = t.join(base, "episode_id").withColumn("ord", F.col("ord") - F.col("base")).withColumn("t_s", F.col("t_s") - F.col("base_t"))
    t = t.withColumn("dataset", F.lit(recipe.dataset))
    first = t.filter("t_s IS NOT NULL").groupBy(*KEYS).agg(F.min_by("t_s", "ord").alias("t0"))
    at = align(F.col("t_s"), recipe.gaze_clock, first=F.col("t0"), clip_start=clip_start(F.col("episode_id")), const=recipe.const_s.get("gaze"), fps=recipe.track.fps)
    return t.join(first, KEYS, "left").select(*KEYS, F.col("ord").cast("long").alias("ord"), at.alias("t_s"), "valid", "ch", "t0")


def _key_of(episodes: DataFrame, form: str) -> Column:
    return fill_template(form, {n: F.try_element_at("tokens", F.lit(n)) for n in key_tokens(form)})


def _records(spark: SparkSession, c: Channel, root: str, episodes: DataFrame) -> DataFrame | None:
    """(episode_id, ord, rec, duration_s) of a channel's items, each with its episode."""
    known = episodes.select("episode_id", "tokens", "duration_s")
    if c.reader == "json_by_key":
        read = lambda glob: annotations.json_records(spark, glob, c.where)
    elif c.reader == "pandas_pickle":
        read = lambda glob: annotations.pickle_records(spark, glob)
    elif c.reader in ("csv", "tsv"):
        read = lambda glob: annotations.csv_rows(spark, glob)
    else:
        raise ValueError(f"channel {c.name!r}: reader {c.reader!r} is unknown")
    rows = _rows(spark, root, c.select, read)
    if rows is None:
        return None
    if c.deny_file:
        deny = annotations.csv_rows(spark, f"{root}/{c.deny_file}").select(annotations.value(c.deny_field).alias("__id")).distinct()
        rows = rows.withColumn("__id", F.coalesce(annotations.value("unique_narration_id"), annotations.value("narration_id"))).join(deny, "__id", "left_anti").drop("__id")
    if c.reader == "json_by_key":
        keyed = known.withColumn("key", _key_of(known, c.key))
        return rows.drop("episode_id", "tokens").join(keyed, "key").select("episode_id", "ord", "rec", "duration_s")
    if c.by == "row_field":
        # a row may name its clip without the frames that end a clip's id
        short = F.regexp_replace("episode_id", r"-F\d+-F\d+$", "")
        keyed = known.withColumn("key", F.explode(F.array_distinct(F.array("episode_id", short))))
        return rows.drop("episode_id", "tokens").withColumn("key", annotations.value(c.key)).join(keyed, "key").select("episode_id", "ord", "rec", "duration_s")
    return rows.drop("tokens").join(known.drop("tokens"), "episode_id").select("episode_id", "ord", "rec", "duration_s")


def segments(spark: SparkSession, recipe: Recipe, root: str, episodes: DataFrame, first: DataFrame) -> DataFrame:
    """(dataset, episode_id, channel, kind, role, ord, start_s, end_s, point_s, text, extras) of all channels.

    ``first`` gives the recording's first raw time (t0) for clocks that start with it.
    """
    eps, out = _episodes(episodes, recipe), None
    if "duration_s" not in eps.columns:
        eps = eps.withColumn("duration_s", F.lit(None).cast("double"))
    for c in recipe.channels:
        rec = None if c.role == "disabled" else _records(spark, c, root, eps)
        if rec is None:
            continue
        s = annotations.segments(rec, ["episode_id", "ord"], c.spec, F.col("duration_s")).withColumn("dataset", F.lit(recipe.dataset)).join(first, KEYS, "left")
        at = lambda n: align(F.col(n), recipe.text_clock, first=F.col("t0"), clip_start=clip_start(F.col("episode_id")), const=recipe.const_s.get("annotations"), fps=recipe.track.fps).alias(n)
        if c.spec.whole:
            at = lambda n: F.col(n)
        s = s.select(*KEYS, F.lit(c.name).alias("channel"), F.lit(c.kind).alias("kind"), F.lit(c.role).alias("role"), "ord", at("start_s"), at("end_s"), at("point_s"), "text", "extras")
        out = s if out is None else out.unionByName(s)
    if out is None:
        return spark.createDataFrame([], "dataset string, episode_id string, channel string, kind string, role string, ord long, start_s double, end_s double, point_s double, text string, extras map<string,string>")
    return out


def widest_gap(samples: DataFrame) -> DataFrame:
    """(keys, gap_s): the longest time between two valid samples of an episode."""
    v = samples.filter("valid AND t_s IS NOT NULL")
    d = lag_over(v, KEYS, "t_s", "ord", F.col("t_s"), "__before", 600.0)
    return d.groupBy(*KEYS).agg(F.max(F.col("t_s") - F.col("__before")).alias("gap_s"))


def emitted(episodes: DataFrame, samples: DataFrame, segs: DataFrame, max_gap_s: float | None = None) -> DataFrame:
    """(dataset, episode_id, emitted, reason): with a duration, a sample, a segment and no wide gap."""
    n = samples.groupBy(*KEYS).agg(F.count(F.lit(1)).alias("samples"))
    m = segs.groupBy(*KEYS).agg(F.count(F.lit(1)).alias("segments"))
    j = episodes.join(n, KEYS, "left").join(m, KEYS, "left")
    wide = F.lit(None).cast("string")
    if max_gap_s is not None:
        j = j.join(widest_gap(samples), KEYS, "left")
        wide = F.when(F.col("gap_s") > max_gap_s, "gap between valid samples")
    why = F.concat_ws("; ", F.when(~F.coalesce(F.col("duration_s") > 0, F.lit(False)), "no duration"), F.when(F.col("samples").isNull(), "no samples"), F.when(F.col("segments").isNull(), "no segments"), wide)
    return j.select(*KEYS, (why == "").alias("emitted"), why.alias("reason"))


def shipped_durations(episodes: DataFrame, shipped: DataFrame, off: float = 1.0) -> DataFrame:
    """Episodes with the duration their metadata ships, where there is one, and a warning if it is far from the probed one.

    ``shipped`` is (dataset, episode_id, shipped_s).
    """
    j = episodes.join(shipped.select(*KEYS, "shipped_s"), KEYS, "left")
    use = F.col("shipped_s") > 0
    warn = F.when(use & (F.abs(F.col("duration_s") - F.col("shipped_s")) > off), F.concat(F.lit("shipped "), F.round("shipped_s", 2), F.lit(" s, probed "), F.round("duration_s", 2), F.lit(" s")))
    return j.withColumn("warning", warn).withColumn("duration_s", F.when(use, F.col("shipped_s")).otherwise(F.col("duration_s"))).drop("shipped_s")


def run(spark: SparkSession, recipe: Recipe, root: str, episodes: DataFrame) -> dict[str, DataFrame]:
    """The dataset's tables. ``episodes`` has the keys, ``duration_s`` (null where only probing knows) and
    may have ``tokens``, a map of names in path templates. A culled dataset has no episodes."""
    episodes = episodes.filter("false") if recipe.cull else _wanted(episodes, recipe)
    t = track(spark, recipe, root, episodes)
    t = t.filter("false") if recipe.cull else t
    first = t.groupBy(*KEYS).agg(F.first("t0", ignorenulls=True).alias("t0"))
    s = segments(spark, recipe, root, episodes, first)
    return {"track": t.drop("t0"), "segment": s, "episode": emitted(episodes.drop("tokens"), t, s, recipe.max_gap_s)}
