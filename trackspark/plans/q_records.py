"""Queries on records: predicates, joins, catalogues, manifests, splits, validation, geometry."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trackspark.functions import geometry as G
from trackspark.functions import text as T
from trackspark.functions import time as TM
from trackspark.functions.predicate import glob, predicate
from trackspark.operators.dedupe import latest
from trackspark.operators.grid import usable_samples
from trackspark.operators.sharded import lag_over, number_over
from trackspark.plans import splits, validate
from trackspark.session import table
from trackspark.sources import catalog

EP = ["dataset", "episode_id"]
#: The square that letterboxed pictures fill.
SIDE = 378


def _boxed(spark: SparkSession, d: str) -> tuple[DataFrame, G.Letterbox]:
    s = usable_samples(table(spark, d, "gaze_sample"), ("x", "y"))
    r = table(spark, d, "recipe").select("dataset", "width", "height", "coordinate_space")
    return s.join(r, "dataset"), G.Letterbox(F.col("width"), F.col("height"), SIDE)


def letterbox_bins(spark: SparkSession, d: str) -> DataFrame:
    """Samples on the padded square: bins of both axes, and whether they lie on the picture."""
    s, box = _boxed(spark, d)
    nx, ny = box.norm(F.col("x"), F.col("y"))
    return s.select("sample_id", G.to_bins(nx).alias("x_bin"), G.to_bins(ny).alias("y_bin"), box.holds(F.col("x"), F.col("y")).alias("on_picture"), G.in_frame(F.col("x"), F.col("y"), F.col("width"), F.col("height")).alias("in_frame"))


def pinhole_project(spark: SparkSession, d: str) -> DataFrame:
    """Where a fixed world ray falls in the picture of each tracked pose; behind the camera: null."""
    p = latest(table(spark, d, "pose").select("pose_id", "m", "tracked", "arrived_at"), "pose_id", "arrived_at").filter("tracked AND size(m) = 16")
    ray = [F.lit(v) for v in (0.1, 0.0, 0.0, 0.8, 0.2, -0.1)]
    x, y = G.pinhole(F.col("m"), ray, 681.4, 682.4, 445.4, 237.4)
    return p.select("pose_id", F.round(x, 4).alias("px"), F.round(y, 4).alias("py"), G.in_frame(x, y, F.lit(896), F.lit(504)).alias("in_frame"))


PREDICATES = ("modality == 'gaze'", "modality != gaze", "size_bytes >= 1000000", "size_bytes < 10", "sha1 == null", "sequence_id != none", "sha1 == true", "size_bytes == 0", "filename > 5", "no_such == null", "dataset != null", "")


def predicate_filter(spark: SparkSession, d: str) -> DataFrame:
    """Rows that each predicate of the small language keeps."""
    a = table(spark, d, "asset")
    types = dict(a.dtypes)
    n = a.agg(*[F.count_if(predicate(p, types)).alias(f"p{i}") for i, p in enumerate(PREDICATES)])
    return n.select(F.inline(F.array(*[F.struct(F.lit(p).alias("predicate"), F.col(f"p{i}").alias("kept")) for i, p in enumerate(PREDICATES)])))


def _episodes(spark: SparkSession, d: str) -> DataFrame:
    e = table(spark, d, "episode")
    rest = [c for c in e.columns if c not in EP]
    return e.groupBy(*EP).agg(F.max_by(F.struct(*rest), F.struct("uploaded_at", "take_uid", "wearer_id", "duration_s")).alias("r")).select(*EP, "r.*")


def emit_policy(spark: SparkSession, d: str) -> DataFrame:
    """Whether an episode is emitted: it has a duration, samples and segments; else what is missing."""
    e = _episodes(spark, d)
    g = usable_samples(table(spark, d, "gaze_sample")).groupBy(*EP).agg(F.count(F.lit(1)).alias("samples"))
    s = table(spark, d, "segment").groupBy(*EP).agg(F.countDistinct("segment_id").alias("segments"))
    j = e.join(g, EP, "left").join(s, EP, "left")
    why = F.concat_ws("; ", F.when(~F.coalesce(F.col("duration_s") > 0, F.lit(False)), "no duration"), F.when(F.col("samples").isNull(), "no samples"), F.when(F.col("segments").isNull(), "no segments"))
    return j.select(*EP, (why == "").alias("emitted"), why.alias("reason"), F.coalesce("samples", F.lit(0)).alias("samples"), F.coalesce("segments", F.lit(0)).alias("segments"))


def anti_denylist(spark: SparkSession, d: str) -> DataFrame:
    """Orders of customers who are not on the list of overdrawn accounts."""
    deny = table(spark, d, "customer").filter("c_acctbal < 0").select(F.col("c_custkey").alias("o_custkey"))
    return table(spark, d, "orders").join(deny, "o_custkey", "left_anti").select("o_orderkey", "o_custkey")


def anti_known_union(spark: SparkSession, d: str) -> DataFrame:
    """Customers with orders, and of the others those of the building segment, each marked."""
    known = table(spark, d, "orders").select(F.col("o_custkey").alias("c_custkey")).distinct()
    more = table(spark, d, "customer").filter("c_mktsegment = 'BUILDING'").select("c_custkey").join(known, "c_custkey", "left_anti")
    return known.withColumn("found", F.lit(True)).unionByName(more.withColumn("found", F.lit(False)))


def semi_key(spark: SparkSession, d: str) -> DataFrame:
    """Segments whose episode is in the episode table, keys compared as text."""
    s = table(spark, d, "segment").select("segment_id", "dataset", F.col("episode_id").cast("string").alias("episode_id")).distinct()
    return s.join(table(spark, d, "episode").select(*EP).distinct(), EP, "left_semi").select("segment_id", *EP)


def bridge_first_match(spark: SparkSession, d: str) -> DataFrame:
    """Take uids with the first episode that carries them."""
    e = table(spark, d, "episode").filter("take_uid IS NOT NULL")
    return e.groupBy("take_uid").agg(F.min(F.struct("dataset", "episode_id")).alias("e"), F.countDistinct("dataset", "episode_id").alias("n")).select("take_uid", "e.dataset", "e.episode_id", "n")


def asset_summary(spark: SparkSession, d: str) -> DataFrame:
    """Of each dataset and modality: assets, sequences, bytes, unknown sizes, GB; totals by rollup."""
    a = table(spark, d, "asset").select("asset_id", "dataset", "modality", "sequence_id", "size_bytes").distinct()
    g = a.rollup("dataset", "modality").agg(F.count(F.lit(1)).alias("assets"), F.countDistinct("sequence_id").alias("sequences"), F.sum(F.coalesce("size_bytes", F.lit(0))).alias("bytes"), F.count_if(F.col("size_bytes").isNull()).alias("unknown"))
    return g.withColumn("gb", F.round(F.col("bytes") / 1e9, 3))


def _sequence(c: str = "sequence_id"):
    return F.lower(F.trim(c))


def sequence_profile(spark: SparkSession, d: str) -> DataFrame:
    """Of each recording: assets, sorted modalities, largest file."""
    a = table(spark, d, "asset").filter(F.coalesce(_sequence(), F.lit("")) != "")
    return a.groupBy("dataset", _sequence().alias("sequence")).agg(F.countDistinct("asset_id").alias("assets"), F.array_join(F.sort_array(F.collect_set("modality")), ",").alias("modalities"), F.max("size_bytes").alias("largest"))


def asset_status(spark: SparkSession, d: str) -> DataFrame:
    """Assets of the first listing held against the last listing of the same place."""
    a = table(spark, d, "asset").filter("url IS NOT NULL").select("url", "asset_id", "size_bytes", "sha1", "listed_at")
    first = a.groupBy("url").agg(F.min_by(F.struct("size_bytes", "sha1"), F.struct("listed_at", "asset_id")).alias("r")).select(F.col("url").alias("path"), "r.*")
    last = a.filter("size_bytes > 0").groupBy("url").agg(F.max_by(F.struct("size_bytes", "sha1"), F.struct("listed_at", "asset_id")).alias("r")).select(F.col("url").alias("path"), F.col("r.size_bytes").alias("bytes"), F.col("r.sha1").alias("sha1"), F.col("url").endswith(".part").alias("partial"))
    return catalog.asset_status(first, last)


def pick_file(spark: SparkSession, d: str) -> DataFrame:
    """The file a recording uses per modality: by format rank, then size, then name, the last wins."""
    a = table(spark, d, "asset").filter((F.coalesce(_sequence(), F.lit("")) != "") & F.col("filename").isNotNull())
    rank = F.when(F.col("filename").endswith(".json"), 2).when(F.col("filename").rlike(r"\.(csv|txt|npy)$"), 1).otherwise(0)
    return a.groupBy("dataset", _sequence().alias("sequence"), "modality").agg(F.max(F.struct(rank.alias("rank"), F.coalesce("size_bytes", F.lit(-1)).alias("size"), "filename")).alias("m")).select("dataset", "sequence", "modality", "m.filename", F.col("m.size").alias("size_bytes"))


def pick_prefer(spark: SparkSession, d: str) -> DataFrame:
    """The URL of each recording's video: a listed preference, then any video, then a template."""
    a = table(spark, d, "asset").filter(F.coalesce(_sequence(), F.lit("")) != "").select("dataset", _sequence().alias("sequence"), "filename", "url", "modality")
    order = F.when(F.col("filename") == "video_0.mp4", 0).when(F.col("filename").like("%.mp4"), 1).otherwise(2)
    pick = a.groupBy("dataset", "sequence").agg(F.min(F.struct(order.alias("o"), "filename", "url")).alias("m"))
    return pick.select("dataset", "sequence", F.when(F.col("m.o") < 2, F.col("m.url")).otherwise(T.fill_template("store://default/{dataset}/{sequence}.mp4", {"dataset": F.col("dataset"), "sequence": F.col("sequence")})).alias("url"))


def _manifest(spark: SparkSession, d: str) -> DataFrame:
    doc = table(spark, d, "documents")
    bad = F.when(F.coalesce("text", F.lit("")) == "", "no text")
    ident = F.concat_ws(":", "source", F.coalesce("repo", F.lit("none")), "file_path")
    return doc.select(ident.alias("id"), F.col("source").alias("dataset"), F.concat_ws("/", "lang", F.col("doc_id").cast("string")).alias("video"), bad.alias("error"), F.col("doc_id").alias("ord"), "lang")


def join_manifests(spark: SparkSession, d: str) -> DataFrame:
    """Prose pages first, then all of three sources: first row of each id, errors dropped."""
    m = _manifest(spark, d)
    j = splits.join_manifests([(m.filter("lang IN ('markdown', 'rst')"), None), (m, ["mono-mirror", "doc-site", "plugin-hub"])])
    return j.select("id", "dataset", "video", "source_ord")


def pointer_scan(spark: SparkSession, d: str) -> DataFrame:
    """Pointers of usable clips."""
    return splits.pointers(_manifest(spark, d))


def _unique_pointers(spark: SparkSession, d: str) -> DataFrame:
    return splits.pointers(_manifest(spark, d)).groupBy("id").agg(F.min_by(F.struct("dataset", "video"), F.struct("video", "dataset")).alias("r")).select("id", "r.*")


RATIOS = [("train", 0.7), ("val", 0.15), ("test", 0.15)]


def stratified_split(spark: SparkSession, d: str) -> DataFrame:
    """Pointers split with exact quotas in every dataset."""
    return splits.stratified(_unique_pointers(spark, d), "id", "dataset", RATIOS, 7).select("id", "dataset", "split")


def episode_split(spark: SparkSession, d: str) -> DataFrame:
    """Orders split by their place in the hashed order of their priority."""
    o = table(spark, d, "orders").select(F.col("o_orderkey").cast("string").alias("id"), F.col("o_orderpriority").alias("grp"))
    return splits.proportional(o, "id", "grp", [("train", 8.0), ("val", 2.0)], 3).select("id", "grp", "split")


def split_counts_rollup(spark: SparkSession, d: str) -> DataFrame:
    """Clips per split and dataset, with totals."""
    return stratified_split(spark, d).rollup("split", "dataset").agg(F.count(F.lit(1)).alias("clips"))


def pull_manifest(spark: SparkSession, d: str) -> DataFrame:
    """Where the members of each split lie."""
    o = episode_split(spark, d).select("split", F.concat(F.col("grp"), F.lit(":"), F.col("id")).alias("id"))
    return splits.pull_manifest(o, "store://root/{dataset}/episodes/{episode}/episode.json")


def pointer_join_back(spark: SparkSession, d: str) -> DataFrame:
    """Pointers of the validation split joined back to the manifest."""
    val = stratified_split(spark, d).filter("split = 'val'").select("id")
    return _manifest(spark, d).filter("error IS NULL").join(val, "id").select("id", "ord", "lang")


def _versions(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    g = table(spark, d, "gaze_sample").select("sample_id", *EP, "ord", "t_s", "x", "y", "valid", "arrived_at")
    cols = F.struct(*EP, "ord", "t_s", "x", "y", "valid")
    # repeated rows share their stamp, so both ends are decided by it
    first = g.groupBy("sample_id").agg(F.min_by(cols, "arrived_at").alias("r")).select("sample_id", "r.*")
    last = g.groupBy("sample_id").agg(F.max_by(cols, "arrived_at").alias("r")).select("sample_id", "r.*")
    return first, last


TOLERANCES = {"t_s": 1e-6, "x": 1e-3, "y": 1e-3, "valid": None}


def validate_diff(spark: SparkSession, d: str) -> DataFrame:
    """Cells in which the first version of a sample differs from the last."""
    first, last = _versions(spark, d)
    return validate.differences(last, first, ["dataset", "episode_id", "ord", "sample_id"], TOLERANCES)


def first_difference(spark: SparkSession, d: str) -> DataFrame:
    """Of each episode: the first differing position and how many cells differ."""
    return validate.first_difference(validate_diff(spark, d), EP, "ord")


def validate_report(spark: SparkSession, d: str) -> DataFrame:
    """Differences by column and in all, and whether each check holds."""
    n = validate_diff(spark, d).groupBy("column").agg(F.count(F.lit(1)).alias("n"))
    names = spark.createDataFrame([(c,) for c in TOLERANCES], "name string")
    return validate.report(names.join(n, names["name"] == n["column"], "left").select("name", F.coalesce("n", F.lit(0)).alias("differences")))


def viewer_filter(spark: SparkSession, d: str) -> DataFrame:
    """Episodes of the list box: a dataset, part of the id in any case, a range of durations."""
    e = _episodes(spark, d)
    finite = F.col("duration_s").isNotNull() & ~F.isnan("duration_s")
    return e.filter((F.col("dataset") == "holoassist") & F.lower("episode_id").contains("loft") | ((F.col("dataset") == "egtea") & finite & F.col("duration_s").between(10, 5000))).select(*EP, "duration_s")


def viewer_roles(spark: SparkSession, d: str) -> DataFrame:
    """Segments by role, final before source before auxiliary, numbered within their episode and role."""
    s = table(spark, d, "segment").select("segment_id", *EP, F.lower(F.trim("channel")).alias("channel"), F.coalesce("start_s", "point_s").alias("at")).distinct()
    role = F.when(F.col("channel").isin("fine", "atomic", "action", "narration", "atomic_action"), "source").when(F.col("channel") == "coarse", "final").otherwise("auxiliary")
    s = s.withColumn("role", role).filter("at IS NOT NULL AND NOT isnan(at)").withColumn("us", F.round(F.col("at") * 1e6).cast("long"))
    return number_over(s, [*EP, "role"], "us", "segment_id", "i", 600_000_000).select("segment_id", "role", "i")


def message_list(spark: SparkSession, d: str) -> DataFrame:
    """Texts of each channel of an episode in order, as one line of messages."""
    s = table(spark, d, "segment").select("segment_id", *EP, F.lower(F.trim("channel")).alias("channel"), F.col("text"), "ord").distinct().filter(F.coalesce(F.trim("text"), F.lit("")) != "")
    return s.groupBy(*EP, "channel").agg(F.transform(F.sort_array(F.collect_list(F.struct("ord", "segment_id", "text"))), lambda x: x["text"]).alias("texts")).select(*EP, "channel", F.size("texts").cast("long").alias("n"), F.array_join("texts", "|").alias("messages"))


def eval_l2_acc(spark: SparkSession, d: str) -> DataFrame:
    """Each sample predicted by the one before: mean distance in a 0-100 square and shares within 5, 10, 15."""
    s, _ = _boxed(spark, d)
    s = s.filter("width > 0 AND height > 0").withColumn("us", F.round(F.col("t_s") * 1e6).cast("long"))
    s = lag_over(s, EP, "us", "sample_id", F.struct("x", "y"), "b", 600_000_000).filter("b IS NOT NULL")
    dx, dy = (F.col("x") - F.col("b.x")) / F.col("width") * 100, (F.col("y") - F.col("b.y")) / F.col("height") * 100
    s = s.withColumn("l2", F.round(F.sqrt(dx * dx + dy * dy), 4))
    g = s.groupBy("dataset").agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("l2").cast("decimal(20,4)")).alias("sum"), *[F.count_if(F.col("l2") <= r).alias(f"n{r}") for r in (5, 10, 15)])
    return g.select("dataset", "n", F.round(F.col("sum").cast("double") / F.col("n"), 4).alias("l2"), *[F.round(F.col(f"n{r}") / F.col("n"), 6).alias(f"acc{r}") for r in (5, 10, 15)])


def url_basename(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "asset").select("asset_id", "url").distinct().select("asset_id", T.url_basename(F.col("url")).alias("name"))


def id_parts(spark: SparkSession, d: str) -> DataFrame:
    """Datasets and safe file names of clip ids."""
    return _manifest(spark, d).select("ord", T.dataset_of(F.col("id")).alias("dataset"), T.safe_name(F.col("id")).alias("name"))


def time_units(spark: SparkSession, d: str) -> DataFrame:
    """One instant written in every unit, read back as seconds."""
    e = table(spark, d, "episode").filter("duration_s IS NOT NULL AND NOT isnan(duration_s)").select(*EP, F.round(F.col("duration_s") * 1000).cast("long").alias("ms")).distinct()
    c = lambda k: (F.col("ms") * k).cast("string")
    clock = F.concat_ws(":", (F.col("ms") / 3_600_000).cast("long").cast("string"), (F.col("ms") / 60_000 % 60).cast("long").cast("string"), F.concat_ws(".", (F.col("ms") / 1000 % 60).cast("long").cast("string"), F.lpad((F.col("ms") % 1000).cast("string"), 3, "0")))
    units = {"from_ms": TM.to_seconds(F.col("ms").cast("string"), "ms"), "from_us": TM.to_seconds(c(1000), "us"), "from_ns": TM.to_seconds(c(1_000_000), "ns"), "from_ticks": TM.to_seconds(c(10_000), "filetime_100ns"), "from_frames": TM.to_seconds(F.col("ms").cast("string"), "frame_index", 1000), "from_clock": TM.to_seconds(clock, "hms_decimal"), "guess": TM.guess_seconds(c(1_000_000), "t_ns")}
    return e.select(*EP, "ms", *[F.round(v, 3).alias(k) for k, v in units.items()])


def modality_infer(spark: SparkSession, d: str) -> DataFrame:
    """Modality and format of assets from their file names."""
    return table(spark, d, "asset").filter("filename IS NOT NULL").select("asset_id", "filename").distinct().select("asset_id", catalog.modality(F.col("filename")).alias("modality"), catalog.file_format(F.col("filename")).alias("format"))


def name_normalise(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "documents").select("doc_id", catalog.dataset_name(F.col("repo")).alias("name"))


GLOBS = ["*loft*", "P1?-*", "z000000[0-4]*"]


def glob_exclude(spark: SparkSession, d: str) -> DataFrame:
    """Episodes that no exclusion pattern matches."""
    e = table(spark, d, "episode").select(*EP).distinct()
    return e.filter(~glob(F.col("episode_id"), GLOBS))


def manifest_filter(spark: SparkSession, d: str) -> DataFrame:
    """Episodes of three datasets that have all of the requested modalities."""
    want = F.array(F.lit("gaze"), F.lit("annotations"))
    return _episodes(spark, d).filter(F.col("dataset").isin("egome", "egtea", "hd-epic") & (F.size(F.array_except(want, F.coalesce("modalities", F.array().cast("array<string>")))) == 0)).select(*EP)


def rating_verdict(spark: SparkSession, d: str) -> DataFrame:
    """Documents with the band most raters gave; without any: unrated."""
    r = table(spark, d, "reading_label").select("doc_id", "rater", "band").distinct().groupBy("doc_id", "band").agg(F.count(F.lit(1)).alias("n"))
    best = r.groupBy("doc_id").agg(F.max_by("band", F.struct("n", "band")).alias("band"), F.sum("n").alias("votes"))
    return table(spark, d, "documents").select("doc_id").join(best, "doc_id", "left").select("doc_id", F.coalesce("band", F.lit("unrated")).alias("band"), F.coalesce("votes", F.lit(0)).alias("votes"))


def dimension_join(spark: SparkSession, d: str) -> DataFrame:
    """Orders by region and segment over three dimensions: customers, nations, regions."""
    c = table(spark, d, "customer").join(table(spark, d, "nation"), F.col("c_nationkey") == F.col("n_nationkey")).join(table(spark, d, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    o = table(spark, d, "orders").select("o_custkey", "o_totalprice")
    return o.join(c, F.col("o_custkey") == F.col("c_custkey")).groupBy("r_name", "c_mktsegment").agg(F.count(F.lit(1)).alias("orders"), F.round(F.sum(F.col("o_totalprice").cast("decimal(20,2)")).cast("double"), 2).alias("total"))


def resume_pending(spark: SparkSession, d: str) -> DataFrame:
    """Episodes still to be built: listed, not excluded, without segments so far or with a later upload."""
    e = _episodes(spark, d).select(*EP, "uploaded_at")
    done = table(spark, d, "segment").groupBy(*EP).agg(F.max("arrived_at").alias("done_at"))
    return e.join(done, EP, "left").filter("done_at IS NULL OR uploaded_at > done_at").select(*EP)


_Q = """letterbox_bins pinhole_project predicate_filter emit_policy anti_denylist anti_known_union semi_key bridge_first_match asset_summary sequence_profile asset_status pick_file pick_prefer join_manifests pointer_scan
stratified_split episode_split split_counts_rollup pull_manifest pointer_join_back validate_diff first_difference validate_report viewer_filter viewer_roles message_list eval_l2_acc url_basename id_parts time_units
modality_infer name_normalise glob_exclude manifest_filter rating_verdict dimension_join resume_pending""".split()
QUERIES = {n: globals()[n] for n in _Q}

_LATEST = """latest AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY sample_id ORDER BY arrived_at DESC NULLS LAST) rn FROM gaze_sample) WHERE rn = 1),
us AS (SELECT dataset, episode_id, sample_id, t_s, x, y FROM latest WHERE valid AND t_s >= 0 AND NOT isnan(t_s) AND NOT isinf(t_s) AND x IS NOT NULL AND NOT isnan(x) AND y IS NOT NULL AND NOT isnan(y))"""
_EPS = "eps AS (SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY dataset, episode_id ORDER BY uploaded_at DESC NULLS LAST, take_uid DESC NULLS LAST, wearer_id DESC NULLS LAST, duration_s DESC NULLS LAST) rn FROM episode) WHERE rn = 1)"
_MAN = "man AS (SELECT concat_ws(':', source, coalesce(repo, 'none'), file_path) id, source dataset, concat_ws('/', lang, CAST(doc_id AS VARCHAR)) video, CASE WHEN coalesce(text, '') = '' THEN 'no text' END error, doc_id ord, lang FROM documents)"
_PTR = f"{_MAN}, ptr AS (SELECT id, coalesce(nullif(dataset, ''), CASE WHEN contains(id, ':') THEN split_part(id, ':', 1) ELSE 'unknown' END) dataset, video FROM man WHERE coalesce(trim(id), '') <> '' AND error IS NULL)"
_STR = f"""{_PTR}, up AS (SELECT id, dataset, video FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY video, dataset) k FROM ptr) WHERE k = 1),
n AS (SELECT dataset, count(*) n FROM up GROUP BY 1), q AS (SELECT dataset, n, i, s, q, floor(q * n) b, q * n - floor(q * n) f FROM n, (VALUES (0, 'train', CAST(0.7 AS DOUBLE)), (1, 'val', CAST(0.15 AS DOUBLE)), (2, 'test', CAST(0.15 AS DOUBLE))) r(i, s, q)),
g AS (SELECT *, b + CASE WHEN row_number() OVER (PARTITION BY dataset ORDER BY f DESC, q DESC, i) <= n - sum(b) OVER (PARTITION BY dataset) THEN 1 ELSE 0 END c FROM q),
e AS (SELECT dataset, s, sum(c) OVER (PARTITION BY dataset ORDER BY i) hi, c FROM g),
o AS (SELECT *, row_number() OVER (PARTITION BY dataset ORDER BY md5(concat_ws(':', '7', dataset, id)), id) - 1 p FROM up),
st AS (SELECT o.id, o.dataset, e.s split FROM o JOIN e ON o.dataset = e.dataset AND o.p >= e.hi - e.c AND o.p < e.hi)"""
_ESP = """esp AS (SELECT id, grp, CASE WHEN (p - 0.5) / n <= 0.8 + 1e-12 THEN 'train' ELSE 'val' END split FROM (SELECT CAST(o_orderkey AS VARCHAR) id, o_orderpriority grp, row_number() OVER (PARTITION BY o_orderpriority ORDER BY md5(concat_ws(':', '3', o_orderpriority, CAST(o_orderkey AS VARCHAR))), CAST(o_orderkey AS VARCHAR)) p, count(*) OVER (PARTITION BY o_orderpriority) n FROM orders))"""
_SEQ = "aset AS (SELECT *, lower(trim(sequence_id)) sequence FROM asset WHERE coalesce(trim(sequence_id), '') <> '')"
_VER = """v AS (SELECT *, row_number() OVER (PARTITION BY sample_id ORDER BY arrived_at) f, row_number() OVER (PARTITION BY sample_id ORDER BY arrived_at DESC) l FROM gaze_sample),
a AS (SELECT * FROM v WHERE f = 1), e AS (SELECT * FROM v WHERE l = 1),
keyed AS (SELECT e.dataset, e.episode_id, e.ord, e.sample_id, e.t_s t1, a.t_s t2, e.x x1, a.x x2, e.y y1, a.y y2, e.valid v1, a.valid v2 FROM e JOIN a ON e.dataset = a.dataset AND e.episode_id = a.episode_id AND e.ord = a.ord AND e.sample_id = a.sample_id),
cells AS (SELECT dataset, episode_id, ord, sample_id, unnest([CASE WHEN NOT same(t1, t2, 1e-6) THEN 't_s' END, CASE WHEN NOT same(x1, x2, 1e-3) THEN 'x' END, CASE WHEN NOT same(y1, y2, 1e-3) THEN 'y' END, CASE WHEN v1 IS DISTINCT FROM v2 THEN 'valid' END]) c FROM keyed),
diff AS (SELECT dataset, episode_id, ord, sample_id, c AS "column", 'differs' AS kind FROM cells WHERE c IS NOT NULL
 UNION ALL SELECT dataset, episode_id, ord, sample_id, '*', 'missing' FROM e WHERE NOT EXISTS (SELECT 1 FROM a WHERE e.dataset = a.dataset AND e.episode_id = a.episode_id AND e.ord = a.ord AND e.sample_id = a.sample_id)
 UNION ALL SELECT dataset, episode_id, ord, sample_id, '*', 'unexpected' FROM a WHERE NOT EXISTS (SELECT 1 FROM e WHERE e.dataset = a.dataset AND e.episode_id = a.episode_id AND e.ord = a.ord AND e.sample_id = a.sample_id))"""
_VER = re.sub(r"same\((\w+), (\w+), ([\de-]+)\)", r"(CASE WHEN \1 IS NULL OR \2 IS NULL THEN \1 IS NULL AND \2 IS NULL WHEN isnan(\1) AND isnan(\2) THEN true ELSE abs(\1 - \2) <= \3 END)", _VER)
_BOX = f"least({SIDE} / CAST(r.width AS DOUBLE), {SIDE} / CAST(r.height AS DOUBLE))"


ORACLES = {
    "letterbox_bins": f"""WITH {_LATEST}, b AS (SELECT sample_id, x, y, r.width w, r.height h, {_BOX} k FROM us JOIN recipe r ON us.dataset = r.dataset), p AS (SELECT *, ({SIDE} - w * k) / 2 ox, ({SIDE} - h * k) / 2 oy FROM b), q AS (SELECT *, ox + x * k px, oy + y * k py FROM p)
SELECT sample_id, CAST(round_even(greatest(0.0, least(1.0, px / {SIDE})) * 1000, 0) AS INT) AS x_bin, CAST(round_even(greatest(0.0, least(1.0, py / {SIDE})) * 1000, 0) AS INT) AS y_bin,
 px BETWEEN ox - 0.5 AND {SIDE} - ox + 0.5 AND py BETWEEN oy - 0.5 AND {SIDE} - oy + 0.5 AS on_picture, coalesce(x >= 0 AND x < w AND y >= 0 AND y < h, false) AS in_frame FROM q""",
    "pinhole_project": """WITH l AS (SELECT pose_id, m FROM (SELECT *, row_number() OVER (PARTITION BY pose_id ORDER BY arrived_at DESC NULLS LAST) k FROM pose) WHERE k = 1 AND tracked AND len(m) = 16),
c AS (SELECT pose_id, m, CAST(0.1 AS DOUBLE) + CAST(0.8 AS DOUBLE) * CAST(1.0 AS DOUBLE) - m[4] a, CAST(0.0 AS DOUBLE) + CAST(0.2 AS DOUBLE) * CAST(1.0 AS DOUBLE) - m[8] b, CAST(0.0 AS DOUBLE) + CAST(-0.1 AS DOUBLE) * CAST(1.0 AS DOUBLE) - m[12] c FROM l),
r AS (SELECT pose_id, m[1] * a + m[5] * b + m[9] * c u, m[2] * a + m[6] * b + m[10] * c v, m[3] * a + m[7] * b + m[11] * c w FROM c),
p AS (SELECT pose_id, CASE WHEN u > 1e-9 THEN CAST(445.4 AS DOUBLE) - CAST(681.4 AS DOUBLE) * v / u END x, CASE WHEN u > 1e-9 THEN CAST(237.4 AS DOUBLE) - CAST(682.4 AS DOUBLE) * w / u END y FROM r)
SELECT pose_id, round(x, 4) AS px, round(y, 4) AS py, coalesce(x >= 0 AND x < 896 AND y >= 0 AND y < 504, false) AS in_frame FROM p""",
    "predicate_filter": "SELECT predicate, CAST(kept AS BIGINT) AS kept FROM (" + " UNION ALL ".join(f"SELECT '{p.replace(chr(39), chr(39) * 2)}' AS predicate, (SELECT count(*) FROM asset WHERE {s}) AS kept" for p, s in zip(PREDICATES, ("modality IS NOT DISTINCT FROM 'gaze'", "modality IS DISTINCT FROM 'gaze'", "size_bytes >= 1000000", "size_bytes < 10", "sha1 IS NULL", "sequence_id IS NOT NULL", "coalesce(sha1, '') <> ''", "size_bytes = 0", "try_cast(filename AS DOUBLE) > 5", "true", "dataset IS NOT NULL", "true"))) + ")",
    "emit_policy": f"""WITH {_LATEST}, {_EPS}, g AS (SELECT dataset, episode_id, count(*) n FROM us GROUP BY 1, 2), s AS (SELECT dataset, episode_id, count(DISTINCT segment_id) n FROM segment GROUP BY 1, 2),
j AS (SELECT e.dataset, e.episode_id, concat_ws('; ', CASE WHEN NOT coalesce(e.duration_s > 0, false) THEN 'no duration' END, CASE WHEN g.n IS NULL THEN 'no samples' END, CASE WHEN s.n IS NULL THEN 'no segments' END) reason, coalesce(g.n, 0) samples, coalesce(s.n, 0) segments
 FROM eps e LEFT JOIN g ON e.dataset = g.dataset AND e.episode_id = g.episode_id LEFT JOIN s ON e.dataset = s.dataset AND e.episode_id = s.episode_id) SELECT dataset, episode_id, reason = '' AS emitted, reason, samples, segments FROM j""",
    "anti_denylist": "SELECT o_orderkey, o_custkey FROM orders o WHERE NOT EXISTS (SELECT 1 FROM customer c WHERE c.c_custkey = o.o_custkey AND c.c_acctbal < 0)",
    "anti_known_union": "SELECT DISTINCT o_custkey AS c_custkey, true AS found FROM orders UNION ALL SELECT c_custkey, false FROM customer c WHERE c_mktsegment = 'BUILDING' AND NOT EXISTS (SELECT 1 FROM orders o WHERE o.o_custkey = c.c_custkey)",
    "semi_key": "SELECT DISTINCT segment_id, dataset, episode_id FROM segment s WHERE EXISTS (SELECT 1 FROM episode e WHERE e.dataset = s.dataset AND e.episode_id = s.episode_id)",
    "bridge_first_match": "SELECT take_uid, arg_min(dataset, (dataset, episode_id)) AS dataset, arg_min(episode_id, (dataset, episode_id)) AS episode_id, count(DISTINCT (dataset, episode_id)) AS n FROM episode WHERE take_uid IS NOT NULL GROUP BY 1",
    "asset_summary": "SELECT dataset, modality, count(*) AS assets, count(DISTINCT sequence_id) AS sequences, CAST(sum(coalesce(size_bytes, 0)) AS BIGINT) AS bytes, count(*) FILTER (size_bytes IS NULL) AS unknown, round(sum(coalesce(size_bytes, 0)) / 1e9, 3) AS gb FROM (SELECT DISTINCT asset_id, dataset, modality, sequence_id, size_bytes FROM asset) GROUP BY ROLLUP (dataset, modality)",
    "sequence_profile": f"WITH {_SEQ} SELECT dataset, sequence, count(DISTINCT asset_id) AS assets, coalesce(string_agg(DISTINCT modality, ',' ORDER BY modality), '') AS modalities, max(size_bytes) AS largest FROM aset GROUP BY 1, 2",
    "asset_status": """WITH a AS (SELECT DISTINCT url, asset_id, size_bytes, sha1, listed_at FROM asset WHERE url IS NOT NULL), f AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY url ORDER BY listed_at, asset_id) k FROM a) WHERE k = 1), l AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY url ORDER BY listed_at DESC, asset_id DESC) k FROM a WHERE size_bytes > 0) WHERE k = 1),
r AS (SELECT f.url path, CASE WHEN l.url IS NULL THEN 'missing' WHEN f.size_bytes IS NOT NULL AND f.size_bytes <> l.size_bytes THEN 'size' WHEN f.url LIKE '%.part' THEN 'partial' WHEN f.sha1 IS NOT NULL AND l.sha1 IS NOT NULL AND lower(f.sha1) <> lower(l.sha1) THEN 'sha1' ELSE 'ok' END reason FROM f LEFT JOIN l ON f.url = l.url) SELECT path, reason = 'ok' AS complete, reason FROM r""",
    "pick_file": f"WITH {_SEQ}, r AS (SELECT dataset, sequence, modality, filename, coalesce(size_bytes, -1) size, CASE WHEN filename LIKE '%.json' THEN 2 WHEN regexp_matches(filename, '\\.(csv|txt|npy)$') THEN 1 ELSE 0 END rank FROM aset WHERE filename IS NOT NULL) SELECT dataset, sequence, modality, filename, size AS size_bytes FROM (SELECT *, row_number() OVER (PARTITION BY dataset, sequence, modality ORDER BY rank DESC, size DESC, filename DESC) k FROM r) WHERE k = 1",
    "pick_prefer": f"WITH {_SEQ}, r AS (SELECT dataset, sequence, filename, url, CASE WHEN filename = 'video_0.mp4' THEN 0 WHEN filename LIKE '%.mp4' THEN 1 ELSE 2 END o FROM aset) SELECT dataset, sequence, CASE WHEN o < 2 THEN url ELSE replace(replace('store://default/{{dataset}}/{{sequence}}.mp4', '{{dataset}}', dataset), '{{sequence}}', sequence) END AS url FROM (SELECT *, row_number() OVER (PARTITION BY dataset, sequence ORDER BY o, filename NULLS FIRST, url NULLS FIRST) k FROM r) WHERE k = 1",
    "join_manifests": f"WITH {_MAN}, u AS (SELECT *, 0 s FROM man WHERE lang IN ('markdown', 'rst') UNION ALL SELECT *, 1 FROM man WHERE dataset IN ('mono-mirror', 'doc-site', 'plugin-hub')) SELECT id, dataset, video, s AS source_ord FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY s, ord) k FROM u WHERE error IS NULL AND coalesce(id, '') <> '') WHERE k = 1",
    "pointer_scan": f"WITH {_PTR} SELECT * FROM ptr",
    "stratified_split": f"WITH {_STR} SELECT id, dataset, split FROM st",
    "episode_split": f"WITH {_ESP} SELECT id, grp, split FROM esp",
    "split_counts_rollup": f"WITH {_STR} SELECT split, dataset, count(*) AS clips FROM st GROUP BY ROLLUP (split, dataset)",
    "pull_manifest": f"WITH {_ESP} SELECT split, grp AS dataset, id AS episode, 'store://root/' || grp || '/episodes/' || id || '/episode.json' AS uri FROM esp",
    "pointer_join_back": f"WITH {_STR} SELECT m.id, m.ord, m.lang FROM man m JOIN st ON m.id = st.id AND st.split = 'val' WHERE m.error IS NULL",
    "validate_diff": f"WITH {_VER} SELECT * FROM diff",
    "first_difference": f'WITH {_VER} SELECT dataset, episode_id, arg_min("column", (ord, "column")) AS "column", min(ord) AS position, count(*) AS total FROM diff GROUP BY 1, 2',
    "validate_report": f"""WITH {_VER}, n AS (SELECT c.name, count(d."column") differences FROM (VALUES ('t_s'), ('x'), ('y'), ('valid')) c(name) LEFT JOIN diff d ON d."column" = c.name GROUP BY 1) SELECT name, differences = 0 AS ok, differences FROM n UNION ALL SELECT 'all', sum(differences) = 0, CAST(sum(differences) AS BIGINT) FROM n""",
    "viewer_filter": f"WITH {_EPS} SELECT dataset, episode_id, duration_s FROM eps WHERE (dataset = 'holoassist' AND contains(lower(episode_id), 'loft')) OR (dataset = 'egtea' AND NOT isnan(duration_s) AND duration_s BETWEEN 10 AND 5000)",
    "viewer_roles": """WITH s AS (SELECT DISTINCT segment_id, dataset, episode_id, lower(trim(channel)) channel, coalesce(start_s, point_s) a FROM segment), r AS (SELECT *, CASE WHEN channel IN ('fine', 'atomic', 'action', 'narration', 'atomic_action') THEN 'source' WHEN channel = 'coarse' THEN 'final' ELSE 'auxiliary' END role, CAST(round(a * 1e6) AS BIGINT) us FROM s WHERE a IS NOT NULL AND NOT isnan(a))
SELECT segment_id, role, row_number() OVER (PARTITION BY dataset, episode_id, role ORDER BY us, segment_id) - 1 AS i FROM r""",
    "message_list": "WITH s AS (SELECT DISTINCT segment_id, dataset, episode_id, lower(trim(channel)) channel, text, ord FROM segment WHERE coalesce(trim(text), '') <> '') SELECT dataset, episode_id, channel, count(*) AS n, string_agg(text, '|' ORDER BY ord, segment_id, text) AS messages FROM s GROUP BY 1, 2, 3",
    "eval_l2_acc": f"""WITH {_LATEST}, b AS (SELECT us.dataset, us.episode_id, sample_id, x, y, r.width w, r.height h, CAST(round(t_s * 1e6) AS BIGINT) u FROM us JOIN recipe r ON us.dataset = r.dataset WHERE r.width > 0 AND r.height > 0),
l AS (SELECT dataset, (x - lag(x) OVER q) / w * 100 dx, (y - lag(y) OVER q) / h * 100 dy FROM b WINDOW q AS (PARTITION BY dataset, episode_id ORDER BY u, sample_id)), d AS (SELECT dataset, round(sqrt(dx * dx + dy * dy), 4) l2 FROM l WHERE dx IS NOT NULL)
SELECT dataset, count(*) AS n, round(CAST(sum(CAST(l2 AS DECIMAL(20, 4))) AS DOUBLE) / count(*), 4) AS l2, round(count(*) FILTER (l2 <= 5) / count(*), 6) AS acc5, round(count(*) FILTER (l2 <= 10) / count(*), 6) AS acc10, round(count(*) FILTER (l2 <= 15) / count(*), 6) AS acc15 FROM d GROUP BY 1""",
    "url_basename": "SELECT asset_id, regexp_extract(split_part(url, '?', 1), '[^/]*$') AS name FROM (SELECT DISTINCT asset_id, url FROM asset)",
    "id_parts": f"WITH {_MAN} SELECT ord, CASE WHEN contains(id, ':') THEN split_part(id, ':', 1) ELSE 'unknown' END AS dataset, replace(replace(id, '/', '__'), ':', '_') AS name FROM man",
    "time_units": "SELECT DISTINCT dataset, episode_id, ms, " + ", ".join(f"round(ms / CAST(1000 AS DOUBLE), 3) AS {u}" for u in ("from_ms", "from_us", "from_ns", "from_ticks", "from_frames", "from_clock", "guess")) + " FROM (SELECT dataset, episode_id, CAST(round(duration_s * 1000) AS BIGINT) ms FROM episode WHERE duration_s IS NOT NULL AND NOT isnan(duration_s))",
    "modality_infer": r"""WITH a AS (SELECT DISTINCT asset_id, lower(filename) f, CASE WHEN lower(filename) LIKE '%.tar.gz' THEN 'tgz' ELSE regexp_extract(lower(filename), '\.([a-z0-9]+)$', 1) END s FROM asset WHERE filename IS NOT NULL),
k AS (SELECT *, CASE WHEN s IN ('mp4', 'mov', 'mkv', 'avi', 'webm', 'vrs') THEN 'video' WHEN s IN ('csv', 'jsonl', 'parquet') THEN 'table' WHEN s = 'json' THEN 'json' WHEN s IN ('zip', 'tar', 'tgz', 'gz', 'bz2', 'xz') THEN 'archive' ELSE 'binary' END format FROM a)
SELECT asset_id, CASE WHEN f LIKE '%gaze%' OR f LIKE '%eye%' OR f LIKE '%etdata%' THEN 'gaze' WHEN f LIKE '%annot%' OR f LIKE '%narration%' OR f LIKE '%action%' OR f LIKE '%label%' OR f LIKE '%ground\_truth%' ESCAPE '\' THEN 'annotation'
 WHEN f LIKE '%depth%' OR f LIKE '%point\_cloud%' ESCAPE '\' OR f LIKE '%semidense%' THEN 'depth' WHEN f LIKE '%pose%' OR f LIKE '%hand%' OR f LIKE '%motion%' OR f LIKE '%mvnx%' OR f LIKE '%slam\_trajectories%' ESCAPE '\' THEN 'pose'
 WHEN format = 'video' OR f LIKE '%video%' OR f LIKE '%rgb%' OR f LIKE '%preview%' OR f LIKE '%takes%' THEN 'video' ELSE 'other' END AS modality, format FROM k""",
    "name_normalise": """WITH a(k, v) AS (VALUES ('ariaeverydayactivities', 'aea'), ('aria_everyday_activities', 'aea'), ('hot3daria', 'hot3d'), ('ariadigitaltwin', 'adt'), ('aria_digital_twin', 'adt'), ('aria digital twin', 'adt'), ('egtea gaze+', 'egtea'), ('ego4d', 'ego-exo4d')),
n AS (SELECT doc_id, lower(trim(repo)) s, regexp_replace(lower(repo), '[^a-z0-9+_-]+', '', 'g') c FROM documents) SELECT doc_id, coalesce(x.v, y.v, c) AS name FROM n LEFT JOIN a x ON n.s = x.k LEFT JOIN a y ON n.c = y.k""",
    "glob_exclude": "SELECT DISTINCT dataset, episode_id FROM episode WHERE episode_id IS NULL OR NOT (episode_id GLOB '*loft*' OR episode_id GLOB 'P1?-*' OR episode_id GLOB 'z000000[0-4]*')",
    "manifest_filter": f"WITH {_EPS} SELECT dataset, episode_id FROM eps WHERE dataset IN ('egome', 'egtea', 'hd-epic') AND list_has_all(coalesce(modalities, []), ['gaze', 'annotations'])",
    "rating_verdict": "WITH r AS (SELECT doc_id, band, count(*) n FROM (SELECT DISTINCT doc_id, rater, band FROM reading_label) GROUP BY 1, 2), b AS (SELECT doc_id, arg_max(band, (n, band)) band, CAST(sum(n) AS BIGINT) votes FROM r GROUP BY 1) SELECT d.doc_id, coalesce(b.band, 'unrated') AS band, coalesce(b.votes, 0) AS votes FROM documents d LEFT JOIN b ON d.doc_id = b.doc_id",
    "dimension_join": "SELECT r_name, c_mktsegment, count(*) AS orders, round(CAST(sum(CAST(o_totalprice AS DECIMAL(20, 2))) AS DOUBLE), 2) AS total FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey GROUP BY 1, 2",
    "resume_pending": f"WITH {_EPS}, s AS (SELECT dataset, episode_id, max(arrived_at) done_at FROM segment GROUP BY 1, 2) SELECT e.dataset, e.episode_id FROM eps e LEFT JOIN s ON e.dataset = s.dataset AND e.episode_id = s.episode_id WHERE s.done_at IS NULL OR e.uploaded_at > s.done_at",
}
