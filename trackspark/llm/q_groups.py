"""p5: assets of related recordings, and splits that keep them together."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trackspark.llm.groups import assign, components, hot_keys, join_spread
from trackspark.session import durable, table


def _clean(c: str):
    bare = F.lower(F.regexp_replace(c, r"^\s+|\s+$", ""))
    return F.when(bare != "", bare)


def _assets(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "asset").select("asset_id", "dataset", "sequence_id", "sha1", "size_bytes")


def _groups(a: DataFrame, more: list | None = None) -> DataFrame:
    recording = F.concat_ws("\u0001", F.lit("recording"), "dataset", _clean("sequence_id"))
    recording = F.when(F.col("dataset").isNotNull() & _clean("sequence_id").isNotNull(), recording)
    file = F.when((F.col("size_bytes") > 0) & _clean("sha1").isNotNull(), F.concat(F.lit("file:"), _clean("sha1")))
    return components(a, "asset_id", recording, F.array(file, *(more or [])))


def p5_found(spark: SparkSession, d: str) -> DataFrame:
    """Assets that are not the smallest of their group, with the smallest."""
    return _groups(_assets(spark, d)).filter("asset_id <> group_id").select(F.col("group_id").alias("group_asset_id"), "asset_id")


def _by_wearer(spark: SparkSession, d: str) -> DataFrame:
    """Assets with the wearer of their recording as one more entity."""
    a = _assets(spark, d).withColumn("__seq", _clean("sequence_id"))
    e = table(spark, d, "episode").select("dataset", _clean("episode_id").alias("__seq"), "wearer_id").filter("wearer_id IS NOT NULL").distinct()
    return a.join(e, ["dataset", "__seq"], "left")


def _split(spark: SparkSession, d: str) -> DataFrame:
    """(request_id, asset_id, group_id, label, subset) for every request and asset."""
    reqs: dict = {}
    for r in table(spark, d, "split_request").collect():  # 8 rows, fixed
        reqs.setdefault(r.group_by, {}).setdefault(r.request_id, (r.seed, []))[1].append((r.subset, r.ratio))
    label = _assets(spark, d).filter("asset_id IS NOT NULL").groupBy("asset_id").agg(F.min("dataset").alias("label"))
    out = None
    for group_by, requests in sorted(reqs.items()):  # the kinds of entity, two
        if group_by == "wearer_id":
            a = _by_wearer(spark, d)
            found = _groups(a, [F.when(F.col("wearer_id").isNotNull(), F.concat_ws("\u0001", F.lit("wearer"), "dataset", "wearer_id"))])
        else:
            found = _groups(_assets(spark, d))
        g = durable(found.join(label, "asset_id"))
        placed = assign(g.groupBy("group_id", "label").agg(F.count(F.lit(1)).alias("n")), requests)
        sizes = durable(g.groupBy("group_id").agg(F.count(F.lit(1)).alias("rows")))
        where = placed.groupBy("group_id").agg(F.collect_list(F.struct(F.col("request").alias("request_id"), "subset")).alias("where"))  # an entry a request
        part = join_spread(g, where, "group_id", hot_keys(sizes, "group_id", "rows")).select("asset_id", "group_id", "label", F.inline("where"))
        out = part if out is None else out.unionByName(part)
    return out


def p5_splits(spark: SparkSession, d: str) -> DataFrame:
    """(request_id, asset_id, group_id, subset) for every request and asset."""
    return _split(spark, d).select("request_id", "asset_id", "group_id", "subset")


def p5_shares(spark: SparkSession, d: str) -> DataFrame:
    """Of each request, label ("all": whatever the label) and subset: ratio, share reached, assets, deviation.

    ``least`` is a deviation of some subset that the label's groups make unavoidable.
    """
    s = durable(_split(spark, d).withColumn("label", F.explode(F.array(F.lit("all"), F.coalesce("label", F.lit(""))))))
    n = s.groupBy("request_id", "label", "subset").agg(F.count(F.lit(1)).alias("assets"))
    whole = n.groupBy("request_id", "label").agg(F.sum("assets").alias("total"))
    largest = s.groupBy("request_id", "label", "group_id").agg(F.count(F.lit(1)).alias("n")).groupBy("request_id", "label").agg(F.max("n").alias("largest"))
    r = table(spark, d, "split_request").withColumn("ratio", F.greatest(F.coalesce("ratio", F.lit(0.0)), F.lit(0.0)))
    norm = r.groupBy("request_id").agg(F.sum("ratio").alias("sum"), F.max("ratio").alias("most"))
    each = whole.join(largest, ["request_id", "label"]).join(r.select("request_id", "subset", "ratio").join(norm, "request_id"), "request_id").join(n, ["request_id", "label", "subset"], "left")
    ratio, share = F.col("ratio") / F.col("sum"), F.coalesce("assets", F.lit(0)) / F.col("total")
    least = F.greatest(F.lit(0.0), F.col("largest") / F.col("total") - F.col("most") / F.col("sum"))
    return each.select("request_id", "label", "subset", F.round(ratio, 6).alias("ratio"), F.round(share, 6).alias("share"), F.coalesce("assets", F.lit(0)).alias("assets"), F.round(F.abs(share - ratio), 6).alias("deviation"), F.round(least, 6).alias("least"))


def p5_bounds(spark: SparkSession, d: str) -> DataFrame:
    """Of each request: assets placed, and what breaks a rule (none).

    ``torn``: groups in several subsets; ``twice``: assets placed more than once; ``off``: subsets that
    miss their quota by more than the largest group.
    """
    s = durable(_split(spark, d))
    r = table(spark, d, "split_request")
    total = r.groupBy("request_id").agg(F.sum("ratio").alias("whole"))
    groups = s.groupBy("request_id", "group_id").agg(F.count(F.lit(1)).alias("n"), F.min("subset").alias("lo"), F.max("subset").alias("hi"))
    torn = groups.groupBy("request_id").agg(F.count_if(F.col("lo") != F.col("hi")).alias("torn"), F.max("n").alias("largest"), F.sum("n").alias("assets"))
    twice = s.groupBy("request_id", "asset_id").agg(F.count(F.lit(1)).alias("n")).groupBy("request_id").agg(F.count_if(F.col("n") > 1).alias("twice"))
    got = r.join(s.groupBy("request_id", "subset").agg(F.count(F.lit(1)).alias("n")), ["request_id", "subset"], "left").join(total, "request_id").join(torn, "request_id")
    off = F.abs(F.coalesce("n", F.lit(0)) - F.col("assets") * F.col("ratio") / F.col("whole")) > F.col("largest")
    return got.groupBy("request_id", "assets", "torn").agg(F.count_if(off).alias("off")).join(twice, "request_id").select("request_id", "assets", "torn", "twice", "off")


QUERIES = {f.__name__: f for f in (p5_found, p5_splits, p5_shares, p5_bounds)}

ORACLES = {
    "p5_found": """WITH RECURSIVE a AS (SELECT DISTINCT asset_id, CASE WHEN trim(sequence_id) <> '' THEN dataset || chr(1) || lower(trim(sequence_id)) END q, CASE WHEN size_bytes > 0 AND trim(sha1) <> '' THEN lower(trim(sha1)) END h FROM asset),
l AS (SELECT asset_id, 'q' || q e FROM a WHERE q IS NOT NULL UNION SELECT asset_id, 'h' || h FROM a WHERE h IS NOT NULL),
m AS (SELECT e, min(asset_id) lo FROM l GROUP BY e),
pairs AS (SELECT DISTINCT asset_id x, lo y FROM l JOIN m USING (e) WHERE asset_id <> lo),
sides AS (SELECT x, y FROM pairs UNION SELECT y, x FROM pairs),
r(x, y) AS (SELECT DISTINCT x, x FROM sides UNION SELECT r.x, b.y FROM r JOIN sides b ON r.y = b.x)
SELECT min(y) AS group_asset_id, x AS asset_id FROM r GROUP BY x HAVING min(y) <> x""",
    # which group goes where is a free choice: the rules of the split are compared
    "p5_bounds": """SELECT request_id, (SELECT count(DISTINCT asset_id) FROM asset) AS assets, CAST(0 AS BIGINT) AS torn, CAST(0 AS BIGINT) AS twice, CAST(0 AS BIGINT) AS "off" FROM split_request GROUP BY 1""",
}
