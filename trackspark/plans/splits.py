"""Manifests and splits: pointer scans, joining manifests, exact-quota and episode splits.

Order within a stratum is ``md5(seed:stratum:id), id``: it needs no random generator, and adding a
stratum changes no other. Running positions are counted in ranges of the hash, so that a stratum
with a third of all rows is not sorted in one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trackspark.functions.text import dataset_of, fill_template
from trackspark.operators.sharded import number_over

#: Ranges of the hash in which positions are counted.
RANGES = 4096


def hashed_position(df: DataFrame, keys: list[str], ident: str, seed: int, out: str = "pos") -> DataFrame:
    """Add the row's position from 0 in the hashed order of its stratum."""
    h = F.md5(F.concat_ws(":", F.lit(str(seed)), *keys, ident))
    d = df.withColumn("__h", h).withColumn("__r", F.conv(F.substring("__h", 1, 3), 16, 10).cast("long"))
    d = d.withColumn("__tie", F.struct("__h", ident))
    return number_over(d, keys, "__r", "__tie", out, 4096 / RANGES).drop("__h", "__r", "__tie")


def pointers(manifest: DataFrame) -> DataFrame:
    """(id, dataset, video) of usable clips: an id, no error; the dataset falls back to the id's prefix."""
    ok = (F.coalesce(F.trim("id"), F.lit("")) != "") & F.col("error").isNull()
    return manifest.filter(ok).select("id", F.coalesce(F.nullif(F.col("dataset"), F.lit("")), dataset_of(F.col("id"))).alias("dataset"), "video")


def join_manifests(sources: list[tuple[DataFrame, list[str] | None]], ident: str = "id") -> DataFrame:
    """Union of manifests in order, each with its datasets to keep; of one id the first row stays.

    Rows need ``ord`` (file order) and ``error``; rows with an error or without an id are dropped.
    The first row is chosen by an aggregate, so a repeated id is reduced before the shuffle.
    """
    parts = []
    for k, (df, keep) in enumerate(sources):
        p = df.filter(F.col("error").isNull() & (F.coalesce(F.col(ident), F.lit("")) != ""))
        named = F.coalesce(F.nullif(F.col("dataset"), F.lit("")), dataset_of(F.col(ident)))
        p = p.filter(named.isin(keep)) if keep else p
        parts.append(p.withColumn("source_ord", F.lit(k)))
    u = parts[0]
    for p in parts[1:]:
        u = u.unionByName(p, allowMissingColumns=True)
    rest = [c for c in u.columns if c != ident]
    return u.groupBy(ident).agg(F.min_by(F.struct(*rest), F.struct("source_ord", "ord")).alias("r")).select(ident, "r.*")


def join_counts(sources: list[tuple[DataFrame, list[str] | None]], ident: str = "id") -> DataFrame:
    """(source_ord, rows, errors, without_id, other_dataset, repeated, kept) of a join of manifests."""
    parts = []
    for k, (df, keep) in enumerate(sources):
        bad, lost = F.col("error").isNotNull(), F.coalesce(F.col(ident), F.lit("")) == ""
        named = F.coalesce(F.nullif(F.col("dataset"), F.lit("")), dataset_of(F.col(ident)))
        out = ~F.coalesce(named.isin(keep), F.lit(False)) if keep else F.lit(False)
        why = F.when(bad, "errors").when(lost, "without_id").when(out, "other_dataset")
        parts.append(df.select(F.lit(k).alias("source_ord"), F.col(ident).alias("id"), why.alias("why")))
    u = parts[0]
    for p in parts[1:]:
        u = u.unionByName(p)
    first = u.filter("why IS NULL").groupBy("id").agg(F.min("source_ord").alias("source_ord")).groupBy("source_ord").agg(F.count(F.lit(1)).alias("kept"))
    n = u.groupBy("source_ord").agg(F.count(F.lit(1)).alias("rows"), *[F.count_if(F.col("why") == w).alias(w) for w in ("errors", "without_id", "other_dataset")])
    j = n.join(first, "source_ord", "left").withColumn("kept", F.coalesce("kept", F.lit(0)))
    return j.select("source_ord", "rows", "errors", "without_id", "other_dataset", (F.col("rows") - F.col("errors") - F.col("without_id") - F.col("other_dataset") - F.col("kept")).alias("repeated"), "kept")


def collected_video(video: Column, dataset: Column) -> Column:
    """The place of a clip's film beside a joined manifest: videos/dataset/name."""
    return F.concat_ws("/", F.lit("videos"), dataset, F.regexp_extract(video, r"[^/]*$", 0))


def absolute_video(video: Column, root: str) -> Column:
    """A relative film path below its manifest's folder; absolute ones and URLs stay."""
    return F.when(video.rlike(r"^(/|[a-z][a-z0-9+.-]*:)"), video).otherwise(F.concat(F.lit(root.rstrip("/") + "/"), video))


def quotas(counts: DataFrame, ratios: list[tuple[str, float]]) -> DataFrame:
    """Add ``steps``: for each split, in order, the position where it ends (largest remainder).

    Leftovers go to the largest fractions; ties to the larger ratio, then to the split named first.
    """
    whole = sum(q for _, q in ratios)
    if whole <= 0:
        raise ValueError("split ratios must sum to more than 0")
    rows = F.array(*[F.struct(F.lit(i).alias("i"), F.lit(s).alias("split"), F.lit(float(q / whole)).alias("q")) for i, (s, q) in enumerate(ratios)])
    n = F.col("n")
    raw = F.transform(rows, lambda r: F.struct(r["i"].alias("i"), r["split"].alias("split"), r["q"].alias("q"), F.floor(r["q"] * n).alias("base"), (r["q"] * n - F.floor(r["q"] * n)).alias("frac")))
    left = n - F.aggregate(raw, F.lit(0).cast("long"), lambda a, r: a + r["base"])
    ranked = F.array_sort(raw, lambda a, b: F.when(a["frac"] != b["frac"], F.when(a["frac"] > b["frac"], -1).otherwise(1)).when(a["q"] != b["q"], F.when(a["q"] > b["q"], -1).otherwise(1)).otherwise((a["i"] - b["i"]).cast("int")))
    given = F.array_sort(F.transform(ranked, lambda r, k: F.struct(r["i"].alias("i"), r["split"].alias("split"), (r["base"] + (k < left).cast("long")).alias("n"))))
    ends = F.transform(given, lambda r, k: F.struct(r["split"].alias("split"), F.aggregate(F.slice(given, 1, k + 1), F.lit(0).cast("long"), lambda a, x: a + x["n"]).alias("end")))
    return counts.withColumn("steps", ends)


def stratified(rows: DataFrame, ident: str, stratum: str, ratios: list[tuple[str, float]], seed: int) -> DataFrame:
    """Rows with ``split``: exact quotas in every stratum."""
    n = quotas(rows.groupBy(stratum).agg(F.count(F.lit(1)).alias("n")), ratios).drop("n")
    p = hashed_position(rows, [stratum], ident, seed).join(n, stratum)
    return p.withColumn("split", F.get(F.filter("steps", lambda s: F.col("pos") < s["end"]), F.lit(0))["split"]).drop("steps", "pos")


def proportional(rows: DataFrame, ident: str, group: str, ratios: list[tuple[str, float]], seed: int) -> DataFrame:
    """Rows with ``split`` by their place (position + 0.5) / n in the hashed order of their group."""
    whole = sum(q for _, q in ratios)
    n = rows.groupBy(group).agg(F.count(F.lit(1)).alias("__n"))
    p = hashed_position(rows, [group], ident, seed).join(n, group)
    place = (F.col("pos") + 0.5) / F.col("__n")
    out: Column | None = None
    upto = 0.0
    for s, q in ratios:
        upto += q / whole
        out = F.when(place <= upto + 1e-12, s) if out is None else out.when(place <= upto + 1e-12, s)
    return p.withColumn("split", out).drop("pos", "__n")


def pull_manifest(split: DataFrame, template: str) -> DataFrame:
    """(split, dataset, episode, uri) of split members, by a layout template with {dataset} and {episode}."""
    ds, ep = F.split_part("id", F.lit(":"), F.lit(1)), F.split_part("id", F.lit(":"), F.lit(2))
    return split.select("split", ds.alias("dataset"), ep.alias("episode"), fill_template(template, {"dataset": ds, "episode": ep}).alias("uri"))
