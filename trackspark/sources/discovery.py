"""Finding episodes: documents beside the data, raw manifests, path templates, indexes."""

from __future__ import annotations

import re
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def template_glob(template: str) -> tuple[str, str]:
    """(glob, pattern) of a path template: every {name} stands for one path part or a piece of it."""
    glob = re.sub(r"\{\w+\}", "*", template)
    pattern = ""
    seen: list[str] = []
    for part in re.split(r"(\{\w+\})", template):
        if part.startswith("{"):
            n = part[1:-1]
            pattern += rf"\{seen.index(n) + 1}" if n in seen else "([^/]+?)"
            seen += [] if n in seen else [n]
        else:
            pattern += re.escape(part).replace(r"\*", "[^/]*")
    return glob, pattern + "$"


def token(path: Column, template: str, name: str) -> Column:
    """The value of {name} in a path that a template describes; "" where it does not match."""
    order = list(dict.fromkeys(re.findall(r"\{(\w+)\}", template)))
    return F.regexp_extract(path, template_glob(template)[1], order.index(name) + 1)


# fixed values: names in path templates that stand for the episode itself
IDS = ("episode_id", "take_name", "video_uid", "video_name", "episode")


@dataclass
class Select:
    """Which file of an episode is used: shipped metadata, a list of preferences, a pattern with a pick, a template."""

    template: str = ""
    prefer: list[str] = field(default_factory=list)
    glob: str = ""
    pick: str = "single"
    suffix: str = ""
    metadata: str | None = None

    def patterns(self) -> list[str]:
        """Path patterns in order of preference, relative to the dataset."""
        if self.prefer:
            return [f"{self.template.rstrip('/')}/{p}".lstrip("/") for p in self.prefer]
        return [p for p in [self.glob or self.template] if p]


def exists(spark: SparkSession, glob: str) -> bool:
    """Whether any file matches; only the file system is asked."""
    path = spark._jvm.org.apache.hadoop.fs.Path(glob)
    found = path.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(path)
    return found is not None and len(found) > 0


def tokens_of(path: Column, pattern: str) -> Column:
    """A map of the names in a pattern to their pieces of a path, null where it does not match."""
    names = list(dict.fromkeys(re.findall(r"\{(\w+)\}", pattern)))
    if not names:
        return F.create_map().cast("map<string,string>")
    got = F.create_map(*[x for n in names for x in (F.lit(n), token(path, pattern, n))])
    return F.when(token(path, pattern, names[0]) != "", got)


def chosen_files(spark: SparkSession, root: str, select: Select) -> DataFrame:
    """(path, tokens, pattern): of the files with equal tokens the one preferred.

    Patterns come first in their order; inside a pattern "largest" and "smallest" go by size,
    "invariant_suffix" puts the suffix first, and then the smallest path wins.
    """
    out = None
    for order, pattern in enumerate(select.patterns()):
        glob = f"{root}/{template_glob(pattern)[0]}"
        if not exists(spark, glob):
            continue
        files = spark.read.format("binaryFile").load(glob).select("path", "length")
        rank = {"largest": -F.col("length"), "smallest": F.col("length"), "invariant_suffix": F.when(F.col("path").endswith(select.suffix), 0).otherwise(1)}.get(select.pick, F.lit(0))
        part = files.select("path", tokens_of(F.col("path"), pattern).alias("tokens"), F.lit(order).alias("pattern"), rank.cast("long").alias("rank")).filter("tokens IS NOT NULL")
        out = part if out is None else out.unionByName(part)
    if out is None:
        return spark.createDataFrame([], "path string, tokens map<string,string>, pattern int")
    key = F.to_json("tokens")
    best = out.groupBy(key.alias("k")).agg(F.min(F.struct("pattern", "rank", "path")).alias("b"), F.any_value("tokens").alias("tokens"))
    return best.select("b.path", "tokens", "b.pattern")


def list_episodes(spark: SparkSession, dataset: str, root: str, how: dict) -> DataFrame:
    """(dataset, episode_id, tokens, path) of all episodes a recipe's glob finds: files or folders."""
    glob = f"{root}/{how['glob']}"
    deep = how.get("enumerate") == "take_dir"
    empty = spark.createDataFrame([], "dataset string, episode_id string, tokens map<string,string>, path string")
    if not exists(spark, glob):
        return empty
    if deep:
        hits = spark._jvm.org.apache.hadoop.fs.Path(glob)
        found = hits.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(hits)
        files = spark.createDataFrame([(f.getPath().toString(),) for f in found], "path string")
    else:
        files = spark.read.format("binaryFile").load(glob).select("path")
    rule = how.get("id_from") or {}
    steps = F.split("path", "/")
    name = F.try_element_at(steps, F.lit(rule.get("level", -1)))
    if rule.get("rule") == "filename_stem":
        strip = rule.get("strip_suffix") or ""
        name = F.try_element_at(steps, F.lit(-1))
        name = F.when(name.endswith(strip), name.substr(F.lit(1), F.length(name) - len(strip))).otherwise(name) if strip else F.regexp_replace(name, r"\.[^.]*$", "")
    elif rule.get("rule") == "filename_regex":
        name = F.regexp_extract(F.try_element_at(steps, F.lit(-1)), rule["regex"], 1)
    folder = F.try_element_at(steps, F.lit(-2))
    tokens = F.map_concat(F.create_map(*[x for n in IDS for x in (F.lit(n), name)]), F.create_map(F.lit("session"), folder, F.lit("participant"), folder))
    return files.select(F.lit(dataset).alias("dataset"), name.alias("episode_id"), tokens.alias("tokens"), "path").filter("episode_id <> ''").dropDuplicates(["episode_id"])


def episode_documents(spark: SparkSession, root: str) -> DataFrame:
    """(dataset, episode_id, duration_s, files) of all ``episode.json`` below a folder.

    Dataset and id fall back to the names of the folders the document lies in.
    """
    raw = spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", "episode.json").text(root, wholetext=True).select(F.col("_metadata.file_path").alias("path"), F.try_parse_json("value").alias("v"))
    parts = F.split("path", "/")
    get = lambda p, t: F.try_variant_get(F.col("v"), p, t)
    return raw.filter("v IS NOT NULL").select("path", F.coalesce(get("$.dataset", "string"), F.try_element_at(parts, F.lit(-3))).alias("dataset"), F.coalesce(get("$.episode_id", "string"), F.try_element_at(parts, F.lit(-2))).alias("episode_id"), get("$.duration_s", "double").alias("duration_s"), F.coalesce(get("$.files", "map<string,string>"), F.create_map().cast("map<string,string>")).alias("files"))


def episode_files(files: DataFrame, dataset: str) -> DataFrame:
    """(dataset, episode_id, files): one file per modality of each sequence of a listing.

    Of several the last by (format rank, size, name) is taken: structured text after tables.
    """
    rank = F.when(F.col("format") == "json", 2).when(F.col("format").isin("table", "array", "text"), 1).otherwise(0)
    pick = files.filter("modality <> 'other'").groupBy("sequence", "modality").agg(F.max(F.struct(rank.alias("rank"), "bytes", "rel")).alias("m"))
    return pick.groupBy("sequence").agg(F.map_from_entries(F.collect_list(F.struct("modality", "m.rel"))).alias("files")).select(F.lit(dataset).alias("dataset"), F.col("sequence").alias("episode_id"), "files")


def known_and_new(documents: DataFrame, manifest: DataFrame) -> DataFrame:
    """Episodes with a document, and those of a manifest that have none."""
    keys = ["dataset", "episode_id"]
    cols = [*keys, "files"]
    return documents.select(*cols).unionByName(manifest.join(documents.select(*keys), keys, "left_anti").select(*cols))


def index_lookup(spark: SparkSession, path: str, ids: DataFrame, ident: str) -> DataFrame:
    """ids with ``target`` from JSON indexes {key: target}: the exact key, else the first that holds the id.

    Keys are cut into all pieces as long as some id, so that both are joins on equality.
    """
    entries = spark.read.text(path, wholetext=True).select(F.posexplode(F.from_json("value", "map<string,string>")).alias("no", "key", "target"))
    wanted = ids.select(F.col(ident).alias("__id")).filter("length(__id) > 0").distinct()
    lengths = [r[0] for r in wanted.select(F.length("__id")).distinct().collect()]  # no more than the longest id has characters
    if not lengths:
        return ids.withColumn("target", F.lit(None).cast("string"))

    def cut_to(n: int) -> Column:
        # a key shorter than n gives one short piece, which is no id of that length
        return F.transform(F.sequence(F.lit(1), F.greatest(F.length("key") - (n - 1), F.lit(1))), lambda i: F.substring("key", i, F.lit(n)))

    pieces = F.explode(F.flatten(F.array(*[cut_to(n) for n in sorted(lengths)])))
    cut = entries.select("no", "key", "target", pieces.alias("__id"))
    best = F.struct((F.col("key") != F.col("__id")).alias("inside"), "no", "target")
    found = cut.join(wanted, "__id", "left_semi").groupBy("__id").agg(F.min(best)["target"].alias("target"))
    return ids.join(found, F.col(ident) == F.col("__id"), "left").drop("__id")
