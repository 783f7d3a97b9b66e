"""Catalogues of assets, directory profiles and file checks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from trackspark.functions.text import url_basename

# fixed values: parts of a path that tell a file's modality, in order of precedence
MODALITY = (
    ("gaze", ("gaze", "eye", "eyes", "etdata")),
    ("annotation", ("annot", "narration", "action", "label", "ground_truth")),
    ("depth", ("depth", "point_cloud", "semidense")),
    ("pose", ("pose", "hand", "motion", "mvnx", "slam_trajectories")),
    ("video", ("video", "rgb", "preview", "takes")),
)
# fixed values: suffixes of each format
FORMATS = (
    ("video", ("mp4", "mov", "mkv", "avi", "webm", "vrs")),
    ("table", ("csv", "jsonl", "parquet")),
    ("json", ("json",)),
    ("archive", ("zip", "tar", "tgz", "gz", "bz2", "xz")),
)
# fixed values: other spellings of dataset names
ALIASES = {
    "ariaeverydayactivities": "aea",
    "aria_everyday_activities": "aea",
    "hot3daria": "hot3d",
    "ariadigitaltwin": "adt",
    "aria_digital_twin": "adt",
    "aria digital twin": "adt",
    "egtea gaze+": "egtea",
    "ego4d": "ego-exo4d",
}
# fixed values: columns that tell how gaze and annotations are written
GAZE_FORMS = (("normalized_2d", (("x_norm", "y_norm"),)), ("pixel_2d", (("x_px", "y_px"), ("x", "y"), ("gaze_x", "gaze_y"))))
INTERVAL_COLUMNS = ("start_s", "end_s", "start_time", "end_time", "start_frame", "end_frame")
LABEL_COLUMNS = ("label", "text", "narration", "action", "verb", "noun")


def _first_of(cases: list[tuple[Column, str]], other: str) -> Column:
    out = F.lit(other)
    for hit, name in reversed(cases):
        out = F.when(hit, name).otherwise(out)
    return out


def modality(path: Column) -> Column:
    """Modality by the words of a path (relative to its dataset), else "other"."""
    low = F.lower(path)
    cases = [(low.rlike("|".join(words)), name) for name, words in MODALITY[:-1]]
    film = file_format(path) == "video"
    return _first_of([*cases, (film | low.rlike("|".join(MODALITY[-1][1])), "video")], "other")


def asked_modality(name: str) -> str:
    """A modality as users write it: annotations in four spellings, else the name or "other"."""
    low = name.strip().lower()
    if low.removeprefix("text ") in ("annotation", "annotations"):
        return "annotation"
    return low if low in ("depth", "pose", "video", "gaze") else "other"


def gaze_form(columns: Column) -> Column:
    """How gaze is written, by an array of lower-case column names; null if they do not tell."""
    have = lambda pair: F.array_contains(columns, pair[0]) & F.array_contains(columns, pair[1])
    cases = []
    for name, pairs in GAZE_FORMS:
        hit = F.lit(False)
        for pair in pairs:
            hit = hit | have(pair)
        cases.append((hit, name))
    part = lambda *words: F.exists(columns, lambda c: c.rlike("|".join(words)))
    return F.nullif(_first_of([*cases, (part("yaw", "pitch"), "angular"), (part("origin", "direction"), "ray")], ""), F.lit(""))


def annotation_form(columns: Column) -> Column:
    """"interval", "event_or_label" or null, by an array of lower-case column names."""
    any_of = lambda names: F.arrays_overlap(columns, F.array(*[F.lit(n) for n in names]))
    return F.when(any_of(INTERVAL_COLUMNS), "interval").when(any_of(LABEL_COLUMNS), "event_or_label")


def suffix(path: Column) -> Column:
    """Lower-case suffix without the dot; a compressed tar is "tgz"."""
    last = F.regexp_extract(F.lower(path), r"\.([a-z0-9]+)$", 1)
    return F.when(F.lower(path).endswith(".tar.gz"), "tgz").otherwise(last)


def file_format(path: Column) -> Column:
    """The kind of file by its suffix, else "binary"."""
    return _first_of([(suffix(path).isin(*kinds), name) for name, kinds in FORMATS], "binary")


def dataset_name(c: Column) -> Column:
    """The short name of a dataset: lower case without blanks and most signs, known spellings replaced."""
    names = F.create_map(*[F.lit(x) for pair in ALIASES.items() for x in pair])
    spaced, compact = F.lower(F.trim(c)), F.regexp_replace(F.lower(c), r"[^a-z0-9+_-]+", "")
    return F.coalesce(F.try_element_at(names, spaced), F.try_element_at(names, compact), compact)


def listing(spark: SparkSession, root: str) -> DataFrame:
    """(path, rel, sequence, bytes, modified, modality, format) of all files; contents are not read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(root).select("path", F.col("length").alias("bytes"), F.col("modificationTime").alias("modified"))
    rel = F.regexp_replace(F.regexp_replace("path", r"^file:/*", "/"), "^" + root.rstrip("/").replace(".", r"\.") + "/", "")
    return files.withColumn("rel", rel).select("path", "rel", F.split_part("rel", F.lit("/"), F.lit(1)).alias("sequence"), "bytes", "modified", modality(F.col("rel")).alias("modality"), file_format(F.col("rel")).alias("format"))


def profile(files: DataFrame) -> DataFrame:
    """Of each sequence: files, bytes, modalities and formats."""
    return files.groupBy("sequence").agg(F.count(F.lit(1)).alias("files"), F.sum("bytes").alias("bytes"), F.sort_array(F.collect_set("modality")).alias("modalities"), F.sort_array(F.collect_set("format")).alias("formats"))


def digests(spark: SparkSession, path: str) -> DataFrame:
    """(path, sha1, sha256) of files of any size, read in pieces."""

    def sums(it):
        import hashlib

        import pandas as pd

        for pdf in it:
            rows = []
            for p in pdf["path"]:
                a, b = hashlib.sha1(), hashlib.sha256()
                with open_at(p) as f:
                    while piece := f.read(1 << 22):
                        a.update(piece)
                        b.update(piece)
                rows.append((p, a.hexdigest(), b.hexdigest()))
            yield pd.DataFrame(rows, columns=["path", "sha1", "sha256"])

    return _paths(spark, path).mapInPandas(sums, "path string, sha1 string, sha256 string")


def calibration_lines(spark: SparkSession, path: str) -> DataFrame:
    """(path, line) of JSON lines as VARIANT; lines that are no JSON are left out."""
    raw = spark.read.text(path).select(F.col("_metadata.file_path").alias("path"), F.try_parse_json("value").alias("line"))
    return raw.filter("line IS NOT NULL")


def open_at(path: str):
    """A seekable handle on a file in any store Arrow knows; only what is read travels."""
    import re
    from urllib.parse import unquote, urlsplit

    from pyarrow import fs

    if not re.match(r"^[a-z][a-z0-9+.-]*:", path) or path.startswith("file:"):
        return fs.LocalFileSystem().open_input_file(unquote(urlsplit(path).path) if path.startswith("file:") else path)
    store, inside = fs.FileSystem.from_uri(re.sub(r"^s3[an]:", "s3:", path))
    return store.open_input_file(inside)


def _paths(spark: SparkSession, path: str) -> DataFrame:
    """Paths of files; the contents are not read."""
    return spark.read.format("binaryFile").option("recursiveFileLookup", "**" in path).load(path.removesuffix("/**")).select("path")


def video_headers(spark: SparkSession, path: str) -> DataFrame:
    """(path, duration_s, width, height, frames) from the movie box of MP4 files.

    Only the box headers and the movie box are read, however long the film; null where there is none.
    """

    def parse(it):
        import pandas as pd

        for pdf in it:
            rows = []
            for p in pdf["path"]:
                with open_at(p) as f:
                    rows.append((p, *movie_header(f)))
            yield pd.DataFrame(rows, columns=["path", "duration_s", "width", "height", "frames"]).astype({"width": "Int64", "height": "Int64", "frames": "Int64"})

    return _paths(spark, path).mapInPandas(parse, "path string, duration_s double, width long, height long, frames long")


def video_durations(spark: SparkSession, path: str) -> DataFrame:
    """(path, duration_s) from the movie header of MP4 files."""
    return video_headers(spark, path).select("path", "duration_s")


def _boxes(b: bytes, lo: int, hi: int):
    """(kind, begin, end) of the boxes inside a box."""
    import struct

    while lo + 8 <= hi:
        size, kind = struct.unpack(">I4s", b[lo : lo + 8])
        head = 8
        if size == 1 and lo + 16 <= hi:
            size, head = struct.unpack(">Q", b[lo + 8 : lo + 16])[0], 16
        elif size == 0:
            size = hi - lo
        if size < head:
            return
        yield kind, lo + head, min(lo + size, hi)
        lo += size


def movie_header(f) -> tuple[float | None, int | None, int | None, int | None]:
    """(duration_s, width, height, frames) of a seekable MP4; the size and frames of its first film track."""
    import struct

    f.seek(0, 2)
    end, at, moov = f.tell(), 0, None
    while at + 8 <= end and moov is None:
        f.seek(at)
        head = f.read(16)
        size, kind = struct.unpack(">I4s", head[:8])
        if size == 1 and len(head) == 16:
            size = struct.unpack(">Q", head[8:])[0]
        elif size == 0:
            size = end - at
        if size < 8:
            break
        if kind == b"moov":
            f.seek(at)
            moov = f.read(min(size, end - at))
        at += size
    if moov is None:
        return None, None, None, None
    duration = width = height = frames = None
    outer = next(_boxes(moov, 0, len(moov)), None)
    try:
        for kind, lo, hi in _boxes(moov, *outer[1:]):
            if kind == b"mvhd":
                scale, n = struct.unpack(">IQ", moov[lo + 20 : lo + 32]) if moov[lo] == 1 else struct.unpack(">II", moov[lo + 12 : lo + 20])
                duration = n / scale if scale else None
            elif kind == b"trak" and width is None:
                width, height, frames = _film_track(moov, lo, hi)
    except (struct.error, IndexError):
        pass
    return duration, width, height, frames


def _film_track(b: bytes, lo: int, hi: int) -> tuple[int | None, int | None, int | None]:
    import struct

    size, film, frames = (None, None), False, None
    todo = [(lo, hi)]
    while todo:
        for kind, x, y in _boxes(b, *todo.pop()):
            if kind in (b"mdia", b"minf", b"stbl"):
                todo.append((x, y))
            elif kind == b"tkhd":
                size = tuple(v >> 16 for v in struct.unpack(">II", b[y - 8 : y]))
            elif kind == b"hdlr":
                film = b[x + 8 : x + 12] == b"vide"
            elif kind == b"stts":
                n = struct.unpack(">I", b[x + 4 : x + 8])[0]
                frames = sum(struct.unpack(f">{2 * n}I", b[x + 8 : x + 8 + 8 * n])[::2])
    return (*size, frames) if film else (None, None, None)


def archive_members(spark: SparkSession, path: str, most: int | None = None) -> DataFrame:
    """(path, member, bytes) of zip and tar archives, the first ``most`` of each if given.

    Members are listed through ranged reads; only compressed tars are read to their end.
    """

    def names(it):
        import itertools
        import tarfile
        import zipfile

        import pandas as pd

        for pdf in it:
            rows = []
            for p in pdf["path"]:
                with open_at(p) as f:
                    try:
                        if zipfile.is_zipfile(f):
                            found = ((m.filename, m.file_size) for m in zipfile.ZipFile(f).infolist())
                        else:
                            f.seek(0)
                            found = ((m.name, m.size) for m in tarfile.open(fileobj=f))
                        rows += [(p, *m) for m in itertools.islice(found, most)]
                    except (tarfile.TarError, zipfile.BadZipFile, EOFError):
                        pass
            yield pd.DataFrame(rows, columns=["path", "member", "bytes"])

    return _paths(spark, path).mapInPandas(names, "path string, member string, bytes long")


def table_profile(spark: SparkSession, path: str, sample: int = 1000) -> DataFrame:
    """(path, rows, columns, gaze, annotation, first, middle, last) of CSV, JSON lines or parquet tables.

    Rows are counted in full (of parquet from the footers); the sample's first, middle and last row
    are given as JSON text, the forms of gaze and annotation by the column names.
    """
    kind = path.rsplit(".", 1)[-1].lower()
    reader = spark.read.option("header", True)
    df = {"csv": reader.csv, "jsonl": spark.read.json, "parquet": spark.read.parquet}[kind](path)
    names = F.array(*[F.lit(c.lower()) for c in df.columns])
    some = F.array(*[F.struct(F.to_json(F.struct(*[F.col(f"`{c}`") for c in df.columns])).alias("j"))])
    rows = [r[0][0]["j"] for r in df.limit(sample).select(some).collect()] if df.columns else []  # a bounded sample is the feature
    picked = [rows[0], rows[len(rows) // 2], rows[-1]] if rows else [None] * 3
    one = df.agg(F.count(F.lit(1)).alias("rows"))
    return one.select(F.lit(path).alias("path"), "rows", F.array(*[F.lit(c) for c in df.columns]).alias("columns"), gaze_form(names).alias("gaze"), annotation_form(names).alias("annotation"), *[F.lit(v).cast("string").alias(n) for n, v in zip(("first", "middle", "last"), picked)])


def json_profile(spark: SparkSession, path: str, keys: int = 100, items: int = 100) -> DataFrame:
    """(path, kind, size, keys): top-level kind, length, and the names of an object's or of a list's first objects."""
    v = F.try_parse_json("value")
    text = spark.read.text(path, wholetext=True).select(F.col("_metadata.file_path").alias("path"), v.alias("v"))
    fields = F.try_variant_get("v", "$", "map<string,variant>")
    elements = F.try_variant_get("v", "$", "array<variant>")
    inner = F.array_distinct(F.flatten(F.transform(F.slice(F.coalesce(elements, F.array().cast("array<variant>")), 1, items), lambda e: F.coalesce(F.map_keys(F.try_variant_get(e, "$", "map<string,variant>")), F.array().cast("array<string>")))))
    kind = F.when(F.col("v").isNull(), "unreadable").when(fields.isNotNull(), "object").when(elements.isNotNull(), "list").otherwise("value")
    names = F.coalesce(F.map_keys(fields), inner)
    return text.select("path", kind.alias("kind"), F.coalesce(F.size(F.map_keys(fields)), F.size(elements)).alias("size"), F.slice(F.sort_array(names), 1, keys).alias("keys"))


def provider_catalog(spark: SparkSession, path: str, dataset: str) -> DataFrame:
    """Assets of a provider's JSON: ``sequences`` {sequence: {asset key: {filename, download_url, ...}}}."""
    doc = spark.read.text(path, wholetext=True).select(F.try_parse_json("value").alias("v"))
    by_sequence = doc.select(F.explode(F.try_variant_get("v", "$.sequences", "map<string,variant>")).alias("sequence_id", "assets"))
    each = by_sequence.select("sequence_id", F.explode(F.try_variant_get("assets", "$", "map<string,variant>")).alias("asset_key", "a"))
    get = lambda n, t: F.try_variant_get("a", f"$.{n}", t)
    each = each.filter(F.try_variant_get("a", "$", "map<string,variant>").isNotNull())
    extra = F.map_filter(F.transform_values(F.try_variant_get("a", "$", "map<string,variant>"), lambda k, v: F.coalesce(F.try_variant_get(v, "$", "string"), F.to_json(v))), lambda k, v: ~k.isin("filename", "download_url", "file_size_bytes", "sha1sum"))
    name = F.coalesce(get("filename", "string"), url_basename(get("download_url", "string")))
    return each.select(F.lit(dataset).alias("dataset"), "sequence_id", "asset_key", modality(F.concat_ws("/", "asset_key", name)).alias("modality"), name.alias("filename"), get("download_url", "string").alias("url"), get("file_size_bytes", "long").alias("size_bytes"), F.lower(get("sha1sum", "string")).alias("sha1"), extra.alias("extra"))


def listed_catalog(spark: SparkSession, dataset: str, urls: dict[str, list[str]]) -> DataFrame:
    """Assets named directly: {asset key: URLs}; the sequence is the dataset itself."""
    rows = [(dataset, dataset, key, u) for key, us in urls.items() for u in us]
    df = spark.createDataFrame(rows, "dataset string, sequence_id string, asset_key string, url string")
    none = F.lit(None)
    return df.select("dataset", "sequence_id", "asset_key", modality(F.concat_ws("/", "asset_key", "url")).alias("modality"), url_basename(F.col("url")).alias("filename"), "url", none.cast("long").alias("size_bytes"), none.cast("string").alias("sha1"), F.create_map().cast("map<string,string>").alias("extra"))


def markdown_catalog(spark: SparkSession, path: str) -> DataFrame:
    """(dataset, url, filename): links under the headings of Markdown files, each read whole."""
    lines = spark.read.text(path, wholetext=True).select(F.col("_metadata.file_path").alias("file"), F.posexplode(F.split("value", r"\r?\n")).alias("ord", "line"))
    # headings and links of one document: its lines fit a row, so the fill-down does as well
    head = F.nullif(F.regexp_extract("line", r"^#{1,6}\s+(.*?)\s*$", 1), F.lit(""))
    w = Window.partitionBy("file").orderBy("ord").rowsBetween(Window.unboundedPreceding, 0)
    links = lines.withColumn("head", F.last(head, ignorenulls=True).over(w)).select("ord", "head", F.explode(F.regexp_extract_all("line", F.lit(r"(https?://[^\s)>\]]+)"), 1)).alias("url"))
    return links.select(dataset_name(F.col("head")).alias("dataset"), "url", url_basename(F.col("url")).alias("filename"))


def asset_status(expected: DataFrame, observed: DataFrame) -> DataFrame:
    """Expected files with what was found: ok, or the first reason against it.

    ``expected`` has path, size_bytes, sha1; ``observed`` path, bytes, sha1, partial.
    """
    o = observed.select("path", F.col("bytes").alias("found_bytes"), F.col("sha1").alias("found_sha1"), "partial")
    j = expected.join(o, "path", "left")
    reason = (
        F.when(F.col("found_bytes").isNull(), "missing")
        .when(F.col("size_bytes").isNotNull() & (F.col("size_bytes") != F.col("found_bytes")), "size")
        .when(F.coalesce("partial", F.lit(False)), "partial")
        .when(F.col("sha1").isNotNull() & F.col("found_sha1").isNotNull() & (F.lower("sha1") != F.lower("found_sha1")), "sha1")
    )
    return j.select("path", reason.isNull().alias("complete"), F.coalesce(reason, F.lit("ok")).alias("reason"))
