"""Timed annotations from CSV, keyed JSON and pickled frames, as segments.

A record is (ids, rec): a map from field to VARIANT. A segment is (ids, start_s, end_s, point_s, text,
extras). Rows with neither a start nor a point are kept here and left out where spans are needed.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from trackspark.functions.predicate import compare, literal, parts
from trackspark.functions.text import compose
from trackspark.functions.time import to_seconds
from trackspark.operators import nested
from trackspark.sources.catalog import open_at
from trackspark.sources.lines import csv_records


@dataclass
class SegmentSpec:
    """``end_plus`` names a field whose seconds are added to the start; ``whole`` spans the episode."""

    start: str | None = None
    end: str | None = None
    point: str | None = None
    units: str = "s"
    fps: float | None = None
    text: list[str] = field(default_factory=lambda: ["text"])
    sep: str = " "
    strip_prefix: str | None = None
    keep: str | None = None
    drop: str | None = None
    extras: list[str] = field(default_factory=list)
    end_plus: str | None = None
    whole: bool = False


def value(name: str, rec: str = "rec") -> Column:
    """Text of a field: the key of that name, else the longest key that begins it and a way inside."""
    steps = name.split(".")
    found = [F.try_variant_get(F.try_element_at(rec, F.lit(name)), "$", "string")]
    for k in range(len(steps) - 1, 0, -1):
        way = "".join(f"[{s}]" if s.isdecimal() else f"['{s}']" for s in steps[k:])
        found.append(F.try_variant_get(F.try_element_at(rec, F.lit(".".join(steps[:k]))), "$" + way, "string"))
    return F.coalesce(*found)


def holds(expr: str | None) -> Column:
    """A predicate of the small language on a record; a JSON boolean is compared by its truth."""
    if not expr or not expr.strip():
        return F.lit(True)
    name, op, token = parts(expr)
    text, want = value(name), literal(token)
    if isinstance(want, bool):
        true = F.coalesce((F.length(text) > 0) & ~F.lower(text).isin("false", "0", "0.0", "[]", "{}"), F.lit(False))
        return compare(true, "boolean", op, want)
    return compare(text, "string", op, want)


def segments(records: DataFrame, ids: list[str], spec: SegmentSpec, duration: Column | None = None) -> DataFrame:
    """Records as segments; ``duration`` ends those that span a whole episode."""
    time = lambda n: F.lit(None).cast("double") if n is None else to_seconds(value(n), spec.units, spec.fps)
    d = records.filter(holds(spec.keep))
    d = d.filter(~holds(spec.drop)) if spec.drop else d
    start, end = time(spec.start), time(spec.end)
    if spec.end is None and spec.end_plus:
        end = start + value(spec.end_plus).try_cast("double")
    if spec.whole:
        start, end = F.lit(0.0), duration if duration is not None else F.lit(None).cast("double")
    extras = F.map_from_arrays(F.array(*[F.lit(e) for e in spec.extras]), F.array(*[value(e) for e in spec.extras])) if spec.extras else F.create_map().cast("map<string,string>")
    return d.select(*ids, start.alias("start_s"), end.alias("end_s"), time(spec.point).alias("point_s"), compose([value(t) for t in spec.text], spec.sep, spec.strip_prefix).alias("text"), extras.alias("extras"))


def csv_rows(spark: SparkSession, path: str) -> DataFrame:
    """(path, ord, rec) of CSV files; names lose a trailing "(suffix)" beside their full form."""
    plain = csv_records(spark, path)
    short = lambda e: F.struct(F.regexp_replace(e["key"], r"\s*\([^)]*\)\s*$", "").alias("key"), e["value"].alias("value"))
    more = F.map_from_entries(F.filter(F.transform(F.map_entries("rec"), short), lambda e: ~F.map_contains_key("rec", e["key"])))
    return plain.select("path", "ord", F.transform_values(F.map_concat("rec", more), lambda k, v: v.cast("variant")).alias("rec"))


def read_csv(spark: SparkSession, path: str, spec: SegmentSpec) -> DataFrame:
    return segments(csv_rows(spark, path), ["path", "ord"], spec)


@dataclass
class KeyedPath:
    """Where a keyed JSON file keeps its records.

    ``kind`` "keyed": below ``top`` an object keyed by take, inside each ``level`` ("" for the take itself);
    "listed": a list of takes that name themselves in ``top`` and hold records in ``level``.
    """

    kind: str
    top: str
    level: str = ""


def keyed_path(select_path: str, key_form: str | None = None) -> KeyedPath:
    """The parts of a select path such as ``annotations.{key}.level`` or ``[field].level[test]``."""
    if select_path.startswith("["):
        name, _, rest = select_path[1:].partition("]")
        return KeyedPath("listed", name, re.sub(r"\[.*$", "", rest.lstrip(".")))
    top, brace, _ = select_path.partition("{")
    if not brace:
        raise ValueError(f"select path {select_path!r} names no key")
    rest = select_path[len(top) :]
    form = key_form if key_form and rest.startswith(key_form) else re.match(r"\{\w+\}[^.]*", rest)[0]
    return KeyedPath("keyed", top.rstrip("."), rest[len(form) :].lstrip("."))


#: Lists inside an entry that hold its records, with the entry's fields that each of them inherits.
INNER = {"descriptions": ("rejected",), "commentary_data": ("task_name",)}


def _inherit(name: str, carried: tuple[str, ...]) -> Column:
    """Objects of the entry's list ``name``, each with the entry's own ``carried`` fields."""
    more = F.map_filter("f", lambda k, v: k.isin(*carried))
    items = F.filter(F.transform(nested.as_list(F.try_element_at("f", F.lit(name))), nested.fields_of), lambda m: m.isNotNull())
    return F.transform(items, lambda m: F.map_concat(F.map_filter(m, lambda k, v: ~k.isin(*carried)), more))


def json_records(spark: SparkSession, path: str, where: KeyedPath) -> DataFrame:
    """(path, key, ord, rec) of keyed JSON files, each parsed once."""
    text = spark.read.text(path, wholetext=True).select(F.col("_metadata.file_path").alias("path"), "value")
    doc = nested.parse(text, "value")
    if where.kind == "listed":
        takes = doc.select("path", F.explode(nested.as_list(F.col("doc"))).alias("take")).select("path", nested.fields_of(F.col("take")).alias("f"))
        takes = takes.select("path", F.try_variant_get(F.try_element_at("f", F.lit(where.top)), "$", "string").alias("key"), F.try_element_at("f", F.lit(where.level)).alias("held"))
    else:
        level = F.col("doc")
        for step in where.top.split("."):
            level = F.try_element_at(nested.fields_of(level), F.lit(step))
        takes = doc.select("path", F.explode(nested.fields_of(level)).alias("key", "held"))
        if where.level:
            takes = takes.withColumn("held", F.try_element_at(nested.fields_of(F.col("held")), F.lit(where.level)))
    each = takes.filter("held IS NOT NULL").select("path", "key", F.posexplode(nested.as_list(F.col("held"))).alias("entry_no", "entry")).withColumn("f", nested.fields_of(F.col("entry"))).filter("f IS NOT NULL")
    inner = F.lit(None).cast("array<map<string,variant>>")
    for name, carried in reversed(INNER.items()):
        inner = F.when(F.map_contains_key("f", name), _inherit(name, carried)).otherwise(inner)
    rows = each.select("path", "key", "entry_no", F.posexplode(F.coalesce(inner, F.array("f"))).alias("item_no", "rec"))
    return rows.select("path", "key", (F.col("entry_no").cast("long") * (1 << 24) + F.col("item_no")).alias("ord"), "rec")


def pickle_records(spark: SparkSession, path: str) -> DataFrame:
    """(path, ord, rec) of pickled pandas frames (trusted files only), unpickled by the tasks, one file each."""

    def rows(it):
        import io
        import json

        import pandas as pd

        plain = lambda v: v.tolist() if hasattr(v, "tolist") else v
        for pdf in it:
            for p in pdf["path"]:
                with open_at(p) as f:
                    frame = pd.read_pickle(io.BytesIO(f.read()))
                names = [str(c) for c in frame.columns]
                for lo in range(0, len(frame), 10_000):
                    part = frame.iloc[lo : lo + 10_000].itertuples(index=False, name=None)
                    texts = [json.dumps({n: None if v is None or v != v else v for n, v in zip(names, map(plain, r)) if not isinstance(v, float) or v == v}, default=str) for r in part]
                    yield pd.DataFrame({"path": p, "ord": range(lo, lo + len(texts)), "j": texts})

    raw = spark.read.format("binaryFile").load(path).select("path").mapInPandas(rows, "path string, ord long, j string")
    return raw.select("path", "ord", nested.fields_of(F.parse_json("j")).alias("rec"))


def read_pickle(spark: SparkSession, path: str, spec: SegmentSpec, deny: DataFrame | None = None, key: str = "id") -> DataFrame:
    """Segments of a pickled frame, without the keys of a list of errata."""
    rec = pickle_records(spark, path)
    if deny is not None:
        rec = rec.withColumn("__key", value(key)).join(deny.select(F.col(key).cast("string").alias("__key")).distinct(), "__key", "left_anti")
    return segments(rec, ["path", "ord"], spec)
