"""Deeply nested records into flat tables that point to their parents.

Method: a merged schema is inferred over all payloads (one pass, aggregated where the data lie; only
field paths come back, never data), then each level of objects is exploded into a child table that
carries the parent's surrogate key and the position in the array. Levels whose keys are data
(takes by name) are named by the source's ``select_path`` and become rows, not fields, so that the
schema has as many fields as the format, not as the data.

Payloads stay in the JVM as VARIANT; only schema inference walks them in Python.

Defined results
* null, empty, incomplete or unreadable payloads and text behind the JSON value give nothing; of
  duplicate keys in one object the last counts; JSON inside a JSON string is unwrapped to its end;
* one object in place of a list is a list of one; elements that are no objects keep their position
  but have no row; missing and null levels have no rows;
* payloads with equal keys are all read: callers deduplicate by record id before.
"""

from __future__ import annotations

import json
import re
from collections import Counter
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: How often JSON inside a JSON string is unwrapped. Each wrapping doubles the escapes, so that no
#: string of 2**31 bytes can be wrapped more often.
WRAPS = 31


def fields_of(v: Column) -> Column:
    """The object's fields as a map, null for what is no object."""
    return F.try_variant_get(v, "$", "map<string,variant>")


def as_list(v: Column) -> Column:
    """The elements of an array; anything else is a list of one."""
    return F.coalesce(F.try_variant_get(v, "$", "array<variant>"), F.array(v))


def parse(df: DataFrame, payload: str, out: str = "doc") -> DataFrame:
    """Add the payload as VARIANT; rows without readable, complete JSON are dropped."""
    bare = F.regexp_replace(F.col(payload), "^[\\uFEFF\\s]+", "")
    df.sparkSession.conf.set("spark.sql.variant.allowDuplicateKeys", "true")  # the last one wins
    peel = lambda s, _: F.when(s.startswith('"'), F.regexp_replace(F.try_variant_get(F.try_parse_json(s), "$", "string"), "^[\\uFEFF\\s]+", "")).otherwise(s)
    text = F.aggregate(F.sequence(F.lit(1), F.lit(WRAPS)), bare, peel)
    # parsed inside brackets: what follows the value would break the list
    boxed = F.try_variant_get(F.try_parse_json(F.concat(F.lit("["), F.col("__text"), F.lit("]"))), "$", "array<variant>")
    parsed = df.withColumn("__text", text).withColumn("__box", boxed).filter("size(__box) = 1")
    return parsed.withColumn(out, F.element_at("__box", 1)).drop("__text", "__box")


def compile_path(select_path: str) -> tuple[str, str, str | None]:
    """(kind, name, item level) of a select path.

    ``annotations.{key}``: the object under ``annotations`` is keyed by take;
    ``[field].level``: a list of objects that name their take in ``field`` and hold items in ``level``.
    """
    if m := re.fullmatch(r"\[(\w+)\]\.(\w+)", select_path):
        return "list", m[1], m[2]
    if m := re.fullmatch(r"(\w+)\.\{.*", select_path):
        return "keyed", m[1], None
    raise ValueError(f"select path {select_path!r} is neither 'name.{{key}}' nor '[field].level'")


def takes(df: DataFrame, paths: dict[str, str], keys: list[str], payload: str = "payload", dataset: str = "dataset") -> DataFrame:
    """(keys, dataset, take_no, take_key, take): one row per take of each payload."""
    doc = parse(df.filter(F.col(dataset).isin(list(paths))), payload).select(*keys, dataset, F.posexplode(as_list(F.col("doc"))).alias("top_no", "top"))
    doc = doc.withColumn("fields", fields_of(F.col("top"))).filter("fields IS NOT NULL").drop("top")
    parts = []
    for name, path in paths.items():
        kind, key, _ = compile_path(path)
        mine = doc.filter(F.col(dataset) == name)
        if kind == "keyed":
            entries = fields_of(F.col("fields")[key])
            parts.append(mine.select(*keys, dataset, "top_no", F.explode(entries).alias("take_key", "take")))
        else:
            parts.append(mine.select(*keys, dataset, "top_no", F.try_variant_get(F.col("fields")[key], "$", "string").alias("take_key"), F.to_variant_object(F.col("fields")).alias("take")))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def root(df: DataFrame, value: str, ids: list[str]) -> DataFrame:
    """The first level: (ids, path, parent_id, position, trail, row_id, fields).

    ``path`` names the level, ``trail`` has the positions of the row and all rows above it.
    """
    sid = F.md5(F.concat_ws("/", *[F.coalesce(F.col(c).cast("string"), F.lit("\u0000")) for c in ids], F.col("position").cast("string")))
    df = df.select(*ids, F.posexplode(as_list(F.col(value))).alias("position", "element"))
    df = df.withColumn("fields", fields_of(F.col("element"))).filter("fields IS NOT NULL")
    return df.select(*ids, F.array().cast("array<string>").alias("path"), F.lit(None).cast("string").alias("parent_id"), F.col("position").cast("long").alias("position"), F.array(F.col("position").cast("long")).alias("trail"), sid.alias("row_id"), "fields")


def child(level: DataFrame, ids: list[str], names: list[str] | None = None) -> DataFrame:
    """The next level: every field that holds objects, its objects with position and parent.

    ``names`` tells which fields may; without it all are looked into.
    """
    fields = F.col("fields") if names is None else F.map_filter("fields", lambda k, v: k.isin(names))
    e = level.select(*ids, "path", "trail", "row_id", F.explode(fields).alias("name", "value"))
    e = e.select(*ids, F.concat("path", F.array("name")).alias("path"), "trail", F.col("row_id").alias("parent_id"), F.posexplode(as_list(F.col("value"))).alias("position", "element"))
    e = e.withColumn("fields", fields_of(F.col("element"))).filter("fields IS NOT NULL")
    sid = F.md5(F.concat_ws("/", "parent_id", F.element_at("path", -1), F.col("position").cast("string")))
    trail = F.concat("trail", F.array(F.col("position").cast("long")))
    return e.select(*ids, "path", "parent_id", F.col("position").cast("long").alias("position"), trail.alias("trail"), sid.alias("row_id"), "fields")


def holds_objects(v: Column) -> Column:
    """True if the value is an object or a list with one in it: a level with rows of its own."""
    return F.exists(as_list(v), lambda x: fields_of(x).isNotNull())


def flat(fields: Column, level: Callable[[Column], Column] | None = None) -> Column:
    """All fields as a map from path to JSON text, those left out that are levels with own rows.

    ``level`` tells by name which fields may be levels. Objects are opened once ("name/field"; "~" and
    "/" inside names are "~0" and "~1"), what lies deeper and lists are JSON text.
    """
    if level is not None:
        fields = F.map_filter(fields, lambda k, v: ~(level(k) & holds_objects(v)))
    name = lambda k: F.replace(F.replace(k, F.lit("~"), F.lit("~0")), F.lit("/"), F.lit("~1"))
    pair = lambda k, v: F.struct(k.alias("key"), F.to_json(v).alias("value"))
    inner = lambda e: F.transform(F.map_entries(fields_of(e["value"])), lambda x: pair(F.concat(name(e["key"]), F.lit("/"), name(x["key"])), x["value"]))
    open_ = lambda e: F.when(F.size(fields_of(e["value"])) > 0, inner(e)).otherwise(F.array(pair(name(e["key"]), e["value"])))
    return F.map_from_entries(F.flatten(F.transform(F.map_entries(fields), open_)))


def _walk(v: object, path: tuple[str, ...], seen: Counter) -> None:
    if isinstance(v, list):
        for x in v:
            if isinstance(x, dict):
                _walk(x, path, seen)
            elif not isinstance(x, list):
                seen[(path, "element:" + _kind(x))] += 1
        return
    if isinstance(v, dict):
        seen[(path, "object")] += 1
        for k, x in v.items():
            if isinstance(x, (dict, list)):
                seen[((*path, k), "array" if isinstance(x, list) else "single")] += 1
                _walk(x, (*path, k), seen)
            else:
                seen[((*path, k), _kind(x))] += 1


def _kind(x: object) -> str:
    return "null" if x is None else "boolean" if isinstance(x, bool) else "bigint" if isinstance(x, int) else "double" if isinstance(x, float) else "string"


def infer(df: DataFrame, value: str, group: str) -> DataFrame:
    """Merged schema: (group, path, kind, n). Fields of optional levels and mixed types all appear."""
    text = df.select(F.col(group).cast("string").alias("g"), F.to_json(F.col(value)).alias("j"))

    def batches(it):
        import pandas as pd

        seen: dict[str, Counter] = {}
        for pdf in it:
            for g, j in zip(pdf["g"], pdf["j"]):
                if j is not None:
                    v = json.loads(j)
                    _walk(v, (), seen.setdefault(g, Counter()))
        rows = [(g, list(p), k, n) for g, c in seen.items() for (p, k), n in c.items()]
        yield pd.DataFrame(rows, columns=["g", "path", "kind", "n"])

    counted = text.mapInPandas(batches, "g string, path array<string>, kind string, n long")
    return counted.groupBy("g", "path", "kind").agg(F.sum("n").alias("n")).withColumnRenamed("g", group)


def levels(df: DataFrame, value: str, ids: list[str], schema: DataFrame | None = None, most: int | None = None) -> list[DataFrame]:
    """The levels of objects, depth by depth, as the merged schema names them; ``most`` of them if given.

    A level of the schema without rows in some payload gives no row there; a depth that no schema path
    reaches ends the list.
    """
    schema = infer(df, value, ids[0]) if schema is None else schema
    paths = [list(r.path) for r in schema.filter("kind = 'object'").select("path").distinct().collect()]  # fields of the format, not data
    out: list[DataFrame] = []
    for depth in range(max(map(len, paths), default=-1) + 1):
        if most is not None and depth == most:
            break
        names = sorted({p[-1] for p in paths if len(p) == depth and p})
        out.append(root(df, value, ids) if depth == 0 else child(out[-1], ids, names))
    return out
