"""Tables from and to parquet, CSV and JSON lines.

A missing file is an empty table of the declared schema; CSV cells are coerced explicitly.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def exists(spark: SparkSession, path: str) -> bool:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p)


def read_table(spark: SparkSession, path: str, schema: StructType | str | None = None) -> DataFrame:
    """Read by suffix; ``x.parquet`` falls back to ``x.parquet.jsonl``; missing: empty."""
    if not exists(spark, path) and exists(spark, path + ".jsonl"):
        path += ".jsonl"
    if not exists(spark, path):
        return spark.createDataFrame([], schema or StructType([]))
    r = spark.read.schema(schema) if schema is not None else spark.read
    if path.endswith((".jsonl", ".json")):
        return r.option("mode", "DROPMALFORMED").json(path)
    if path.endswith(".csv"):
        return r.option("header", True).csv(path) if schema is not None else coerced(r.option("header", True).csv(path))
    return r.parquet(path)


def coerced(df: DataFrame) -> DataFrame:
    """Text columns as the narrowest type that all their cells have: boolean, integer, number or text."""
    seen = []
    for c in df.columns:
        v = coerce(F.col(f"`{c}`"))
        n = [F.count(v[k]) for k in ("b", "i", "d", "s")]
        seen.append(F.when((n[0] > 0) & (n[1] + n[2] + n[3] == 0), "b").when((n[1] > 0) & (n[0] + n[2] + n[3] == 0), "i").when((n[1] + n[2] > 0) & (n[0] + n[3] == 0), "d").otherwise("s"))
    kinds = df.agg(F.array(*seen)).first()[0] if df.columns else []
    typed = {"b": lambda v, c: v["b"], "i": lambda v, c: v["i"], "d": lambda v, c: F.coalesce(v["d"], v["i"].cast("double")), "s": lambda v, c: F.when(F.trim(c) != "", c)}
    return df.select(*[typed[k](coerce(F.col(f"`{c}`")), F.col(f"`{c}`")).alias(c) for c, k in zip(df.columns, kinds)])


def write_table(df: DataFrame, path: str, partition: list[str] | None = None) -> None:
    """Write by suffix; nested columns of a CSV become JSON."""
    w = df
    if path.endswith(".csv"):
        nested = [c for c, t in df.dtypes if t.startswith(("array", "struct", "map"))]
        w = df.withColumns({c: F.to_json(c) for c in nested})
    out = w.write.mode("overwrite")
    out = out.partitionBy(*partition) if partition else out
    if path.endswith(".csv"):
        out.option("header", True).csv(path)
    elif path.endswith((".jsonl", ".json")):
        out.json(path)
    else:
        out.parquet(path)


def coerce(c: Column) -> Column:
    """A text cell as (b, i, d, s): boolean, integer, number or text; empty is null in all."""
    t = F.trim(c)
    low = F.lower(t)
    boolean = F.when(low.isin("true", "false"), low == "true")
    integer = F.when(t.rlike(r"^[+-]?\d{1,18}$"), t.try_cast("long"))
    number = F.when(integer.isNull() & t.rlike(r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$"), t.try_cast("double"))
    text = F.when((t != "") & boolean.isNull() & integer.isNull() & number.isNull(), c)
    return F.struct(boolean.alias("b"), integer.alias("i"), number.alias("d"), text.alias("s"))


def json_records(spark: SparkSession, path: str) -> DataFrame:
    """(path, ord, record): records of JSON files as VARIANT.

    A list gives its objects; an object gives the objects of its longest list of objects, or itself.
    """
    raw = spark.read.text(path, wholetext=True).select(F.col("_metadata.file_path").alias("path"), F.try_parse_json("value").alias("v")).filter("v IS NOT NULL")
    objects = lambda a: F.filter(a, lambda x: F.try_variant_get(x, "$", "map<string,variant>").isNotNull())
    top = F.try_variant_get(F.col("v"), "$", "array<variant>")
    fields = F.try_variant_get(F.col("v"), "$", "map<string,variant>")
    lists = F.transform(F.map_values(fields), lambda x: objects(F.coalesce(F.try_variant_get(x, "$", "array<variant>"), F.array().cast("array<variant>"))))
    sized = F.transform(lists, lambda a, i: F.struct(F.size(a).alias("n"), (-i).alias("i")))
    best = F.array_max(sized)
    chosen = F.when(best["n"] > 0, F.get(lists, -best["i"])).otherwise(F.array("v"))
    records = F.when(top.isNotNull(), objects(top)).when(fields.isNotNull(), chosen)
    return raw.select("path", F.posexplode(records).alias("ord", "record"))
