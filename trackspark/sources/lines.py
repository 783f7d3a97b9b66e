"""Lines and cells of text files, read in splits.

A file's lines keep their order: a line's number is the number of lines in the splits before its own
plus its place there. The table of splits has one row per split; text is never moved to a file's row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def lines(spark: SparkSession, path: str) -> DataFrame:
    """(path, ord, line) of all files; ord counts a file's lines from 0."""
    raw = spark.read.text(path).select(F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("at"), F.col("value").alias("line"))
    per = raw.groupBy("path", "block").agg(F.min("at").alias("low"), F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("path").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)  # a row per split
    per = per.select("path", "block", (F.coalesce(F.sum("n").over(before), F.lit(0)) - F.col("low")).alias("shift"))
    return raw.join(per, ["path", "block"]).select("path", (F.col("at") + F.col("shift")).alias("ord"), "line")


def cells(line: Column, sep: str, n: int) -> Column:
    """The first n cells of a line, quotes understood; cells that are missing are null."""
    got = F.from_csv(line, F.lit(", ".join(f"c{i} STRING" for i in range(n))), {"sep": sep})
    return F.array(*[F.trim(got[f"c{i}"]) for i in range(n)])


def csv_records(spark: SparkSession, path: str, strip_suffix: bool = False) -> DataFrame:
    """(path, ord, rec): rows of CSV files as maps from each file's own header, names trimmed.

    The separator of a file is ",", ";" or tab, whichever its header has most of. A header may begin
    with "#"; with ``strip_suffix`` its names lose a trailing "(suffix)". ord counts rows from 0.
    """
    text = lines(spark, path).filter(F.length(F.trim("line")) > 0)
    head = text.groupBy("path").agg(F.min(F.struct("ord", "line")).alias("h"))
    count = lambda sep: F.length("h.line") - F.length(F.replace(F.col("h.line"), F.lit(sep)))
    sep = F.when((count(";") > count(",")) & (count(";") >= count("\t")), ";").when(count("\t") > count(","), "\t").otherwise(",")
    bare = F.regexp_replace("h.line", "^[\\uFEFF\\s#]+", "")
    head = head.select("path", F.col("h.ord").alias("first"), bare.alias("names"), sep.alias("sep"), (F.greatest(count(","), count(";"), count("\t")) + 1).alias("width"))
    kinds = [(r.sep, r.width) for r in head.groupBy("sep").agg(F.max("width").alias("width")).collect()]  # at most three
    name = (lambda c: F.regexp_replace(c, r"\s*\([^)]*\)\s*$", "")) if strip_suffix else (lambda c: c)
    out = None
    for s, width in kinds:
        mine = head.filter(F.col("sep") == s).withColumn("names", F.transform(cells(F.col("names"), s, width), name))
        rows = text.join(mine.select("path", "first", "names"), "path").filter("ord > first").withColumn("values", cells(F.col("line"), s, width))
        both = F.filter(F.arrays_zip("names", "values"), lambda x: F.length(x["names"]) > 0)
        rec = F.aggregate(both, F.array().cast("array<struct<names:string,values:string>>"), lambda a, x: F.when(F.exists(a, lambda y: y["names"] == x["names"]), a).otherwise(F.array_append(a, x)))
        part = rows.select("path", (F.col("ord") - F.col("first") - 1).alias("ord"), F.map_from_entries(rec).alias("rec"))
        out = part if out is None else out.unionByName(part)
    return out if out is not None else spark.createDataFrame([], "path string, ord long, rec map<string,string>")
