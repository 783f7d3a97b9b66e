"""p6 and p7: containers filled with documents, and a mix of sources; sizes in tokens."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from trackspark.llm.mixing import mix
from trackspark.llm.packing import pack
from trackspark.llm.tokens import token_counts
from trackspark.session import durable, table


def _sizes(spark: SparkSession, d: str, *keep: str) -> DataFrame:
    """Documents with their size in tokens, counted once."""
    return durable(token_counts(table(spark, d, "documents"), ["doc_id", *keep]))


def p6_containers(spark: SparkSession, d: str) -> DataFrame:
    """Where each document, or each piece of a long one, lies: for every container specification."""
    specs = table(spark, d, "container_spec").select("spec_id", F.col("capacity_tokens").alias("capacity"))
    items = _sizes(spark, d).select(F.col("doc_id").alias("item_id"), F.col("n_tokens").alias("n"))
    return pack(items, specs).withColumnRenamed("item_id", "doc_id")


def p6_fill(spark: SparkSession, d: str) -> DataFrame:
    """Of each specification: containers, tokens, the least number possible, the share filled."""
    specs = table(spark, d, "container_spec")
    got = p6_containers(spark, d).groupBy("spec_id").agg(F.countDistinct("container_id").alias("containers"), F.sum("n_tokens").alias("tokens"))
    return got.join(specs, "spec_id").select("spec_id", "capacity_tokens", "containers", "tokens", F.ceil(F.col("tokens") / F.col("capacity_tokens")).alias("least"), F.round(F.col("tokens") / (F.col("containers") * F.col("capacity_tokens")), 6).alias("filled"))


def p6_bounds(spark: SparkSession, d: str) -> DataFrame:
    """Of each specification: documents packed, and containers or documents that break a rule (none)."""
    sizes = _sizes(spark, d).select("doc_id", F.col("n_tokens").alias("n"))
    specs = table(spark, d, "container_spec").select("spec_id", F.col("capacity_tokens").alias("capacity"))
    packed = durable(pack(sizes.withColumnRenamed("doc_id", "item_id"), specs))
    full = packed.groupBy("spec_id", "container_id").agg(F.sum("n_tokens").alias("used")).join(specs, "spec_id").groupBy("spec_id").agg(F.count_if(F.col("used") > F.col("capacity")).alias("overfull"))
    docs = packed.groupBy("spec_id", F.col("item_id").alias("doc_id")).agg(F.count(F.lit(1)).alias("pieces"), F.sum("n_tokens").alias("got")).join(sizes, "doc_id").join(specs, "spec_id")
    docs = docs.groupBy("spec_id").agg(F.count(F.lit(1)).alias("documents"), F.count_if(F.col("got") != F.col("n")).alias("incomplete"), F.count_if(F.col("pieces") != F.ceil(F.col("n") / F.col("capacity"))).alias("cut_too_often"))
    return docs.join(full, "spec_id").select("spec_id", "documents", "overfull", "incomplete", "cut_too_often")


def _mixed(spark: SparkSession, d: str) -> tuple[DataFrame, dict, list, DataFrame]:
    targets = [(r.source, r.target_share, r.max_repeats) for r in table(spark, d, "mix_target").collect()]  # 10 rows, fixed
    records = _sizes(spark, d, "source").select(F.col("doc_id").alias("id"), "source", F.col("n_tokens").alias("n"))
    drawn, found = mix(records, targets)
    return drawn, found, targets, records


def p7_mix(spark: SparkSession, d: str) -> DataFrame:
    """Drawn documents and how often each is used."""
    return _mixed(spark, d)[0].select(F.col("id").alias("doc_id"), "source", F.col("n").alias("n_tokens"), "copies")


def p7_shares(spark: SparkSession, d: str) -> DataFrame:
    """Of each target source: what it holds, what was wanted and drawn, and the shares beside the targets."""
    drawn, found, targets, _ = _mixed(spark, d)
    rows = [(s, t, k, *found[s]) for s, t, k in targets]
    base = spark.createDataFrame(rows, "source string, target_share double, max_repeats int, available_tokens long, wanted_tokens double")
    got = drawn.groupBy("source").agg(F.sum(F.col("n") * F.col("copies")).alias("drawn_tokens"), F.max("copies").alias("most_copies"))
    out = base.join(got, "source", "left").withColumn("total", F.sum("drawn_tokens").over(Window.partitionBy(F.lit(0))))  # a row per target
    n = F.coalesce("drawn_tokens", F.lit(0))
    return out.select("source", "target_share", F.round(n / F.col("total"), 6).alias("share"), "max_repeats", F.coalesce("most_copies", F.lit(0)).alias("most_copies"), "available_tokens", F.round("wanted_tokens").cast("long").alias("wanted_tokens"), n.alias("drawn_tokens"))


def p7_bounds(spark: SparkSession, d: str) -> DataFrame:
    """Of each target source: its documents with text, and those that break a rule of the mix (none).

    ``over_cap``: used more often than allowed; ``above``: 1 if more is drawn than wanted; ``open``:
    documents not drawn that what is missing would still hold.
    """
    drawn, found, targets, records = _mixed(spark, d)
    base = F.broadcast(spark.createDataFrame([(s, max(k or 0, 0), *found[s]) for s, _, k in targets], "source string, max_repeats int, available long, wanted double"))  # a row per target
    each = records.filter("n > 0").join(drawn.select("id", "copies"), "id", "left").withColumn("copies", F.coalesce("copies", F.lit(0)))
    got = F.broadcast(each.groupBy("source").agg(F.sum(F.col("n") * F.col("copies")).alias("drawn")))  # a row per source of the targets, after the join
    each = base.join(got, "source", "left").join(each, "source", "left").withColumn("sure", F.floor(F.col("wanted") / F.col("available") + 1e-12))
    undrawn = (F.col("copies") <= F.col("sure")) & (F.col("copies") < F.col("max_repeats"))
    return each.groupBy("source", "max_repeats").agg(
        F.count("id").alias("documents"),
        F.count_if(F.col("copies") > F.col("max_repeats")).alias("over_cap"),
        F.max(F.when(F.col("drawn") > F.col("wanted") + 1e-6, 1).otherwise(0)).cast("long").alias("above"),
        F.count_if(undrawn & (F.col("drawn") + F.col("n") <= F.col("wanted"))).alias("open"),
    )


QUERIES = {f.__name__: f for f in (p6_containers, p6_fill, p6_bounds, p7_mix, p7_shares, p7_bounds)}
# sizes depend on a tokenizer, which SQL has not: the rules of the results are compared
ORACLES = {
    "p6_bounds": """SELECT spec_id, (SELECT count(*) FROM documents WHERE length(text) > 0) AS documents, CAST(0 AS BIGINT) AS overfull, CAST(0 AS BIGINT) AS incomplete, CAST(0 AS BIGINT) AS cut_too_often FROM container_spec""",
    "p7_bounds": """SELECT m.source, m.max_repeats, count(d.doc_id) AS documents, CAST(0 AS BIGINT) AS over_cap, CAST(0 AS BIGINT) AS above, CAST(0 AS BIGINT) AS "open"
FROM mix_target m LEFT JOIN (SELECT * FROM documents WHERE length(text) > 0) d ON d.source = m.source GROUP BY 1, 2""",
}
