"""p8: the reading band of every document with enough English prose."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trackspark.llm import reading
from trackspark.session import table


def _levels(spark: SparkSession, d: str) -> DataFrame:
    docs = table(spark, d, "documents")
    return reading.levels(docs, reading.fit(docs, table(spark, d, "reading_label")))


def p8_found(spark: SparkSession, d: str) -> DataFrame:
    """Band of each document with at least 40 words of English prose."""
    return _levels(spark, d).select("doc_id", "band")


def p8_profile(spark: SparkSession, d: str) -> DataFrame:
    """Of each source and band: documents and words of prose."""
    docs = table(spark, d, "documents").select("doc_id", "source")
    return _levels(spark, d).join(docs, "doc_id").groupBy("source", "band").agg(F.count(F.lit(1)).alias("documents"), F.sum("n_words").alias("words"))


QUERIES = {"p8_found": p8_found, "p8_profile": p8_profile}
ORACLES: dict[str, str] = {}
