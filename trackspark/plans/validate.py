"""Recompute and compare: two versions of a table by key and position, with tolerances."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trackspark.functions.diff import close


def differences(expected: DataFrame, actual: DataFrame, keys: list[str], columns: dict[str, float | None]) -> DataFrame:
    """One row per differing cell: keys, column, kind. ``columns`` give tolerances; None is exact.

    Rows on one side only are "missing" or "unexpected".
    """
    e = expected.select(*keys, *[F.col(c).alias(f"e_{c}") for c in columns], F.lit(True).alias("__e"))
    a = actual.select(*keys, *[F.col(c).alias(f"a_{c}") for c in columns], F.lit(True).alias("__a"))
    j = e.join(a, keys, "full")
    cells = F.array(*[F.when(~close(F.col(f"e_{c}"), F.col(f"a_{c}"), tol), F.lit(c)) for c, tol in columns.items()])
    kind = F.when(F.col("__a").isNull(), "missing").when(F.col("__e").isNull(), "unexpected").otherwise("differs")
    names = F.when(kind == "differs", F.filter(cells, lambda x: x.isNotNull())).otherwise(F.array(F.lit("*")))
    return j.select(*keys, F.explode(names).alias("column"), kind.alias("kind"))


def first_difference(diff: DataFrame, source: list[str], position: str) -> DataFrame:
    """Of each source: the first differing position, its column and the number of differences."""
    return diff.groupBy(*source).agg(F.min_by("column", F.struct(position, "column")).alias("column"), F.min(position).alias("position"), F.count(F.lit(1)).alias("total"))


def report(checks: DataFrame) -> DataFrame:
    """(name, ok, differences) per check, plus the row "all"."""
    return checks.rollup("name").agg(F.sum("differences").alias("differences")).select(F.coalesce("name", F.lit("all")).alias("name"), (F.col("differences") == 0).alias("ok"), "differences")
