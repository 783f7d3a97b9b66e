"""Keep the newest version of each record."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def latest(df: DataFrame, key: str, order: str) -> DataFrame:
    """The row of each ``key`` with the largest ``order``; null counts as oldest, of ties one stays.

    An aggregate, not a window: versions are reduced before the shuffle, so a record repeated a
    million times costs its mappers one row each. Rows with a null key are versions of one unknown
    record and are treated as such.
    """
    rest = [c for c in df.columns if c not in (key, order)]
    newest = F.max_by(F.struct(*rest), F.struct(F.col(order).isNotNull(), F.col(order)))
    return df.groupBy(key).agg(newest.alias("__v"), F.max(order).alias(order)).select(key, order, *[F.col("__v").getField(c).alias(c) for c in rest])
