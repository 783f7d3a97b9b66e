"""Equality with a tolerance: null equals null, NaN equals NaN, numbers within ``tol``."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def close(a: Column, b: Column, tol: float | None) -> Column:
    if tol is None:
        return a.eqNullSafe(b)
    both = F.isnan(a) & F.isnan(b)
    return F.when(a.isNull() | b.isNull(), a.isNull() & b.isNull()).when(both, True).otherwise(F.coalesce(F.abs(a - b) <= F.lit(tol), F.lit(False)))
