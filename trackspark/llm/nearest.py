"""Matching the records of two tables by nearest time.

Method: both tables are cut into time shards per entity. The candidates of a shard, together with
those of its neighbours that lie within the tolerance of its edges, form a sorted array with a
piecewise-linear learned index: a greedy pass covers the array with the fewest segments whose line
predicts every position to within ``EPS``. A probe predicts its place and searches only the
``2 * EPS + 4`` entries around it, which hold the exact neighbours.

A shard's array has the candidates of ``SHARD_S`` seconds of one entity, so an entity with a third
of all rows is spread over its shards.

Defined results
* candidates at one instant: the smallest id represents them; of two equally near, the earlier;
* null entity columns match nothing; null tolerance: the probe has no partner;
* repeated rows of a candidate change nothing; empty tables give no partner.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Largest error of a predicted position.
EPS = 8
#: Seconds in a shard; longer where the tolerance asks for it.
SHARD_S = 240.0


def build_index(t, eps: int = EPS):
    """Segments (first key, first position, slope) that predict positions in sorted ``t`` to ``eps``."""
    import numpy as np

    keys = t.tolist()
    n = len(keys)
    at, slopes = [], []
    i = 0
    while i < n:
        x0, lo, hi, j = keys[i], 0.0, float("inf"), i + 1
        while j < n:
            dx, dy = keys[j] - x0, j - i
            low, high = (dy - eps) / dx, (dy + eps) / dx
            if low > hi or high < lo:
                break
            if low > lo:
                lo = low
            if high < hi:
                hi = high
            j += 1
        at.append(i)
        slopes.append(0.0 if hi == float("inf") else (lo + hi) / 2)
        i = j
    at = np.asarray(at, dtype=np.int64)
    return t[at], at, np.asarray(slopes)


def lookup(t, index, q, eps: int = EPS):
    """Position in ``t`` of the entry nearest to each ``q``; of two equally near the earlier."""
    import numpy as np

    first, at, slope = index
    seg = np.clip(np.searchsorted(first, q, side="right") - 1, 0, None)
    end = np.append(at[1:], len(t))[seg]
    guess = at[seg] + slope[seg] * np.maximum(q - first[seg], 0.0)
    guess = np.minimum(guess, end).astype(np.int64)
    window = np.arange(-eps - 2, eps + 3)
    out = np.empty(len(q), dtype=np.int64)
    for a in range(0, len(q), 65536):
        pos = np.clip(guess[a : a + 65536, None] + window, 0, len(t) - 1)
        best = np.abs(t[pos] - q[a : a + 65536, None]).argmin(axis=1)
        out[a : a + 65536] = pos[np.arange(len(pos)), best]
    return out


def _match(left, right):
    import numpy as np
    import pyarrow as pa
    import pyarrow.compute as pc

    n = left.num_rows
    ids = left.column("probe_id").combine_chunks()
    q = left.column("q").to_numpy()
    if n == 0 or right.num_rows == 0:
        none = pa.nulls(n)
        return pa.table({"probe_id": ids.cast(pa.int64()), "match_id": none.cast(pa.int64()), "dt": none.cast(pa.float64())})
    t, c = right.column("t").to_numpy(), right.column("cand_id").to_numpy()
    order = np.lexsort((c, t))
    t, c = t[order], c[order]
    fresh = np.append(True, t[1:] != t[:-1])
    t, c = t[fresh], c[fresh]
    pos = lookup(t, build_index(t), q)
    dt = t[pos] - q
    near = np.abs(dt) <= left.column("tol").to_numpy()
    return pa.table({"probe_id": ids, "match_id": pa.array(c[pos], mask=~near), "dt": pc.if_else(pa.array(near), pa.array(dt), pa.scalar(None, pa.float64()))})


def nearest(probes: DataFrame, candidates: DataFrame, entity: list[str], shard_s: float = SHARD_S) -> DataFrame:
    """(probe_id, match_id, dt): each probe with its nearest candidate, null if none within ``tol``.

    ``probes`` has entity, probe_id, t, tol; ``candidates`` entity, cand_id, t, tol (the tolerance of
    the entity, by which shard edges overlap). Times are finite; callers filter what may not match.
    """
    width = F.greatest(F.lit(shard_s), F.col("tol") * 4)
    whole = F.lit(True)
    for k in entity:
        whole = whole & F.col(k).isNotNull()
    ok = whole & F.col("tol").isNotNull() & F.col("t").isNotNull()
    p = probes.filter(ok).select(*entity, F.floor(F.col("t") / width).cast("long").alias("shard"), "probe_id", F.col("t").alias("q"), "tol")
    reach = F.col("tol") * (1 + 1e-9) + 1e-9
    edges = F.sequence(F.floor((F.col("t") - reach) / width).cast("long"), F.floor((F.col("t") + reach) / width).cast("long"))
    c = candidates.filter(ok).select(*entity, F.explode(edges).alias("shard"), "cand_id", "t")
    pairs = p.groupBy(*entity, "shard").cogroup(c.groupBy(*entity, "shard")).applyInArrow(_match, "probe_id long, match_id long, dt double")
    lone = probes.filter(~F.coalesce(ok, F.lit(False))).select("probe_id", F.lit(None).cast("long").alias("match_id"), F.lit(None).cast("double").alias("dt"))
    return pairs.unionByName(lone)
