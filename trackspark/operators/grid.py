"""Irregular readings onto a regular grid.

Method: every source (an entity such as a recording) is cut into time shards of ``SHARD`` slots.
Each shard knows its first and last reading; a prefix scan over these summaries carries the state
across shard borders, and every shard is then filled on its own. No task ever sees more than one
shard of a source, so a source with a third of all rows is spread like any other.

Defined results
* no readings, or only unusable ones: the source has no rows, but :func:`fill` marks all its slots
  "missing" where :func:`ends` knows it;
* repeated readings, ties in time: one slot takes the reading latest in time, then by id;
* null, NaN, infinite or negative times and null or NaN values are unusable;
* a null source column is a source of its own; extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from trackspark.operators.dedupe import latest
from trackspark.operators.scan import join_null_safe, prefix_scan

#: Slots in a shard.
SHARD = 4096
#: A pause longer than this many seconds is a stop of the recorder.
STOP_S = 900.0


def is_usable(t: str = "t_s", values: tuple[str, ...] = ("x", "y"), valid: str = "valid") -> Column:
    """True for a reading that may fill a slot, never null."""
    cond = F.col(valid) & (F.col(t) >= 0) & ~F.isnan(t) & (F.col(t) < F.lit(float("inf")))
    for v in values:
        cond = cond & F.col(v).isNotNull() & ~F.isnan(v)
    return F.coalesce(cond, F.lit(False))


def newest_samples(gaze: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """(sample_id, ok, dataset, episode_id, t_s, *keep) of the newest version of every sample, usable or not."""
    cols = [F.when(is_usable(), F.col(c)).alias(c) for c in keep]
    return latest(gaze.select("sample_id", "arrived_at", is_usable().alias("ok"), "dataset", "episode_id", "t_s", *cols), "sample_id", "arrived_at").drop("arrived_at")


def usable_samples(gaze: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """(sample_id, dataset, episode_id, t_s, *keep) of the usable newest versions.

    Usability is decided before the shuffle, so that of an unusable version only its stamp travels.
    """
    ok = is_usable()
    cols = [F.when(ok, F.col(c)).alias(c) for c in ("dataset", "episode_id", "t_s", *keep)]
    slim = gaze.select("sample_id", "arrived_at", ok.alias("__ok"), *cols)
    return latest(slim, "sample_id", "arrived_at").filter("__ok").drop("__ok", "arrived_at")


def slots(samples: DataFrame, rates: DataFrame, source: list[str], values: tuple[str, ...] = (), shard: int = SHARD) -> DataFrame:
    """One row per occupied slot: source, shard, slot, hz, n and the chosen reading's values.

    ``rates`` gives ``hz`` per dataset (a small dimension); readings of datasets without a positive
    rate have no grid. Readings are reduced to slots before the shuffle, and only slots are then
    partitioned by (source, shard): what follows inside a shard needs no other shuffle.
    """
    s = samples.select(*source, "t_s", "sample_id", *values).join(rates.filter("hz > 0").select("dataset", "hz"), "dataset")
    s = s.withColumn("slot", F.floor(F.col("t_s") * F.col("hz")).cast("long"))
    s = s.withColumn("shard", F.floor(F.col("slot") / F.lit(shard)).cast("long"))
    s = s.select(*source, "shard", "slot", "hz", *(["t_s", "sample_id", *values] if values else []))
    aggs = [F.count(F.lit(1)).alias("n")]
    if values:
        aggs.append(F.max(F.struct("t_s", "sample_id", *values)).alias("r"))
    return s.groupBy(*source, "shard", "slot", "hz").agg(*aggs).repartition(*source, "shard")


def _shard_summary(occupied: DataFrame, source: list[str]) -> DataFrame:
    """First and last occupied slot of each shard, and the last one before the shard."""
    ends = occupied.groupBy(*source, "shard", "hz").agg(F.min("slot").alias("first"), F.max("slot").alias("last"))
    return prefix_scan(ends, source, "shard", "last", "carry")


def gaps(occupied: DataFrame, source: list[str]) -> DataFrame:
    """(source, hz, slot_from, slot_to): maximal runs of empty slots between two occupied ones.

    Runs inside a shard come from the shard alone, runs over shard borders from the carried state.
    """
    w = Window.partitionBy(*source, "shard").orderBy("slot")
    inner = occupied.withColumn("before", F.lag("slot").over(w)).select(*source, "hz", (F.col("before") + 1).alias("slot_from"), (F.col("slot") - 1).alias("slot_to"))
    border = _shard_summary(occupied, source).select(*source, "hz", (F.col("carry") + 1).alias("slot_from"), (F.col("first") - 1).alias("slot_to"))
    return inner.unionByName(border).filter("slot_from <= slot_to")


def ends(episodes: DataFrame, newest: DataFrame, rates: DataFrame, source: list[str]) -> DataFrame:
    """(source, hz, end): the last slot of every source, one row each.

    ``episodes`` gives ``duration_s`` per source and may repeat; ``newest`` comes from
    :func:`newest_samples`, so that unusable samples reach as far as usable ones. The later of both
    counts. Durations and times that are null, NaN, infinite or negative say nothing; a source
    without any other has slot 0 alone.
    """
    both = episodes.select(*source, F.col("duration_s").alias("t")).unionByName(newest.select(*source, F.col("t_s").alias("t")))
    known = (F.col("t") >= 0) & ~F.isnan("t") & (F.col("t") < F.lit(float("inf")))
    last = both.groupBy(*source).agg(F.max(F.when(known, F.col("t"))).alias("t")).join(rates.filter("hz > 0").select("dataset", "hz"), "dataset")
    return last.select(*source, "hz", F.coalesce(F.floor(F.col("t") * F.col("hz")).cast("long"), F.lit(0).cast("long")).alias("end"))


def fill(occupied: DataFrame, source: list[str], values: tuple[str, ...], max_gap: DataFrame, shard: int = SHARD, stop_s: float = STOP_S, until: DataFrame | None = None) -> DataFrame:
    """The full grid: source, slot, time_s, values, valid, state.

    ``occupied`` comes from :func:`slots` with the same values; ``max_gap`` gives ``max_gap_s`` per
    dataset. An empty slot between two readings at most ``max_gap_s`` apart is interpolated
    ("filled"); others are marked "missing", those of a recorder stop "stop", those before the
    first reading "before". Slots run from 0 to the last occupied one, or with ``until`` (from
    :func:`ends`) to the source's end: those after the last reading, and all of a source without
    readings, are "missing".
    """
    here = ["slot", "t_s", *values]
    flat = occupied.select(*source, "shard", "hz", "slot", F.col("r.t_s").alias("t_s"), *[F.col(f"r.{v}").alias(v) for v in values])
    flat = flat.withColumn("me", F.struct(*here))
    w = Window.partitionBy(*source, "shard").orderBy("slot")
    flat = flat.withColumn("prev", F.lag("me").over(w))
    ends = flat.groupBy(*source, "shard").agg(F.max("me").alias("last"))
    carry = prefix_scan(ends, source, "shard", "last", "carry").drop("last")
    # only the first reading of a shard looks beyond it
    first = join_null_safe(flat.filter("prev IS NULL"), carry, [*source, "shard"]).withColumn("prev", F.col("carry")).drop("carry")
    runs = flat.filter("prev IS NOT NULL").unionByName(first)
    runs = runs.join(max_gap, "dataset", "left")
    lo = F.coalesce(F.col("prev.slot") + 1, F.lit(0).cast("long"))
    runs = runs.withColumn("lo", lo).withColumn("tail", F.lit(False))
    if until is not None:
        reached = occupied.groupBy(*source).agg(F.max("slot").alias("reached"))
        tails = join_null_safe(until, reached, source).withColumn("lo", F.coalesce(F.col("reached") + 1, F.lit(0).cast("long")))
        tails = tails.filter("lo <= end").select(*source, "hz", F.col("end").alias("slot"), "lo", F.lit(True).alias("tail"))
        runs = runs.unionByName(tails, allowMissingColumns=True)
    runs = runs.withColumn("chunk", F.explode(F.sequence(F.floor(F.col("lo") / shard), F.floor(F.col("slot") / shard))))
    a, b = F.greatest("lo", F.col("chunk") * shard), F.least("slot", F.col("chunk") * shard + (shard - 1))
    runs = runs.withColumn("g", F.explode(F.sequence(a.cast("long"), b.cast("long"))))
    own = F.col("g") == F.col("slot")
    time = F.col("g") / F.col("hz")
    share = (time - F.col("prev.t_s")) / (F.col("t_s") - F.col("prev.t_s"))
    close = F.coalesce((F.col("t_s") - F.col("prev.t_s")) <= F.col("max_gap_s"), F.lit(False))
    state = (
        F.when(F.col("tail"), "missing")
        .when(own, "sample")
        .when(F.col("prev").isNull(), "before")
        .when((F.col("slot") - F.col("lo")) / F.col("hz") > stop_s, "stop")
        .when(close, "filled")
        .otherwise("missing")
    )
    out = runs.withColumn("state", state)
    lerp = lambda v: F.when(F.col("state") == "sample", F.col(v)).when(F.col("state") == "filled", F.col(f"prev.{v}") + (F.col(v) - F.col(f"prev.{v}")) * share)
    return out.select(*source, F.col("g").alias("slot"), time.alias("time_s"), *[lerp(v).alias(v) for v in values], F.col("state").isin("sample", "filled").alias("valid"), "state")
