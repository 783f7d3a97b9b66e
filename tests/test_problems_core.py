"""Grids, nested records and periods against brute force, and their edge cases."""

import json
import random

from pyspark.sql import functions as F

from trackspark.operators import grid, nested, periods
from trackspark.operators.scan import prefix_scan

GAZE = "sample_id long, dataset string, episode_id string, ord long, t_s double, x double, y double, valid boolean, arrived_at timestamp, slot string"


def test_prefix_scan_matches_brute_force(spark):
    rnd = random.Random(3)
    rows = [(k, p, rnd.choice([None, rnd.randint(0, 99)])) for k in ("a", None) for p in rnd.sample(range(200), 60)]
    df = spark.createDataFrame(rows, "k string, p long, v long")
    for how in ("last", "max"):
        for reverse in (False, True):
            got = {(r.k, r.p): r.o for r in prefix_scan(df, ["k"], "p", "v", "o", how, reverse, fan=7).collect()}
            for k, p, _ in rows:
                before = [(q, v) for kk, q, v in rows if kk == k and v is not None and (q > p if reverse else q < p)]
                want = None if not before else max(v for _, v in before) if how == "max" else (min if reverse else max)(before)[1]
                assert got[(k, p)] == want


def _gaze(spark, rows):
    import datetime as dt

    at = dt.datetime(2024, 1, 1)
    return spark.createDataFrame([(i, d, e, 0, t, x, y, v, at + dt.timedelta(seconds=a) if a is not None else None, "clash") for i, d, e, t, x, y, v, a in rows], GAZE)


def test_grid_versions_nulls_and_gaps(spark):
    nan = float("nan")
    rows = [(1, "d", "e", 0.05, 1.0, 1.0, True, 0), (2, "d", "e", 0.95, 2.0, 2.0, True, 0), (2, "d", "e", 0.35, 2.0, 2.0, True, 5), (3, "d", "e", 0.15, None, 1.0, True, 0), (4, "d", "e", 0.15, nan, 1.0, True, 0), (5, "d", "e", -1.0, 1.0, 1.0, True, 0), (6, "d", "e", None, 1.0, 1.0, True, 0), (7, "d", "e", float("inf"), 1.0, 1.0, True, 0), (8, "d", "e", 0.15, 1.0, 1.0, None, 0), (9, "d", None, 0.05, 1.0, 1.0, True, None), (10, "x", "e", 0.05, 1.0, 1.0, True, 0), (1, "d", "e", 0.05, 1.0, 1.0, True, 0)]
    rates = spark.createDataFrame([("d", 10.0)], "dataset string, hz double")
    s = grid.usable_samples(_gaze(spark, rows))
    got = grid.gaps(grid.slots(s, rates, ["dataset", "episode_id"], shard=2), ["dataset", "episode_id"]).collect()
    assert [(r.dataset, r.episode_id, r.slot_from, r.slot_to) for r in got] == [("d", "e", 1, 2)]
    assert grid.gaps(grid.slots(s.limit(0), rates, ["dataset", "episode_id"]), ["dataset", "episode_id"]).count() == 0


def test_grid_fill_matches_brute_force_over_shards(spark):
    rnd = random.Random(5)
    times = sorted(rnd.sample(range(3000), 40))
    rows = [(i, "d", "e", t / 10 + 0.01, float(t), 0.0, True, 0) for i, t in enumerate(times)]
    rates = spark.createDataFrame([("d", 10.0)], "dataset string, hz double")
    gap = spark.createDataFrame([("d", 3.0)], "dataset string, max_gap_s double")
    occupied = grid.slots(grid.usable_samples(_gaze(spark, rows), ("x", "y")), rates, ["dataset", "episode_id"], ("x", "y"), shard=16)
    got = {r.slot: r for r in grid.fill(occupied, ["dataset", "episode_id"], ("x", "y"), gap, shard=16, stop_s=15.0).collect()}
    assert sorted(got) == list(range(max(times) + 1))
    for k, r in got.items():
        before, after = [t for t in times if t < k], [t for t in times if t > k]
        if k in times:
            want = "sample"
        elif not before:
            want = "before"
        elif after[0] - before[-1] - 1 > 150:
            want = "stop"
        else:
            want = "filled" if (after[0] - before[-1]) / 10 <= 3.0 + 1e-9 else "missing"
        assert r.state == want, (k, r)
        if want == "filled":
            assert abs(r.x - (k - 0.1)) < 1e-6


def test_periods_match_brute_force(spark):
    rnd = random.Random(7)
    rows = [(e, s, s + rnd.choice([-3, 0, 5, 40, 400]), 3) for e in ("a", "b", None) for s in (rnd.randint(-200, 2000) for _ in range(60))]
    rows += [("a", None, 5, 3), ("a", 5, None, 3)] + rows[:9]
    df = spark.createDataFrame(rows, "ent string, s long, e long, gap long")
    got = sorted(((r.ent or "", r.s, r.e, r.gap_from) for r in periods.periods(df, ["ent"], shard_len=50).collect()), key=str)
    want = []
    for ent in ("a", "b", None):
        cur, prev = None, None
        for s, e in sorted({(s, e) for n, s, e, _ in rows if n == ent and s is not None and e is not None and e > s}):
            if cur is None or s > cur[1] + 3:
                if cur:
                    want.append((ent or "", *cur, prev))
                    prev = cur[1]
                cur = [s, e]
            cur[1] = max(cur[1], e)
        want.append((ent or "", *cur, prev))
    assert got == sorted(want, key=str)
    assert periods.periods(df.limit(0), ["ent"]).count() == 0


def test_ms_rejects_what_is_no_time(spark):
    rows = [(None,), (float("nan"),), (float("inf"),), (1.2344999999,), (-0.5,)]
    got = [r[0] for r in spark.createDataFrame(rows, "v double").select(periods.ms(F.col("v"))).collect()]
    assert got == [None, None, None, 1234, -500]


def test_nested_wrapping_positions_and_bad_payloads(spark):
    doc = {"annotations": {"t.1": [{"descriptions": ["n/a", {"text": "a", "revisions": {"by": "r"}}, None, {"revisions": [1, {"by": "q"}]}]}, None], "t2": {"descriptions": {"text": "one"}}, "t3": None}}
    plain = json.dumps(doc)
    twice = json.dumps(json.dumps(plain))
    rows = [(1, "k", plain), (2, "k", " \n" + twice), (3, "k", "[" + plain + "]"), (4, "k", plain[:-9]), (5, "k", plain + " x"), (6, "k", None), (7, "k", ""), (8, "k", "null"), (9, "k", '"text"'), (10, "l", json.dumps({"video_name": "v", "events": [{"id": 0}, 3, {"id": 1}]})), (11, "l", "[]"), (12, "z", plain)]
    df = spark.createDataFrame(rows, "raw_id long, dataset string, payload string")
    t = nested.takes(df, {"k": "annotations.{id}", "l": "[video_name].events"}, ["raw_id"])
    ids = ["dataset", "raw_id", "top_no", "take_key"]
    levels = nested.levels(t, "take", ids)
    assert len(levels) == 3
    items = {(r.raw_id, r.take_key, tuple(r.path), tuple(r.trail)) for r in levels[1].collect()}
    want = {(i, "t.1", ("descriptions",), (0, n)) for i in (1, 2, 3) for n in (1, 3)} | {(i, "t2", ("descriptions",), (0, 0)) for i in (1, 2, 3)} | {(10, "v", ("events",), (0, n)) for n in (0, 2)}
    assert items == want
    revs = sorted((r.raw_id, tuple(r.trail)) for r in levels[2].collect())
    assert revs == sorted((i, p) for i in (1, 2, 3) for p in ((0, 1, 0), (0, 3, 1)))
    parents = {r.row_id for r in levels[1].collect()}
    assert all(r.parent_id in parents for r in levels[2].collect())
    assert nested.levels(t.limit(0), "take", ids) == []
    kinds = {(tuple(r.path), r.kind) for r in nested.infer(t, "take", "dataset").collect()}
    assert (("descriptions",), "single") in kinds and (("descriptions",), "array") in kinds
