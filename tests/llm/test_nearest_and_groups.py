"""Nearest-time matching and grouped splits against brute force."""

import random

import numpy as np
from pyspark.sql import functions as F

from trackspark.llm.groups import assign, components
from trackspark.llm.nearest import EPS, build_index, lookup, nearest


def test_learned_index_error_is_bounded_and_search_exact():
    rnd = np.random.default_rng(1)
    for n in (1, 2, 50, 4000):
        t = np.unique(np.concatenate([rnd.random(n) * 10, rnd.random(n // 2) ** 8 * 1e6, [5.0]]))
        first, at, slope = index = build_index(t)
        seg = np.searchsorted(at, np.arange(len(t)), side="right") - 1
        assert np.abs(at[seg] + slope[seg] * (t - first[seg]) - np.arange(len(t))).max() <= EPS + 1e-6
        q = np.concatenate([rnd.random(500) * 12 - 1, rnd.random(50) * 1.1e6, t[:50], [-1e9, 1e9]])
        got = np.abs(t[lookup(t, index, q)] - q)
        want = np.array([np.abs(t - x).min() for x in q])
        assert (got == want).all()


def test_nearest_matches_brute_force_across_shards(spark):
    rnd = random.Random(2)
    probes = [(e, i * 10 + k, round(rnd.random() * 60, 3), 0.7) for k, e in enumerate(("a", "b", None)) for i in range(150)] + [("a", 9990, 3.0, None), ("lone", 9991, 3.0, 1.0)]
    cands = [(e, i, round(rnd.random() * 60, 3), 0.7, "x") for i in range(120) for e in ("a", "b", None)] + [("a", 5000, 9.9, 0.7, "x"), ("a", 4000, 9.9, 0.7, "x")]
    cands += cands[:20]
    p = spark.createDataFrame(probes, "ent string, probe_id long, t double, tol double")
    c = spark.createDataFrame(cands, "ent string, cand_id long, t double, tol double, extra string")
    got = {r.probe_id: r.match_id for r in nearest(p, c, ["ent"], shard_s=2.0).collect()}
    assert len(got) == len(probes)
    for e, i, q, tol in probes:
        near = sorted((abs(t - q), t, k) for ee, k, t, _, _ in cands if ee == e and e is not None and tol is not None and abs(t - q) <= tol)
        assert got[i] == (near[0][2] if near else None)
    assert nearest(p, c.limit(0), ["ent"]).filter("match_id IS NOT NULL").count() == 0
    assert nearest(p.limit(0), c, ["ent"]).count() == 0


def _brute(rows):
    parent = {r: r for r, _, _ in rows}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    by = {}
    for r, p, es in rows:
        for e in ([("p", p)] if p else []) + [("e", x) for x in es or [] if x]:
            if e in by:
                a, b = find(r), find(by[e])
                parent[max(a, b)] = min(a, b)
            by[e] = r
    return {r: find(r) for r in parent}


def test_components_match_union_find(spark):
    rnd = random.Random(4)
    rows = [(i, rnd.choice([None, f"s{rnd.randint(0, 40)}"]), rnd.choice([None, [None], [f"h{rnd.randint(0, 150)}"], [f"h{rnd.randint(0, 150)}", "h1x"]])) for i in range(1, 160)]
    rows += [(1000 + i, None, [f"c{i}", f"c{i + 1}"]) for i in range(40)] + rows[:10] + [(3, "s39", None)]
    df = spark.createDataFrame([(*r, "clash") for r in rows], "id long, p string, es array<string>, label string")
    got = {r.id: r.group_id for r in components(df, "id", F.col("p"), F.col("es")).collect()}
    assert got == _brute(rows)
    assert components(df.limit(0), "id", F.col("p"), F.col("es")).count() == 0


def test_assign_keeps_groups_and_ratios(spark):
    rnd = random.Random(6)
    rows = [(g, lab, rnd.randint(1, 4)) for g in range(3000) for lab in rnd.sample(["a", "b", None], rnd.randint(1, 2))] + [(9000, "a", 900), (9001, "b", 300)]
    df = spark.createDataFrame(rows, "group_id long, label string, n long")
    out = assign(df, {5: (42, [("train", 70.0), ("val", 15.0), ("test", 15.0)]), 6: (1, [("x", 1.0), ("y", 1.0)])})
    assert out.count() == 2 * 3002
    got = {r.group_id: r.subset for r in out.filter("request = 5").collect()}
    assert len(got) == 3002
    total = sum(n for *_, n in rows)
    for s, q in (("train", 0.7), ("val", 0.15), ("test", 0.15)):
        assert abs(sum(n for g, _, n in rows if got[g] == s) / total - q) < 0.001
        for lab in ("a", "b", None):
            mine = [(g, n) for g, x, n in rows if x == lab]
            assert abs(sum(n for g, n in mine if got[g] == s) / sum(n for _, n in mine) - q) < 0.003
    assert assign(df, {1: (1, [("x", 0.0), ("y", None)])}).count() == 0
    assert assign(df.limit(0), {1: (1, [("x", 1.0)])}).count() == 0
    assert {r.subset for r in assign(df, {1: (1, [("x", 0.0), ("y", 2.0)])}).collect()} == {"y"}


def test_assign_few_recording_sized_groups(spark):
    rnd = random.Random(7)
    rows = [(g, rnd.choice("abc"), rnd.randint(1, 9)) for g in range(90)] + [(100, "a", 37), (101, "b", 25)]
    df = spark.createDataFrame(rows, "group_id long, label string, n long")
    got = {r.group_id: r.subset for r in assign(df, {1: (3, [("train", 0.6), ("val", 0.1), ("test", 0.1)])}).collect()}
    for lab in "abc":
        total = sum(n for _, x, n in rows if x == lab)
        for s, q in (("train", 0.75), ("val", 0.125), ("test", 0.125)):
            assert abs(sum(n for g, x, n in rows if x == lab and got[g] == s) - q * total) <= 1.5


def test_hot_entities_and_primaries_are_spread(spark):
    rows = [(i, "hot" if i % 3 else f"s{i}", ["everyone"] if i % 2 else None) for i in range(1, 3000)] + [(5000 + i, f"t{i}", [f"c{i}", f"c{i + 1}"]) for i in range(30)]
    df = spark.createDataFrame(rows, "id long, p string, es array<string>")
    got = {r.id: r.group_id for r in components(df, "id", F.col("p"), F.col("es")).collect()}
    assert got == _brute(rows)
