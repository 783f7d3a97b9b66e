"""Packing and mixing."""

import random
from collections import defaultdict

from pyspark.sql import functions as F

from trackspark.llm import mixing, packing
from trackspark.llm.tokens import encoding, token_counts, RANKS


def test_token_counts(spark):
    texts = ["plain words, 123", "", None, "x" * 20_000, "naïve — ünïcode\r\n\t", "<|endoftext|>"]
    df = spark.createDataFrame([(i, t, 5) for i, t in enumerate(texts)], "doc_id long, text string, n_tokens long")
    got = {r.doc_id: r.n_tokens for r in token_counts(df, ["doc_id"]).collect()}
    assert got == {i: 0 if t is None else len(encoding(RANKS).encode_ordinary(t)) for i, t in enumerate(texts)}


def test_crossover_loses_and_doubles_nothing():
    rnd = random.Random(1)
    sizes = [rnd.randint(1, 90) for _ in range(300)]
    a, ar, b, br = [], [], [], []
    packing.best_fit(list(range(300)), sizes, 100, a, ar)
    packing.best_fit(sorted(range(300), key=lambda i: rnd.random()), sizes, 100, b, br)
    child, room = packing.crossover(a, ar, b, br, sizes, 100, rnd)
    assert sorted(i for x in child for i in x) == list(range(300))
    assert all(sum(sizes[i] for i in x) + r == 100 and r >= 0 for x, r in zip(child, room))


def test_evolution_beats_its_start():
    rnd = random.Random(2)
    worse = better = 0
    for seed in range(12):
        if seed % 2:
            sizes = [rnd.choice([rnd.randint(200, 500), rnd.randint(20, 120)]) for _ in range(200)]
        else:  # three items fill a container to the last token
            sizes = []
            for _ in range(40):
                x = rnd.randint(380, 490)
                y = rnd.randint(250, (1000 - x) // 2)
                sizes += [x, y, 1000 - x - y]
        start, room = [], []
        packing.best_fit(sorted(range(len(sizes)), key=lambda i: -sizes[i]), sizes, 1000, start, room)
        best = packing.evolve(sizes, 1000, seed, generations=40)[0]
        assert sorted(i for x in best for i in x) == list(range(len(sizes)))
        worse += len(best) > len(start)
        better += len(best) < len(start)
    assert worse == 0 and better >= 4
    assert packing.evolve([], 10, 0, [[]]) == [[]]


def test_elites_migrate_round_the_islands(spark):
    rnd = random.Random(4)
    items = spark.createDataFrame([(1, 1000, i, 0, rnd.randint(120, 480)) for i in range(300)], "spec_id long, capacity long, item_id long, piece_no long, n long")
    got = packing._round(items, 1).collect()
    assert sorted(r.item_id for r in got) == list(range(300))
    used = defaultdict(int)
    for r in got:
        used[r.cell, r.bin] += r.n
    assert max(used.values()) <= 1000
    start, room = [], []
    sizes = [r.n for r in items.orderBy("item_id").collect()]
    packing.best_fit(sorted(range(300), key=lambda i: -sizes[i]), sizes, 1000, start, room)
    assert len(used) <= len(start)


def test_pack_whole_table(spark):
    rnd = random.Random(3)
    rows = [(i, rnd.choice([None, 0, -3, 512, 1024, *(rnd.randint(1, 700) for _ in range(6))])) for i in range(3000)] + [(9000, 51_300)]
    items = spark.createDataFrame([(*r, "clash") for r in rows], "item_id long, n long, capacity string").select("item_id", "n")
    specs = spark.createDataFrame([(1, 512), (2, 2048), (3, 0), (4, None)], "spec_id long, capacity long")
    got = packing.pack(items, specs).collect()
    for spec, cap in ((1, 512), (2, 2048)):
        used, per = defaultdict(int), defaultdict(int)
        pieces = defaultdict(list)
        for r in got:
            if r.spec_id == spec:
                used[r.container_id] += r.n_tokens
                per[r.item_id] += r.n_tokens
                pieces[r.item_id].append((r.piece_no, r.n_tokens))
        assert max(used.values()) <= cap
        assert dict(per) == {i: n for i, n in rows if n and n > 0}
        for i, p in pieces.items():
            assert len(p) == -(-per[i] // cap) and sorted(k for k, _ in p) == list(range(len(p)))
        assert sum(used.values()) / (len(used) * cap) > 0.97
    assert {r.spec_id for r in got} == {1, 2}
    assert packing.pack(items.limit(0), specs).count() == 0


def test_allocation_caps_and_spreads():
    got = mixing.allocate([("a", 0.5, 1), ("b", 0.3, 9), ("c", 0.2, 2), ("none", 0.1, 3), ("neg", -1.0, 1), ("null", None, None)], {"a": 100, "b": 1000, "c": 10, "neg": 5, "null": 5}, 1000)
    assert got["a"] == 100 and got["c"] == 20 and abs(got["b"] - 880) < 1e-6
    assert got["none"] == got["neg"] == got["null"] == 0
    assert mixing.allocate([], {}, 10) == {}


def test_mix_reaches_sizes(spark):
    rnd = random.Random(5)
    rows = [(i, rnd.choice(["a", "a", "a", "b", "c", "d", None]), rnd.choice([0, None, rnd.randint(1, 40)])) for i in range(6000)]
    rows += [(7000, "b", 26_000), (7001, "e", 900), (7002, "e", 500), (7003, "e", 300)]
    df = spark.createDataFrame([(*r, "x") for r in rows], "id long, source string, n long, q string")
    targets = [("a", 0.1, 1), ("b", 0.5, 3), ("c", 0.3, 4), ("zzz", 0.1, 2), ("e", 0.012, 2)]
    drawn, found = mixing.mix(df, targets)
    got = drawn.collect()
    size, hits = defaultdict(int), {}
    for r in got:
        assert 1 <= r.copies <= {"a": 1, "b": 3, "c": 4, "e": 2}[r.source] and r.n > 0
        size[r.source] += r.n * r.copies
        hits[r.id] = r.copies
    assert len(hits) == len(got)
    for s, (have, want) in found.items():
        if not have:
            continue
        sure = int(want // have)
        open_ = [n for i, src, n in rows if src == s and n and n > 0 and hits.get(i, 0) == sure]
        assert size[s] <= want + 1e-6
        assert want - size[s] < min(open_, default=1) or size[s] == have * {"a": 1, "b": 3, "c": 4, "e": 2}[s]
    assert found["zzz"] == (0, 0.0)
    assert sorted(map(tuple, drawn.collect())) == sorted(map(tuple, got))
    assert mixing.mix(df.limit(0), targets)[0].count() == 0


def test_inclusion_takes_certainties_out(spark):
    df = spark.createDataFrame([("a", 100, 1), ("a", 10, 20), ("a", 1, 50), ("b", 5, 4)], "source string, n long, k long")
    got = mixing.inclusion(df, {"a": 150.0, "b": 7.0, "none": 0.0})
    for s, rest in (("a", 150.0), ("b", 7.0)):
        scale, open_ = got[s]
        sizes = [(r.n, r.k) for r in df.collect() if r.source == s]
        assert abs(sum(min(1.0, scale * n) * n * k for n, k in sizes) - rest) < 1e-9
        assert abs(open_ - (rest - sum(n * k for n, k in sizes if scale * n >= 1))) < 1e-9
    assert set(got) == {"a", "b"}


def test_sample_draws_by_inclusion_probability(spark):
    rows = [(i, "s", 1 + i % 7) for i in range(140)]
    df = spark.createDataFrame(rows, "id long, source string, n long").cache()
    drawn, rounds = defaultdict(int), 25
    for seed in range(rounds):
        for r in mixing.sample(df, {"s": 170.0}, seed).filter("hit").collect():
            drawn[r.n] += 1
    scale = 170.0 / sum(n * n for _, _, n in rows)
    for n in range(2, 8):
        assert abs(drawn[n] / (20 * rounds) - scale * n) < 0.09
    assert drawn[7] > 2 * drawn[2]


def test_no_range_of_ranks_holds_a_source(spark):
    n = 20_000
    df = spark.range(n).select(F.col("id"), F.lit("s").alias("source"), (F.pow(F.lit(1000.0), F.rand(3))).cast("long").alias("n"))
    total = df.agg(F.sum("n")).first()[0]
    for share in (1e-4, 0.3, 0.9):
        scale, _ = mixing.inclusion(df.groupBy("source", "n").agg(F.count(F.lit(1)).alias("k")), {"s": total * share})["s"]
        pi, u = F.least(F.col("n") * scale, F.lit(1.0)), mixing.unit(1, "id")
        ranges = df.filter(pi < 1).select(F.floor((F.log(u / (1 - u)) - F.log(pi / (1 - pi))) * mixing.FINE).alias("r"))
        assert ranges.groupBy("r").count().agg(F.max("count")).first()[0] <= 4 * n / (4 * mixing.FINE) + 10
