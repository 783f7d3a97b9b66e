"""Filling fixed-capacity containers with items.

Method: a grouping genetic algorithm. An individual is a set of bins; crossover injects whole
well-filled bins of one parent into the other, drops the other's bins that hold a duplicate, and
best-fits the displaced items. Items are hashed into cells of about ``CELL``; every cell is worked
on by ``ISLANDS`` populations in separate tasks. After each of ``EPOCHS`` their elites migrate round
the ring of islands, and at the end into a last population of the cell. Bins that stay badly filled
hand their items to the next of ``ROUNDS`` over all cells, so that a cell's last, half-empty bins are
packed with those of the others.

Items longer than the capacity are cut into full containers and a remainder; nothing else is cut.

Defined results
* null, zero or negative sizes take no container; a null or non-positive capacity packs nothing;
* ties are broken by id, seeds are fixed: equal input gives equal output;
* repeated ids are separate items when their piece numbers differ; an empty table has no containers.
"""

from __future__ import annotations

import random
from bisect import bisect_left, insort

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trackspark.session import durable

#: Items of a cell; bounds what one task holds.
CELL = 2048
ISLANDS = 3
POPULATION = 4
#: Times an island evolves before a last population of all elites does, and generations each time.
EPOCHS = 3
GENERATIONS = 3
#: Packings of an island that live on and migrate.
ELITES = 2
#: A bin filled less than this hands its items to the next round.
WELL = 0.995
#: Rounds over all cells, each with other cells.
ROUNDS = 2

Bins = list[list[int]]


def best_fit(order: list[int], sizes: list[int], cap: int, bins: Bins, room: list[int]) -> None:
    """Put items, in order, into the fullest bin that takes them; bins and room grow in place."""
    free = sorted((r, b) for b, r in enumerate(room) if r > 0)
    for i in order:
        n = sizes[i]
        at = bisect_left(free, (n, -1))
        if at == len(free):
            b, r = len(bins), cap - n
            bins.append([i])
            room.append(r)
        else:
            r, b = free.pop(at)
            r -= n
            bins[b].append(i)
            room[b] = r
        if r > 0:
            insort(free, (r, b))


def fitness(room: list[int], cap: int) -> tuple[int, float]:
    """Fewer bins first, then uneven filling: what is left unused lies in few bins."""
    return len(room), -sum((cap - r) * (cap - r) for r in room) / (cap * cap)


def lower_bound(sizes: list[int], cap: int) -> int:
    """Bins that any packing needs: for each size k, large items share none, and those of k and more
    have to fit beside the middle ones (the bound L2 of the literature)."""
    import numpy as np

    if not sizes:
        return 0
    a = np.sort(np.asarray(sizes, dtype=np.int64))
    total = np.append(0, np.cumsum(a))
    n = len(a)
    half = np.searchsorted(a, cap / 2, side="right")
    k = np.append(0, np.unique(a[:half]))
    big = np.searchsorted(a, cap - k, side="right")  # from here on: larger than cap - k
    low = np.searchsorted(a, k, side="left")
    middle = big - half
    spare = middle * cap - (total[big] - total[half])
    more = np.maximum(0, -((spare - (total[half] - total[low])) // cap))
    return int((n - big + middle + more).max())


def _improve(bins: Bins, room: list[int], lost: list[int], sizes: list[int]) -> list[int]:
    """Swap items of unfilled bins for larger displaced ones that fit; what is displaced now."""
    spare = sorted((sizes[i], i) for i in lost)
    for b, bin_ in enumerate(bins):
        r = room[b]
        if not r or not spare:
            continue
        for at, i in enumerate(bin_):
            n = sizes[i]
            k = bisect_left(spare, (n + r + 1, -1)) - 1
            if k >= 0 and spare[k][0] > n:
                m, j = spare.pop(k)
                bin_[at] = j
                r -= m - n
                insort(spare, (n, i))
                if not r:
                    break
        room[b] = r
    return [i for _, i in spare]


def crossover(a: Bins, a_room: list[int], b: Bins, b_room: list[int], sizes: list[int], cap: int, rnd: random.Random) -> tuple[Bins, list[int]]:
    """A child: well-filled bins of ``a`` injected into ``b``."""
    full = sorted(range(len(a)), key=lambda k: a_room[k])
    take = full[: max(1, int(len(full) * (0.3 + 0.4 * rnd.random())))]
    moved = set()
    bins: Bins = []
    room: list[int] = []
    for k in take:
        bins.append(list(a[k]))
        room.append(a_room[k])
        moved.update(a[k])
    lost: list[int] = []
    for k, bin_ in enumerate(b):
        if moved.isdisjoint(bin_):
            bins.append(list(bin_))
            room.append(b_room[k])
        else:
            lost += [i for i in bin_ if i not in moved]
    # a few of the emptiest bins are opened as well, or good parents would only copy themselves
    for _ in range(max(1, len(bins) // 50)):
        if len(bins) > 1:
            k = max(rnd.sample(range(len(bins)), min(4, len(bins))), key=room.__getitem__)
            lost += bins[k]
            bins[k], room[k] = bins[-1], room[-1]
            bins.pop()
            room.pop()
    lost = _improve(bins, room, lost, sizes)
    lost.sort(key=lambda i: (-sizes[i], i))
    best_fit(lost, sizes, cap, bins, room)
    return bins, room


def evolve(sizes: list[int], cap: int, seed: int, elites: list[Bins] | None = None, population: int = POPULATION, generations: int = 12) -> list[Bins]:
    """The packings of one population, the best first. ``elites`` come from other islands."""
    rnd = random.Random(seed)
    least = lower_bound(sizes, cap)
    by_size = sorted(range(len(sizes)), key=lambda i: (-sizes[i], i))
    pool: list[tuple[tuple, Bins, list[int]]] = []

    def join(bins: Bins, room: list[int]) -> None:
        pool.append((fitness(room, cap), bins, room))

    for bins in elites or []:
        join(bins, [cap - sum(sizes[i] for i in b) for b in bins])
    while len(pool) < population and not (pool and pool[-1][0][0] <= least):
        order = by_size
        if pool or seed % 2:
            blur = [sizes[i] * (1 + 0.12 * rnd.random()) for i in range(len(sizes))]
            order = sorted(by_size, key=lambda i: -blur[i])
        bins, room = [], []
        best_fit(order, sizes, cap, bins, room)
        join(bins, room)
    pool.sort(key=lambda x: x[0])
    del pool[max(population, 1) :]
    for _ in range(generations):
        if pool[0][0][0] <= least or len(pool) < 2:
            break
        for _ in range(2):
            x, y = sorted(rnd.sample(range(len(pool)), 2))
            join(*crossover(pool[x][1], pool[x][2], pool[y][1], pool[y][2], sizes, cap, rnd))
        pool.sort(key=lambda x: x[0])
        del pool[population:]
    return [bins for _, bins, _ in pool]


_SOLUTION = "spec_id long, capacity long, cell long, island int, ids array<long>, pieces array<long>, sizes array<long>, elites array<array<int>>"


def _bins(of: list[int]) -> Bins:
    """Bins from the bin of each item."""
    bins: Bins = [[] for _ in range(max(of) + 1)]
    for i, k in enumerate(of):
        bins[k].append(i)
    return bins


def _of(bins: Bins, n: int) -> list[int]:
    of = [0] * n
    for k, b in enumerate(bins):
        for i in b:
            of[i] = k
    return of


def _seed(first, step: int) -> int:
    """Differs by cell, epoch and island; island 0 of epoch 0 begins with items by size."""
    return (int(first["cell"]) * (EPOCHS + 1) + step) * 2 * ISLANDS + int(first["island"])


def _solution(first, ids, pieces, sizes, pool: list[Bins]):
    import pandas as pd

    row = [int(first["spec_id"]), int(first["capacity"]), int(first["cell"]), int(first["island"]), ids, pieces, sizes, [_of(b, len(sizes)) for b in pool]]
    return pd.DataFrame([row], columns=["spec_id", "capacity", "cell", "island", "ids", "pieces", "sizes", "elites"])


def _found_island(pdf):
    """The first epoch of one island of a cell: its elites, from the cell's items."""
    pdf = pdf.sort_values(["item_id", "piece_no"])
    first, sizes = pdf.iloc[0], [int(n) for n in pdf["n"]]
    pool = evolve(sizes, int(first["capacity"]), _seed(first, 0), generations=GENERATIONS)
    return _solution(first, pdf["item_id"].tolist(), pdf["piece_no"].tolist(), sizes, pool[:ELITES])


def _next_island(step: int):
    def run(pdf):
        """A later epoch: the island's own elites meet the immigrants of its neighbour."""
        pdf = pdf.sort_values("origin")
        first, sizes = pdf.iloc[0], [int(n) for n in pdf.iloc[0]["sizes"]]
        elites = [_bins([int(k) for k in of]) for pool in pdf["elites"] for of in pool]
        pool = evolve(sizes, int(first["capacity"]), _seed(first, step), elites, generations=GENERATIONS)
        return _solution(first, list(first["ids"]), list(first["pieces"]), sizes, pool[:ELITES])

    return run


_PACKED = "spec_id long, capacity long, cell long, bin int, item_id long, piece_no long, n long"


def _settle(pdf):
    """The last population of a cell, of all islands' elites."""
    import pandas as pd

    pdf = pdf.sort_values("island")
    first, sizes = pdf.iloc[0], [int(n) for n in pdf.iloc[0]["sizes"]]
    elites = [_bins([int(k) for k in of]) for pool in pdf["elites"] for of in pool]
    best = evolve(sizes, int(first["capacity"]), _seed(first, EPOCHS), elites, generations=GENERATIONS)[0]
    rows = [(int(first["spec_id"]), int(first["capacity"]), int(first["cell"]), k, int(first["ids"][i]), int(first["pieces"][i]), sizes[i]) for k, b in enumerate(best) for i in b]
    return pd.DataFrame(rows, columns=["spec_id", "capacity", "cell", "bin", "item_id", "piece_no", "n"])


def _round(items: DataFrame, seed: int) -> DataFrame:
    """Pack (spec_id, capacity, item_id, piece_no, n) cell by cell."""
    sizes = items.groupBy("spec_id").agg(F.greatest(F.ceil(F.count(F.lit(1)) / F.lit(CELL)), F.lit(1)).alias("cells"))
    celled = items.join(F.broadcast(sizes), "spec_id")  # a row per container specification
    celled = celled.withColumn("cell", F.pmod(F.xxhash64(F.lit(seed), "item_id", "piece_no"), F.col("cells"))).drop("cells")
    islands = celled.withColumn("island", F.explode(F.array(*[F.lit(i) for i in range(ISLANDS)])))
    elites = islands.groupBy("spec_id", "cell", "island").applyInPandas(_found_island, _SOLUTION)
    for step in range(1, EPOCHS):
        # elites stay and migrate to the next island of the ring
        there = F.array(F.struct(F.lit(0).alias("origin"), F.col("island").alias("to")), F.struct(F.lit(1).alias("origin"), ((F.col("island") + 1) % ISLANDS).alias("to")))
        moved = elites.withColumn("m", F.explode(there)).withColumn("island", F.col("m.to")).withColumn("origin", F.col("m.origin")).drop("m")
        elites = moved.groupBy("spec_id", "cell", "island").applyInPandas(_next_island(step), _SOLUTION)
    return elites.groupBy("spec_id", "cell").applyInPandas(_settle, _PACKED)


def pack(items: DataFrame, specs: DataFrame) -> DataFrame:
    """(spec_id, container_id, item_id, piece_no, n_tokens): every item in containers of every spec.

    ``items`` is (item_id, n), ``specs`` (spec_id, capacity), a small table.
    """
    some = [(r.spec_id, r.capacity) for r in specs.filter("capacity > 0").select("spec_id", "capacity").distinct().collect()]  # a handful
    if not some:
        return items.sparkSession.createDataFrame([], "spec_id long, container_id string, item_id long, piece_no long, n_tokens long")
    each = F.array(*[F.struct(F.lit(s).cast("long").alias("spec_id"), F.lit(c).cast("long").alias("capacity")) for s, c in some])
    sized = items.filter("n > 0").select("item_id", F.col("n").cast("long").alias("n"), F.inline(each))
    whole = F.floor(F.col("n") / F.col("capacity")).cast("long")
    cut = sized.filter("n >= capacity").select("spec_id", "capacity", "item_id", F.explode(F.sequence(F.lit(0).cast("long"), whole - 1)).alias("piece_no"))
    full = cut.select("spec_id", F.concat_ws("-", F.lit("full"), "item_id", "piece_no").alias("container_id"), "item_id", "piece_no", F.col("capacity").alias("n_tokens"))
    rest = sized.select("spec_id", "capacity", "item_id", whole.alias("piece_no"), (F.col("n") - whole * F.col("capacity")).alias("n")).filter("n > 0")
    done, left = [full], rest
    for k in range(1, ROUNDS + 1):
        packed = durable(_round(left, k))
        named = packed.select("spec_id", F.concat_ws("-", F.lit(f"r{k}"), "cell", "bin").alias("container_id"), "item_id", "piece_no", F.col("n").alias("n_tokens"), "capacity", "cell", "bin", "n")
        if k < ROUNDS:
            fill = packed.groupBy("spec_id", "cell", "bin").agg(F.sum("n").alias("used"))
            named = named.join(fill, ["spec_id", "cell", "bin"])
            well = F.col("used") >= F.col("capacity") * F.lit(WELL)
            left = named.filter(~well).select("spec_id", "capacity", "item_id", "piece_no", "n")
            named = named.filter(well)
        done.append(named.select("spec_id", "container_id", "item_id", "piece_no", "n_tokens"))
    out = done[0]
    for d in done[1:]:
        out = out.unionByName(d)
    return out
