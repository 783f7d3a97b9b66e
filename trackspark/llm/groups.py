"""Splits that keep related records together.

Method: records and the entities they share form a bipartite graph; minimum labels are propagated
over it until nothing changes, and whole groups are then assigned to subsets so that sizes come near
the ratios and the label distribution deviates as little as may be.

Scale of the graph: records of one primary entity (a recording) become one node by an aggregate, and
entities with a single node drop out, so the iterations run over the links between nodes only. An
entity is split over ``SPREAD`` hubs by the hash of the node; the smallest nodes of its hubs carry the
entity itself, so no hub has more than a SPREAD-th of a hot entity. Primary entities, nodes and labels
with more than 1/``HOT`` of all rows (fewer than HOT of them) are joined by a broadcast of that bounded
list, all others by their key. In each round all nodes of a label take the smallest label that any of
them has reached, and then that label's own, which halves chains. Labels are checkpointed every round.

Scale of the assignment: groups with the same counts of each label are one class, counts from
32 on to their five leading bits (at most 32 + 16 log2(n) values for counts up to n); a class is placed
as a whole, so the driver sees classes, never groups. Groups take their place in a class by a hashed order, summed in ``BUCKETS`` ranges.

Defined results
* a null or blank entity links nothing; null record ids are no records;
* repeated rows count once; a record that names several primary entities joins them;
* a table without links: every record is a group of its own; an empty table: no groups;
* a null label is the label "".
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from trackspark.session import durable

#: Hubs of one entity.
SPREAD = 1024
#: A key is hot with more than this fraction's inverse of all rows.
HOT = 256
#: Ranges of the hashed order of each class, for its running number.
BUCKETS = 4096


def hot_keys(df: DataFrame, key: str, weight: str) -> list:
    """Keys with more than 1/HOT of the summed weight: fewer than HOT of them."""
    total = df.agg(F.sum(weight)).first()[0] or 0
    return [r[0] for r in df.filter(F.col(weight) * HOT > total).select(key).collect()]


def _crowded(df: DataFrame, key: str, n: int) -> list:
    """Values of ``key`` in more than 1/HOT of at most ``n`` rows: fewer than HOT of them."""
    return [r[0] for r in df.groupBy(key).agg(F.count(F.lit(1)).alias("k")).filter(F.col("k") * HOT > n).select(key).collect()]


def join_spread(left: DataFrame, right: DataFrame, key: str, hot: list) -> DataFrame:
    """Inner join with a table unique by ``key``; left rows of the hot keys, fewer than HOT, are not shuffled."""
    if not hot:
        return left.join(right, key)
    is_hot = F.col(key).isin(hot)
    few = F.broadcast(right.filter(is_hot))  # a row for each hot key
    return left.filter(~is_hot).join(right.filter(~is_hot), key).unionByName(left.filter(is_hot).join(few, key))


def components(records: DataFrame, rec: str, primary: Column, entities: Column) -> DataFrame:
    """(rec, group_id): the smallest record id reachable over shared entities.

    ``primary`` is a string key or null; ``entities`` an array of further string keys.
    """
    r = records.filter(F.col(rec).isNotNull()).select(F.col(rec).alias("rec"), primary.alias("primary"), entities.alias("entities"))
    named = r.filter("primary IS NOT NULL")
    heads = durable(named.groupBy("primary").agg(F.min("rec").alias("node"), F.count(F.lit(1)).alias("rows")))
    # records without a primary entity stay out of the join: they would all meet in one partition
    nodes = join_spread(named, heads.drop("rows"), "primary", hot_keys(heads, "primary", "rows")).select("rec", "node", "entities")
    nodes = nodes.unionByName(r.filter("primary IS NULL").select("rec", F.col("rec").alias("node"), "entities"))
    own = F.concat(F.lit("record:"), F.col("rec").cast("string"))
    links = nodes.select("node", F.explode(F.array_append(F.filter(F.coalesce("entities", F.array().cast("array<string>")), lambda x: x.isNotNull()), own)).alias("ent")).distinct()
    shared = links.groupBy("ent").agg(F.min("node").alias("lo"), F.max("node").alias("hi")).filter("lo < hi").select("ent")
    links = links.join(shared, "ent", "left_semi")
    # a node hangs on a hub of its entity, the smallest node of each hub on the entity itself
    hubs = links.select("node", F.struct("ent", F.pmod(F.xxhash64("node"), F.lit(SPREAD)).cast("int").alias("hub")).alias("ent"))
    tops = hubs.groupBy("ent").agg(F.min("node").alias("node")).select("node", F.struct(F.col("ent.ent").alias("ent"), F.lit(-1).alias("hub")).alias("ent"))
    edges = durable(hubs.unionByName(tops))
    degree = durable(edges.groupBy("node").agg(F.count(F.lit(1)).alias("rows")))
    n = degree.count()
    busy = hot_keys(degree, "node", "rows")
    labels, hot = degree.select("node", F.col("node").alias("label")), []
    while True:
        low = join_spread(edges, labels, "node", busy).groupBy("ent").agg(F.min("label").alias("low"))
        reach = edges.join(low, "ent").groupBy("node").agg(F.min("low").alias("new"))
        # the smallest label that any node of a label has reached, for all its nodes
        up = durable(labels.join(reach, "node").groupBy("label").agg(F.min("new").alias("up")))
        if up.filter("label <> up").isEmpty():
            break
        far = up.select(F.col("label").alias("up"), F.col("up").alias("far"))
        up = join_spread(up, far, "up", _crowded(up, "up", n)).select("label", F.least("up", "far").alias("up"))
        labels = durable(join_spread(labels, up, "label", hot).select("node", F.col("up").alias("label")))
        hot = _crowded(labels, "label", n)
    # records of nodes without links keep the node as their group
    size = nodes.groupBy("node").agg(F.count(F.lit(1)).alias("rows"))
    final = durable(size.join(labels, "node", "left").select("node", "rows", F.coalesce("label", "node").alias("group_id")))
    done = join_spread(nodes.select("rec", "node"), final.drop("rows"), "node", hot_keys(final, "node", "rows"))
    return done.groupBy("rec").agg(F.min("group_id").alias("group_id")).withColumnRenamed("rec", rec)


def _rounded(n: Column) -> Column:
    """Counts from 32 on to their five leading bits."""
    step = F.pow(F.lit(2), F.greatest(F.floor(F.log2(n.cast("double"))) - 4, F.lit(0))).cast("long")
    return F.when(n < 32, n).otherwise(F.floor(n / step) * step)


def place(classes: list[tuple[int, dict[str, float]]], quota: dict[tuple[str, str], float], subsets: list[str]) -> list[dict[str, int]]:
    """Of each class (number of groups, mean counts by label), how many groups go to each subset.

    The cost of a split is the squared deviation from each quota, relative to the quota. Classes are
    placed from large to small groups, each time where the cost grows least, many groups of a class
    at once as long as many are left; then single groups move or change places while that helps.
    """
    have = dict.fromkeys(quota, 0.0)
    weight = {k: 1.0 / max(q, 1.0) for k, q in quota.items()}
    total = {s: sum(q for (_, t), q in quota.items() if t == s) for s in subsets}
    filled = dict.fromkeys(subsets, 0.0)
    out: list[dict[str, int]] = [dict.fromkeys(subsets, 0) for _ in classes]
    open_ = [s for s in subsets if total[s] > 0]

    def cost(s: str, counts: dict[str, float], k: int) -> float:
        """By how much the cost changes when k groups enter (leave, if negative) subset s."""
        c = 0.0
        for lab, n in counts.items():
            gap, x = have[lab, s] - quota[lab, s], n * k
            c += (2 * gap * x + x * x) * weight[lab, s]
        x = sum(counts.values()) * k
        return c + (2 * (filled[s] - total[s]) * x + x * x) / max(total[s], 1.0)

    def move(i: int, s: str, k: int) -> None:
        counts = classes[i][1]
        out[i][s] += k
        for lab, n in counts.items():
            have[lab, s] += n * k
        filled[s] += sum(counts.values()) * k

    order = sorted(range(len(classes)), key=lambda i: (-sum(classes[i][1].values()), sorted(classes[i][1].items())))
    for i in order:
        left, counts = classes[i]
        while left and open_:
            k = max(1, left // 32)
            move(i, min(open_, key=lambda s: (cost(s, counts, k), s)), k)
            left -= k
    for _ in range(20):
        better = False
        for i in reversed(order):
            counts = classes[i][1]
            for a in open_:
                for b in open_:
                    k = max(1, out[i][a] // 8)
                    while a != b and k and out[i][a] >= k:
                        if cost(a, counts, -k) + cost(b, counts, k) < -1e-9:
                            move(i, a, -k)
                            move(i, b, k)
                            better = True
                        else:
                            k //= 2
        if not better:
            break
    return out


def assign(groups: DataFrame, requests: dict[int, tuple[int, list[tuple[str, float]]]]) -> DataFrame:
    """(request, group_id, subset) for ``groups`` (group_id, label, n): n records of a label in a group.

    ``requests`` is {request: (seed, [(subset, ratio)])}, a handful. Ratios need not sum to 1; negative
    and null ratios count as 0, and no positive ratio at all gives no rows.
    """
    spark = groups.sparkSession
    kind = dict(groups.dtypes)["group_id"]
    asked = {}
    for q, (seed, ratios) in requests.items():
        ratios = [(s, max(x or 0.0, 0.0)) for s, x in sorted(ratios)]
        if (whole := sum(x for _, x in ratios)) > 0:
            asked[q] = (seed, [(s, x / whole) for s, x in ratios])
    g = groups.filter("n > 0").groupBy("group_id", F.coalesce("label", F.lit("")).alias("label")).agg(F.sum("n").alias("n"))
    per = g.groupBy("group_id").agg(F.sort_array(F.collect_list(F.struct("label", "n"))).alias("counts"))  # labels are few
    per = durable(per.withColumn("class", F.xxhash64(F.transform("counts", lambda x: F.struct(x["label"], _rounded(x["n"]))))))
    seen = per.groupBy("class").agg(F.count(F.lit(1)).alias("groups"))
    sums = per.select("class", F.inline("counts")).groupBy("class", "label").agg(F.sum("n").alias("n"))
    rows = seen.join(sums, "class").groupBy("class", "groups").agg(F.collect_list(F.struct("label", "n")).alias("sums")).orderBy("class").collect()
    if not rows or not asked:
        return spark.createDataFrame([], f"request long, group_id {kind}, subset string")
    classes = [(r.groups, {x.label: x.n / r.groups for x in r.sums}) for r in rows]
    totals: dict[str, int] = {}
    for r in rows:
        for x in r.sums:
            totals[x.label] = totals.get(x.label, 0) + x.n
    ladder = []
    for q, (seed, ratios) in asked.items():
        quota = {(lab, s): n * x for lab, n in totals.items() for s, x in ratios}
        for r, found in zip(rows, place(classes, quota, [s for s, _ in ratios])):
            at = 0
            for s, _ in ratios:
                if found[s]:
                    ladder.append((r["class"], q, seed, at, at + found[s], s))
                    at += found[s]
    steps = spark.createDataFrame(ladder, "class long, request long, seed long, lo long, hi long, subset string")
    steps = steps.groupBy("class", "request", "seed").agg(F.collect_list(F.struct("lo", "hi", "subset")).alias("steps"))
    if len(ladder) <= 100_000:
        steps = F.broadcast(steps)
    d = per.select("group_id", "class").join(steps, "class").withColumn("h", F.xxhash64("seed", "group_id"))
    d = d.withColumn("bucket", F.pmod("h", F.lit(BUCKETS)))
    base = d.groupBy("request", "class", "bucket").agg(F.count(F.lit(1)).alias("k"))
    base = base.select("request", "class", "bucket", (F.sum("k").over(Window.partitionBy("request", "class").orderBy("bucket")) - F.col("k")).alias("base"))
    inside = F.row_number().over(Window.partitionBy("request", "class", "bucket").orderBy("h", "group_id")) - 1
    d = d.withColumn("inside", inside).join(base, ["request", "class", "bucket"]).withColumn("place", F.col("base") + F.col("inside"))
    step = F.get(F.filter("steps", lambda x: (F.col("place") >= x["lo"]) & (F.col("place") < x["hi"])), F.lit(0))
    return d.select("request", "group_id", step["subset"].alias("subset"))

