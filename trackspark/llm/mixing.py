"""Mixing sources to target weights.

Method: every source gets its share of the total size as whole copies of all its records, as many as
are certain, and a sample for the rest. The sample has unequal probabilities: a record's inclusion
probability is proportional to its size, scaled so that the expected size of the sample is the rest
that is wanted; records whose probability would reach 1 are certain, are taken out with their size,
and the others are scaled again until no new one is. The sample is drawn by Pareto order sampling:
records are ranked by their random odds divided by their inclusion odds, and the first ranks are taken
up to the wanted size. What the first record beyond leaves open (less than that record) goes to records
that still fit, sizes in descending order, until none fits. The random number of a record is a hash of
its id, so a lost task redraws the same sample.

Scale: running sizes are summed in ranges of the logarithm of the rank. That logarithm is a logistic
variable plus a constant of the record, so whatever the sizes and probabilities are, a range of width
1/``FINE`` holds no more than 1/(4 * FINE) of a source's records, hash luck apart: no task holds a
source. Two steps see one row for each size of a source, so fewer rows than its longest record has
tokens. One row per target reaches the driver.

Defined results
* sources without a target, without records or with a null name contribute nothing; targets without
  records are reported with 0; null or negative targets and repeats count as 0;
* what a source cannot give (records times its cap) is spread over the others by their targets;
* the drawn size never exceeds the wanted size; where a part of a source is drawn, what is missing is
  less than the smallest record not drawn;
* records without size are never drawn; repeated ids share their random number.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from trackspark.session import durable

#: Ranges of ranks per unit of the rank's logarithm.
FINE = 1024


def allocate(targets: list[tuple[str, float, int]], available: dict[str, int], total: float) -> dict[str, float]:
    """Size of each source: shares of ``total``, capped, the shortfall going to the others."""
    share = {s: max(t or 0.0, 0.0) for s, t, _ in targets}
    most = {s: available.get(s, 0) * max(k or 0, 0) for s, _, k in targets}
    got = dict.fromkeys(share, 0.0)
    open_ = {s for s in share if share[s] > 0 and most[s] > 0}
    left = float(total)
    while open_ and left > 1e-9:
        whole = sum(share[s] for s in open_)
        short = {s for s in open_ if left * share[s] / whole >= most[s]}
        if not short:
            got.update({s: left * share[s] / whole for s in open_})
            break
        for s in short:
            got[s] = float(most[s])
            left -= most[s]
        open_ -= short
    return got


def unit(seed: int, key: str) -> Column:
    """A number in (0, 1) that depends on the seed and the key only."""
    return (F.pmod(F.xxhash64(F.lit(seed), key), F.lit(1 << 52)) + F.lit(0.5)) / F.lit(float(1 << 52))


def inclusion(sizes: DataFrame, rest: dict[str, float]) -> dict[str, tuple[float, float]]:
    """{source: (scale, open)}: a record of size n is drawn with probability min(1, scale * n).

    ``sizes`` is (source, n, k): k records of size n. ``open`` is what of ``rest`` the certain records
    (scale * n >= 1) leave to the others. Taking out certainties again and again ends at the largest
    size that is not certain when all larger ones are; running sums over the sizes show it at once.
    """
    rows = [(s, float(x)) for s, x in rest.items() if x > 0]
    if not rows:
        return {}
    known = F.broadcast(sizes.sparkSession.createDataFrame(rows, "source string, rest double"))  # a row per target
    n, k = F.col("n").cast("double"), F.col("k").cast("double")
    larger = Window.partitionBy("source").orderBy(F.desc("n")).rowsBetween(Window.unboundedPreceding, -1)
    others = Window.partitionBy("source").orderBy(F.desc("n")).rowsBetween(0, Window.unboundedFollowing)
    d = sizes.join(known, "source").withColumn("open", F.col("rest") - F.coalesce(F.sum(n * k).over(larger), F.lit(0.0)))
    d = d.withColumn("scale", F.col("open") / F.sum(n * n * k).over(others)).filter(F.col("scale") * n < 1)
    best = d.groupBy("source").agg(F.max_by(F.struct("scale", "open"), "n").alias("b"))
    return {r.source: (r.b.scale, r.b.open) for r in best.collect()}  # a row per target


def _first_ranks(df: DataFrame, keys: list[str], amount: Column, limit: str) -> DataFrame:
    """Add ``taken``: in order of ``log_rank``, id, n, records of each key up to a sum of ``limit``."""
    d = df.withColumn("__m", amount).withColumn("__range", F.floor(F.col("log_rank") * FINE).cast("long"))
    sums = d.groupBy(*keys, "__range").agg(F.sum("__m").alias("__rm"))
    sums = sums.select(*keys, "__range", (F.sum("__rm").over(Window.partitionBy(*keys).orderBy("__range")) - F.col("__rm")).alias("__base"))
    inside = F.sum("__m").over(Window.partitionBy(*keys, "__range").orderBy("log_rank", "id", "n").rowsBetween(Window.unboundedPreceding, 0))
    d = d.withColumn("__upto", inside).join(sums, [*keys, "__range"])
    return d.withColumn("taken", F.col("__base") + F.col("__upto") <= F.col(limit)).drop("__m", "__range", "__base", "__upto")


def _fill(pdf):
    """Largest sizes first, as many of each as there are and as fit: k of them, of each size."""
    import pandas as pd

    pdf = pdf.sort_values("n", ascending=False)
    left, out = float(pdf["open"].iloc[0]), []
    for n, have in zip(pdf["n"], pdf["have"]):
        k = min(int(have), int(left // n))
        if k:
            out.append((pdf["source"].iloc[0], n, k))
            left -= k * n
    return pd.DataFrame(out, columns=["source", "n", "more"])


def sample(records: DataFrame, rest: dict[str, float], seed: int) -> DataFrame:
    """(source, id, n, hit) of every record of the sources in ``rest``: a Pareto sample of that size."""
    spark = records.sparkSession
    sizes = durable(records.groupBy("source", "n").agg(F.count(F.lit(1)).alias("k")))
    rows = [(s, scale, left) for s, (scale, left) in inclusion(sizes, rest).items()]
    if not rows:
        return records.select("source", "id", "n", F.lit(False).alias("hit")).limit(0)
    params = F.broadcast(spark.createDataFrame(rows, "source string, scale double, open double"))  # a row per target
    d = records.select("source", "id", "n").join(params, "source").withColumn("pi", F.col("scale") * F.col("n"))
    certain = d.filter("pi >= 1").select("source", "id", "n", F.lit(True).alias("hit"))
    u, pi = unit(seed, "id"), F.col("pi")
    d = d.filter("pi < 1").withColumn("log_rank", F.log(u / (1 - u)) - F.log(pi / (1 - pi)))
    ranked = durable(_first_ranks(d, ["source"], F.col("n"), "open").select("source", "id", "n", "log_rank", "open", "taken"))
    used = ranked.groupBy("source").agg(F.sum(F.when(F.col("taken"), F.col("n")).otherwise(F.lit(0))).alias("used"))
    spare = ranked.filter("NOT taken").join(F.broadcast(used), "source").withColumn("open", F.col("open") - F.col("used")).filter("n <= open")  # a row per target
    fit = spare.groupBy("source", "n").agg(F.count(F.lit(1)).alias("have"), F.first("open").alias("open"))
    more = fit.groupBy("source").applyInPandas(_fill, "source string, n long, more long")
    extra = _first_ranks(spare.join(more, ["source", "n"]), ["source", "n"], F.lit(1), "more").filter("taken")
    drawn = ranked.filter("taken").select("source", "id", "n").unionByName(extra.select("source", "id", "n"))
    return certain.unionByName(drawn.withColumn("hit", F.lit(True)))


def mix(records: DataFrame, targets: list[tuple[str, float, int]], total: float | None = None, seed: int = 7) -> tuple[DataFrame, dict[str, tuple[int, float]]]:
    """((id, source, n, copies) of the drawn records, {source: (available, wanted)}).

    ``records`` has id, source, n, other columns are left out; ``total`` is the size of the mix, by default all that the target
    sources hold.
    """
    spark = records.sparkSession
    names = [s for s, _, _ in targets]
    mine = records.select("id", "source", F.col("n").cast("long").alias("n")).filter(F.col("source").isin(names) & (F.col("n") > 0))
    available = {r.source: r.n for r in mine.groupBy("source").agg(F.sum("n").alias("n")).collect()}
    want = allocate(targets, available, sum(available.values()) if total is None else total)
    caps = {s: max(k or 0, 0) for s, _, k in targets}
    sure = {s: min(int(want[s] / n + 1e-12), caps[s]) for s, n in available.items()}
    rest = {s: want[s] - sure[s] * n for s, n in available.items() if sure[s] < caps[s]}
    copies = [(s, k) for s, k in sure.items() if k > 0]
    drawn = sample(mine, rest, seed).withColumn("copies", F.lit(1)).select("id", "source", "n", "copies")
    if copies:
        whole = mine.join(F.broadcast(spark.createDataFrame(copies, "source string, copies int")), "source")  # a row per target
        drawn = whole.select("id", "source", "n", "copies").unionByName(drawn)
        some = set(s for s, _ in copies) & {s for s, x in rest.items() if x > 0}
        if some:  # records of a whole copy that are drawn once more
            twice = F.col("source").isin(sorted(some))
            both = drawn.filter(twice).groupBy("id", "source", "n").agg(F.sum("copies").cast("int").alias("copies"))
            drawn = drawn.filter(~twice).unionByName(both)
    return drawn, {s: (available.get(s, 0), want[s]) for s in names}
