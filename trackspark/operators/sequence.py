"""Cutting and packing of spans: hard cuts, hierarchical descent, greedy coalescing, thinning.

Greedy operators reset where their condition cannot hold across two neighbours. Such breaks are
found by sharded windows, and only the rows between two breaks are folded together, streamed in order.
"""

from __future__ import annotations

from functools import partial

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trackspark.functions.text import numbered
from trackspark.operators.fold import fold_sorted
from trackspark.operators.intervals import overlaps, stab
from trackspark.operators.periods import periods
from trackspark.operators.sharded import lag_over, last_over
from trackspark.session import durable


def hard_cut(df: DataFrame, s: str, e: str, longest: int, shortest: int) -> DataFrame:
    """Cut [s, e) into pieces of at most ``longest``; a last piece below ``shortest`` is dropped."""
    n = F.greatest(F.ceil((F.col(e) - F.col(s)) / F.lit(longest)).cast("long"), F.lit(1))
    d = df.withColumn("__i", F.explode(F.sequence(F.lit(0).cast("long"), n - 1)))
    lo = F.col(s) + F.col("__i") * F.lit(longest)
    d = d.withColumn("__lo", lo).withColumn("__hi", F.least(F.col(e), lo + F.lit(longest))).filter(F.col("__hi") - F.col("__lo") >= shortest)
    return d.withColumn(s, F.col("__lo")).withColumn(e, F.col("__hi")).drop("__i", "__lo", "__hi")


def descend(spans: DataFrame, order: list[str], keys: list[str], longest: int, shortest: int, width: int) -> DataFrame:
    """Hierarchical chop: (keys, channel, s, e, text, path).

    ``order`` names the channels from coarse to fine. A span that fits is a clip; one too long is
    replaced by what the finer channels have inside it, clipped to it; one without finer cover is
    cut hard. Only spans of the coarsest channel start a descent. One range join per level, whose
    result is checkpointed: each level is read three times.
    """
    lower = F.lit(0).cast("long")
    live = spans.filter(F.col("channel") == order[0]).select(*keys, "channel", F.greatest("s", lower).alias("s"), "e", "text", F.array(F.col("ord")).alias("path"))
    live = live.filter(F.col("e") - F.col("s") >= shortest)
    done: list[DataFrame] = []
    waiting: list[tuple[int, DataFrame]] = []
    for depth, name in enumerate(order):
        done.append(live.filter(F.col("e") - F.col("s") <= longest))
        long = live.filter(F.col("e") - F.col("s") > longest)
        waiting.append((depth, long))
        if depth + 1 == len(order):
            break
        finer = spans.filter(F.col("channel") == order[depth + 1]).select(*keys, F.col("s").alias("b_s"), F.col("e").alias("b_e"), F.col("text").alias("b_text"), F.col("ord").alias("b_ord"))
        inside = overlaps(long.select(*keys, F.col("s").alias("a_s"), F.col("e").alias("a_e"), "path"), finer, keys, width)
        live = inside.select(*keys, F.lit(order[depth + 1]).alias("channel"), F.greatest("a_s", "b_s").alias("s"), F.least("a_e", "b_e").alias("e"), F.col("b_text").alias("text"), F.array_append("path", F.col("b_ord")).alias("path"))
        live = durable(live.filter(F.col("e") - F.col("s") >= shortest))
    # from the finest level up: a long span without clips below it is cut hard
    clips = done[-1].unionByName(hard_cut(waiting[-1][1], "s", "e", longest, shortest))
    for depth, long in reversed(waiting[:-1]):
        covered = clips.select(*keys, F.slice("path", 1, depth + 1).alias("path")).distinct()
        bare = long.join(covered, [*keys, "path"], "left_anti")
        clips = durable(clips.unionByName(done[depth]).unionByName(hard_cut(bare, "s", "e", longest, shortest)))
    return clips


def _groups(df: DataFrame, keys: list[str], t: str, tie: str, brk: Column, length: float) -> DataFrame:
    """Add ``__head``: the (t, tie) of the row that starts the run this row is in."""
    d = df.withColumn("__brk", brk)
    return last_over(d, keys, t, tie, F.when(F.col("__brk"), F.struct(F.col(t).alias("t"), F.col(tie).alias("tie"))), "__head", length).drop("__brk")


class _Pack:
    """Greedy packing: rows s, e, text in order; clips s, e, texts come out."""

    def __init__(self, longest: int) -> None:
        self.longest, self.s, self.e, self.texts = longest, None, None, []

    def row(self, s, e, text):
        if self.s is not None and e - self.s <= self.longest:
            self.e = e
            self.texts.append(text)
            return ()
        done = self.end()
        self.s, self.e, self.texts = s, e, [text]
        return done

    def end(self):
        return () if self.s is None else ((self.s, self.e, self.texts),)


def coalesce(spans: DataFrame, keys: list[str], longest: int, gap: int, shortest: int, length: float) -> DataFrame:
    """(keys, channel, s, e, n, text): neighbours packed greedily into the longest clips that fit.

    The next span, by start and then ``ord``, is absorbed while it has the same channel, begins at
    most ``gap`` behind the clip's end and the clip stays within ``longest``. A nested span moves
    the end back. Clips shorter than ``shortest`` are dropped.
    """
    d = lag_over(spans, keys, "s", "ord", F.struct("channel", "e"), "__before", length)
    # the end of the clip so far is the end of the row before, if that row was absorbed
    brk = F.col("__before").isNull() | (F.col("__before.channel") != F.col("channel")) | (F.col("s") - F.col("__before.e") > gap)
    d = _groups(d, keys, "s", "ord", brk, length)
    c = fold_sorted(d, [*keys, "channel", "__head"], ["s", "ord"], ["s", "e", "text"], partial(_Pack, longest), "c_s long, c_e long, texts array<string>")
    out = c.select(*keys, "channel", F.col("c_s").alias("s"), F.col("c_e").alias("e"), F.size("texts").cast("long").alias("n"), numbered(F.col("texts")).alias("text"))
    return out.filter(F.col("e") - F.col("s") >= shortest)


class _Cut:
    """Walk the borders of one region: rows r_s, r_e, b with rising b; pieces s, e come out.

    ``at`` is the start of the open piece, ``best`` the latest border that fits it.
    """

    def __init__(self, longest: int, shortest: int) -> None:
        self.longest, self.shortest, self.at, self.best, self.last = longest, shortest, None, None, None

    def _to(self, x: int):
        piece = (self.at, x)
        self.at = x
        return piece

    def row(self, r_s, r_e, b):
        if self.at is None:
            self.at, self.last = r_s, r_e
        out, before = [], self.at
        if b > self.at + self.longest:  # the border lies beyond: cut at the best one, then hard as often as needed
            out.append(self._to(self.best if self.best is not None else self.at + self.longest))
        while b > self.at + self.longest:
            out.append(self._to(self.at + self.longest))
        self.best = b if b >= self.at + self.shortest else self.best if self.at == before else None
        return out

    def end(self):
        return () if self.at is None else ((self.at, self.last),)


def merge_then_split(spans: DataFrame, keys: list[str], longest: int, gap: int, shortest: int) -> DataFrame:
    """(keys, s, e): regions of activity cut at the latest span border that fits, else hard.

    Regions come from the period operator; a region's borders are streamed in order.
    """
    p = periods(spans.withColumn("gap", F.lit(gap)), keys).select(*keys, F.col("s").alias("r_s"), F.col("e").alias("r_e"))
    short = p.filter(F.col("r_e") - F.col("r_s") <= longest).select(*keys, F.col("r_s").alias("s"), F.col("r_e").alias("e"))
    long = p.filter(F.col("r_e") - F.col("r_s") > longest)
    width = max(longest, 1) * 4
    marks = spans.select(*keys, F.explode(F.array("s", "e")).alias("b")).distinct()
    held = stab(marks, long, keys, "b", width, "[]", s="r_s", e="r_e").withColumn("__from", F.col("r_s"))
    pieces = fold_sorted(held, [*keys, "__from"], ["b"], ["r_s", "r_e", "b"], partial(_Cut, longest, shortest), "s long, e long").select(*keys, "s", "e")
    return short.unionByName(pieces).filter(F.col("e") - F.col("s") >= shortest)


class _Thin:
    """Rows t, tie in order; those at least ``least`` behind the last kept come out."""

    def __init__(self, least: float) -> None:
        self.least, self.kept = least, None

    def row(self, t, tie):
        if self.kept is not None and t - self.kept < self.least:
            return ()
        self.kept = t
        return ((t, tie),)

    def end(self):
        return ()


def thin(df: DataFrame, keys: list[str], t: str, tie: str, least: int, length: float, accepted: Column | None = None) -> DataFrame:
    """Rows at least ``least`` behind the last kept row of their source; the first row is kept.

    Rows that are not ``accepted`` (say, whose projection failed) are neither kept nor counted. A row
    that far behind its neighbour is always kept and starts a run; runs are folded alone.
    """
    if accepted is not None:
        df = df.filter(accepted)
    kinds = dict(df.dtypes)
    d = lag_over(df.select(*keys, t, tie), keys, t, tie, F.col(t), "__before", length)
    d = _groups(d, keys, t, tie, F.col("__before").isNull() | (F.col(t) - F.col("__before") >= least), length)
    kept = fold_sorted(d, [*keys, "__head"], [t, tie], [t, tie], partial(_Thin, least), f"__t {kinds[t]}, __tie {kinds[tie]}")
    kept = kept.select(*keys, F.col("__t").alias(t), F.col("__tie").alias(tie))
    return df.join(kept, [*keys, t, tie], "left_semi")
