"""Streams: first row per id, windows of late events, clips packed as spans arrive, watched folders.

Streaming state lives in the checkpoint of the query, so a lost executor loses nothing. Results of
a finished ``availableNow`` run equal the batch operators' (packing: up to the clips still open).
"""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trackspark.sources.catalog import asset_status, digests, listing


def first_by_id(stream: DataFrame, ident: str, event_time: str | None = None, lateness: str = "1 hour") -> DataFrame:
    """The first row of each id; with an event time, state is dropped behind the watermark."""
    if event_time is None:
        return stream.dropDuplicates([ident])
    return stream.withWatermark(event_time, lateness).dropDuplicatesWithinWatermark([ident])


def windowed_counts(stream: DataFrame, event_time: str, keys: list[str], width: str, hop: str | None = None, lateness: str = "1 hour") -> DataFrame:
    """Events per window and key; ``hop`` makes windows slide."""
    w = F.window(event_time, width, hop) if hop else F.window(event_time, width)
    g = stream.withWatermark(event_time, lateness).groupBy(w, *keys).agg(F.count(F.lit(1)).alias("n"))
    return g.select(F.col("window.start").alias("start"), F.col("window.end").alias("end"), *keys, "n")


def sessions(stream: DataFrame, event_time: str, keys: list[str], gap: str, lateness: str = "1 hour") -> DataFrame:
    """Runs of events whose neighbours are less than ``gap`` apart."""
    g = stream.withWatermark(event_time, lateness).groupBy(F.session_window(event_time, gap).alias("w"), *keys).agg(F.count(F.lit(1)).alias("n"))
    return g.select(F.col("w.start").alias("start"), F.col("w.end").alias("end"), *keys, "n")


_CLIP = "ep long, channel string, s long, e long, n long, text string"


def packer(longest: int, gap: int, shortest: int) -> Callable:
    """The state function of :func:`pack`: one open clip per source, emitted when it closes."""

    def step(key: tuple, batches: Iterator, state) -> Iterator:
        import pandas as pd

        cur = list(state.get) if state.exists else None
        done = []

        def close(c: list) -> None:
            texts = [t for t in (x.strip() for x in c[4].split("\x1f")) if t]
            once = [t for k, t in enumerate(texts) if k == 0 or t != texts[k - 1]]
            if c[2] - c[1] >= shortest:
                text = once[0] if len(once) == 1 else " ".join(f"{k + 1}) {t}" for k, t in enumerate(once))
                done.append((key[0], c[0], c[1], c[2], c[3], text))

        frames = [b for b in batches if len(b)]
        if frames:
            pdf = pd.concat(frames).sort_values(["s", "ord"])
            for channel, s, e, text in zip(pdf["channel"], pdf["s"], pdf["e"], pdf["text"]):
                if cur and channel == cur[0] and s - cur[2] <= gap and e - cur[1] <= longest:
                    cur[2], cur[3], cur[4] = int(e), cur[3] + 1, cur[4] + "\x1f" + (text or "")
                else:
                    if cur:
                        close(cur)
                    cur = [channel, int(s), int(e), 1, text or ""]
        if cur:
            state.update(tuple(cur))
        yield pd.DataFrame(done, columns=["ep", "channel", "s", "e", "n", "text"])

    return step


def pack(stream: DataFrame, longest: int, gap: int, shortest: int) -> DataFrame:
    """Greedy packing of spans (ep, channel, ord, s, e, text) that arrive in time order per source."""
    from pyspark.sql.streaming.state import GroupStateTimeout

    state = "channel string, s long, e long, n long, texts string"
    return stream.groupBy("ep").applyInPandasWithState(packer(longest, gap, shortest), _CLIP, state, "append", GroupStateTimeout.NoTimeout)


def run_once(stream: DataFrame, out: str, checkpoint: str, mode: str = "append") -> DataFrame:
    """Process what is there and return it. Complete results replace the folder, others append."""
    w = stream.writeStream.option("checkpointLocation", checkpoint).trigger(availableNow=True)
    if mode == "complete":
        q = w.outputMode("complete").foreachBatch(lambda df, _: df.write.mode("overwrite").parquet(out)).start()
    else:
        q = w.outputMode(mode).format("parquet").option("path", out).start()
    q.awaitTermination()
    return stream.sparkSession.read.schema(stream.schema).parquet(out)


def watch(spark: SparkSession, root: str, expected: DataFrame, stable: int = 3, every_s: float = 60.0, timeout_s: float = 86_400.0, partial: str = r"\.(part|tmp|crdownload)$", sleep: Callable[[float], None] = time.sleep) -> bool:
    """Poll a folder until all expected files (path relative to it, size_bytes, sha1) are complete and
    nothing partial lies there, ``stable`` times in a row with the same files; False after the timeout."""
    began, calm, before = time.time(), 0, None
    while True:
        files = listing(spark, root)
        seen = files.select(F.col("rel").alias("path"), "bytes", F.lit(None).cast("string").alias("sha1"), F.col("rel").rlike(partial).alias("partial"))
        n = seen.agg(F.count(F.lit(1)).alias("n"), F.sum("bytes").alias("b"), F.count_if("partial").alias("p")).first()
        missing = asset_status(expected, seen).filter("NOT complete").count()
        if not missing and not n["p"] and calm + 1 >= stable:  # contents are read once, when all else is well
            sums = digests(spark, f"{root}/**").join(files.select("path", "rel"), "path").select(F.col("rel").alias("path"), "sha1")
            whole = seen.drop("sha1").join(sums, "path", "left")
            missing = asset_status(expected, whole).filter("NOT complete").count()
        calm = calm + 1 if not missing and not n["p"] and (before is None or before == n) else int(not missing and not n["p"])
        before = n
        if calm >= stable:
            return True
        if time.time() - began + every_s > timeout_s:
            return False
        sleep(every_s)
