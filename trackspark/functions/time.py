"""Time expressions: units, clock strings, guesses by magnitude, clock alignment.

All give seconds as DOUBLE; what is no number or empty gives null, an unknown unit raises.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# fixed values: names of time units; the first have that many in a second, frames need a rate
PER_SECOND = {"s": 1.0, "ms": 1e3, "us": 1e6, "ns": 1e9, "filetime_100ns": 1e7}
FRAMES, CLOCK, TIMECODE, US_TO_FRAME = "frame_index", "hms_decimal", "timecode_hmsf", "us_to_frame"
UNITS = (*PER_SECOND, FRAMES, CLOCK, TIMECODE, US_TO_FRAME)
# fixed values: how a raw time is brought to the video's clock
CLOCKS = ("as_is", "subtract_first_gaze", "subtract_const", "subtract_clip_start", "frame_index_over_fps", "mp4_to_vrs_csv")


def _num(c: Column) -> Column:
    return F.trim(c.cast("string")).try_cast("double")


def hms(c: Column) -> Column:
    """HH:MM:SS.mmm, MM:SS.mmm or SS.mmm."""
    parts = F.reverse(F.transform(F.split(F.trim(c), ":"), lambda x: F.trim(x).try_cast("double")))
    ok = (F.size(parts) <= 3) & ~F.exists(parts, lambda x: x.isNull())
    total = F.coalesce(F.get(parts, F.lit(0)), F.lit(0.0)) + F.coalesce(F.get(parts, F.lit(1)), F.lit(0.0)) * 60 + F.coalesce(F.get(parts, F.lit(2)), F.lit(0.0)) * 3600
    return F.when(ok, total)


def timecode(c: Column, fps: float) -> Column:
    """HH:MM:SS:FF at a frame rate."""
    parts = F.transform(F.split(F.trim(c), ":"), lambda x: F.trim(x).try_cast("double"))
    ok = (F.size(parts) == 4) & ~F.exists(parts, lambda x: x.isNull())
    p = lambda i: F.get(parts, F.lit(i))
    return F.when(ok, p(0) * 3600 + p(1) * 60 + p(2) + p(3) / F.lit(fps))


def to_seconds(c: Column, unit: str, fps: float | None = None) -> Column:
    if unit in PER_SECOND:
        return _num(c) / F.lit(PER_SECOND[unit])
    if unit == FRAMES:
        if not fps:
            raise ValueError("frames need a frame rate")
        return _num(c) / F.lit(float(fps))
    if unit == CLOCK:
        return hms(c.cast("string"))
    if unit == TIMECODE:
        if not fps:
            raise ValueError("a timecode needs a frame rate")
        return timecode(c.cast("string"), float(fps))
    raise ValueError(f"unknown time unit {unit!r}")


def guess_seconds(c: Column, name: str) -> Column:
    """Seconds guessed from a column's name and each value's magnitude.

    Values beyond 1e12 are nanoseconds whatever the name says, then the name's suffix decides, then
    values beyond 1e6 are milliseconds.
    """
    v, n = _num(c), name.lower()
    if n.endswith("_ns") or "nanosecond" in n:
        return v / 1e9
    rest = v / 1e3 if n.endswith("_ms") or "millisecond" in n else F.when(F.abs(v) > 1e6, v / 1e3).otherwise(v)
    return F.when(F.abs(v) > 1e12, v / 1e9).otherwise(rest)


def align(t: Column, transform: str, first: Column | None = None, clip_start: Column | None = None, const: float | None = None, fps: float | None = None) -> Column:
    """A raw time on the video's clock. A transform whose anchor is not given raises; a row whose anchor is null has no time."""
    if transform == "as_is":
        return t
    anchors = {"subtract_first_gaze": first, "subtract_clip_start": clip_start, "subtract_const": None if const is None else F.lit(float(const))}
    if transform in anchors:
        if anchors[transform] is None:
            raise ValueError(f"clock transform {transform!r} has no anchor")
        return t - anchors[transform]
    if transform == "frame_index_over_fps":
        if not fps:
            raise ValueError("frames need a frame rate")
        return t / F.lit(float(fps))
    raise ValueError(f"clock transform {transform!r} is not known here")


def clip_start(episode_id: Column) -> Column:
    """Seconds at which a cut clip begins, from an id ending in -startMs-endMs-Ffirst-Flast; else null."""
    return F.nullif(F.regexp_extract(episode_id, r"-(\d+)-\d+-F\d+-F\d+$", 1), F.lit("")).try_cast("double") / 1000


def frame_range(episode_id: Column) -> Column:
    """struct(first, last) of the frames of a cut clip, from an id ending in -Ffirst-Flast; else null."""
    n = lambda g: F.nullif(F.regexp_extract(episode_id, r"-F(\d+)-F(\d+)$", g), F.lit("")).try_cast("long")
    return F.when(n(1).isNotNull(), F.struct(n(1).alias("first"), n(2).alias("last")))


def frame_rate(c: Column) -> Column:
    """A rate written as a number or as a fraction n/d; a zero denominator gives null."""
    n, d = F.split_part(c, F.lit("/"), F.lit(1)), F.split_part(c, F.lit("/"), F.lit(2))
    return F.when(c.contains("/"), F.try_divide(_num(n), _num(d))).otherwise(_num(c))
