"""Projection of a track onto the film's pixels, by the recipe's method."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trackspark.functions import geometry as G
from trackspark.operators import asof

KEYS = ["dataset", "episode_id"]


def project(track: DataFrame, films: DataFrame, method: str, space: str = "pixel_2d", dims: tuple[int, int] | None = None, poses: DataFrame | None = None, cameras: DataFrame | None = None, tolerance_s: float | None = None, depth: float = 1.0) -> DataFrame:
    """Track rows with ``px``, ``py`` (pixels of the film) and ``in_frame``; null where nothing can be said.

    ``track`` has the keys, ord, t_s, valid and ``ch``; ``films`` the keys, width, height. Planar gaze is
    scaled from ``dims`` (or from shares) to the film. Rays ("psi_pinhole_ray") take the nearest of
    ``poses`` (keys, ord, t_s, m) within the tolerance and ``cameras`` (keys, fx, fy, cx, cy, width,
    height), and are scaled from the camera's size to the film's.
    """
    c = lambda n: F.try_element_at("ch", F.lit(n))
    if method in ("already_2d", "normalize_by_dims", "none"):
        t = track.join(films.select(*KEYS, "width", "height"), KEYS, "left")
        w, h = (F.lit(float(v)) for v in dims) if dims else (F.col("width"), F.col("height"))
        share = space == "normalized_2d"
        x = c("x") * F.col("width") if share else c("x") * F.col("width") / w
        y = c("y") * F.col("height") if share else c("y") * F.col("height") / h
    elif method == "psi_pinhole_ray":
        if poses is None or cameras is None:
            raise ValueError("rays need poses and cameras")
        p = asof.bracket(track.filter("t_s IS NOT NULL"), poses.filter("t_s IS NOT NULL AND size(m) = 16"), KEYS, "t_s", ["m"], 600.0)
        near = asof.nearest(p, "t_s")
        m = F.when(F.abs(near["t"] - F.col("t_s")) <= tolerance_s, near["m"]) if tolerance_s is not None else near["m"]
        cam = cameras.select(*KEYS, "fx", "fy", "cx", "cy", F.col("width").alias("cam_w"), F.col("height").alias("cam_h"))
        t = p.select(*track.columns, m.alias("m")).join(films.select(*KEYS, "width", "height"), KEYS, "left").join(cam, KEYS, "left")
        x, y = G.pinhole(F.col("m"), [c(n) for n in ("px", "py", "pz", "vx", "vy", "vz")], F.col("fx"), F.col("fy"), F.col("cx"), F.col("cy"), depth)
        x, y = x * F.col("width") / F.col("cam_w"), y * F.col("height") / F.col("cam_h")
    else:
        raise ValueError(f"projection {method!r} needs a vendor's lens model")
    t = t.withColumn("px", x).withColumn("py", y)
    return t.select(*track.columns, "px", "py", (F.col("valid") & G.in_frame(F.col("px"), F.col("py"), F.col("width"), F.col("height"))).alias("in_frame"))


def agreement(a: DataFrame, b: DataFrame) -> DataFrame:
    """(keys, samples, most, mean): distances between two projections (keys, ord, px, py) of the same samples."""
    j = a.select(*KEYS, "ord", "px", "py").join(b.select(*KEYS, "ord", F.col("px").alias("qx"), F.col("py").alias("qy")), [*KEYS, "ord"])
    d = F.hypot(F.col("px") - F.col("qx"), F.col("py") - F.col("qy"))
    return j.groupBy(*KEYS).agg(F.count(d).alias("samples"), F.max(d).alias("most"), F.avg(d).alias("mean"))
