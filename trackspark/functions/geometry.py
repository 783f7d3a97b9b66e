"""Geometry expressions: letterboxing, bins, pinhole projection, in-frame tests."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

BINS = 1000


def clamp01(v: Column) -> Column:
    return F.greatest(F.lit(0.0), F.least(F.lit(1.0), v))


def to_bins(v: Column, bins: int = BINS) -> Column:
    """A share of [0, 1] as a bin 0..bins, half to even."""
    return F.rint(clamp01(v) * bins).cast("int")


@dataclass(frozen=True)
class Letterbox:
    """A source of (w, h) fitted into a square of ``side``, centred between bars."""

    w: Column
    h: Column
    side: int

    @property
    def scale(self) -> Column:
        return F.least(F.lit(self.side) / self.w, F.lit(self.side) / self.h)

    def padded(self, x: Column, y: Column) -> tuple[Column, Column]:
        """Pixel of the square for a pixel of the source."""
        return (F.lit(self.side) - self.w * self.scale) / 2 + x * self.scale, (F.lit(self.side) - self.h * self.scale) / 2 + y * self.scale

    def norm(self, x: Column, y: Column) -> tuple[Column, Column]:
        px, py = self.padded(x, y)
        return px / self.side, py / self.side

    def holds(self, x: Column, y: Column, tol: float = 0.5) -> Column:
        """True where the pixel lies on the picture, not on a bar."""
        px, py = self.padded(x, y)
        ox, oy = (F.lit(self.side) - self.w * self.scale) / 2, (F.lit(self.side) - self.h * self.scale) / 2
        return px.between(ox - tol, F.lit(self.side) - ox + tol) & py.between(oy - tol, F.lit(self.side) - oy + tol)


def in_frame(x: Column, y: Column, w: Column, h: Column) -> Column:
    return F.coalesce((x >= 0) & (x < w) & (y >= 0) & (y < h), F.lit(False))


def pinhole(m: Column, ray: list[Column], fx: float | Column, fy: float | Column, cx: float | Column, cy: float | Column, depth: float = 1.0) -> tuple[Column, Column]:
    """Pixel of a world ray (origin, direction) seen by a camera with a row-major 4×4 pose.

    The point ``depth`` along the ray is moved into the camera's frame by the transposed rotation;
    the camera looks along +X with Y to the left and Z up. Points behind it give null.
    """
    at = lambda i: F.element_at(m, i + 1)
    fx, fy, cx, cy = (v if isinstance(v, Column) else F.lit(v) for v in (fx, fy, cx, cy))
    p = [ray[k] + ray[3 + k] * F.lit(depth) - at(4 * k + 3) for k in range(3)]
    cam = [at(0 + j) * p[0] + at(4 + j) * p[1] + at(8 + j) * p[2] for j in range(3)]
    ahead = cam[0] > 1e-9
    return F.when(ahead, cx - fx * cam[1] / cam[0]), F.when(ahead, cy - fy * cam[2] / cam[0])


def upright_to_native(x: Column, y: Column, side: int) -> tuple[Column, Column]:
    """Coordinates of a picture turned by a quarter, in its native orientation."""
    return y, F.lit(side - 1) - x


def normalise(x: Column, y: Column, w: Column, h: Column) -> tuple[Column, Column]:
    """Pixels for shares of the frame; values already in pixels stay."""
    share = x.between(0, 1) & y.between(0, 1)
    return F.when(share, x * w).otherwise(x), F.when(share, y * h).otherwise(y)
