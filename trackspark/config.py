"""Run configuration: defaults, files, dotted overrides; ratios, partitions and object-store paths."""

from __future__ import annotations

import json
from dataclasses import asdict, dataclass, field, fields, is_dataclass
from pathlib import Path
from typing import Any


@dataclass
class Grid:
    hz: float = 10.0
    max_gap_s: float | None = None


@dataclass
class Clips:
    fps: float = 2.0
    side: int = 378
    max_clip_s: float = 55.0
    min_clip_s: float = 3.0
    drop_shorter_s: float = 1.0
    merge_gap_s: float = 3.0
    point_window_s: float = 0.5
    min_overlap: float = 0.5


@dataclass
class Tolerances:
    time_s: float = 1e-6
    value: float = 1e-6


@dataclass
class Config:
    grid: Grid = field(default_factory=Grid)
    clips: Clips = field(default_factory=Clips)
    tolerances: Tolerances = field(default_factory=Tolerances)
    layout: str = "{root}/{dataset}/{episode}"


def literal(text: str) -> Any:
    """A command-line value: JSON where it is JSON, else text."""
    try:
        return json.loads(text)
    except ValueError:
        return {"True": True, "False": False, "None": None}.get(text, text)


def assign(tree: dict, dotted: str, value: Any) -> dict:
    """Set ``a.b.c`` in a nested dict, in place."""
    *path, last = dotted.split(".")
    at = tree
    for p in path:
        at = at.setdefault(p, {})
        if not isinstance(at, dict):
            raise ValueError(f"{dotted!r} goes through {p!r}, which is no section")
    at[last] = value
    return tree


def merge(base: dict, over: dict) -> dict:
    """Deep merge into a new dict; ``over`` wins."""
    out = dict(base)
    for k, v in over.items():
        out[k] = merge(out[k], v) if isinstance(v, dict) and isinstance(out.get(k), dict) else v
    return out


def _build(kind: type, tree: dict, at: str = "") -> Any:
    known = {f.name: f for f in fields(kind)}
    if extra := set(tree) - set(known):
        raise ValueError(f"unknown settings: {', '.join(sorted(at + e for e in extra))}")
    made = kind()
    values = {}
    for name, v in tree.items():
        now = getattr(made, name)
        values[name] = _build(type(now), v, f"{at}{name}.") if is_dataclass(now) else v
    return kind(**values)


def load(path: str | None = None, overrides: dict[str, str] | None = None) -> Config:
    """Defaults, then a JSON file, then dotted overrides; checked."""
    tree = asdict(Config())
    if path:
        tree = merge(tree, json.loads(Path(path).read_text()))
    for k, v in (overrides or {}).items():
        assign(tree, k, literal(v) if isinstance(v, str) else v)
    cfg = _build(Config, tree)
    for name in ("grid.hz", "clips.fps", "clips.side", "clips.max_clip_s"):
        a, b = name.split(".")
        v = getattr(getattr(cfg, a), b)
        if not isinstance(v, (int, float)) or isinstance(v, bool) or v <= 0:
            raise ValueError(f"{name} must be positive, not {v!r}")
    return cfg


def ratios(text: str) -> list[tuple[str, float]]:
    """"train=0.8,val=0.2" in the order given; they need not sum to 1."""
    out = []
    for part in text.split(","):
        name, eq, v = part.partition("=")
        if not eq or not name.strip():
            raise ValueError(f"{part!r} is not name=ratio")
        out.append((name.strip(), float(v)))
    if sum(v for _, v in out) <= 0:
        raise ValueError("ratios must sum to more than 0")
    return out


def partitions(text: str) -> list[str]:
    """A comma list or "first..last" of numbered names with equal prefix."""
    if ".." in text:
        a, b = text.split("..")
        stem = a.rstrip("0123456789")
        if not b.startswith(stem):
            raise ValueError(f"{text!r} mixes two prefixes")
        lo, hi = a[len(stem) :], b[len(stem) :]
        return [f"{stem}{i:0{len(lo)}d}" for i in range(int(lo), int(hi) + 1)]
    return [p.strip() for p in text.split(",") if p.strip()]


def join_uri(root: str, *parts: str) -> str:
    return "/".join([root.rstrip("/"), *[p.strip("/") for p in parts if p.strip("/")]])


def split_uri(uri: str) -> tuple[str, str]:
    """(bucket, key) of scheme://bucket/key."""
    scheme, sep, rest = uri.partition("://")
    if not sep or not rest:
        raise ValueError(f"{uri!r} is no object-store address")
    bucket, _, key = rest.partition("/")
    return bucket, key


def mounted(uri: str, mounts: dict[str, str]) -> str:
    """The local path of an address whose bucket is mounted."""
    bucket, key = split_uri(uri)
    if bucket not in mounts:
        raise ValueError(f"bucket {bucket!r} is not mounted")
    return join_uri(mounts[bucket], key)
