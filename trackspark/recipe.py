"""Dataset recipes: declarative JSON compiled to readers and column expressions.

A recipe names its dataset, where episodes, gaze and annotation channels lie, how their columns, times and
validity are written, which clock they are on, and what is left out. Defaults are merged at the top
level only.
"""

from __future__ import annotations

import json
import re
from dataclasses import dataclass, field
from pathlib import Path
from typing import Any

from trackspark.functions.time import CLOCKS, FRAMES, TIMECODE, UNITS, US_TO_FRAME
from trackspark.sources.annotations import KeyedPath, SegmentSpec, keyed_path
from trackspark.sources.discovery import Select
from trackspark.sources.tracks import READERS, TrackSpec

# fixed values: words a recipe may use
ROLES = ("driver", "context", "disabled")
KINDS = ("interval", "point")
CHANNEL_READERS = ("csv", "tsv", "json", "json_by_key", "pandas_pickle")
JOINS = ("episode_id", "key", "stem", "row_field")
PROJECTIONS = ("already_2d", "normalize_by_dims", "projectaria_cpf", "psi_pinhole_ray", "none")
POLICIES = ("source_only", "holoassist_coarse_fine")


@dataclass
class Channel:
    """``key`` is the field, or the form of the key ("{episode_id}.mp4"), that tells an item's episode."""

    name: str
    select: Select
    kind: str = "interval"
    role: str = "driver"
    reader: str = "csv"
    spec: SegmentSpec = field(default_factory=SegmentSpec)
    by: str = "episode_id"
    key: str = "{episode_id}"
    where: KeyedPath | None = None
    deny_file: str | None = None
    deny_field: str | None = None


@dataclass
class Recipe:
    dataset: str
    root: str
    reader: str
    select: Select
    track: TrackSpec
    channels: list[Channel]
    episodes: dict[str, Any] = field(default_factory=dict)
    gaze_clock: str = "as_is"
    text_clock: str = "as_is"
    const_s: dict[str, float] = field(default_factory=dict)
    projection: str = "none"
    space: str = "pixel_2d"
    frame_dims: tuple[int, int] | None = None
    shipped: dict[str, str] = field(default_factory=dict)
    cull: bool = False
    exclude: list[str] = field(default_factory=list)
    max_gap_s: float | None = None
    final_text: str = "source_only"
    require: tuple[str, ...] = ("video", "gaze", "annotation_any")

    def drivers(self) -> list[str]:
        return [c.name for c in self.channels if c.role == "driver"]

    def contexts(self) -> list[str]:
        return [c.name for c in self.channels if c.role == "context"]

    def role_table(self, spark):
        """(channel, role): a small table for joins."""
        return spark.createDataFrame([(c.name, c.role) for c in self.channels], "channel string, role string")


def _time_problems(at: str, t: dict[str, Any], fps: object) -> list[str]:
    units = t.get("units", "s")
    if units not in UNITS:
        return [f"{at}.units: {units!r} is unknown"]
    if units in (FRAMES, TIMECODE, US_TO_FRAME) and not fps:
        return [f"{at}.fps: needed for its units"]
    return []


def problems(r: dict[str, Any]) -> list[str]:
    """All that is wrong with a recipe; empty if it can be compiled."""
    out = [] if r.get("dataset") else ["dataset: missing"]
    gaze = r.get("gaze") or {}
    form = gaze.get("gaze_format") or {}
    for name, g in [("gaze_format", form)] + [(f"variants[{k}]", v) for k, v in enumerate(form.get("variants") or [])]:
        if g.get("reader") not in (*READERS, "tsv"):
            out.append(f"{name}.reader: {g.get('reader')!r} is unknown")
        if not g.get("columns"):
            out.append(f"{name}.columns: none")
        out += _time_problems(f"{name}.time", g.get("time") or {}, (g.get("time") or {}).get("fps"))
    if (method := (form.get("projection") or {}).get("method", "none")) not in PROJECTIONS:
        out.append(f"projection.method: {method!r} is unknown")
    channels = r.get("annotations") or []
    names = [c.get("name") for c in channels]
    if len(set(names)) < len(names):
        out.append("annotations: a name twice")
    for k, c in enumerate(channels):
        at, t = f"annotations[{k}]", c.get("time") or {}
        for key, known, usual in (("clip_role", ROLES, "driver"), ("kind", KINDS, "interval"), ("reader", CHANNEL_READERS, "csv")):
            if c.get(key, usual) not in known:
                out.append(f"{at}.{key}: {c[key]!r} is unknown")
        if c.get("kind") == "point" and not t.get("point"):
            out.append(f"{at}.time.point: missing for a point channel")
        if c.get("kind", "interval") == "interval" and not t.get("start") and not t.get("whole_episode"):
            out.append(f"{at}.time.start: missing for an interval channel")
        out += _time_problems(f"{at}.time", t, t.get("fps"))
        join = c.get("join") or {}
        if join.get("by", "episode_id") not in JOINS:
            out.append(f"{at}.join.by: {join['by']!r} is unknown")
        if c.get("reader") == "json_by_key" and not join.get("select_path"):
            out.append(f"{at}.join.select_path: missing")
    if names and all(c.get("clip_role", "driver") != "driver" for c in channels):
        out.append("annotations: no driver")
    sync = r.get("epoch_sync") or {}
    for side in ("gaze", "annotations"):
        s = sync.get(side) or {}
        if s.get("transform", "as_is") not in CLOCKS:
            out.append(f"epoch_sync.{side}: {s['transform']!r} is unknown")
        if s.get("transform") == "subtract_const" and s.get("const_s") is None:
            out.append(f"epoch_sync.{side}.const_s: missing")
    if (p := (r.get("annotation_bundle") or {}).get("policy", "source_only")) not in POLICIES:
        out.append(f"annotation_bundle.policy: {p!r} is unknown")
    return out


def _select(s: dict[str, Any] | None) -> Select:
    s = s or {}
    return Select(s.get("path_template", ""), list(s.get("prefer") or []), s.get("glob", ""), s.get("pick", "single"), s.get("invariant_suffix", ""), (s.get("from_metadata") or {}).get("field"))


def _track(g: dict[str, Any]) -> TrackSpec:
    t, v = g.get("time") or {}, g.get("validity") or {}
    time = None if t.get("source") == FRAMES else t.get("source")
    extra = {str(c): c for c in g.get("extra_channels") or []}
    spec = TrackSpec(dict(g["columns"]), time, "s" if time is None else t.get("units", "s"), t.get("fps"), v.get("column"), v.get("valid_when", "==1"), extra)
    spec.variants = [(x["match"], _track(x)) for x in g.get("variants") or []]
    return spec


def _channel(c: dict[str, Any]) -> Channel:
    t, text, join, keep = c.get("time") or {}, c.get("text") or {}, c.get("join") or {}, c.get("filter") or {}
    names = text.get("compose") or [text.get("primary", "text")]
    plus = (t.get("end_from") or "").partition("+")[2].strip() or None
    spec = SegmentSpec(t.get("start"), t.get("end"), t.get("point"), t.get("units", "s"), t.get("fps"), list(names), text.get("compose_sep", " "), text.get("strip_prefix_regex"), keep.get("keep_where"), keep.get("drop_where"), list(c.get("extras") or []), plus, bool(t.get("whole_episode")))
    form = join.get("key_in_file")
    where = keyed_path(join["select_path"], form) if c.get("reader") == "json_by_key" else None
    key = form or (join.get("key_field") if join.get("by") == "row_field" else "{" + join.get("key_field", "episode_id") + "}") or "{episode_id}"
    return Channel(c["name"], _select(c.get("select")), c.get("kind", "interval"), c.get("clip_role", "driver"), c.get("reader", "csv"), spec, join.get("by", "episode_id"), key, where, keep.get("denylist_file"), keep.get("denylist_field"))


def compile_recipe(r: dict[str, Any], defaults: dict[str, Any] | None = None) -> Recipe:
    r = {**(defaults or {}), **r}
    if found := problems(r):
        raise ValueError("; ".join(found))
    form, sync, filters = r["gaze"]["gaze_format"], r.get("epoch_sync") or {}, r.get("dataset_filters") or {}
    side = lambda s: (sync.get(s) or {}).get("transform", "as_is")
    const = {s: sync[s]["const_s"] for s in ("gaze", "annotations") if (sync.get(s) or {}).get("const_s") is not None}
    shipped = (((r.get("metadata") or {}).get("prefer_shipped") or {}).get("video") or {}).get("fields") or {}
    return Recipe(
        r["dataset"], r.get("root", ""), form["reader"], _select(r["gaze"].get("select")), _track(form), [_channel(c) for c in r.get("annotations") or []],
        r.get("episode") or {}, side("gaze"), side("annotations"), const, (form.get("projection") or {}).get("method", "none"), form.get("coordinate_space", "pixel_2d"),
        tuple(form["frame_dims"]) if form.get("frame_dims") else None, dict(shipped), bool(filters.get("cull")), list(filters.get("exclude_episode_globs") or []), filters.get("max_gaze_valid_gap_s"),
        (r.get("annotation_bundle") or {}).get("policy", "source_only"), tuple((r.get("emit_policy") or {}).get("require") or ("video", "gaze", "annotation_any")),
    )


def load(path: str, defaults: str | None = None) -> Recipe:
    return compile_recipe(json.loads(Path(path).read_text()), json.loads(Path(defaults).read_text()) if defaults else None)


def key_tokens(form: str) -> list[str]:
    """Names in braces of a key's form."""
    return re.findall(r"\{(\w+)\}", form)
