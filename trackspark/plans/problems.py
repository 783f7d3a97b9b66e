"""Queries p1, p3 and p4: grids, nested annotations, periods."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from trackspark.operators import grid, nested, periods
from trackspark.operators.dedupe import latest
from trackspark.session import durable, table

SOURCE = ["dataset", "episode_id"]
#: Levels of a group that hold items; where none is named, every level of objects does.
ITEM_LEVELS = {"ego-exo4d": ("descriptions", "commentary_data")}


def _rates(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "recipe").select("dataset", F.col("grid_hz").alias("hz"))


def p1_found(spark: SparkSession, d: str) -> DataFrame:
    """Gaps of the regular grid between two usable readings, stops of the recorder left out."""
    samples = grid.usable_samples(table(spark, d, "gaze_sample"))
    occupied = grid.slots(samples, _rates(spark, d), SOURCE)
    g = grid.gaps(occupied, SOURCE)
    return g.filter((F.col("slot_to") - F.col("slot_from") + 1) / F.col("hz") <= grid.STOP_S).select(*SOURCE, "slot_from", "slot_to")


def p1_grid(spark: SparkSession, d: str) -> DataFrame:
    """The full grid of every episode, to its end, each slot with a value or a mark."""
    newest = grid.newest_samples(table(spark, d, "gaze_sample"), ("x", "y"))
    occupied = grid.slots(newest.filter("ok"), _rates(spark, d), SOURCE, ("x", "y"))
    ends = grid.ends(table(spark, d, "episode"), newest, _rates(spark, d), SOURCE)
    limit = table(spark, d, "recipe").select("dataset", F.col("max_gaze_valid_gap_s").alias("max_gap_s"))
    out = grid.fill(occupied, SOURCE, ("x", "y"), limit, until=ends)
    return out.withColumn("time_s", F.round("time_s", 6)).withColumn("x", F.round("x", 4)).withColumn("y", F.round("y", 4))


def p1_episodes(spark: SparkSession, d: str) -> DataFrame:
    """Of each episode: slots of its grid and how many hold a reading, are filled or stay marked."""
    by = p1_grid(spark, d).groupBy(*SOURCE).agg(F.count(F.lit(1)).alias("rows"), *[F.count_if(F.col("state") == s).alias(s) for s in ("sample", "filled", "missing", "stop", "before")], F.max("time_s").alias("last_s"))
    return by.join(_rates(spark, d), "dataset").withColumn("valid", F.round((F.col("sample") + F.col("filled")) / F.col("rows"), 6))


def _takes(spark: SparkSession, d: str) -> DataFrame:
    recipe = {r.dataset: r.select_path for r in table(spark, d, "recipe").filter("select_path IS NOT NULL").select("dataset", "select_path").collect()}
    raw = latest(table(spark, d, "raw_annotation").select("raw_id", "dataset", "payload", "arrived_at"), "raw_id", "arrived_at")
    return durable(nested.takes(raw, recipe, ["raw_id"]))  # parsed once, read by every level


TAKE = ["dataset", "raw_id", "top_no", "take_key"]


def _paths(spark: SparkSession, d: str) -> dict[str, tuple]:
    rows = table(spark, d, "recipe").filter("select_path IS NOT NULL").select("dataset", "select_path").collect()
    return {r.dataset: nested.compile_path(r.select_path) for r in rows}


def _take_id() -> Column:
    return F.md5(F.concat_ws("/", *[F.coalesce(F.col(c).cast("string"), F.lit("\u0000")) for c in TAKE]))


def _levels(paths: dict[str, tuple]) -> tuple[Callable[[Column], Column], Column]:
    """(does a field of that name hold items, are the dataset's groups the entries of a take)."""
    by_position = F.col("dataset").isin(*[n for n in paths if n in ITEM_LEVELS])

    def is_level(key: Column) -> Column:
        cond = F.lit(False)
        for name, (_, _, level) in paths.items():
            at = F.col("dataset") == name
            cond = cond | (at & (key == level) if level else at & key.isin(*ITEM_LEVELS[name]) if name in ITEM_LEVELS else at)
        return cond

    return is_level, by_position


def _items(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(groups, items, revisions), each pointing to its parent by ``parent_id``."""
    t = _takes(spark, d)
    deep = nested.levels(t, "take", TAKE, most=3)
    if not deep:
        none = t.select(*TAKE).filter("false").selectExpr(*TAKE, "'' parent_id", "'' row_id", "'' group_key", "0L group_no", "'' level", "0L item_no", "0L child_no", "CAST(NULL AS MAP<STRING, VARIANT>) fields")
        return none, none, none
    while len(deep) < 3:
        deep.append(nested.child(deep[-1], TAKE))
    top, item, rev = deep[:3]
    is_level, by_position = _levels(_paths(spark, d))
    key = F.col("path")[0]
    group_no, item_no = F.col("trail")[0], F.col("trail")[1]
    named = F.when(by_position, group_no.cast("string")).otherwise(key).alias("group_key")
    # a pass is a group by itself, a level one below its take
    below = lambda parent, name: F.md5(F.concat_ws("/", parent, name))
    passes = top.filter(by_position).select(*TAKE, _take_id().alias("parent_id"), "row_id", group_no.cast("string").alias("group_key"), group_no.alias("group_no"), "fields")
    named_levels = top.filter(~by_position).select(*TAKE, "row_id", group_no.alias("group_no"), F.explode("fields").alias("group_key", "value")).filter(is_level(F.col("group_key")) & nested.holds_objects(F.col("value")))
    named_levels = named_levels.select(*TAKE, _take_id().alias("parent_id"), below("row_id", "group_key").alias("row_id"), "group_key", "group_no", F.expr("CAST(map() AS MAP<STRING, VARIANT>)").alias("fields"))
    group = passes.unionByName(named_levels)
    parent = F.when(by_position, F.col("parent_id")).otherwise(below("parent_id", key)).alias("parent_id")
    item = item.filter(is_level(key)).select(*TAKE, parent, "row_id", named, group_no.alias("group_no"), key.alias("level"), item_no.alias("item_no"), "fields")
    rev = rev.filter(is_level(key) & (F.element_at("path", -1) == "revisions"))
    rev = rev.select(*TAKE, "parent_id", "row_id", named, item_no.alias("item_no"), F.col("position").alias("child_no"), "fields")
    return group, item, rev


def p3_found(spark: SparkSession, d: str) -> DataFrame:
    """Every item (child_no -1) and every revision of the readable payloads."""
    _, item, rev = _items(spark, d)
    cols = ["raw_id", "take_key", "group_key", "item_no", "child_no"]
    return item.withColumn("child_no", F.lit(-1).cast("long")).select(*cols).unionByName(rev.select(*cols))


def _text_of(fields: Column) -> Column:
    """All fields as lines "path=JSON text" in the order of their paths."""
    return F.array_join(F.array_sort(F.transform(F.map_entries(fields), lambda e: F.concat(e["key"], F.lit("="), e["value"]))), "\n")


def _text(*names: str):
    return F.coalesce(*[F.try_variant_get(F.col("fields")[n], "$", "string") for n in names])


def _num(*names: str):
    return F.coalesce(*[_text(n).try_cast("double") for n in names])


def p3_takes(spark: SparkSession, d: str) -> DataFrame:
    """Takes with their key as ``row_id`` and the fields that are no group of their own.

    A field is a line "path=JSON text". A take that is no object has its JSON under the path "", unless it is the list of its groups.
    """
    is_level, by_position = _levels(_paths(spark, d))
    own = nested.fields_of(F.col("take"))
    listed = by_position & F.try_variant_get(F.col("take"), "$", "array<variant>").isNotNull()
    none = F.expr("CAST(map() AS MAP<STRING, STRING>)")
    fields = F.when(listed | (by_position & own.isNotNull()), none).when(own.isNotNull(), nested.flat(own, is_level)).otherwise(F.create_map(F.lit(""), F.to_json("take")))
    t = _takes(spark, d).select(*TAKE, _take_id().alias("row_id"), _text_of(fields).alias("fields"))
    return t.groupBy(*TAKE, "row_id").agg(F.count(F.lit(1)).alias("n"), F.min("fields").alias("fields"))


def p3_groups(spark: SparkSession, d: str) -> DataFrame:
    """Passes and levels, with items or without: parent key, position and all other fields."""
    group, _, _ = _items(spark, d)
    is_level, _ = _levels(_paths(spark, d))
    return group.select(*TAKE, "parent_id", "row_id", "group_key", "group_no", _text_of(nested.flat(F.col("fields"), is_level)).alias("fields"))


def p3_items(spark: SparkSession, d: str) -> DataFrame:
    """Items as a flat table: parent key, position, text and times whatever their spelling, all fields."""
    _, item, _ = _items(spark, d)
    span = F.try_variant_get(F.col("fields")["Step timestamp"], "$", "array<string>")
    return item.select(
        *TAKE, "parent_id", "row_id", "group_key", "level", "item_no",
        F.coalesce(_text("text", "Step description"), F.try_variant_get(F.col("fields")["attributes"], "$['Action sentence']", "string"), F.try_variant_get(F.col("fields")["attributes"], "$['Long form description']", "string")).alias("text"),
        F.coalesce(_num("timestamp", "video_time", "start"), F.get(span, F.lit(0)).try_cast("double")).alias("start_s"),
        F.coalesce(_num("end"), F.get(span, F.lit(1)).try_cast("double")).alias("end_s"),
        _text_of(nested.flat(F.col("fields"), lambda k: k == "revisions")).alias("fields"),
    )


def p3_revisions(spark: SparkSession, d: str) -> DataFrame:
    _, _, rev = _items(spark, d)
    return rev.select(*TAKE, "parent_id", "row_id", "group_key", "item_no", "child_no", _text("by").alias("by"), _text("text").alias("text"), _text_of(nested.flat(F.col("fields"))).alias("fields"))


def p3_schema(spark: SparkSession, d: str) -> DataFrame:
    """The merged schema of each dataset's takes: field path, kind, number of values."""
    s = nested.infer(_takes(spark, d), "take", "dataset")
    return s.select("dataset", F.array_join("path", "/").alias("path"), "kind", "n")


def _segments(spark: SparkSession, d: str) -> DataFrame:
    seg = table(spark, d, "segment").select(*SOURCE, F.lower(F.trim(F.regexp_replace("channel", r"^\s+|\s+$", ""))).alias("channel"), periods.ms(F.col("start_s")).alias("s"), periods.ms(F.col("end_s")).alias("e"))
    rec = table(spark, d, "recipe").select("dataset", periods.ms(F.col("merge_gap_s")).alias("gap"))
    return seg.filter("e > s").join(rec, "dataset")


def _periods(spark: SparkSession, d: str) -> DataFrame:
    return periods.periods(_segments(spark, d), [*SOURCE, "channel"])


def p4_found(spark: SparkSession, d: str) -> DataFrame:
    """Continuous periods of each channel and the gaps between them."""
    lim = table(spark, d, "recipe").select("dataset", periods.ms(F.col("coalesce_max_gap_s")).alias("short"))
    p = _periods(spark, d).join(lim, "dataset")
    one = lambda what, s, e: F.struct(what.alias("what"), s.alias("start_ms"), e.alias("end_ms"))
    s = F.col("s")
    gap = F.when(F.col("gap_from").isNotNull(), F.array(one(F.when(s - F.col("gap_from") <= F.coalesce("short", F.lit(0)), "short_gap").otherwise("long_gap"), F.col("gap_from"), s)))
    both = F.concat(F.array(one(F.lit("period"), s, F.col("e"))), F.coalesce(gap, F.array().cast("array<struct<what:string,start_ms:bigint,end_ms:bigint>>")))
    return p.select(*SOURCE, "channel", F.inline(both))


def p4_coverage(spark: SparkSession, d: str) -> DataFrame:
    """Of each channel: periods, covered ms, first start and last end."""
    p = _periods(spark, d)
    return p.groupBy(*SOURCE, "channel").agg(F.count(F.lit(1)).alias("periods"), F.sum(F.col("e") - F.col("s")).alias("covered_ms"), F.min("s").alias("start_ms"), F.max("e").alias("end_ms"))


QUERIES = {f.__name__: f for f in (p1_found, p1_grid, p1_episodes, p3_found, p3_takes, p3_groups, p3_items, p3_revisions, p3_schema, p4_found, p4_coverage)}

_USABLE = """latest AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY sample_id ORDER BY arrived_at DESC NULLS LAST) rn FROM gaze_sample) WHERE rn = 1),
usable AS (SELECT l.dataset, l.episode_id, l.sample_id, l.t_s, l.x, l.y, r.grid_hz, r.max_gaze_valid_gap_s mg, CAST(floor(l.t_s * r.grid_hz) AS BIGINT) slot FROM latest l JOIN recipe r ON l.dataset = r.dataset
 WHERE l.valid AND l.t_s >= 0 AND NOT isnan(l.t_s) AND NOT isinf(l.t_s) AND l.x IS NOT NULL AND NOT isnan(l.x) AND l.y IS NOT NULL AND NOT isnan(l.y))"""

_MERGED = """seg AS (SELECT s.dataset, s.episode_id, lower(trim(s.channel)) channel, CAST(round(s.start_s * 1000) AS BIGINT) s, CAST(round(s.end_s * 1000) AS BIGINT) e,
  CAST(round(r.merge_gap_s * 1000) AS BIGINT) gap, CAST(round(r.coalesce_max_gap_s * 1000) AS BIGINT) short
  FROM segment s JOIN recipe r ON s.dataset = r.dataset WHERE s.start_s IS NOT NULL AND s.end_s IS NOT NULL AND NOT isnan(s.start_s) AND NOT isnan(s.end_s)),
far AS (SELECT *, max(e) OVER (PARTITION BY dataset, episode_id, channel ORDER BY s, e ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) f FROM seg WHERE e > s),
isl AS (SELECT *, sum(CASE WHEN f IS NULL OR s > f + gap THEN 1 ELSE 0 END) OVER (PARTITION BY dataset, episode_id, channel ORDER BY s, e ROWS UNBOUNDED PRECEDING) k FROM far),
per AS (SELECT dataset, episode_id, channel, k, min(s) s, max(e) e, max(short) short FROM isl GROUP BY ALL),
nxt AS (SELECT *, lag(e) OVER (PARTITION BY dataset, episode_id, channel ORDER BY k) f FROM per)"""

_FLAT = """unwrapped AS (SELECT DISTINCT raw_id, dataset, CASE WHEN json_type(payload::JSON) = 'VARCHAR' THEN payload::JSON->>'$' ELSE payload END p FROM raw_annotation WHERE json_valid(payload)),
docs AS (SELECT raw_id, dataset, p::JSON p FROM unwrapped WHERE json_valid(p)),
tops AS (SELECT raw_id, dataset, unnest(CASE json_type(p) WHEN 'ARRAY' THEN json_extract(p, '$[*]') ELSE [p] END) p FROM docs),
keyed AS (SELECT t.raw_id, t.dataset, e.key take_key, e.value take FROM tops t, json_each(t.p, '$.annotations') e WHERE json_type(t.p, '$.annotations') = 'OBJECT' AND t.dataset IN ('ego-exo4d', 'egome')),
passes AS (SELECT raw_id, take_key, unnest(CASE json_type(take) WHEN 'ARRAY' THEN json_extract(take, '$[*]') ELSE [take] END) g, CAST(generate_subscripts(CASE json_type(take) WHEN 'ARRAY' THEN json_extract(take, '$[*]') ELSE [take] END, 1) - 1 AS VARCHAR) group_key FROM keyed WHERE dataset = 'ego-exo4d'),
lev AS (SELECT raw_id, take_key, group_key, json_extract(g, n) v FROM passes, (VALUES ('$.descriptions'), ('$.commentary_data')) q(n) WHERE json_type(g) = 'OBJECT'
 UNION ALL SELECT k.raw_id, k.take_key, e.key, e.value FROM keyed k, json_each(k.take) e WHERE k.dataset = 'egome' AND json_type(k.take) = 'OBJECT'
 UNION ALL SELECT raw_id, p->>'$.video_name', 'events', json_extract(p, '$.events') FROM tops WHERE dataset = 'holoassist' AND json_type(p) = 'OBJECT'),
lists AS (SELECT raw_id, take_key, group_key, CASE json_type(v) WHEN 'ARRAY' THEN json_extract(v, '$[*]') ELSE [v] END l FROM lev WHERE v IS NOT NULL),
elem AS (SELECT raw_id, take_key, group_key, unnest(l) v, generate_subscripts(l, 1) - 1 item_no FROM lists),
item AS (SELECT * FROM elem WHERE json_type(v) = 'OBJECT'),
revl AS (SELECT raw_id, take_key, group_key, item_no, CASE json_type(json_extract(v, '$.revisions')) WHEN 'ARRAY' THEN json_extract(v, '$.revisions[*]') ELSE [json_extract(v, '$.revisions')] END l FROM item WHERE json_extract(v, '$.revisions') IS NOT NULL),
rev AS (SELECT raw_id, take_key, group_key, item_no, unnest(l) v, generate_subscripts(l, 1) - 1 child_no FROM revl)"""

ORACLES = {
    "p1_found": f"""WITH {_USABLE}, lags AS (SELECT dataset, episode_id, slot, grid_hz, lag(slot) OVER (PARTITION BY dataset, episode_id ORDER BY slot) p FROM (SELECT DISTINCT dataset, episode_id, slot, grid_hz FROM usable))
SELECT dataset, episode_id, p + 1 AS slot_from, slot - 1 AS slot_to FROM lags WHERE slot > p + 1 AND (slot - p - 1) / grid_hz <= 900""",
    "p1_grid": f"""WITH {_USABLE}, one AS (SELECT dataset, episode_id, slot, grid_hz, mg, max_by((t_s, x, y), (t_s, sample_id)) m FROM usable GROUP BY ALL),
nb AS (SELECT dataset, episode_id, slot, grid_hz, mg, m[1] t, m[2] x, m[3] y, lag(slot) OVER w p, lag(m[1]) OVER w pt, lag(m[2]) OVER w px, lag(m[3]) OVER w py FROM one WINDOW w AS (PARTITION BY dataset, episode_id ORDER BY slot)),
g AS (SELECT *, unnest(generate_series(coalesce(p + 1, 0), slot)) g FROM nb),
st AS (SELECT *, CASE WHEN g = slot THEN 'sample' WHEN p IS NULL THEN 'before' WHEN (slot - p - 1) / grid_hz > 900 THEN 'stop' WHEN t - pt <= mg THEN 'filled' ELSE 'missing' END state, (g / grid_hz - pt) / (t - pt) f FROM g),
seen AS (SELECT dataset, episode_id, duration_s t FROM episode UNION ALL SELECT dataset, episode_id, t_s FROM latest),
furthest AS (SELECT dataset, episode_id, max(t) FILTER (t >= 0 AND NOT isnan(t) AND NOT isinf(t)) t FROM seen GROUP BY 1, 2),
ends AS (SELECT s.dataset, s.episode_id, r.grid_hz, coalesce(CAST(floor(s.t * r.grid_hz) AS BIGINT), 0) e FROM furthest s JOIN recipe r ON s.dataset = r.dataset WHERE r.grid_hz > 0),
tails AS (SELECT e.dataset, e.episode_id, e.grid_hz, unnest(generate_series(coalesce(u.m + 1, 0), e.e)) g FROM ends e LEFT JOIN (SELECT dataset, episode_id, max(slot) m FROM usable GROUP BY 1, 2) u ON e.dataset = u.dataset AND e.episode_id IS NOT DISTINCT FROM u.episode_id)
SELECT dataset, episode_id, g AS slot, round(g / grid_hz, 6) AS time_s, round(CASE state WHEN 'sample' THEN x WHEN 'filled' THEN px + (x - px) * f END, 4) AS x, round(CASE state WHEN 'sample' THEN y WHEN 'filled' THEN py + (y - py) * f END, 4) AS y, state IN ('sample', 'filled') AS valid, state FROM st
UNION ALL SELECT dataset, episode_id, g, round(g / grid_hz, 6), NULL, NULL, false, 'missing' FROM tails""",
    "p3_found": f"""WITH {_FLAT} SELECT raw_id, take_key, group_key, CAST(item_no AS BIGINT) AS item_no, CAST(-1 AS BIGINT) AS child_no FROM item UNION ALL
SELECT raw_id, take_key, group_key, CAST(item_no AS BIGINT), CAST(child_no AS BIGINT) FROM rev WHERE json_type(v) = 'OBJECT'""",
    "p4_found": f"""WITH {_MERGED} SELECT dataset, episode_id, channel, 'period' AS what, s AS start_ms, e AS end_ms FROM per UNION ALL
SELECT dataset, episode_id, channel, CASE WHEN s - f <= coalesce(short, 0) THEN 'short_gap' ELSE 'long_gap' END, f, s FROM nxt WHERE f IS NOT NULL""",
    "p4_coverage": f"""WITH {_MERGED} SELECT dataset, episode_id, channel, count(*) AS periods, CAST(sum(e - s) AS BIGINT) AS covered_ms, min(s) AS start_ms, max(e) AS end_ms FROM per GROUP BY ALL""",
}
ORACLES["p1_episodes"] = f"""WITH g AS ({ORACLES["p1_grid"]}), n AS (SELECT dataset, episode_id, count(*) "rows", count(*) FILTER (state = 'sample') "sample", count(*) FILTER (state = 'filled') filled, count(*) FILTER (state = 'missing') missing, count(*) FILTER (state = 'stop') stop,
 count(*) FILTER (state = 'before') "before", max(time_s) last_s FROM g GROUP BY 1, 2) SELECT n.*, r.grid_hz AS hz, round((n."sample" + n.filled) / n."rows", 6) AS valid FROM n JOIN recipe r ON n.dataset = r.dataset"""


# a number with nothing behind its point is the whole number
_NUMBERS = r"regexp_replace(CAST({0} AS VARCHAR), '(\d)\.0+([,\]}}]|$)', '\1\2', 'g')"


def _flat_sql(source: str, skipped: str) -> str:
    """SQL for (id, fields) of (id, dataset, v): lines of an object's fields, ``skipped`` tells which are levels."""
    esc = "replace(replace({}, '~', '~0'), '/', '~1')"
    key, inner = esc.format("f.key"), esc.format("i.key")
    return f"""SELECT id, string_agg(line, chr(10) ORDER BY line) fields FROM (
 SELECT s.id, {key} || coalesce('/' || {inner}, '') || '=' || {_NUMBERS.format("coalesce(i.value, f.value)")} line FROM {source} s, json_each(s.v) f
 LEFT JOIN LATERAL (SELECT * FROM json_each(CASE json_type(f.value) WHEN 'OBJECT' THEN f.value ELSE '{{}}'::JSON END)) i ON true WHERE NOT coalesce({skipped}, false)) GROUP BY 1"""


_HOLDS = "(json_type(f.value) = 'OBJECT' OR (json_type(f.value) = 'ARRAY' AND len(list_filter(json_extract(f.value, '$[*]'), lambda x: json_type(x) = 'OBJECT')) > 0))"
_TREE = f"""{_FLAT}, n AS (SELECT raw_id, dataset, unnest(l) p, CAST(generate_subscripts(l, 1) - 1 AS INT) k FROM (SELECT raw_id, dataset, CASE json_type(p) WHEN 'ARRAY' THEN json_extract(p, '$[*]') ELSE [p] END l FROM docs)),
t AS (SELECT dataset, raw_id, k, e.key take_key, e.value take FROM n, json_each(n.p, '$.annotations') e WHERE json_type(n.p, '$.annotations') = 'OBJECT' AND dataset IN ('ego-exo4d', 'egome')
 UNION ALL SELECT dataset, raw_id, k, p->>'$.video_name', p FROM n WHERE dataset = 'holoassist' AND json_type(p) = 'OBJECT'),
tk AS (SELECT *, md5(concat_ws('/', coalesce(dataset, chr(0)), raw_id, k, coalesce(take_key, chr(0)))) id FROM t),
tf AS ({_flat_sql("(SELECT id, dataset, take v FROM tk WHERE dataset <> 'ego-exo4d' AND json_type(take) = 'OBJECT')", f"(s.dataset = 'egome' OR f.key = 'events') AND {_HOLDS}")}),
top AS (SELECT * FROM (SELECT tk.* EXCLUDE (take, id, l), id take_id, unnest(l) v, CAST(generate_subscripts(l, 1) - 1 AS BIGINT) no FROM (SELECT *, CASE json_type(take) WHEN 'ARRAY' THEN json_extract(take, '$[*]') ELSE [take] END l FROM tk) tk) WHERE json_type(v) = 'OBJECT'),
root AS (SELECT *, md5(concat_ws('/', coalesce(dataset, chr(0)), raw_id, k, coalesce(take_key, chr(0)), no)) id FROM top),
lev2 AS (SELECT r.* EXCLUDE (v), f.key lev, f.value v, {_HOLDS} holds FROM root r, json_each(r.v) f WHERE CASE r.dataset WHEN 'ego-exo4d' THEN f.key IN ('descriptions', 'commentary_data') WHEN 'egome' THEN true ELSE f.key = 'events' END),
elem2 AS (SELECT * EXCLUDE (v, l), unnest(l) v, CAST(generate_subscripts(l, 1) - 1 AS BIGINT) item_no FROM (SELECT *, CASE json_type(v) WHEN 'ARRAY' THEN json_extract(v, '$[*]') ELSE [v] END l FROM lev2)),
it AS (SELECT *, CASE dataset WHEN 'ego-exo4d' THEN id ELSE md5(id || '/' || lev) END parent_id, md5(concat_ws('/', id, lev, item_no)) item_id, CASE dataset WHEN 'ego-exo4d' THEN CAST(no AS VARCHAR) ELSE lev END group_key FROM elem2 WHERE json_type(v) = 'OBJECT'),
itf AS ({_flat_sql("(SELECT item_id id, dataset, v FROM it)", f"f.key = 'revisions' AND {_HOLDS}")}),
rl AS (SELECT * EXCLUDE (v), json_extract(v, '$.revisions') v FROM it WHERE json_extract(v, '$.revisions') IS NOT NULL),
rv AS (SELECT * FROM (SELECT * EXCLUDE (v, l), unnest(l) v, CAST(generate_subscripts(l, 1) - 1 AS BIGINT) child_no FROM (SELECT *, CASE json_type(v) WHEN 'ARRAY' THEN json_extract(v, '$[*]') ELSE [v] END l FROM rl)) WHERE json_type(v) = 'OBJECT'),
rvf AS ({_flat_sql("(SELECT md5(concat_ws('/', item_id, 'revisions', child_no)) id, dataset, v FROM rv)", "false")})"""
ORACLES["p3_takes"] = f"""WITH {_TREE} SELECT dataset, raw_id, k AS top_no, take_key, tk.id AS row_id, count(*) AS n,
 min(CASE WHEN dataset = 'ego-exo4d' AND json_type(take) IN ('ARRAY', 'OBJECT') THEN '' WHEN json_type(take) = 'OBJECT' THEN coalesce(tf.fields, '') ELSE '=' || {_NUMBERS.format('take')} END) AS fields FROM tk LEFT JOIN tf ON tk.id = tf.id GROUP BY ALL"""
ORACLES["p3_groups"] = f"""WITH {_TREE}, gf AS ({_flat_sql("(SELECT id, dataset, v FROM root WHERE dataset = 'ego-exo4d')", f"f.key IN ('descriptions', 'commentary_data') AND {_HOLDS}")})
SELECT dataset, raw_id, k AS top_no, take_key, take_id AS parent_id, r.id AS row_id, CAST(no AS VARCHAR) AS group_key, no AS group_no, coalesce(gf.fields, '') AS fields FROM root r LEFT JOIN gf ON r.id = gf.id WHERE dataset = 'ego-exo4d'
UNION ALL SELECT dataset, raw_id, k, take_key, take_id, md5(id || '/' || lev), lev, no, '' FROM lev2 WHERE dataset <> 'ego-exo4d' AND holds"""
ORACLES["p3_items"] = f"""WITH {_TREE} SELECT dataset, raw_id, k AS top_no, take_key, parent_id, item_id AS row_id, group_key, lev AS level, item_no,
 coalesce(v->>'$.text', v->>'$."Step description"', v->>'$.attributes."Action sentence"', v->>'$.attributes."Long form description"') AS text,
 coalesce(try_cast(v->>'$.timestamp' AS DOUBLE), try_cast(v->>'$.video_time' AS DOUBLE), try_cast(v->>'$.start' AS DOUBLE), try_cast(v->>'$."Step timestamp"[0]' AS DOUBLE)) AS start_s,
 coalesce(try_cast(v->>'$.end' AS DOUBLE), try_cast(v->>'$."Step timestamp"[1]' AS DOUBLE)) AS end_s, coalesce(itf.fields, '') AS fields FROM it LEFT JOIN itf ON it.item_id = itf.id"""
ORACLES["p3_revisions"] = f"""WITH {_TREE} SELECT dataset, raw_id, k AS top_no, take_key, item_id AS parent_id, rvf.id AS row_id, group_key, item_no, child_no, v->>'$.by' AS "by", v->>'$.text' AS text, coalesce(rvf.fields, '') AS fields
FROM rv LEFT JOIN rvf ON md5(concat_ws('/', item_id, 'revisions', child_no)) = rvf.id"""
_KIND = "CASE json_type({0}) WHEN 'OBJECT' THEN 'single' WHEN 'ARRAY' THEN 'array' WHEN 'NULL' THEN 'null' WHEN 'BOOLEAN' THEN 'boolean' WHEN 'DOUBLE' THEN CASE WHEN CAST({0} AS DOUBLE) = floor(CAST({0} AS DOUBLE)) THEN 'bigint' ELSE 'double' END WHEN 'VARCHAR' THEN 'string' ELSE 'bigint' END"
ORACLES["p3_schema"] = f"""WITH RECURSIVE {_TREE},
walk(dataset, path, v, what) AS (SELECT dataset, '', take, 'value' FROM tk
 UNION ALL SELECT w.dataset, CASE WHEN x.key IS NULL THEN w.path ELSE w.path || CASE w.path WHEN '' THEN '' ELSE '/' END || x.key END, x.v, CASE WHEN x.key IS NULL THEN 'element' ELSE 'field' END
 FROM walk w, LATERAL (SELECT e.key, e.value v FROM json_each(CASE json_type(w.v) WHEN 'OBJECT' THEN w.v ELSE '{{}}'::JSON END) e
  UNION ALL SELECT NULL, unnest(CASE json_type(w.v) WHEN 'ARRAY' THEN json_extract(w.v, '$[*]') ELSE []::JSON[] END)) x WHERE NOT (x.key IS NULL AND json_type(x.v) = 'ARRAY')),
kinds AS (SELECT dataset, path, 'object' kind FROM walk WHERE json_type(v) = 'OBJECT'
 UNION ALL SELECT dataset, path, {_KIND.format('v')} FROM walk WHERE what = 'field'
 UNION ALL SELECT dataset, path, 'element:' || {_KIND.format('v')} FROM walk WHERE what = 'element' AND json_type(v) <> 'OBJECT')
SELECT dataset, path, kind, count(*) AS n FROM kinds GROUP BY ALL"""
