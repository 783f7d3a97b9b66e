"""Whole results where earlier versions left rows out."""

import datetime as dt
import json

from trackspark.operators import grid, nested
from trackspark.plans import problems, q_pipelines

SRC = ["dataset", "episode_id"]


def test_p1_grid_runs_to_the_end_of_every_episode(spark):
    at = dt.datetime(2024, 1, 1)
    rows = [(1, "d", "a", 0.1, 1.0, True), (2, "d", "a", 1.5, None, True), (3, "d", "b", 0.7, 1.0, False), (4, "d", "c", 2.0, 1.0, True), (5, "d", None, 0.2, 1.0, None), (7, "d", "f", float("inf"), 1.0, True), (8, "z", "a", 0.0, 1.0, True)]
    gaze = spark.createDataFrame([(i, d, e, t, x, x, v, at) for i, d, e, t, x, v in rows] + [(6, "d", "a", 9.0, 1.0, 1.0, False, at), (6, "d", "a", 1.1, 1.0, 1.0, False, at + dt.timedelta(1))], "sample_id long, dataset string, episode_id string, t_s double, x double, y double, valid boolean, arrived_at timestamp")
    episode = spark.createDataFrame([("d", "a", 1.0), ("d", "a", 1.0), ("d", "b", 1.25), ("d", "c", 0.5), ("d", "e", 0.6), ("d", "f", -1.0), ("d", "g", float("nan"))], "dataset string, episode_id string, duration_s double")
    rates = spark.createDataFrame([("d", 2.0)], "dataset string, hz double")
    newest = grid.newest_samples(gaze, ("x", "y"))
    ends = grid.ends(episode, newest, rates, SRC)
    occupied = grid.slots(newest.filter("ok"), rates, SRC, ("x", "y"), shard=2)
    out = grid.fill(occupied, SRC, ("x", "y"), spark.createDataFrame([("d", 0.5)], "dataset string, max_gap_s double"), shard=2, until=ends)
    got = sorted(((r.episode_id or "", r.slot, r.state, r.x, r.valid) for r in out.collect()), key=str)
    miss = lambda e, ks: [(e, k, "missing", None, False) for k in ks]
    want = [("a", 0, "sample", 1.0, True), *miss("a", (1, 2, 3)), *miss("b", (0, 1, 2)), *[("c", k, "before", None, False) for k in range(4)], ("c", 4, "sample", 1.0, True), *miss("e", (0, 1)), *miss("f", (0,)), *miss("g", (0,)), *miss("", (0,))]
    assert got == sorted(want, key=str)


def test_p3_tables_point_to_their_parents_and_carry_all_fields(spark, tmp_path):
    docs = [
        (1, "ego-exo4d", {"annotations": {"t": [{"rejected": True, "annotator_id": "a"}, {"descriptions": [{"text": "x", "unsure": False, "revisions": [{"by": "r", "k": 1}]}]}], "u": None}}),
        (2, "egome", {"annotations": {"v": {"fine": [{"label": 3, "attributes": {"Noun": "cup", "a/b": [1]}}], "coarse": [], "subject": "s"}}}),
        (3, "holoassist", [{"video_name": "w", "task_name": "n", "events": [{"id": 0}]}]),
    ]
    at = dt.datetime(2024, 1, 1)
    spark.createDataFrame([(i, d, json.dumps(p), at) for i, d, p in docs], "raw_id long, dataset string, payload string, arrived_at timestamp").write.parquet(f"{tmp_path}/raw_annotation.parquet")
    paths = [("ego-exo4d", "annotations.{take_uid}"), ("egome", "annotations.{episode}"), ("holoassist", "[video_name].events")]
    spark.createDataFrame(paths, "dataset string, select_path string").write.parquet(f"{tmp_path}/recipe.parquet")
    rows = {n: problems.QUERIES[n](spark, str(tmp_path)).collect() for n in ("p3_takes", "p3_groups", "p3_items", "p3_revisions")}
    ids = {n: {r.row_id for r in t} for n, t in rows.items()}
    assert all(len(ids[n]) == len(t) for n, t in rows.items())
    for child, parent in (("p3_groups", "p3_takes"), ("p3_items", "p3_groups"), ("p3_revisions", "p3_items")):
        assert rows[child] and {r.parent_id for r in rows[child]} <= ids[parent]
    got = {n: {(r.take_key, r.group_key if n != "p3_takes" else None): dict(x.split("=", 1) for x in r.fields.split("\n") if x) for r in t} for n, t in rows.items()}
    assert got["p3_takes"] == {("t", None): {}, ("u", None): {"": "null"}, ("v", None): {"subject": '"s"', "coarse": "[]"}, ("w", None): {"task_name": '"n"', "video_name": '"w"'}}
    assert got["p3_groups"] == {("t", "0"): {"rejected": "true", "annotator_id": '"a"'}, ("t", "1"): {}, ("v", "fine"): {}, ("w", "events"): {}}
    assert got["p3_items"] == {("t", "1"): {"text": '"x"', "unsure": "false"}, ("v", "fine"): {"label": "3", "attributes/Noun": '"cup"', "attributes/a~1b": "[1]"}, ("w", "events"): {"id": "0"}}
    assert got["p3_revisions"] == {("t", "1"): {"by": '"r"', "k": "1"}}


def test_canonical_tables_label_segments_between_whole_seconds(spark, tmp_path):
    at = dt.datetime(2024, 1, 1)
    spark.createDataFrame([(1, "d", "e", 0.1, 0.5, 0.5, True, at), (2, "d", "e", 1.9, 0.5, 0.5, True, at)], "sample_id long, dataset string, episode_id string, t_s double, x double, y double, valid boolean, arrived_at timestamp").write.parquet(f"{tmp_path}/gaze_sample.parquet")
    spark.createDataFrame([(1, "d", "e", 1.2, 1.6, "c", "t")], "segment_id long, dataset string, episode_id string, start_s double, end_s double, channel string, text string").write.parquet(f"{tmp_path}/segment.parquet")
    (r,) = q_pipelines.canonical_tables(spark, str(tmp_path)).collect()
    assert (r.instants, r.with_gaze, r.labelled) == (20, 19, 4)


def test_nested_unwraps_to_the_end_and_takes_the_last_of_equal_keys(spark):
    deep = '{"a":1}'
    for _ in range(12):
        deep = json.dumps(deep)
    df = spark.createDataFrame([(1, deep), (2, '{"a": 2, "b": {"c": 1, "c": 3}, "a": 4}')], "raw_id long, payload string")
    got = {r.raw_id: json.loads(r.j) for r in nested.parse(df, "payload").selectExpr("raw_id", "to_json(doc) j").collect()}
    assert got == {1: {"a": 1}, 2: {"a": 4, "b": {"c": 3}}}
