"""The user's commands end to end on small folders."""

import json

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from trackspark import api, config, recipe
from trackspark.plans import extract
from trackspark.sources import catalog, discovery


def _recipe(dataset, gaze, channels, sync=("as_is", "as_is"), **more):
    form = {"reader": "csv", "columns": {"x": "x", "y": "y"}, "time": {"source": "t", "units": "s"}, **gaze.pop("form", {})}
    return recipe.compile_recipe({"dataset": dataset, "gaze": {"select": gaze, "gaze_format": form}, "annotations": channels, "epoch_sync": {"gaze": {"transform": sync[0]}, "annotations": {"transform": sync[1]}}, **more})


def _episodes(spark, dataset, *rows):
    return spark.createDataFrame([(dataset, *r) for r in rows], "dataset string, episode_id string, duration_s double, tokens map<string,string>")


def _segs(out):
    return sorted((r.episode_id, r.channel, round(r.start_s, 6) if r.start_s is not None else None, round(r.end_s, 6) if r.end_s is not None else None, r.point_s, r.text) for r in out["segment"].collect())


def test_extract_by_recipe(spark, tmp_path):
    for ep, t0 in (("e1", 100.0), ("skip9", 5.0)):
        d = tmp_path / "set" / ep
        d.mkdir(parents=True)
        (d / "general.csv").write_text("t,x,y,ok,note\n" + "".join(f'{t0 + k * 0.1},{k},1,{int(k != 1)},"a,b"\n' for k in range(3)))
        (d / "text.csv").write_text('start,end,verb,noun\n100.05,100.25,open,"door, left"\n')
    (tmp_path / "set" / "e1" / "personal.csv").write_text("x,t,y,ok\n" + "".join(f"{k + 50},{100 + k * 0.1},1,{int(k != 1)}\n" for k in range(3)))
    gaze = {"path_template": "set/{episode_id}/", "prefer": ["personal.csv", "general.csv"], "form": {"validity": {"column": "ok", "valid_when": "==1"}}}
    text = {"name": "fine", "select": {"path_template": "set/{episode_id}/", "glob": "set/{episode_id}/*ext.csv"}, "time": {"start": "start", "end": "end"}, "text": {"compose": ["verb", "noun"]}, "join": {"by": "stem"}}
    r = _recipe("d", gaze, [text], ("subtract_first_gaze", "subtract_first_gaze"), dataset_filters={"exclude_episode_globs": ["skip*"]})
    eps = _episodes(spark, "d", ("e1", 3.0, None), ("e2", 1.0, None), ("e3", None, None), ("skip9", 2.0, None))
    out = api.run_extract(spark, r, str(tmp_path), eps)
    assert [(x.episode_id, round(x.t_s, 6), x.valid, x.ch["x"]) for x in out["track"].orderBy("ord").collect()] == [("e1", 0.0, True, 50.0), ("e1", 0.1, False, 51.0), ("e1", 0.2, True, 52.0)]
    assert _segs(out) == [("e1", "fine", 0.05, 0.25, None, "open door, left")]
    assert {x.episode_id: x.reason for x in out["episode"].collect()} == {"e1": "", "e2": "no samples; no segments", "e3": "no duration; no samples; no segments"}
    wide = _recipe("d", {**gaze, "form": {"validity": {"column": "ok", "valid_when": "==1"}}}, [text], dataset_filters={"max_gaze_valid_gap_s": 0.15})
    assert {x.episode_id: x.reason for x in api.run_extract(spark, wide, str(tmp_path), eps)["episode"].collect()}["e1"] == "gap between valid samples"
    culled = _recipe("d", {**gaze, "form": {}}, [text], dataset_filters={"cull": True})
    assert [t.count() for t in api.run_extract(spark, culled, str(tmp_path), eps).values()] == [0, 0, 0]


def test_extract_keyed_json(spark, tmp_path):
    (tmp_path / "g").mkdir()
    (tmp_path / "g" / "t1.csv").write_text("t,x,y\n1,2,3\n")
    atomic = {"annotations": {"u1": [{"rejected": False, "descriptions": [{"text": "a", "timestamp": 1.5, "rejected": 9}, 3]}, {"rejected": True, "descriptions": [{"text": "no", "timestamp": 2}]}], "u.2": []}}
    expert = {"annotations": {"u1": [{"task_name": "cook", "commentary_data": [{"text": "e", "video_time": 2, "duration_approx": 1.5, "error": False}, {"text": "bad", "video_time": 2, "error": True}]}]}}
    events = [{"video_name": "t1", "events": [{"label": "Fine", "start": 1, "end": 2, "attributes": {"Verb": "open", "Noun": "door"}}, {"label": "Other", "start": 1, "end": 2}]}, {"video_name": "t9", "events": []}]
    levels = {"annotations": {"t1_ego.mp4": {"Coarse-level": "A: tea", "Fine-level": [{"Step timestamp": [0.5, 1], "Step text": "B:pour"}]}}}
    for name, doc in (("a", atomic), ("x", expert), ("e", events), ("l", levels)):
        (tmp_path / f"{name}.json").write_text(json.dumps(doc))
    keyed = lambda f, path, **j: {"select": {"path_template": f"{f}.json"}, "reader": "json_by_key", "join": {"by": "key", "select_path": path, **j}}
    channels = [
        {"name": "atomic", "kind": "point", "time": {"point": "timestamp"}, "filter": {"drop_where": "rejected==true"}, **keyed("a", "annotations.{take_uid}", key_field="take_uid")},
        {"name": "expert", "time": {"start": "video_time", "end_from": "start+duration_approx"}, "filter": {"drop_where": "error==true"}, "extras": ["task_name"], **keyed("x", "annotations.{take_uid}", key_field="take_uid")},
        {"name": "fine", "time": {"start": "start", "end": "end"}, "text": {"compose": ["attributes.Verb", "attributes.Adjective", "attributes.Noun"]}, "filter": {"keep_where": "label=='Fine'"}, **keyed("e", "[video_name].events[label=='Fine']", key_field="video_name")},
        {"name": "coarse", "time": {"whole_episode": True}, "text": {"primary": "Coarse-level", "strip_prefix_regex": "^[A-Z]:"}, **keyed("l", "annotations.{episode_id}_ego.mp4", key_in_file="{episode_id}_ego.mp4")},
        {"name": "step", "time": {"start": "Step timestamp.0", "end": "Step timestamp.1"}, "text": {"primary": "Step text"}, **keyed("l", "annotations.{episode_id}_ego.mp4.Fine-level", key_in_file="{episode_id}_ego.mp4")},
        {"name": "off", "clip_role": "disabled", "time": {"start": "s"}, **keyed("none", "annotations.{take_uid}")},
        {"name": "gone", "time": {"start": "s"}, **keyed("none", "annotations.{take_uid}")},
    ]
    r = _recipe("d", {"path_template": "g/{take_name}.csv"}, channels)
    out = api.run_extract(spark, r, str(tmp_path), _episodes(spark, "d", ("t1", 9.0, {"take_uid": "u1"}), ("t2", 1.0, None)))
    assert _segs(out) == [("t1", "atomic", None, None, 1.5, "a"), ("t1", "coarse", 0.0, 9.0, None, "tea"), ("t1", "expert", 2.0, 3.5, None, "e"), ("t1", "fine", 1.0, 2.0, None, "open door"), ("t1", "step", 0.5, 1.0, None, "B:pour")]
    assert [r.extras["task_name"] for r in out["segment"].filter("channel = 'expert'").collect()] == ["cook"]


def test_extract_sessions_pickles_and_arrays(spark, tmp_path):
    (tmp_path / "s").mkdir()
    head = "## Version: BeGaze 3.1\nTime\tType\tF\tX\n"
    (tmp_path / "s" / "OP1.txt").write_text(head + "".join(f"{k}\tSMP\t{k}\t{k * 10}\n" for k in range(60)))
    head = "## Version: BeGaze 3.4\nTime\tX\n"
    (tmp_path / "s" / "OP2.txt").write_text(head + "".join(f"{1_000_000 + k * 41_667}\t{k * 10}\n" for k in range(60)))
    (tmp_path / "labels.csv").write_text("Clip Prefix;Starting Time (ms);Ending Time (ms);Action Label\nOP1-1000-2000;1000;2000;cut\nOP2-500-900;500;700;mix\n")
    ids = ("OP1-1000-2000-F24-F26", "OP2-500-900-F12-F13", "OP1-0-9-F59-F70")
    form = {"reader": "begaze_txt", "columns": {"x": 3}, "time": {"source": 2, "units": "frame_index", "fps": 24}, "variants": [{"match": "## Version: BeGaze 3.4", "reader": "begaze_txt", "columns": {"x": 1}, "time": {"source": 0, "units": "us_to_frame", "fps": 24}}]}
    label = {"name": "action", "select": {"path_template": "labels.csv"}, "time": {"start": "Starting Time (ms)", "end": "Ending Time (ms)", "units": "ms"}, "text": {"primary": "Action Label"}, "join": {"by": "row_field", "key_field": "Clip Prefix"}}
    r = _recipe("d", {"path_template": "s/{session}.txt", "form": form}, [label], ("as_is", "subtract_clip_start"))
    out = api.run_extract(spark, r, str(tmp_path), _episodes(spark, "d", *[(i, 2.0, {"session": i[:3]}) for i in ids]))
    got = sorted((x.episode_id, x.ord, round(x.t_s * 24, 6), x.ch["x"]) for x in out["track"].collect())
    assert got == [(ids[2], 0, 0.0, 590.0), (ids[0], 0, 0.0, 240.0), (ids[0], 1, 1.0, 250.0), (ids[0], 2, 2.0, 260.0), (ids[1], 0, 0.0, 120.0), (ids[1], 1, 1.0, 130.0)]
    assert _segs(out) == [(ids[0], "action", 0.0, 1.0, None, "cut"), (ids[1], "action", 0.0, 0.2, None, "mix")]

    (tmp_path / "n").mkdir()
    np.save(tmp_path / "n" / "v1.npy", np.array([[0.1, 0.2, 1], [0.5, 0.5, 0]], dtype=np.float32))
    pd.DataFrame({"unique_narration_id": ["a", "b"], "video_id": ["v1", "v1"], "narration": ["one", "two"], "start_timestamp": [0.5, 1.0], "end_timestamp": [1.0, np.nan], "pairs": [[("x", "y")], []]}).to_pickle(tmp_path / "n.pkl")
    (tmp_path / "bad.csv").write_text("erratum_narration_id\nb\n")
    form = {"reader": "npy", "columns": {"x": 0, "y": 1}, "time": {"source": "frame_index", "units": "frame_index", "fps": 30}, "validity": {"column": 2, "valid_when": "==1"}}
    pick = {"name": "narration", "reader": "pandas_pickle", "select": {"path_template": "n.pkl"}, "time": {"start": "start_timestamp", "end": "end_timestamp"}, "text": {"primary": "narration"}, "extras": ["pairs"], "join": {"by": "row_field", "key_field": "video_id"}, "filter": {"denylist_file": "bad.csv", "denylist_field": "erratum_narration_id"}}
    out = api.run_extract(spark, _recipe("d", {"path_template": "n/{video_uid}.npy", "form": form}, [pick]), str(tmp_path), _episodes(spark, "d", ("v1", 1.0, None)))
    assert [(x.valid, round(x.t_s, 6)) for x in out["track"].orderBy("ord").collect()] == [(True, 0.0), (False, 0.033333)]
    assert _segs(out) == [("v1", "narration", 0.5, 1.0, None, "one")] and out["segment"].first().extras["pairs"] == '[["x","y"]]'


def test_episodes_and_files_of_a_recipe(spark, tmp_path):
    for p, n in (("P1", "P1-1.mp4"), ("P2", "P2-7.mp4")):
        (tmp_path / "v" / p).mkdir(parents=True)
        (tmp_path / "v" / p / n).write_text("x")
    (tmp_path / "v" / "P2" / "big_P2-7.bin").write_text("xxxx")
    got = discovery.list_episodes(spark, "d", str(tmp_path), {"enumerate": "video_glob", "glob": "v/P*/*.mp4", "id_from": {"rule": "filename_stem", "strip_suffix": ".mp4"}}).orderBy("episode_id").collect()
    assert [(r.episode_id, r.tokens["participant"]) for r in got] == [("P1-1", "P1"), ("P2-7", "P2")]
    got = discovery.list_episodes(spark, "d", str(tmp_path), {"enumerate": "take_dir", "glob": "v/*", "id_from": {"rule": "path_component", "level": -1}}).collect()
    assert {r.episode_id for r in got} == {"P1", "P2"}
    assert discovery.list_episodes(spark, "d", str(tmp_path), {"glob": "none/*"}).count() == 0
    pick = lambda how, **k: {r.tokens["participant"]: r.path.rsplit("/", 1)[-1] for r in discovery.chosen_files(spark, str(tmp_path), discovery.Select(glob="v/{participant}/*", pick=how, **k)).collect()}
    assert pick("single") == {"P1": "P1-1.mp4", "P2": "P2-7.mp4"}
    assert pick("largest") == {"P1": "P1-1.mp4", "P2": "big_P2-7.bin"}
    assert pick("invariant_suffix", suffix=".bin") == {"P1": "P1-1.mp4", "P2": "big_P2-7.bin"}
    e = _episodes(spark, "d", ("a", 10.0, None), ("b", 10.0, None)).drop("tokens")
    s = spark.createDataFrame([("d", "a", 12.0)], "dataset string, episode_id string, shipped_s double")
    got = {r.episode_id: (r.duration_s, r.warning) for r in extract.shipped_durations(e, s).collect()}
    assert got == {"a": (12.0, "shipped 12.0 s, probed 10.0 s"), "b": (10.0, None)}


def test_rectify_then_validate_and_mutate(spark, tmp_path):
    t = spark.createDataFrame([("d", "e", k, k * 0.1, 0.1 * k, 0.5) for k in range(5)], "dataset string, episode_id string, ord long, time_s double, x_norm double, y_norm double")
    s = spark.createDataFrame([("d", "e", 0, 0.0, 0.2, "a", "A")], "dataset string, episode_id string, ord long, start_s double, end_s double, label string, text string")
    cfg = config.load(overrides={"grid.hz": "10"})
    tables = api.run_rectify(t, s, None, str(tmp_path / "c"), cfg)
    rep = {r.name: r.ok for r in api.run_validate(spark, str(tmp_path / "c"), tables, cfg).collect()}
    assert rep == {"timeline": True, "gaze": True, "annotations": True, "all": True}
    bad = {**tables, "gaze": tables["gaze"].withColumn("x_norm", F.when(F.col("frame_index") == 2, 0.9).otherwise(F.col("x_norm")))}
    rep = {r.name: (r.ok, r.differences) for r in api.run_validate(spark, str(tmp_path / "c"), bad, cfg).collect()}
    assert rep["gaze"] == (False, 1) and rep["all"][0] is False and rep["timeline"][0] is True


def test_discovery(spark, tmp_path):
    a = tmp_path / "raw" / "ds" / "ep1"
    a.mkdir(parents=True)
    (a / "episode.json").write_text(json.dumps({"duration_s": 0.4, "files": {"gaze": "g.csv"}}))
    (a / "gaze.csv").write_text("x")
    (a / "gaze.json").write_text("{}")
    docs = discovery.episode_documents(spark, str(tmp_path / "raw"))
    got = docs.collect()
    assert [(r.dataset, r.episode_id, r.duration_s, r.files) for r in got] == [("ds", "ep1", 0.4, {"gaze": "g.csv"})]
    files = discovery.episode_files(catalog.listing(spark, str(tmp_path / "raw" / "ds")), "ds")
    assert files.first().files["gaze"] == "ep1/gaze.json"
    more = spark.createDataFrame([("ds", "ep1", {"gaze": "no"}), ("ds", "ep2", {"gaze": "yes"})], "dataset string, episode_id string, files map<string,string>")
    assert sorted((r.episode_id, r.files["gaze"]) for r in discovery.known_and_new(docs, more).collect()) == [("ep1", "g.csv"), ("ep2", "yes")]
    (tmp_path / "idx.json").write_text(json.dumps({"a-x1-b": "one", "x2": "two", "b-x1": "late", "y-x2": "no"}))
    ids = spark.createDataFrame([("x1",), ("x2",), ("x3",)], "id string")
    assert {r.id: r.target for r in discovery.index_lookup(spark, str(tmp_path / "idx.json"), ids, "id").collect()} == {"x1": "one", "x2": "two", "x3": None}
    assert spark.range(1).select(discovery.token(F.lit("file:/r/set/e7/g.csv"), "set/{episode}/g.csv", "episode")).first()[0] == "e7"


def test_downloads_splits_and_doctor(spark, tmp_path):
    assets = spark.createDataFrame([("Ego4D", "S1 ", "gaze", "g.csv"), ("other", "s1", "gaze", "h.csv"), ("ego-exo4d", "s2", "video", "v.mp4")], "dataset string, sequence_id string, modality string, filename string")
    got = api.plan_downloads(assets, ["EGO-Exo4D"], ["Gaze"], ["s1"]).collect()
    assert [r.filename for r in got] == ["g.csv"]
    m = spark.createDataFrame([(f"d:{i}", "d", "v", None) for i in range(10)] + [("d:0", "d", "v", None), ("d:99", "d", "v", "bad")], "id string, dataset string, video string, error string")
    s = api.make_splits(m, config.ratios("train=0.7,val=0.3"), 1, str(tmp_path / "s"))
    assert {r.split: r.clips for r in api.split_index(s).filter("dataset IS NOT NULL").collect()} == {"train": 7, "val": 3}
    assert spark.read.json(str(tmp_path / "s")).count() == 10
    eps = spark.createDataFrame([("d", f"e{i}", ["gaze", "video"] if i % 2 else ["video"]) for i in range(20)], "dataset string, episode_id string, modalities array<string>")
    e = api.episode_split(eps, [("a", 0.5), ("b", 0.5)], 1, modalities=["gaze"])
    assert {r.split: r.n for r in e.groupBy("split").agg(F.count(F.lit(1)).alias("n")).collect()} == {"a": 5, "b": 5}
    assert api.doctor(spark)["spark"] == spark.version
