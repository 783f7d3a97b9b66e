"""Expressions against hand-computed values."""

import pytest
from pyspark.sql import functions as F

from trackspark import config, recipe
from trackspark.functions import geometry as G
from trackspark.functions import text as T
from trackspark.functions import time as TM
from trackspark.functions.diff import close
from trackspark.functions.predicate import glob, literal, predicate, valid_when
from trackspark.sources import catalog


def _one(spark, *cols):
    return list(spark.range(1).select(*[c.alias(f"c{i}") for i, c in enumerate(cols)]).first())


def test_time_units(spark):
    got = _one(spark, TM.to_seconds(F.lit("1500"), "ms"), TM.to_seconds(F.lit(" 2e6 "), "us"), TM.to_seconds(F.lit("x"), "ms"), TM.to_seconds(F.lit(""), "s"), TM.to_seconds(F.lit("30"), "frame_index", 15), TM.hms(F.lit("01:02:03.5")), TM.hms(F.lit("02:03.5")), TM.hms(F.lit("a:b")), TM.timecode(F.lit("00:00:01:12"), 24), TM.to_seconds(F.lit("10000000"), "filetime_100ns"))
    assert got == [1.5, 2.0, None, None, 2.0, 3723.5, 123.5, None, 1.5, 1.0]
    got = _one(spark, TM.guess_seconds(F.lit("2000000"), "time"), TM.guess_seconds(F.lit("5"), "time_ms"), TM.guess_seconds(F.lit("3e12"), "t"), TM.guess_seconds(F.lit("12.5"), "t"), TM.frame_rate(F.lit("30000/1001")), TM.frame_rate(F.lit("1/0")), TM.frame_rate(F.lit("25")))
    assert got[:4] == [2000.0, 0.005, 3000.0, 12.5] and abs(got[4] - 29.97002997) < 1e-6 and got[5:] == [None, 25.0]
    assert _one(spark, TM.align(F.lit(5.0), "subtract_first_gaze", first=F.lit(2.0)), TM.align(F.lit(5.0), "subtract_clip_start", clip_start=F.lit(None).cast("double"))) == [3.0, None]
    for bad in (lambda: TM.to_seconds(F.lit("1"), "weeks"), lambda: TM.align(F.lit(1.0), "subtract_first_gaze"), lambda: TM.align(F.lit(1.0), "subtract_const"), lambda: TM.align(F.lit(1.0), "mp4_to_vrs_csv")):
        with pytest.raises(ValueError):
            bad()
    assert _one(spark, TM.guess_seconds(F.lit("2e12"), "time_ms"), TM.guess_seconds(F.lit("5"), "t_Nanoseconds")) == [2000.0, 5e-9]
    one = "OP01-R01-Salad-1500-2000-F36-F48"
    assert _one(spark, TM.clip_start(F.lit(one)), TM.clip_start(F.lit("x")), TM.frame_range(F.lit(one))["last"], TM.frame_range(F.lit("x"))) == [1.5, None, 48, None]


def test_predicates_are_two_valued(spark):
    rows = [("ego", True, 3.0, None, (1,), {"k": "v"}, [4, 5]), (None, None, None, "x", None, None, None), ("false", False, 0.0, "", (2,), {}, [])]
    df = spark.createDataFrame(rows, "view string, flag boolean, n double, extra string, s struct<a:int>, m map<string,string>, l array<int>")
    types = dict(df.dtypes)
    want = {"view == 'ego'": [1, 0, 0], "view != ego": [0, 1, 1], "flag == true": [1, 0, 0], "flag == false": [0, 1, 1], "view == true": [1, 0, 1], "n >= 0": [1, 0, 1], "n > abc": [0, 0, 0], "n == 3": [1, 0, 0], "s.a == 1": [1, 0, 0], "m.k == v": [1, 0, 0], "l.1 == 5": [1, 0, 0], "s.q == null": [1, 1, 1], "l == true": [1, 0, 0], "missing == none": [1, 1, 1], "missing != none": [0, 0, 0], "extra == null": [1, 0, 0], "": [1, 1, 1]}
    for p, expect in want.items():
        assert [int(r[0]) for r in df.select(predicate(p, types)).collect()] == expect, p
    assert [literal(x) for x in ("'a b'", "true", "null", "3", "2.5", "word")] == ["a b", True, None, 3, 2.5, "word"]
    assert _one(spark, valid_when(F.lit(1), "int", "==1"), valid_when(F.lit(None).cast("double"), "double", ">=0")) == [True, False]
    with pytest.raises(ValueError):
        predicate("nonsense", types)
    assert _one(spark, glob(F.lit("P12-x"), ["P1?-*"]), glob(F.lit("P1-x"), ["P1?-*"]), glob(F.lit("a.b"), ["a?b"]), glob(F.lit(None).cast("string"), ["*"])) == [True, False, True, False]


def test_text(spark):
    got = _one(spark, T.compose([F.lit("a"), F.lit(None), F.lit("none"), F.lit(""), F.lit("b")]), T.compose([F.lit("#C C opens")], strip_prefix=r"#\w+\s+"), T.safe_name(F.lit("a/b:c")), T.dataset_of(F.lit("x:y:z")), T.dataset_of(F.lit("plain")), T.url_basename(F.lit("https://h/p/f.mp4?x=1/2")), T.url_basename(F.lit("https://h/p/")), T.fill_template("{a}/{b}.x", {"a": F.lit("1"), "b": F.lit("2")}))
    assert got == ["a b", "C opens", "a__b_c", "x", "unknown", "f.mp4", "", "1/2.x"]
    nums = [["a"], ["a", "a"], [" ", None], ["a", "", "a", "b", "a"]]
    got = [r[0] for r in spark.createDataFrame([(n,) for n in nums], "t array<string>").select(T.numbered(F.col("t"))).collect()]
    assert got == ["a", "a", "", "1) a 2) b 3) a"]
    pts = spark.createDataFrame([([(0.0, 12.4, 3.5), (0.5, None, None)],)], "p array<struct<t:double,x:double,y:double>>")
    assert pts.select(T.answer(F.col("p"))).first()[0] == "t=0.0s: (12, 4); t=0.5s: (no gaze)"
    ch = lambda c: T.final_text("coarse_fine", F.lit(c), F.lit("pour"), F.lit("make tea"))
    assert _one(spark, ch("fine"), ch("coarse"), ch("other"), T.final_text("source_only", F.lit("fine"), F.lit("pour"), F.lit("x")), T.final_text("coarse_fine", F.lit("fine"), F.lit("pour"), F.lit(None).cast("string"))) == ["<context: make tea> <action: pour>", "<pour>", "pour", "pour", "<context: > <action: pour>"]


def test_geometry(spark):
    box = G.Letterbox(F.lit(896), F.lit(504), 378)
    px, py = box.padded(F.lit(448.0), F.lit(252.0))
    got = _one(spark, px, py, box.holds(F.lit(448.0), F.lit(252.0)), box.holds(F.lit(448.0), F.lit(-20.0)), G.to_bins(F.lit(0.0005)), G.to_bins(F.lit(0.0015)), G.to_bins(F.lit(7.0)), G.in_frame(F.lit(None).cast("double"), F.lit(1.0), F.lit(5), F.lit(5)))
    assert [round(v, 9) for v in got[:2]] == [189.0, 189.0] and got[2:] == [True, False, 0, 2, 1000, False]
    eye = F.array(*[F.lit(float(v)) for v in (1, 0, 0, 0, 0, 1, 0, 0, 0, 0, 1, 0, 0, 0, 0, 1)])
    x, y = G.pinhole(eye, [F.lit(float(v)) for v in (0, 0, 0, 1, 0, 0)], 100, 100, 50, 40)
    bx, _ = G.pinhole(eye, [F.lit(float(v)) for v in (0, 0, 0, -1, 0, 0)], 100, 100, 50, 40)
    lx, ly = G.pinhole(eye, [F.lit(float(v)) for v in (0, 0, 0, 1, 0.5, 0.25)], 100, 100, 50, 40)
    assert _one(spark, x, y, bx, lx, ly) == [50.0, 40.0, None, 0.0, 15.0]


def test_close_and_names(spark):
    nan, null = F.lit(float("nan")), F.lit(None).cast("double")
    assert _one(spark, close(nan, nan, 0.1), close(null, null, 0.1), close(null, F.lit(1.0), 0.1), close(F.lit(1.0), F.lit(1.05), 0.1), close(F.lit(1.0), nan, 0.1), close(F.lit("a"), F.lit("a"), None)) == [True, True, False, True, False, True]
    assert _one(spark, catalog.modality(F.lit("a/eye_track.csv")), catalog.modality(F.lit("x/notes.bin")), catalog.file_format(F.lit("A.MP4")), catalog.dataset_name(F.lit(" Ego_Exo 4D! ")), catalog.suffix(F.lit("a.csv.gz"))) == ["gaze", "other", "video", "ego_exo4d", "gz"]
    names = lambda *c: F.array(*[F.lit(x) for x in c])
    assert _one(spark, catalog.dataset_name(F.lit("EGTEA Gaze+")), catalog.dataset_name(F.lit("Ego4D")), catalog.suffix(F.lit("a.TAR.GZ")), catalog.modality(F.lit("a/take_point_cloud/x.csv")), catalog.modality(F.lit("q/film.vrs"))) == ["egtea", "ego-exo4d", "tgz", "depth", "video"]
    assert _one(spark, catalog.gaze_form(names("x_norm", "y_norm")), catalog.gaze_form(names("left_yaw")), catalog.gaze_form(names("q")), catalog.annotation_form(names("start_s")), catalog.annotation_form(names("verb")), catalog.annotation_form(names("q"))) == ["normalized_2d", "angular", None, "interval", "event_or_label", None]
    assert [catalog.asked_modality(m) for m in ("Text annotations", "Depth", "smell")] == ["annotation", "depth", "other"]


def test_config_and_recipe():
    cfg = config.load(overrides={"grid.hz": "5", "clips.fps": "3"})
    assert cfg.grid.hz == 5 and cfg.clips.fps == 3 and cfg.clips.side == 378
    for bad in ({"grid.hz": "0"}, {"grid.nope": "1"}, {"grid.hz": "true"}):
        with pytest.raises(ValueError):
            config.load(overrides=bad)
    assert config.ratios("train=0.8,val=0.2") == [("train", 0.8), ("val", 0.2)]
    assert config.partitions("part08..part11") == ["part08", "part09", "part10", "part11"] and config.partitions("a, b") == ["a", "b"]
    assert config.split_uri("s3://b/k/x") == ("b", "k/x") and config.mounted("s3://b/k", {"b": "/mnt/b"}) == "/mnt/b/k"
    with pytest.raises(ValueError):
        config.ratios("a=0")
    good = {"dataset": "d", "gaze": {"gaze_format": {"reader": "csv", "columns": {"x": "x"}, "time": {"source": "us", "units": "us"}}}, "annotations": [{"name": "fine", "time": {"start": "s", "end": "e"}}]}
    r = recipe.compile_recipe(good, {"annotation_bundle": {"policy": "holoassist_coarse_fine"}})
    assert r.final_text == "holoassist_coarse_fine" and r.drivers() == ["fine"] and r.track.units == "us"
    bad = {**good, "gaze": {"gaze_format": {"reader": "nope", "columns": {}, "time": {"units": "frame_index"}}}, "annotations": [{"name": "p", "kind": "point", "clip_role": "context"}, {"name": "p", "clip_role": "context"}], "epoch_sync": {"gaze": {"transform": "subtract_const"}}}
    found = recipe.problems(bad)
    for word in ("reader", "twice", "point", "fps", "no driver", "const_s", "time.start"):
        assert any(word in p for p in found), word
