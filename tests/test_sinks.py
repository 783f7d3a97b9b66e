"""Sinks, projection, region filter, large files, command line."""

import hashlib
import json
import struct

import pytest
from pyspark.sql import functions as F

from trackspark import __main__, api
from trackspark.operators import asof, intervals
from trackspark.plans import classify, clips, project, rectify, splits
from trackspark.sources import catalog, sinks, tables, tracks
from trackspark.streaming.operators import watch


def test_shards_resume_and_manifest(spark, tmp_path):
    rows = lambda *e: spark.createDataFrame([("d", x, f"d:{x}#{k}", [k, 1]) for x in e for k in range(2)], "dataset string, episode_id string, id string, points array<long>")
    eps = spark.createDataFrame([("d", "1"), ("d", "2"), ("d", "3")], "dataset string, episode_id string")
    root = str(tmp_path / "out")
    assert sinks.pending(eps, root, ["dataset", "episode_id"]).count() == 3
    api.write_clips(rows("1", "2"), root, ["dataset", "episode_id"])
    assert [r.episode_id for r in sinks.pending(eps, root, ["dataset", "episode_id"]).collect()] == ["3"]
    whole = api.write_clips(rows("2", "3"), root, ["dataset", "episode_id"])
    assert whole.count() == 6 and json.loads((tmp_path / "out" / "report.json").read_text()) == {"clips": 6}
    flat = spark.read.parquet(f"{root}/manifest_flat")
    assert set(flat.columns) == {"dataset", "episode_id", "id", "n_points"} and flat.filter("n_points = 2").count() == 6
    (tmp_path / "out" / "_shards" / "dataset=d" / "episode_id=1" / "cut.json").write_text("{broken\n")
    assert sinks.read_shards(spark, root, rows("1").schema).filter("id IS NOT NULL").count() == 6


def test_split_index_and_join_counts(spark, tmp_path):
    m = spark.createDataFrame([(f"d:{i}", "d", f"v/{i}.mp4") for i in range(10)], "id string, dataset string, video string")
    s = splits.stratified(m, "id", "dataset", [("train", 0.8), ("val", 0.2)], 1)
    index = sinks.write_splits(s, str(tmp_path), "a", [("train", 0.8), ("val", 0.2)], 1, m, "m.jsonl")
    read = json.loads((tmp_path / "a" / "split_index.json").read_text())
    assert read == index and read["counts"] == {"train": {"total": 8, "by_dataset": {"d": 8}}, "val": {"total": 2, "by_dataset": {"d": 2}}}
    assert sinks.manifest_digest(m) == sinks.manifest_digest(m.orderBy(F.desc("id"))) != sinks.manifest_digest(m.limit(9))
    (tmp_path / "x.jsonl").write_text("".join(json.dumps(r) + "\n" for r in [{"id": "d:1", "dataset": "d", "video": "c/1.mp4"}, {"id": "e:1", "video": "/abs/2.mp4"}, {"id": "d:2", "error": "bad"}, {"dataset": "d"}, {"id": "f:1", "dataset": "f"}]) + "{no\n")
    (tmp_path / "y.jsonl").write_text(json.dumps({"id": "d:1", "dataset": "d", "video": "late"}) + "\n")
    got = api.join_manifests(spark, [(str(tmp_path / "x.jsonl"), ["d", "e"]), (str(tmp_path / "y.jsonl"), None)], str(tmp_path / "z")).orderBy("source_ord").collect()
    assert [tuple(r) for r in got][1] == (1, 1, 0, 0, 0, 1, 0)
    assert (got[0].errors, got[0].other_dataset, got[0].kept) == (1, 1, 2)
    assert sorted(r.video for r in spark.read.json(str(tmp_path / "z")).collect()) == ["videos/2.mp4", "videos/d/1.mp4"]
    one = spark.range(1)
    assert one.select(splits.absolute_video(F.lit("a/b"), "/r/"), splits.absolute_video(F.lit("s3://b/k"), "/r")).first()[:] == ("/r/a/b", "s3://b/k")


def test_projection(spark):
    track = "dataset string, episode_id string, ord long, t_s double, valid boolean, ch map<string,double>"
    t = spark.createDataFrame([("d", "e", 0, 0.0, True, {"x": 100.0, "y": 50.0}), ("d", "e", 1, 1.0, True, {"x": 9999.0, "y": 50.0}), ("d", "none", 0, 0.0, True, {"x": 1.0, "y": 1.0})], track)
    films = spark.createDataFrame([("d", "e", 200, 100)], "dataset string, episode_id string, width long, height long")
    got = {(r.episode_id, r.ord): (r.px, r.py, r.in_frame) for r in project.project(t, films, "already_2d", dims=(400, 200)).collect()}
    assert got[("e", 0)] == (50.0, 25.0, True) and got[("e", 1)][2] is False and got[("none", 0)] == (None, None, False)
    eye = [float(v) for v in (1, 0, 0, 0, 0, 1, 0, 0, 0, 0, 1, 0, 0, 0, 0, 1)]
    ray = {"px": 0.0, "py": 0.0, "pz": 0.0, "vx": 1.0, "vy": 0.5, "vz": 0.25}
    rays = spark.createDataFrame([("d", "e", 0, 0.0, True, ray), ("d", "e", 1, 5.0, True, ray), ("d", "e", 2, 0.1, True, {**ray, "vx": -1.0})], track)
    poses = spark.createDataFrame([("d", "e", 0, 0.05, eye)], "dataset string, episode_id string, ord long, t_s double, m array<double>")
    cams = spark.createDataFrame([("d", "e", 100.0, 100.0, 100.0, 50.0, 400, 200)], "dataset string, episode_id string, fx double, fy double, cx double, cy double, width long, height long")
    p = project.project(rays, films, "psi_pinhole_ray", poses=poses, cameras=cams, tolerance_s=0.2)
    assert {r.ord: (r.px, r.py) for r in p.collect()} == {0: (25.0, 12.5), 1: (None, None), 2: (None, None)}
    r = project.agreement(p, p.withColumn("px", F.col("px") + 3).withColumn("py", F.col("py") + 4)).first()
    assert (r.samples, r.most, r.mean) == (1, 5.0, 5.0)
    with pytest.raises(ValueError):
        project.project(t, films, "projectaria_cpf")


def test_region_filter_and_gap_cull(spark):
    spans = spark.createDataFrame([("e", 1, "coarse", 0, 100), ("e", 2, "fine", 10, 20), ("e", 3, "fine", 50, 60), ("f", 4, "fine", 0, 9), ("g", 5, "fine", 0, 9), ("h", 6, "fine", 0, 10)], "ep string, ord long, channel string, s long, e long")
    regions = spark.createDataFrame([("e", "coarse", 0, 100, True), ("e", "fine", 12, 13, True), ("f", None, 5, 6, True), ("g", None, 0, 9, False), ("h", None, 10, 12, True)], "ep string, channel string, r_s long, r_e long, interesting boolean")
    assert sorted(r.ord for r in intervals.in_regions(spans, regions, ["ep"], "ord", 30).collect()) == [1, 2, 4]
    track = spark.createDataFrame([("e", 0, 0), ("e", 1, 10), ("f", 0, 0), ("f", 1, 900)], "ep string, ord long, us long")
    spec = clips.ClipSpec(order=("coarse", "fine"))
    assert sorted(r.ord for r in clips.kept(spans, track, ["ep"], spec, widest_us=100, regions=regions).collect()) == [1, 2]


def test_flags_and_points_between_neighbours(spark):
    probes = spark.createDataFrame([("a", t) for t in (0, 5, 10, 15, 40)], "k string, t long")
    reads = spark.createDataFrame([("a", 0, 0, False), ("a", 1, 10, True), ("a", 2, 20, False)], "k string, ord long, t long, ok boolean")
    f = asof.bracket(probes, reads, ["k"], "t", ["ok"], 7)
    assert {r.t: r.v for r in f.select("t", asof.either("ok", "t").alias("v")).collect()} == {0: False, 5: True, 10: True, 15: True, 40: False}
    assert {r.t: r.v for r in f.select("t", asof.either("ok", "t", 5).alias("v")).collect()} == {0: False, 5: False, 10: True, 15: False, 40: False}
    again = spark.createDataFrame([("a", 3, 10, False), ("a", 1, 10, True)], "k string, ord long, t long, ok boolean")
    assert asof.bracket(probes.filter("t = 10"), again, ["k"], "t", ["ok"], 7).first().prev.ord == 1
    grid = spark.createDataFrame([("d", "e", k, k * 1.0) for k in range(3)], "dataset string, episode_id string, frame_index long, time_s double")
    pts = spark.createDataFrame([("d", "e", 0, 0.4, "x", "X"), ("d", "e", 1, 1.6, "y", "Y")], "dataset string, episode_id string, ord long, time_s double, label string, text string")
    assert [r.labels for r in rectify.label_nearest(grid, pts).orderBy("frame_index").collect()] == ["x", "x", "y"]


def test_cut_off_answers_are_asked_again_in_half(spark):
    spans = spark.createDataFrame([("e", i, i * 1.0, i + 1.0, "fine", f"t{i}") for i in range(10)], "ep string, i long, start_s double, end_s double, channel string, text string")
    found = classify.verdicts(spark.createDataFrame([("e", '[{"i": 0, "interesting": true}, {"i": 1, "interesting": false}, {"i": 2, "inter')], "ep string, answer string"), ["ep"])
    again = classify.prompts_again(spans, found, ["ep"], "rubric", 10).orderBy("chunk").collect()
    assert len(again) == 2 and again[0].prompt.count("\n") == 3 and again[1].prompt.count("\n") == 5


def test_films_and_texts_larger_than_a_cell(spark, tmp_path):
    def box(kind, body):
        return struct.pack(">I4s", 8 + len(body), kind) + body

    tkhd = box(b"tkhd", bytes(76) + struct.pack(">II", 1408 << 16, 1200 << 16))
    stts = box(b"stts", struct.pack(">IIIIII", 0, 2, 7, 1, 3, 2))
    mdia = box(b"mdia", box(b"hdlr", bytes(8) + b"vide" + bytes(4)) + box(b"minf", box(b"stbl", stts)))
    moov = box(b"moov", box(b"mvhd", struct.pack(">IIIII", 0, 0, 0, 1000, 12345)) + box(b"trak", tkhd + mdia))
    big = 3 * 2**30
    with (tmp_path / "film.mp4").open("wb") as f:
        f.write(box(b"ftyp", bytes(8)) + struct.pack(">I4sQ", 1, b"mdat", big))
        f.seek(16 + big)
        f.write(moov)
    (tmp_path / "none.mp4").write_bytes(b"nothing")
    got = {r.path.rsplit("/")[-1]: (r.duration_s, r.width, r.height, r.frames) for r in catalog.video_headers(spark, str(tmp_path / "*.mp4")).collect()}
    assert got == {"film.mp4": (12.345, 1408, 1200, 10), "none.mp4": (None, None, None, None)}
    n = 1_000_000
    (tmp_path / "g.txt").write_text("# head\n" + "".join(f"{k} {k % 7}\n" for k in range(n)))
    t = tracks.read_track(spark, "whitespace_txt", str(tmp_path / "g.txt"), tracks.TrackSpec({"x": 1}, 0))
    r = t.agg(F.count("*").alias("n"), F.count_if(F.col("ord") != F.col("t_s")).alias("off"), F.sum("ch.x").alias("x")).first()
    assert (r.n, r.off, r.x) == (n, 0, sum(k % 7 for k in range(n)))


def test_profiles_and_catalogues(spark, tmp_path):
    (tmp_path / "g.csv").write_text("x_norm,y_norm,n,flag,e\n" + "".join(f"0.{k},0.5,{k},true,\n" for k in range(1, 6)))
    r = catalog.table_profile(spark, str(tmp_path / "g.csv"), 3).first()
    assert r.rows == 5 and r.gaze == "normalized_2d" and r.annotation is None and json.loads(r.last)["n"] == "3"
    assert dict(tables.read_table(spark, str(tmp_path / "g.csv")).dtypes) == {"x_norm": "double", "y_norm": "double", "n": "bigint", "flag": "boolean", "e": "string"}
    for name, text in (("o", '{"b": 1, "a": [2]}'), ("l", '[{"k": 1}, 3, {"j": 2}]'), ("v", "3"), ("x", "{no")):
        (tmp_path / f"{name}.json").write_text(text)
    got = {r.path[-6]: (r.kind, r.size, r["keys"]) for r in catalog.json_profile(spark, str(tmp_path / "*.json")).collect()}
    assert got["o"] == ("object", 2, ["a", "b"]) and got["l"] == ("list", 3, ["j", "k"]) and got["v"][0] == "value" and got["x"][0] == "unreadable"
    (tmp_path / "p.json").write_text(json.dumps({"sequences": {"s1": {"mps_eye_gaze": {"filename": "g.zip", "download_url": "https://h/g.zip?q=1", "file_size_bytes": 5, "sha1sum": "AB", "cdn": True}, "odd": 3}}}))
    a = catalog.provider_catalog(spark, str(tmp_path / "p.json"), "aea").collect()
    assert [(r.sequence_id, r.asset_key, r.modality, r.filename, r.size_bytes, r.sha1, r.extra) for r in a] == [("s1", "mps_eye_gaze", "gaze", "g.zip", 5, "ab", {"cdn": "true"})]
    assert [r.filename for r in catalog.listed_catalog(spark, "d", {"video": ["https://h/a.mp4?x"]}).collect()] == ["a.mp4"]
    (tmp_path / "c.jsonl").write_text('{"a": 1}\n{bad\n{"a": 2}\n')
    assert catalog.calibration_lines(spark, str(tmp_path / "c.jsonl")).count() == 2


def test_watch_reads_digests_before_it_is_content(spark, tmp_path):
    (tmp_path / "w").mkdir()
    (tmp_path / "w" / "a.bin").write_bytes(b"good")
    want = lambda body: spark.createDataFrame([("a.bin", 4, hashlib.sha1(body).hexdigest())], "path string, size_bytes long, sha1 string")
    how = {"stable": 1, "every_s": 1.0, "timeout_s": 0.5, "sleep": lambda s: None}
    assert watch(spark, str(tmp_path / "w"), want(b"good"), **how) is True
    assert watch(spark, str(tmp_path / "w"), want(b"evil"), **how) is False


def test_command_line(spark, tmp_path, capsys):
    m = tmp_path / "m.jsonl"
    m.write_text("".join(json.dumps({"id": f"d:{i}", "dataset": "d", "video": "v", "error": None}) + "\n" for i in range(10)))
    assert __main__.main(["doctor"]) == 0 and "spark" in capsys.readouterr().out
    tables.write_table(spark.read.json(str(m)).withColumn("error", F.lit(None).cast("string")), str(tmp_path / "m.parquet"))
    assert __main__.main(["--json", "make-splits", str(tmp_path / "m.parquet"), str(tmp_path / "s"), "train=0.8,val=0.2"]) == 0
    assert '"clips":8' in capsys.readouterr().out
