"""Readers on small files."""

import io
import json
import struct
import zipfile

import numpy as np
import pandas as pd

from trackspark.sources import annotations as A
from trackspark.sources import catalog, tables, tracks


def test_tables_round_trip_and_missing(spark, tmp_path):
    df = spark.createDataFrame([(1, "a", [1, 2])], "id long, s string, v array<int>")
    for name in ("t.parquet", "t.jsonl"):
        tables.write_table(df, str(tmp_path / name))
        assert tables.read_table(spark, str(tmp_path / name), df.schema).collect() == df.collect()
    tables.write_table(df, str(tmp_path / "t.csv"))
    assert tables.read_table(spark, str(tmp_path / "t.csv")).first().v == "[1,2]"
    assert tables.read_table(spark, str(tmp_path / "none.parquet"), "id long").count() == 0
    cells = spark.createDataFrame([("true",), ("12",), ("1e3",), ("",), (" x",), (None,)], "c string")
    got = [tuple(r[0]) for r in cells.select(tables.coerce(cells["c"])).collect()]
    assert got == [(True, None, None, None), (None, 12, None, None), (None, None, 1000.0, None), (None,) * 4, (None, None, None, " x"), (None,) * 4]


def test_json_records_choose_the_longest_list(spark, tmp_path):
    (tmp_path / "a.json").write_text(json.dumps({"meta": {"x": 1}, "few": [{"a": 1}], "many": [{"a": 1}, 3, {"a": 2}]}))
    (tmp_path / "b.json").write_text(json.dumps([{"q": 1}, "no", {"q": 2}]))
    (tmp_path / "c.json").write_text(json.dumps({"only": 1}))
    (tmp_path / "d.json").write_text("{broken")
    got = {r.path[-6:]: r.n for r in tables.json_records(spark, str(tmp_path / "*.json")).groupBy("path").count().withColumnRenamed("count", "n").collect()}
    assert got == {"a.json": 2, "b.json": 2, "c.json": 1}


def test_track_readers(spark, tmp_path):
    (tmp_path / "g.csv").write_text("Frame,tracking_us, X ,y,ok\n0,1000000,1.5,2,1\n1,1100000,,2,0\n")
    got = tracks.read_track(spark, "csv", str(tmp_path / "g.csv"), tracks.TrackSpec({"x": "x", "y": "y"}, "tracking_us", "us", valid="ok")).orderBy("ord").collect()
    assert [(r.t_s, r.valid, r.ch["x"]) for r in got] == [(1.0, True, 1.5), (1.1, False, None)]
    (tmp_path / "g.txt").write_text("# head\n\n0.0\t1 2 3\n0.5  4 5 0\n")
    got = tracks.read_track(spark, "whitespace_txt", str(tmp_path / "g.txt"), tracks.TrackSpec({"x": 1}, 0, valid=-1, valid_when=">=1")).orderBy("ord").collect()
    assert [(r.ord, r.t_s, r.valid, r.ch["x"]) for r in got] == [(0, 0.0, True, 1.0), (1, 0.5, False, 4.0)]
    np.save(tmp_path / "g.npy", np.array([[0.1, 0.2, 1], [0.3, np.nan, 0], [0.5, 0.6, 1]], dtype=np.float32))
    got = tracks.read_track(spark, "npy", str(tmp_path / "g.npy"), tracks.TrackSpec({"x": 0, "y": 1}, fps=30, valid=2)).orderBy("ord").collect()
    assert [r.valid for r in got] == [True, False, True] and got[1].ch["y"] is None and abs(got[2].t_s - 2 / 30) < 1e-9
    lines = ["## export", "Time\tType\tX"] + [f"{1_000_000 + k * 41_667}\tSMP\t{k}" for k in range(6)]
    (tmp_path / "b.tsv").write_text("\n".join(lines))
    got = tracks.read_track(spark, "begaze_txt", str(tmp_path / "b.tsv"), tracks.TrackSpec({"x": -1}, 0, fps=24, frames=(2, 3))).orderBy("ord").collect()
    assert [(r.ord, r.ch["x"]) for r in got] == [(0, 2.0), (1, 3.0)] and abs(got[1].t_s - 1 / 24) < 1e-9
    (tmp_path / "p.txt").write_text("0.5 0 " + " ".join(map(str, range(16))) + "\n1 2 3\n")
    assert [(r.t_s, r.m[15]) for r in tracks.read_poses(spark, str(tmp_path / "p.txt")).collect()] == [(0.5, 15.0)]
    v = [681.388, 0, 445.448, 0, 682.386, 237.431, 0, 0, 1, *range(13), 896, 504]
    (tmp_path / "c.txt").write_text(" ".join(map(str, v)))
    r = tracks.read_intrinsics(spark, str(tmp_path / "c.txt")).first()
    assert (r.fx, r.fy, r.cx, r.cy, r.width, r.height) == (681.388, 682.386, 445.448, 237.431, 896, 504)


def test_annotation_readers(spark, tmp_path):
    (tmp_path / "a.csv").write_text("# start (ms); end (ms) ;view;verb;noun\n1000;2500;ego;open;door\n3000;4000;exo;close;none\n")
    spec = A.SegmentSpec("start", "end", units="ms", text=["verb", "noun"], keep="view == 'ego'", extras=["view"])
    got = A.read_csv(spark, str(tmp_path / "a.csv"), spec).collect()
    assert [(r.start_s, r.end_s, r.text, r.extras["view"]) for r in got] == [(1.0, 2.5, "open door", "ego")]
    pd.DataFrame({"id": ["a", "b"], "start": [0.5, 1.0], "stop": [1.0, 2.0], "text": ["one", "two"]}).to_pickle(tmp_path / "a.pkl")
    deny = spark.createDataFrame([("b",)], "id string")
    got = A.read_pickle(spark, str(tmp_path / "a.pkl"), A.SegmentSpec("start", "stop"), deny).collect()
    assert [(r.start_s, r.text) for r in got] == [(0.5, "one")]


def _mp4(scale, n, version=0):
    body = bytes([version, 0, 0, 0]) + (struct.pack(">IIII", 0, 0, scale, n) if version == 0 else struct.pack(">QQIQ", 0, 0, scale, n))
    mvhd = struct.pack(">I4s", 8 + len(body), b"mvhd") + body
    return struct.pack(">I4sI", 12, b"ftyp", 0) + struct.pack(">I4s", 8 + len(mvhd), b"moov") + mvhd


def test_catalogue(spark, tmp_path):
    root = tmp_path / "root"
    (root / "seq1").mkdir(parents=True)
    (root / "seq1" / "video.mp4").write_bytes(_mp4(1000, 12345))
    (root / "seq1" / "gaze.csv").write_text("x\n")
    (root / "seq1" / "v1.mp4").write_bytes(_mp4(90_000, 180_000, 1))
    (root / "seq1" / "bad.mp4").write_bytes(b"nothing")
    files = catalog.listing(spark, str(root))
    p = catalog.profile(files).first()
    assert p.sequence == "seq1" and p.files == 4 and p.modalities == ["gaze", "video"] and p.formats == ["table", "video"]
    got = {r.path.rsplit("/")[-1]: r.duration_s for r in catalog.video_durations(spark, str(root / "seq1" / "*.mp4")).collect()}
    assert got == {"video.mp4": 12.345, "v1.mp4": 2.0, "bad.mp4": None}
    f = io.BytesIO()
    with zipfile.ZipFile(f, "w") as z:
        z.writestr("in/a.txt", "hello")
    (tmp_path / "x.zip").write_bytes(f.getvalue())
    assert [(r.member, r.bytes) for r in catalog.archive_members(spark, str(tmp_path / "x.zip")).collect()] == [("in/a.txt", 5)]
    (tmp_path / "d.md").write_text("# Set One\n[a](https://h/x/a.zip?k=1)\ntext\n## Set-Two\nhttps://h/b.mp4 https://h/c.mp4\n")
    got = [(r.dataset, r.filename) for r in catalog.markdown_catalog(spark, str(tmp_path / "d.md")).collect()]
    assert got == [("setone", "a.zip"), ("set-two", "b.mp4"), ("set-two", "c.mp4")]
    d = catalog.digests(spark, str(root / "seq1" / "gaze.csv")).first()
    import hashlib

    assert d.sha1 == hashlib.sha1(b"x\n").hexdigest() and d.sha256 == hashlib.sha256(b"x\n").hexdigest()
