"""Write-back plans, keypoints, hashes of images, files, the watch loop: small cases with known results."""

import math
import os

import numpy as np
import pytest
from pyspark.sql import functions as F

from framesift.functions import imagehash
from framesift.functions import keypoints as K
from framesift.operators import writeback as W
from framesift.sources import files as S
from framesift.sources import textformats as T
from framesift.streaming import watch

NAN = float("nan")
POINTS = "array<struct<x double, y double>>"


def test_points(spark):
    x = spark.createDataFrame([([(0.5, 0.25), (NAN, NAN)], [(0.504, 0.25), (NAN, NAN)], [(0.5, 0.25), (0.1, 0.1)])], f"a {POINTS}, b {POINTS}, c {POINTS}")
    w, h = F.lit(1000), F.lit(1000)
    r = x.select(
        K.absolute_points(F.col("a"), w, h).alias("abs"), K.points_equal(F.col("a"), F.col("a")).alias("same"), K.points_equal(F.col("a"), F.col("b")).alias("near"), K.points_moved(F.col("a"), F.col("b"), w, h).alias("m1"),
        K.points_moved(F.col("a"), F.col("c"), w, h).alias("m2"), K.points_usable(F.col("a"), 2).alias("ok"), K.points_usable(F.col("a"), 3).alias("few"), K.coordinates_fit(F.array(*[F.lit(v) for v in (0.0, -1.0, 2.0, 2.0)]), F.col("a"), F.lit(1), F.lit(1)).alias("fit"),
    ).first()
    assert [tuple(p) for p in r.abs] == [(500, 250, False), (0, 0, True)]
    assert (r.same, r.near, r.m1, r.m2, r.ok, r.few, r.fit) == (True, False, False, True, True, False, True)
    s = spark.createDataFrame([([(500.0, 250.0, False, True), (1.0, 1.0, True, False)],)], "s array<struct<x double, y double, outside boolean, occluded boolean>>")
    a, b = s.select(K.relative_points(F.col("s"), w, h).alias("p")).first().p
    assert tuple(a) == (0.5, 0.25, 1) and math.isnan(b.x) and b.v == 0


def test_boxes_moved(spark):
    box = lambda *v: F.array(*map(F.lit, v))
    a = box(0.1, 0.1, 0.5, 0.5)
    r = spark.range(1).select(*[K.box_moved(a, b, F.lit(1000), F.lit(1000)).alias(n) for n, b in (("x", box(0.104, 0.1, 0.5, 0.5)), ("y", box(0.104, 0.1, 0.502, 0.5)), ("z", a))]).first()
    assert (r.x, r.y, r.z) == (False, True, False)


def slow_hash(px):
    """The hash by its definition, term by term."""
    def resize(rows):
        n, scale = len(rows[0]), len(rows[0]) / 32
        wide = max(scale, 1.0)
        out = []
        for row in rows:
            line = []
            for o in range(32):
                c = (o + 0.5) * scale
                lo, hi = max(0, int(c - 3 * wide + 0.5)), min(n, int(c + 3 * wide + 0.5))
                ws = []
                for k in range(lo, hi):
                    t = (k + 0.5 - c) / wide
                    ws.append(0.0 if abs(t) >= 3 else 1.0 if t == 0 else 3 * math.sin(math.pi * t) * math.sin(math.pi * t / 3) / (math.pi * t) ** 2)
                line.append(min(255, max(0, math.floor(sum(w * row[lo + i] for i, w in enumerate(ws)) / sum(ws) + 0.5))))
            out.append(line)
        return out

    small = list(zip(*resize(list(zip(*resize(px), strict=True))), strict=True))
    cos = [[2 * math.cos(math.pi * k * (2 * i + 1) / 64) for i in range(32)] for k in range(8)]
    part = [[sum(cos[v][i] * small[r][i] for i in range(32)) for r in range(32)] for v in range(8)]
    low = [sum(cos[u][r] * part[v][r] for r in range(32)) for u in range(8) for v in range(8)]
    mid = sorted(low)[31:33]
    return f"{int(''.join(str(int(c > sum(mid) / 2)) for c in low), 2):016x}"


def test_image_hash(spark):
    rng = np.random.default_rng(3)
    for shape in ((40, 70), (8, 8), (33, 32), (120, 5)):
        px = rng.integers(0, 256, shape)
        assert imagehash.hash_of(px) == slow_hash(px.tolist())
    px = rng.integers(0, 256, (20, 30, 3)).astype(np.uint8)
    x = spark.createDataFrame([((bytearray(px.tobytes()), 20, 30, 3),), ((bytearray(b""), -1, -1, -1),), (None,)], "image struct<data binary, height int, width int, nChannels int>")
    got = [r.h for r in x.select(imagehash.perceptual_hash(F.col("image")).alias("h")).collect()]
    assert got == [imagehash.hash_of(imagehash.grey(px.tobytes(), 20, 30, 3)), None, None]


DET = "array<struct<label string, box array<double>, tags array<string>, attributes map<string,string>>>"


def test_pulled_boxes(spark):
    b = [0.1, 0.1, 0.2, 0.2]
    near = [0.1005, 0.1, 0.2, 0.2]
    rows = [
        (1, ["t"], 1000, 1000, [("car", b, ["age_1"], {"age": "1"}), ("dog", b, [], {})], [("car", near, [], {"age": " 1 "})]),
        (2, ["t"], 1000, 1000, [("car", b, ["age_1"], {"age": "1"})], [("car", near, [], {"age": "2"})]),
        (3, None, None, None, [("car", b, ["age_1"], {})], [("car", [0.2, 0.1, 0.2, 0.2], None, None)]),
        (4, ["t"], 10, 10, None, None),
        (5, ["t"], 10, 10, [("dog", b, [], {})], [("car", b, ["x"], {}), ("dog", near, [], {})]),
    ]
    x = spark.createDataFrame(rows, f"sample_id bigint, tags array<string>, width int, height int, before {DET}, after {DET}")
    r = {v.sample_id: (v.changed, v.tags, [(d.label, d.tags) for d in v.dets]) for v in W.pulled_boxes(x, ["car"], ["b1"], ["age"]).collect()}
    assert r[1] == (False, ["t"], [("dog", []), ("car", ["age_1"])])
    assert r[2] == (True, ["t", "b1", "changed"], [("car", ["age_1"])])
    assert r[3] == (True, ["b1", "changed"], [("car", None)])
    assert r[4] == (False, ["t"], [])
    assert r[5] == (True, ["t", "b1", "changed"], [("dog", []), ("car", ["x"])])


def test_pulled_faces(spark):
    face = lambda dx, p, *more: ([0.1 + dx, 0.1, 0.2, 0.2], p, *more)
    p = [[0.1, 0.1], [NAN, NAN]]
    rows = [
        (1, 1000, 1000, [face(0.0, p, "i1", ["a"])], [face(0.001, p)]),
        (2, 1000, 1000, [face(0.0, p, "i1", ["a"])], [face(0.3, [[0.1, 0.1], [0.2, 0.2]])]),
        (3, 1000, 1000, [face(0.0, p, "i1", ["a"]), face(0.5, p, "i2", [])], [face(0.5, p)]),
        (4, 1000, 1000, None, None),
        (5, 1000, 1000, [face(0.0, [[0.9, 0.9]], "i1", []), face(0.5, p, "i2", ["b"])], [face(0.3, p), face(0.6, [[0.9, 0.9]])]),
    ]
    new = "array<struct<box array<double>, points array<array<double>>>>"
    x = spark.createDataFrame(rows, f"sample_id bigint, width int, height int, old array<struct<box array<double>, points array<array<double>>, instance_id string, tags array<string>>>, new {new}")
    r = {v.sample_id: (v.changed, [(f.instance_id, f.tags) for f in v.faces]) for v in W.pulled_faces(x).collect()}
    assert r == {1: (False, [("i1", ["a"])]), 2: (True, [("i1", ["a"])]), 3: (True, [("i2", [])]), 4: (False, []), 5: (True, [("i2", ["b"]), ("i1", [])])}


def test_task_images(spark):
    side = spark.createDataFrame([("t/a/1.json", "1.jpg"), ("t/a/2.json", "/x/U.jpg"), ("t/a/3.json", "/x/two.jpg"), ("t/a/4.json", None), ("t/a/5.json", "../../out.jpg"), ("t/a/6.json", "../b/u.jpg")], "path string, image_path string")
    images = spark.createDataFrame([(p,) for p in ("t/a/1.jpg", "t/b/u.jpg", "t/b/two.jpg", "t/c/two.jpg", "t/a/4.png", "t/a/4.jpg", "t/a/1.txt")], "path string")
    r = {v.path[4]: v.image for v in W.task_images(side, images).collect()}
    assert r == {"1": "t/a/1.jpg", "2": "t/b/u.jpg", "3": None, "4": "t/a/4.jpg", "5": None, "6": "t/b/u.jpg"}


def test_export_names(spark):
    classes = ["猫" * 25, "a b/c", "__", *"defg"]
    r = spark.range(1).select(T.export_stem(F.array(F.lit("d"), F.lit("a b/c")), classes, F.lit(7)).alias("a"), T.export_stem(F.array(*map(F.lit, classes)), classes, F.lit(1234567)).alias("b"), T.export_stem(F.array().cast("array<string>"), classes, F.lit(1)).alias("c")).first()
    assert (r.a, r.b, r.c) == ("a_b_c__d_000007", "猫" * 10 + "__a_b_c__class__d__e__f__more_1234567", "negative_000001")


def test_listings_and_writers(spark, tmp_path):
    root = tmp_path / "in"
    (root / "sub").mkdir(parents=True)
    for n in ("b.JPG", "a.png", "sub/c.jpg", ".hid.jpg", "note.txt"):
        (root / n).write_bytes(n.encode())
    (root / "empty.jpg").write_bytes(b"")
    os.symlink(root / "a.png", root / "link.png")
    got = lambda d: sorted(r.relative for r in d.collect())
    assert got(S.listed_locally(spark, str(root), S.IMAGES, links="skip")) == [".hid.jpg", "a.png", "b.JPG", "empty.jpg", "sub/c.jpg"]
    assert S.listed_locally(spark, str(root), S.IMAGES, recursive=False).count() == 4
    assert sorted(r.path.rsplit("/", 1)[1] for r in S.listed(spark, str(root)).collect()) == ["a.png", "b.JPG", "c.jpg", "link.png"]
    assert S.split_names(str(root)) == ["sub"]
    os.symlink(root / "gone.png", root / "dangling.png")
    with pytest.raises(OSError):
        S.listed_locally(spark, str(root), S.IMAGES)

    out = tmp_path / "out"
    plan = spark.createDataFrame([("x/1.txt", "one"), ("2.txt", ""), ("../no.txt", "n"), ("3.txt", None), ("4.txt", "p"), ("4.txt", "q")], "target string, text string")
    r = sorted((v.target, v.status) for v in S.write_files(plan, str(out)).collect())
    assert r == [("../no.txt", "outside"), ("2.txt", "written"), ("3.txt", "missing"), ("4.txt", "collision"), ("4.txt", "collision"), ("x/1.txt", "written")]
    assert (out / "x/1.txt").read_text() == "one" and (out / "2.txt").read_text() == "" and sorted(os.listdir(out)) == ["2.txt", "x"]
    assert {v.status for v in S.write_files(plan.limit(2), str(out)).collect()} == {"exists"} and {v.status for v in S.write_files(plan.limit(2), str(out), "replace").collect()} == {"written"}
    copy = spark.createDataFrame([("c.jpg", str(root / "sub/c.jpg")), ("d.jpg", str(root / "no.jpg"))], "target string, source string")
    assert {v.target: v.status for v in S.write_files(copy, str(out)).collect()} == {"c.jpg": "written", "d.jpg": "missing"}
    with pytest.raises(FileExistsError):
        S.require_empty(str(out))


def test_renames(spark, tmp_path):
    for n in "abc":
        (tmp_path / n).write_text(n)
    at = lambda n: str(tmp_path / n)
    plan = lambda rows: spark.createDataFrame([(at(s), at(t)) for s, t in rows], "source string, target string")
    assert S.rename_all(plan([("a", "b"), ("b", "a"), ("c", "c")])) == 2
    assert [(tmp_path / n).read_text() for n in "abc"] == ["b", "a", "c"]
    with pytest.raises(FileExistsError):
        S.rename_all(plan([("a", "d"), ("b", "c")]))
    assert sorted(os.listdir(tmp_path)) == ["a", "b", "c"] and (tmp_path / "a").read_text() == "b"


def test_tables_and_reports(spark, tmp_path):
    path = str(tmp_path / "t")
    S.replace_table(spark.range(3), path)
    S.append_rows(spark.range(3, 5), path)
    S.replace_table(spark.read.parquet(path).where("id > 1"), path)
    assert sorted(r.id for r in spark.read.parquet(path).collect()) == [2, 3, 4] and os.listdir(tmp_path) == ["t"]
    report = str(tmp_path / "r")
    assert S.write_report(spark.range(2), report, ["id"]) and not S.write_report(spark.range(0), report, ["id"]) and not os.path.exists(report)
    (tmp_path / "x.csv").write_text("﻿name;n\na,b;1\n", encoding="utf-8")
    x = S.read_table(spark, str(tmp_path / "x.csv"))
    assert x.columns == ["name", "n"] and x.first().name == "a,b"


def test_watch_loop(spark, tmp_path):
    source, results = str(tmp_path / "in"), str(tmp_path / "out")
    schema = "path string, value int"

    def score(x):
        return x.select("path", F.when((F.col("value") >= 0) | F.lit(os.path.exists(tmp_path / "mended")), "ok").otherwise("fail").alias("status"), "value")

    def go(rows):
        spark.createDataFrame(rows, schema).write.mode("append").parquet(source)
        watch.keep_scored(spark.readStream.schema(schema).parquet(source), score, results, str(tmp_path / "cp"), every=None).awaitTermination()
        return {r.path: r.status for r in watch.latest_results(spark, results).collect()}

    assert go([("a", 1), ("b", -1)]) == {"a": "ok", "b": "fail"}
    (tmp_path / "mended").write_text("")
    assert go([("a", 2), ("c", 3)]) == {"a": "ok", "b": "ok", "c": "ok"}
    assert {r.value for r in spark.read.parquet(results).where("path = 'a'").collect()} == {1}
