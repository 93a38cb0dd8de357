import json
import os

import pytest
from pyspark.sql import functions as F

from framesift.operators import attaching, exports, matching
from framesift.sources import files as S
from framesift.sources.shared import numbered_within
from framesift.streaming import watch


def put(folder, **texts):
    for name, text in texts.items():
        path = os.path.join(folder, *name.split("__"))
        os.makedirs(os.path.dirname(path), exist_ok=True)
        with open(path.replace("_dot_", "."), "w") as f:
            f.write(text)


def test_folders(spark, tmp_path):
    root = str(tmp_path)
    put(root, images__train__a_dot_jpg="1", images__train__sub__b_dot_jpg="22", images__val__c_dot_jpg="3", labels__train__a_dot_txt="0 1 1 1 1")
    assert S.split_folders(root, "train") == (f"{root}/images/train", f"{root}/labels/train") and S.split_folders(root, "val")[1] is None
    with pytest.raises(FileNotFoundError):
        S.split_folders(root, "test")
    x, folders = S.scanned_folder(spark, f"{root}/images/train")
    assert [r.relative for r in x.collect()] == ["a.jpg"] and folders == 1
    every = S.listed_locally(spark, f"{root}/images", [".jpg"])
    assert S.first_files(every)[1:] == (3, 4) and S.first_files(every, 2)[1:] == (2, 3)
    S.require_new(f"{root}/none.json")
    with pytest.raises(FileExistsError):
        S.require_new(f"{root}/images")


def test_table_is_rewritten(spark, tmp_path):
    path = str(tmp_path / "t.csv")
    with open(path, "w", encoding="utf-8-sig") as f:
        f.write("name;n\na.jpg;1\nb.jpg;2\n")
    assert S.rewrite_table(spark, path, lambda t: t.where("name = 'b.jpg'")) == 1
    assert open(path).read().split() == ["name;n", "b.jpg;2"] and os.listdir(tmp_path) == ["t.csv"] or sorted(os.listdir(tmp_path)) == [".t.csv.crc", "t.csv"]
    assert S.rewrite_table(spark, path, lambda t: t.where("n > 9")) == 0 and open(path).read().strip() == "name;n"
    with pytest.raises(ValueError):
        S.rewrite_table(spark, path, lambda t: (_ for _ in ()).throw(ValueError()))
    assert open(path).read().strip() == "name;n"


def test_numbers_within_groups(spark):
    rows = [(g, k) for g in ("a", "b", None) for k in range(700 if g == "a" else 5)]
    x = numbered_within(spark.createDataFrame(rows, "g string, k int"), ["g"], ["k"], "n").collect()
    assert sorted((r.g or "", r.k, r.n) for r in x) == sorted((g or "", k, k + 1) for g, k in rows)
    assert numbered_within(spark.createDataFrame([], "g string, k int"), ["g"], ["k"], "n").count() == 0


def test_leaf_plan_of_nothing(spark):
    none = spark.createDataFrame([], "path string")
    x = matching.leaf_plan(none, none, spark.createDataFrame([], "filepath string"))
    assert matching.import_counts(x, matching.orphan_labels(none, none)).first().asDict() == {"images": 0, "new": 0, "labelled": 0, "known": 0, "collisions": 0, "orphans": 0}


def test_conversion(spark):
    labels = spark.createDataFrame([("a", "1 0.5 0.5 0.5 0.5\n0 0.1 0.1 0.2 0.2"), ("b", " "), ("c", "2 0.5 0.5 0.5 0.5"), ("d", "0 0.5 0.5 0.5 0.5"), ("f", "0 0.04 0.5 0.2 0.2")], "stem string, text string")
    images = spark.createDataFrame([(s, f"x/{s}.jpg", w, 100) for s, w in (("a", 200), ("b", 200), ("c", 200), ("e", 200), ("f", 50))], "stem string, path string, width int, height int")
    got = {r.stem: (r.issue, r.text and [(s["label"], s["points"]) for s in json.loads(r.text)["shapes"]]) for r in exports.converted(labels, images, ["u", "v"]).collect()}
    assert got["a"] == (None, [("v", [[50.0, 25.0], [150.0, 75.0]]), ("u", [[0.0, 0.0], [40.0, 20.0]])]) and got["b"] == (None, [])
    assert got["c"] == ("parse_error", None) and got["d"] == ("missing_image", None) and got["e"] == ("missing_label", None) and got["f"][0] is None


def test_tracks(spark):
    doc = {"shapes": [], "tracks": [{"label_id": 1, "group": 3, "shapes": [{"frame": 4, "outside": False, "points": [0, 0]}, {"frame": 8, "outside": True, "occluded": True, "points": [8, 4]}], "elements": []}]}
    shapes, keys = attaching.payload_shapes(spark.createDataFrame([(1, json.dumps(doc)), (2, "broken"), (3, None)], "task bigint, text string"))
    frames = spark.createDataFrame([(1, f) for f in (0, 4, 5, 8, 90)] + [(2, 0)], "task bigint, frame bigint")
    got = {r.frame: (r.points, r.outside, r.occluded) for r in attaching.track_points(frames, keys).collect()}
    assert shapes.count() == 0 and got == {0: (None, True, False), 4: ([0.0, 0.0], False, False), 5: ([2.0, 1.0], False, False), 8: ([8.0, 4.0], True, True), 90: ([8.0, 4.0], True, True)}


def test_watch_parts(spark, tmp_path):
    r = spark.range(1).select(watch.fitted_size(F.lit(4000), F.lit(1)).alias("flat"), watch.fitted_size(F.lit(10), F.lit(20)).alias("small"), watch.call_payload("is it?", F.lit(b"ab"), "m").alias("body")).first()
    assert (r.flat.width, r.flat.height) == (1024, 1) and (r.small.width, r.small.height) == (10, 20)
    body = json.loads(r.body)
    assert body["messages"][0]["content"] == [{"type": "text", "text": "is it?"}, {"type": "image_url", "image_url": {"url": "data:image/jpeg;base64,YWI="}}]
    done = watch.verdicts(spark.createDataFrame([("/in/a/b.jpg", '{"k": true}'), ("/in/c.jpg", None), ("/in/d.jpg", '{"k": "maybe"}')], "path string, answer string"), "k")
    files = watch.mirrored(done, "/in", "out", "k")
    assert {(v.target, v.status) for v in S.write_files(files, str(tmp_path)).collect()} == {("out/a/b.json", "written")}
    assert json.loads((tmp_path / "out/a/b.json").read_text()) == {"path": "a/b.jpg", "k": True}
