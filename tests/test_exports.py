import json

import pytest

from framesift.functions import grammar as G
from framesift.operators import attaching, exports


def fails(f, *args, **more):
    with pytest.raises(ValueError):
        f(*args, **more)


def test_lists_and_classes():
    assert G.names("b, a ,b", "keep") == ["b", "a", "b"] and G.names("b,a,b", "drop") == ["b", "a"]
    fails(G.names, "b,a,b"), fails(G.names, " , ")
    r = G.attribute_classes(["cat-mood_0", "cat-mood_12", "dog", "cow-mood_1"])
    assert r.attribute == "mood" and r.labels == ("cat", "cow") and r.plain == ("dog",) and r.by_code["cat", 12] == "cat-mood_12"
    assert G.attribute_classes(["dog", "a-b"]) is None
    fails(G.attribute_classes, ["a-x_1", "b-y_1"]), fails(G.attribute_classes, ["a-x_1", "a-x_01"]), fails(G.attribute_classes, ["a-x_1", "a"])


def test_thresholds_and_specs():
    assert G.threshold(0, "edge") == 0 and G.threshold("1", "iou") == 1 and G.threshold(0.02, "clip") == 0.02
    for value, kind in ((0.5, "edge"), (0, "clip"), (0, "iou"), (1.01, "iou"), (-0.1, "edge"), ("nan", "iou"), ("inf", "iou"), ("x", "clip")):
        fails(G.threshold, value, kind)
    assert G.select_attributes(["mood= good,bad,good", "n=1"]) == {"mood": ["good", "bad"], "n": ["1"]} and G.field_range(" mood:1-3 ") == ("mood", 1, 3)
    fails(G.select_attribute, "mood"), fails(G.select_attribute, "mood="), fails(G.select_attribute, "label_id=a"), fails(G.select_attributes, ["a=1", "a=2"]), fails(G.field_range, "mood:3-1"), fails(G.field_range, "mood")
    assert G.report_name("a b/c-d.e") == "a_b_c-d.e"
    G.refuse_keypoint_classes(["a"]), G.require_keypoint_label("kpt_a")
    fails(G.refuse_keypoint_classes, ["a", "kpt_b"]), fails(G.require_keypoint_label, "a")


def test_projects_and_skeletons():
    G.require_project(None, ["a"]), G.require_project({"a": {"x"}, "b": {"x", "y"}}, ["b", "a"], ["x"])
    fails(G.require_project, {"a": set()}, ["a", "b"]), fails(G.require_project, {"a": {"x"}}, ["a"], ["x", "y"])
    assert G.labels_of_task({}, {"a": 1}) == {"a": 1} and G.labels_of_task({"b": 2}, {"a": 1}) == {"b": 2}
    names = [f"p{k}" for k in range(42)]
    text = lambda **c: json.dumps({"categories": [{"keypoints": names, "skeleton": [[0, 1], [5, 41]]} | c]})
    assert G.skeleton_schema(text()) == (names, [[0, 1], [5, 41]])
    for bad in ({"keypoints": names[:41]}, {"keypoints": [*names[:41], ""]}, {"skeleton": []}, {"skeleton": [[0, 42]]}, {"skeleton": [[1]]}, {"skeleton": [[0, True]]}):
        fails(G.skeleton_schema, text(**bad))
    fails(G.skeleton_schema, "{}")
    assert G.drawing_template('{"a": [1, 2.5]}', ["a"]) == {"a": (1.0, 2.5)}
    for bad in ('{"a": [1]}', '{"a": [1, "2"]}', '{"b": [1, 2]}', "[]"):
        fails(G.drawing_template, bad, ["a"])
    assert G.keypoint_target(68, "keypoints", "kpt_face") == ("keypoints_68", "kpt_face") and G.keypoint_target(42, "mine", "kpt_x") == ("mine", "kpt_x")
    fails(G.keypoint_target, 68, "mine", "kpt_face"), fails(G.keypoint_target, 68, "keypoints", "kpt_x"), fails(G.keypoint_target, 42, "keypoints_68", "kpt_face")


def test_guards(spark):
    x = spark.createDataFrame([(1, ["a"]), (2, ["b", None]), (3, None)], "sample_id bigint, tags array<string>")
    exports.require_tags(x, ["a", "b"])
    fails(exports.require_tags, x, ["a", "c"]), fails(exports.require_rows, x.where("sample_id > 9"), "samples")
    assert exports.require_rows(x, "samples") is x
    p = exports.keypoint_export(spark.createDataFrame([(1, "/a/x.jpg", True, 5, 5, 1, True), (2, "/b/x.jpg", True, 5, 5, 1, True), (3, "/b/y.jpg", False, 5, 5, 1, True), (4, None, True, 5, 5, None, None), (5, "/b/x.jpg", True, None, 5, 1, True)], "sample_id int, filepath string, file_exists boolean, width int, height int, n_faces int, paired boolean"))
    assert {r.sample_id: r.issue for r in p.collect()} == {1: "duplicate_name", 2: "duplicate_name", 3: "missing_image", 4: "unpaired", 5: "missing_size"}
    fails(exports.export_or_stop, p)
    assert exports.export_or_stop(p.where("sample_id = 5")).count() == 0


def test_labels_of_nothing(spark):
    rules = G.attribute_classes(["cat-mood_0", "cat-mood_1", "dog"])
    kind = "sample_id int, dets array<struct<label string, tags array<string>>>"
    x = spark.createDataFrame([(1, None), (2, []), (3, [("cat", None), ("cat", ["mood_1", "mood_0", None]), ("cat", ["mood_7"]), (None, None), ("dog", ["mood_7"]), ("owl", [])])], kind)
    r = {v.sample_id: ([d.label for d in v.kept or []], v.defaulted, v.omitted_default, v.unmapped) for v in exports.attribute_labels(x, rules).collect()}
    assert r == {1: ([], 0, 0, []), 2: ([], 0, 0, []), 3: (["cat-mood_0", "cat-mood_1", "dog"], 1, 0, ["cat-mood_7"])}
    assert exports.inspected(exports.attribute_labels(x, rules)).first().negative_images == 2


def test_boxes_of_files_and_samples(spark):
    from pyspark.sql import functions as F

    kind = "array<struct<label string, box array<double>>>"
    a, b = [("x", [0.1, 0.1, 0.2, 0.2]), ("w", [0.5, 0.5, 0.1, 0.1])], [("w", [0.5004, 0.5, 0.1, 0.1]), ("x", [0.1, 0.1, 0.2, 0.2])]
    x = spark.createDataFrame([(1, a, b), (2, a, a[:1]), (3, [], None), (4, a, [("x", a[0][1]), ("v", a[1][1])]), (5, a, [a[0], ("w", [0.6, 0.5, 0.1, 0.1])])], f"n int, a {kind}, b {kind}")
    got = {r.n: r.same for r in x.select("n", attaching.same_boxes(F.col("a"), F.col("b"), F.lit(1000), F.lit(1000)).alias("same")).collect()}
    assert got == {1: True, 2: False, 3: True, 4: False, 5: False}
