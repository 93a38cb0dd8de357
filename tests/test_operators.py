from pyspark.sql import functions as F

from framesift.functions import columns as C
from framesift.operators import annotations as A
from framesift.operators import dedup, similarity
from framesift.sources import textformats as T


def one(spark, **cols):
    return spark.range(1).select(*[c.alias(k) for k, c in cols.items()]).first()


def box(*v):
    return F.array(*[F.lit(x).cast("double") for x in v])


def test_boxes(spark):
    cases = {"inside": (0.05, 0.3, 0.7, 0.6), "whole": (0, 0, 1, 1), "edge": (0.5, 0.5, 0.5005, 0.4), "part": (0.8, -0.3, 0.1, 0.6), "off": (-0.7, 0.2, 0.6, 0.1), "no_width": (0.2, 0.2, 0, 0.3), "nan": (float("nan"), 0, 0.5, 0.5), "five": (0, 0, 0.5, 0.5, 1)}
    r = one(spark, **{k: C.box_issue(box(*v)) for k, v in cases.items()}, null=C.box_issue(F.lit(None).cast("array<double>")), clip=C.box_clipped(box(0.75, 0.4, 0.26, 0.125)), act=C.box_action(box(0.75, 0.4, 0.26, 0.125)), far=C.box_action(box(0.75, 0.4, 0.28, 0.125)), tall=C.box_action(box(0.1, 0, 0.2, 1.015)))
    assert r.asDict() == {"inside": None, "whole": None, "edge": None, "part": "partial", "off": "no_overlap", "no_width": "invalid", "nan": "invalid", "five": "invalid", "null": "invalid", "clip": [0.75, 0.4, 0.25, 0.125], "act": "clip", "far": "delete", "tall": "delete"}


def test_tags_keep_order(spark):
    tags = F.array(*map(F.lit, ["b", "dup_near", "a", "b"]))
    r = one(spark, w=C.without(tags, C.DUP_TAGS), m=C.with_managed(tags, C.DUP_TAGS, F.array(F.lit("dup_repeat_keep"), F.lit("dup_repeat"))), s=C.with_managed(tags, C.DUP_TAGS, F.array(F.lit("dup_near"))), a=C.appended(F.lit(None).cast("array<string>"), ["x"]))
    assert r.w == ["b", "a", "b"] and r.m == ["b", "a", "b", "dup_repeat", "dup_repeat_keep"] and r.s == ["b", "dup_near", "a", "b"] and r.a == ["x"]


def test_hash_bits(spark):
    r = one(spark, a=C.hash_bits(F.lit("ffffffffffffffff")), b=C.hash_bits(F.lit("zz")), c=C.hash_bits(F.lit("")), d=C.hash_bits(F.lit("0f")))
    assert (r.a, r.b, r.c, r.d) == (-1, None, None, 15)


def sample(i, sha, tags=(), boxes=0, area=100):
    return (i, f"/images/{i}.jpg", sha, area, boxes, True, list(tags), "", "")


SCHEMA = "sample_id bigint, filepath string, sha256 string, area bigint, box_count bigint, file_exists boolean, tags array<string>, dup_group string, dup_of string"


def test_sticky_roles(spark):
    x = spark.createDataFrame([sample(1, "a"), sample(2, "a", boxes=2), sample(3, "b", ["dup_repeat_drop"]), sample(4, "b"), sample(5, "c", ["dup_repeat_keep"]), sample(6, "c"), sample(7, ""), sample(8, None), sample(9, "d")], SCHEMA)
    r = {v.sample_id: (v.role, v.dup_of) for v in dedup.group_roles(x, "sha256", "dup_repeat_keep", "dup_repeat_drop", "exact").collect()}
    assert r == {1: ("drop", "/images/2.jpg"), 2: ("keep", None), 3: ("drop", None), 4: (None, None), 5: ("keep", None), 6: ("drop", "/images/5.jpg")}


def test_hamming_pairs_lose_none(spark):
    import random

    random.seed(5)
    base = [random.getrandbits(63) for _ in range(10)]
    v = [(i, base[i % 10] ^ (1 << random.randrange(63)) ^ (1 << random.randrange(63))) for i in range(80)]
    reps = {}
    for i, b in v:
        reps.setdefault(b, i)
    want = {(a, b) for x, a in reps.items() for y, b in reps.items() if a < b and (x ^ y).bit_count() <= 3}
    got = {(r.a, r.b) for r in similarity.hamming_pairs(spark.createDataFrame(v, "id bigint, bits bigint"), 3).collect()}
    assert got == want and want


def test_yolo_text(spark):
    x = spark.createDataFrame([(1, "0 0.5 0.5 0.2 0.4\n1 0.5 0.5 0.1 0.1"), (2, ""), (3, "0 nan 0.5 0.2 0.4"), (4, "0 0.5 0.5 0 0.4"), (5, "0 0.5 0.5 0.2 0.4 9"), (6, "0.0 0.5 0.5 0.2 0.4"), (7, None)], "f int, text string")
    r = T.parse_yolo(x, "f").collect()
    assert [(v.f, v.class_id, v.box) for v in r if not v.parse_error][:1] == [(1, 0, [0.4, 0.3, 0.2, 0.4])]
    assert {v.f for v in r if v.parse_error} == {3, 4, 5}
    assert {v.f for v in T.parse_yolo(x, "f", classes=1).collect() if v.parse_error} == {1, 3, 4, 5}
    assert {v.f for v in T.parse_yolo(x, "f", strict=(100, 100)).collect() if v.parse_error} == {3, 4, 5, 6}


def test_coco_and_sidecar(spark):
    doc = '{"images":[{"id":1,"file_name":"a.jpg","width":10,"height":10},{"id":2,"file_name":"b.jpg","width":10,"height":10}],"annotations":[{"image_id":1,"bbox":[1,2,3,4],"face_box":[0,0,0,0],"keypoints":[1,1,2]}]}'
    r = T.parse_coco(spark.createDataFrame([("p", doc)], "path string, text string")).collect()
    assert {v.file_name: v.issue for v in r} == {"a.jpg": None, "b.jpg": "missing_annotation"}
    side = '{"sample_id":" ","description":"x fo_sample_id=abc1","imagePath":"a.jpg","imageWidth":100,"imageHeight":50,"shapes":[{"label":"head","shape_type":"rectangle","points":[[10,5],[30,25]]},{"label":"z","shape_type":"polygon","points":[]}]}'
    r = T.parse_sidecar(spark.createDataFrame([("p", side), ("q", "nope"), ("r", side.replace("polygon", "circle"))], "path string, text string"), ["head"]).orderBy("path").collect()
    flat = T.parse_sidecar(spark.createDataFrame([("p", side.replace('"imageWidth":100', '"imageWidth":0'))], "path string, text string"), ["head"]).first()
    assert flat.issue == "bad_image_size" and flat.boxes is None
    assert r[0].boxes[0].box == [0.1, 0.1, 0.2, 0.4] and r[0].sample_id == "abc1" and [v.issue for v in r] == [None, "json_error", "unsupported_shape"]


def test_matchings():
    a, b = [[0, 0, 1, 1], [0, 0, 1.4, 1]], [[0, 0, 1.3, 1], [0, 0, 0.8, 1]]
    assert A.perfect_matching(a, b, 0.5) is not None and A.perfect_matching(a, b[:1], 0.5) is None and not A.greedy_matching(a, [[9, 9, 9, 9], a[0]], 0.5)
    assert A.staged_assignment([([0], [0]), ([50], [50])], [([1], [0]), ([99], [99])]) == [0, 1]


def test_matching_of_many_boxes():
    n = 1500
    same, steps = [[0.5] * 4] * n, [[float(k)] * 4 for k in range(n)]
    assert sorted(A.perfect_matching(same, same, 0.0)) == list(range(n))
    assert A.perfect_matching(steps, [[k + 0.5] * 4 for k in range(n)], 0.5) is not None and A.perfect_matching(steps, [[k + 0.5] * 4 for k in range(n - 1)] + [[0.5] * 4], 0.5)[1] == n - 1 and A.perfect_matching(steps, [[k + 0.5] * 4 for k in range(n - 1)] + [[-0.6] * 4], 0.5) is None


def test_hashes_at_every_distance(spark):
    import random

    random.seed(6)
    v = [(i, random.getrandbits(20) & random.getrandbits(20)) for i in range(150)] + [(200, 7), (201, 7), (202, -1)]
    x = spark.createDataFrame(v, "id bigint, bits bigint")
    reps = {}
    for i, b in v:
        reps.setdefault(b, i)
    for k in (0, 2, 9):
        want = {(min(a, b), max(a, b)): ((x ^ y) & (1 << 64) - 1).bit_count() for x, a in reps.items() for y, b in reps.items() if a != b and ((x ^ y) & (1 << 64) - 1).bit_count() <= k}
        got = [((r.a, r.b), r.distance) for r in similarity.hamming_pairs(x, k).collect()]
        assert dict(got) == want and len(got) == len(want)
    assert {(r.a, r.b) for r in similarity.members(x).collect()} >= {(200, 201)}
    s = spark.createDataFrame([(1, "0f"), (2, " 0F"), (3, "0e"), (4, ""), (5, None), (6, "f0"), (7, "zz")], "sample_id bigint, phash string")
    assert {r.sample_id: r.near_key for r in similarity.clusters(s).collect()} == {1: "0f", 2: "0f", 3: "0e", 6: "f0"}
    assert {r.sample_id: r.near_key for r in similarity.clusters(s, 1).collect()} == {1: "0e", 2: "0e", 3: "0e", 6: "f0"}


def test_near_duplicates_of_what_exact_ones_leave(spark):
    rows = [sample(1, "a", boxes=1), sample(2, "a"), sample(3, "b"), sample(4, "c", ["dup_near_keep"]), sample(5, "d"), sample(6, "e", ["dup_near", "q"])]
    x = spark.createDataFrame([(*r, h) for r, h in zip(rows, ["11", "22", "11", "22", "22", "33"], strict=True)], SCHEMA + ", phash string")
    p = {r.sample_id: (r.exact_role, r.near_role, r.new_tags) for r in dedup.full_plan(x).collect()}
    assert p[1] == ("keep", "keep", ["dup_repeat", "dup_repeat_keep", "dup_near", "dup_near_keep"]) and p[2] == ("drop", None, ["dup_repeat", "dup_repeat_drop"])
    assert p[3][1] == "drop" and p[4][1:] == ("keep", ["dup_near", "dup_near_keep"]) and p[5][1] == "drop" and p[6] == (None, None, ["q"])
    assert {r.sample_id for r in dedup.delete_ids(dedup.full_plan(x)).collect()} == {2, 3, 5} and dedup.plan_counts(dedup.full_plan(x)).first().stale == 1


def test_answers(spark):
    say = lambda t: T.answer_json(F.lit(t), "k")
    got = lambda c: F.get_json_object(c, "$.k")
    r = one(spark, nested=got(say('So: {"k": 3, "more": {"x": 1}} ok')), inner=got(say('{"a": {"k": 4}}')), fence=got(say('{"k": 1} ```JSON\n{"k": 2}\n```')), none=say("no {braces} here"), empty=say(""), open=say('{"k": 5'), null=T.answer_json(F.lit(None).cast("string"), "k"))
    assert r.asDict() == {"nested": "3", "inner": "4", "fence": "2", "none": None, "empty": None, "open": None, "null": None}


def test_box_edits(spark):
    s = spark.createDataFrame([(1, [("a", [0.0]), ("b", [1.0])]), (2, [("c", [2.0])])], "sample_id int, dets array<struct<label string, box array<double>>>")
    e = spark.createDataFrame([(1, 0, None), (1, 1, [9.0]), (2, 5, [1.0])], "sample_id int, idx int, box array<double>")
    r = {v.sample_id: [(d.label, d.box) for d in v.dets] for v in A.edited(s, e).collect()}
    assert r == {1: [("b", [9.0])], 2: [("c", [2.0])]}


def test_interpolation(spark):
    k = spark.createDataFrame([(1, 0, 0.0, False), (1, 10, 10.0, True)], "track int, t bigint, value double, outside boolean")
    f = spark.createDataFrame([(1, -1), (1, 0), (1, 5), (1, 10), (1, 99), (2, 1)], "track int, t bigint")
    r = {(v.track, v.t): (v.value, v.outside) for v in A.interpolated(f, k).collect()}
    assert r == {(1, -1): (None, True), (1, 0): (0.0, False), (1, 5): (5.0, False), (1, 10): (10.0, True), (1, 99): (10.0, True), (2, 1): (None, True)}


def test_payloads(spark):
    import json

    from framesift.sources import payloads as P

    x = spark.createDataFrame([("a/b.jpg", "id1", 100, 50, [("head", [0.1, 0.1, 0.2, 0.4])]), ("c.png", "id2", 10, 10, [])], "path string, sample_id string, width int, height int, dets array<struct<label string, box array<double>>>")
    r = {v.target: json.loads(v.text) for v in P.shape_documents(x).collect()}
    assert r["a/b.json"]["shapes"] == [{"label": "head", "shape_type": "rectangle", "points": [[10.0, 5.0], [30.0, 25.0]]}] and r["c.json"]["shapes"] == []
    f = spark.createDataFrame([("b.jpg", 10, 10, [1.0, 2.0, 3.0, 4.0], [(1.0, 2.0, 2), (float("nan"), 0.0, 1)]), ("a.jpg", 10, 10, [1.0, 2.0, 3.0, 4.0], [(5.0, 6.0, 1)])], "file_name string, width int, height int, bbox array<double>, points array<struct<x double, y double, v int>>")
    doc = json.loads(P.keypoint_document(f).first().text)
    assert [i["file_name"] for i in doc["images"]] == ["a.jpg", "b.jpg"] and doc["annotations"][1]["keypoints"] == [1.0, 2.0, 2.0, 0.0, 0.0, 0.0] and doc["annotations"][1]["num_keypoints"] == 1
    assert P.task_size([3, 3, 3, 3, 3], 10) == 3 and P.task_size([7, 2, 7, 2], 9) == 2 and P.task_size([1] * 6, 50, 5) == 5
