"""Plans that attach label files and faces to samples: matched, checked, compared with what is there; one row each."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from framesift.functions import columns as C
from framesift.functions.keypoints import points_equal, size_outcome
from framesift.operators.matching import attach


def sorted_boxes(boxes: Column) -> Column:
    """boxes array<struct<label, box>> in order of label and box, for comparison."""
    return F.array_sort(F.coalesce(boxes, F.array().cast("array<struct<label:string,box:array<double>>>")))


def same_boxes(a: Column, b: Column, width: Column, height: Column, tol: float = 0.5) -> Column:
    """Whether two lists have the same labels and, in order of label and box, no edge apart by more than tol pixels."""
    edge = lambda v: F.array(v["box"][0] * width, v["box"][1] * height, (v["box"][0] + v["box"][2]) * width, (v["box"][1] + v["box"][3]) * height)
    near = F.zip_with(sorted_boxes(a), sorted_boxes(b), lambda p, q: (p["label"] == q["label"]) & (C.corner_delta(edge(p), edge(q)) <= tol))
    return F.coalesce((F.size(sorted_boxes(a)) == F.size(sorted_boxes(b))) & F.forall(near, lambda v: F.coalesce(v, F.lit(False))), F.lit(False))


def label_plan(files: DataFrame, samples: DataFrame, allowed: list[str]) -> tuple[DataFrame, DataFrame]:
    """files(path, claimed, sha256, width, height, boxes, parse_issue), samples(sample_id, sha256, boxes) to a plan and its issues.

    plan(path, sample_id, outcome): write, unchanged (the sample's boxes of allowed labels are the same), or an issue.
    A file that could not be parsed, or has no image (sha256 null), is no candidate. Candidates are matched as by
    attach(). Those that share their image's hash are all reported (duplicate_task_image_hash); where they match
    different samples, none of them is attached. Of several files of one sample the first by path is attached.
    """
    fine = files.where("parse_issue is null and sha256 is not null")
    matched = attach(fine.select("path", "claimed", "sha256"), samples.select("sample_id", "sha256"))
    hit = F.col("status").isin("match", "sample_id_collision")
    x = fine.join(matched, "path")
    groups = x.groupBy("sha256").agg(F.count("*").alias("images"), F.count_distinct(F.when(hit, F.col("sample_id"))).alias("targets"))
    x = x.join(groups, "sha256").withColumn("status", F.when(hit, F.when((F.col("images") > 1) & (F.col("targets") > 1), "skipped").otherwise("match")).otherwise(F.col("status")))
    first = x.where("status = 'match'").groupBy("sample_id").agg(F.min("path").alias("first_path"))
    x = x.join(first, "sample_id", "left").withColumn("status", F.when((F.col("status") == "match") & (F.col("path") > F.col("first_path")), "sample_id_collision").otherwise(F.col("status")))
    now = samples.select("sample_id", F.filter("boxes", lambda b: b["label"].isin(*allowed)).alias("now"))
    x = x.join(now, "sample_id", "left")
    wanted = F.filter("boxes", lambda b: b["label"].isin(*allowed))
    outcome = F.when(F.col("status") != "match", F.col("status")).when(same_boxes(F.col("now"), wanted, F.col("width"), F.col("height")), "unchanged").otherwise("write")
    plan = x.select("path", "sample_id", outcome.alias("outcome"))
    bad = files.where("parse_issue is not null or sha256 is null").select("path", F.lit(None).cast(samples.schema["sample_id"].dataType).alias("sample_id"), F.coalesce("parse_issue", F.lit("missing_image")).alias("issue"))
    doubled = x.where("images > 1").select("path", "sample_id", F.lit("duplicate_task_image_hash").alias("issue"))
    other = plan.where("outcome not in ('write', 'unchanged', 'skipped')").select("path", "sample_id", F.col("outcome").alias("issue"))
    return plan, bad.unionByName(doubled).unionByName(other)


def face_plan(matches: DataFrame, tags: list[str]) -> DataFrame:
    """matches of faces with samples, with outcome, box, points, instance_id and new_tags.

    matches(sample_id, json_width, json_height, width, height, box_px array, points_px array<struct<x, y>>, now_boxes
    array<struct<box, instance_id>>, now_points array<struct<points, instance_id>>, other_points int, tags): now_ are the
    sample's of the face label, other_points how many faces its other point field has. Coordinates are rescaled to the
    sample's size if they fit in it, else the outcome is size_mismatch. A box is locked, that is kept, if the other field
    has the face and there is one box. unchanged: one box and one point list, equal already, and no new tag. The instance id is
    the first that a box or a point list has.
    """
    sized = F.col("width").isNotNull() & F.col("height").isNotNull()
    w, h = F.when(sized, F.col("width")).otherwise(F.col("json_width")), F.when(sized, F.col("height")).otherwise(F.col("json_height"))
    x = matches.withColumn("_w", w).withColumn("_h", h)
    fits = size_outcome(F.col("box_px"), F.col("points_px"), (F.col("json_width"), F.col("json_height")), (F.col("_w"), F.col("_h")))
    size = lambda k: "_w" if k % 2 == 0 else "_h"
    box = F.array(*[F.bround(F.try_divide(F.get("box_px", F.lit(k)), F.col(size(k))), 6) for k in range(4)])
    points = F.transform("points_px", lambda p: F.struct(F.bround(F.try_divide(p["x"], F.col("_w")), 6).alias("x"), F.bround(F.try_divide(p["y"], F.col("_h")), 6).alias("y")))
    locked = (F.coalesce("other_points", F.lit(0)) > 0) & (F.size("now_boxes") == 1)
    x = x.withColumn("size", fits).withColumn("locked", F.coalesce(locked, F.lit(False)))
    x = x.withColumn("box", F.when(F.col("locked"), F.get("now_boxes", F.lit(0))["box"]).otherwise(box)).withColumn("points", points)
    x = x.withColumn("new_tags", C.appended(F.col("tags"), tags))
    near = F.forall(F.zip_with(F.get("now_boxes", F.lit(0))["box"], "box", lambda p, q: F.abs(p - q) <= 1e-5), lambda v: F.coalesce(v, F.lit(False)))
    current = (F.size("now_boxes") == 1) & (F.size("now_points") == 1) & near & points_equal(F.get("now_points", F.lit(0))["points"], F.col("points")) & (F.size("new_tags") == F.size(C.tags_or_empty(F.col("tags"))))
    ids = F.filter(F.concat(F.coalesce(F.col("now_boxes.instance_id"), F.array().cast("array<string>")), F.coalesce(F.col("now_points.instance_id"), F.array().cast("array<string>"))), lambda v: F.coalesce(v, F.lit("")) != "")
    outcome = F.when(F.col("size") == "size_mismatch", "size_mismatch").when(F.coalesce(current, F.lit(False)), "unchanged").otherwise("write")
    return x.withColumn("outcome", outcome).withColumn("instance_id", F.get(ids, F.lit(0))).drop("_w", "_h")


def shape_skeletons(shapes: DataFrame, skeleton: int, nodes: list[int]) -> DataFrame:
    """shapes(frame, kind, label_id, group, elements array<struct<label_id, outside, occluded, points array<double>>>, width, height)
    of a download to (frame, group, points array<struct<x, y>>, flags): a row for each skeleton, its points in order of nodes.

    A point is relative to the image; 0 and NaN if its element is absent, outside or without a place, 1 if occluded, else 2.
    """
    x = shapes.where((F.col("kind") == "skeleton") & (F.col("label_id") == skeleton))
    by_id = F.map_from_entries(F.transform("elements", lambda e: F.struct(e["label_id"], e)))
    place = F.transform(F.array(*[F.lit(n) for n in nodes]), lambda n: F.try_element_at(by_id, n))
    out = lambda e: F.coalesce(e["outside"], F.lit(False)) | e.isNull() | F.coalesce(F.size(e["points"]) < 2, F.lit(True))
    nan = F.lit(float("nan"))
    share = lambda e, k, size: F.when(out(e), nan).otherwise(F.bround(F.try_divide(F.get(e["points"], F.lit(k)), F.col(size)), 6))
    x = x.withColumn("_e", place)
    return x.select(
        "frame", F.coalesce("group", F.lit(0)).alias("group"), F.transform("_e", lambda e: F.struct(share(e, 0, "width").alias("x"), share(e, 1, "height").alias("y"))).alias("points"),
        F.transform("_e", lambda e: F.when(out(e), 0).when(F.coalesce(e["occluded"], F.lit(False)), 1).otherwise(2)).alias("flags"),
    )


def shape_boxes(shapes: DataFrame, label: int) -> DataFrame:
    """shapes(frame, kind, label_id, group, points, width, height) to (frame, group, box): rectangles of a label, relative."""
    x = shapes.where((F.col("kind") == "rectangle") & (F.col("label_id") == label) & (F.size("points") >= 4))
    return x.select("frame", F.coalesce("group", F.lit(0)).alias("group"), C.relative_box(F.slice("points", 1, 4), F.col("width"), F.col("height")).alias("box"))


def payload_shapes(payloads: DataFrame) -> tuple[DataFrame, DataFrame]:
    """payloads(task, text) of an annotation server's download, {shapes, tracks}, to shapes and the keyframes of tracks.

    shapes(task, frame, kind, label_id, group, points, elements); keyframes(task, track, label_id, group, node, frame, outside, occluded,
    points), with node null for a track's own and else the label of its element. Tracks are numbered by their place.
    """
    element = "struct<label_id:bigint,outside:boolean,occluded:boolean,points:array<double>>"
    key = "array<struct<frame:bigint,outside:boolean,occluded:boolean,points:array<double>>>"
    kind = f"struct<shapes:array<struct<frame:bigint,type:string,label_id:bigint,`group`:bigint,points:array<double>,elements:array<{element}>>>,tracks:array<struct<label_id:bigint,`group`:bigint,shapes:{key},elements:array<struct<label_id:bigint,shapes:{key}>>>>>"
    x = payloads.select("task", F.from_json("text", kind).alias("j"))
    shapes = x.select("task", F.inline("j.shapes")).withColumnRenamed("type", "kind")
    t = x.select("task", F.posexplode("j.tracks").alias("track", "t"))
    own = t.select("task", "track", "t.label_id", F.col("t.group").alias("group"), F.lit(None).cast("bigint").alias("node"), F.inline("t.shapes"))
    nodes = t.select("task", "track", "t.label_id", F.col("t.group").alias("group"), F.explode("t.elements").alias("e"))
    nodes = nodes.select("task", "track", "label_id", "group", F.col("e.label_id").alias("node"), F.inline("e.shapes"))
    return shapes, own.unionByName(nodes)


def track_points(frames: DataFrame, keyframes: DataFrame) -> DataFrame:
    """frames(task, frame), keyframes of payload_shapes() to each track's place and node at each frame of its task:
    (task, track, label_id, group, node, frame, points, outside, occluded).

    Before the first keyframe a node is outside. Between two it moves linearly, coordinate by coordinate; after the last
    it stays. Flags are those of the keyframe at or before.
    """
    from pyspark.sql import Window

    k = keyframes.withColumn("node", F.coalesce("node", F.lit(-1)))
    ids = ["task", "track", "label_id", "group", "node"]
    after = Window.partitionBy(*ids).orderBy("frame")
    k = k.withColumn("next", F.lead("frame").over(after)).withColumn("to", F.lead("points").over(after)).withColumn("n", F.row_number().over(after))
    at = F.col("f")
    x = frames.withColumnRenamed("frame", "f").join(k, "task").where((at >= F.col("frame")) & (F.col("next").isNull() | (at < F.col("next"))))
    part = F.when(F.col("next").isNull(), 0.0).otherwise((at - F.col("frame")) / (F.col("next") - F.col("frame")))
    points = F.when(F.col("to").isNull(), F.col("points")).otherwise(F.zip_with("points", "to", lambda p, q: p + (q - p) * part))
    x = x.withColumn("points", points)  # not in the select below, where frame would be taken as the new one
    inside = x.select(*ids, at.alias("frame"), "points", F.coalesce("outside", F.lit(False)).alias("outside"), F.coalesce("occluded", F.lit(False)).alias("occluded"))
    early = frames.withColumnRenamed("frame", "f").join(k.where("n = 1"), "task").where(at < F.col("frame"))
    early = early.select(*ids, at.alias("frame"), F.lit(None).cast("array<double>").alias("points"), F.lit(True).alias("outside"), F.lit(False).alias("occluded"))
    return inside.unionByName(early).withColumn("node", F.when(F.col("node") >= 0, F.col("node")))
