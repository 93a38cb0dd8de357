"""Text formats: label files, model answers, names and dense ids."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from framesift.functions.columns import finite
from framesift.functions.keypoints import face_box
from framesift.sources.shared import numbered_within


def parse_yolo(files: DataFrame, key: str, strict: tuple[int | Column, int | Column] | None = None, slack: float = 5.0, classes: int | None = None, keep: tuple[str, ...] = ()) -> DataFrame:
    """files(key, text) of lines "class cx cy w h" to (key, line, class_id, box, parse_error), a row for each line.

    One bad line makes the whole file an error: its rows have no class and box. Blank files give no rows (unlabelled).
    Numbers must be finite, sizes positive. Lenient: the class may be written as a number with a fraction of zero.
    strict=(width, height): the class is an integer literal, and a box at most slack pixels outside is clamped.
    classes: the length of the class list; a class beyond it is an error. keep: more columns of files to be kept.
    """
    x = files.select(key, *keep, F.posexplode(F.split(F.col("text"), "\r?\n")).alias("line", "raw")).where("trim(raw) <> ''")
    p = F.split(F.trim(F.regexp_replace("raw", r"\s+", " ")), " ")
    num = F.transform(p, lambda v: v.try_cast("double"))
    x = x.withColumn("p", p).withColumn("n", num)
    cls = F.get("p", F.lit(0)).try_cast("int") if strict else F.get("n", F.lit(0)).cast("int")
    cx, cy, w, h = (F.get("n", F.lit(k)) for k in range(1, 5))
    ok = (F.size("n") == 5) & F.forall("n", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < 1e9)) & (w > 0) & (h > 0) & cls.isNotNull() & (cls >= 0)
    ok = ok & (F.get("n", F.lit(0)) == F.floor(F.get("n", F.lit(0)))) & (cls < (classes if classes is not None else 1 << 31))
    box = F.array(cx - w / 2, cy - h / 2, w, h)
    if strict:
        over = F.greatest((w / 2 - cx) * strict[0], (cx + w / 2 - 1) * strict[0], (h / 2 - cy) * strict[1], (cy + h / 2 - 1) * strict[1])
        ok = ok & (over <= slack)
        x1, y1 = F.greatest(cx - w / 2, F.lit(0.0)), F.greatest(cy - h / 2, F.lit(0.0))
        box = F.array(x1, y1, F.least(cx + w / 2, F.lit(1.0)) - x1, F.least(cy + h / 2, F.lit(1.0)) - y1)
    x = x.withColumn("ok", F.coalesce(ok, F.lit(False)))
    bad = F.max(~F.col("ok")).over(Window.partitionBy(key))  # a file's lines: bounded by the file
    x = x.withColumn("parse_error", bad)
    good = ~F.col("parse_error")
    return x.select(key, *keep, "line", F.when(good, cls).alias("class_id"), F.when(good, F.transform(box, lambda v: F.bround(v, 6))).alias("box"), "parse_error")


def parse_yolo_sized(files: DataFrame, key: str, classes: int, slack: float = 5.0) -> DataFrame:
    """parse_yolo(strict) of files(key, text, width, height), each with its image's size."""
    x = parse_yolo(files, key, strict=(F.col("width"), F.col("height")), slack=slack, classes=classes, keep=("width", "height"))
    return x.drop("width", "height")


def yolo_lines(dets: Column) -> Column:
    """dets array<struct<class_id, box>> as the text of a label file; empty for none."""
    one = lambda d: F.format_string("%d %.6f %.6f %.6f %.6f", d["class_id"], d["box"][0] + d["box"][2] / 2, d["box"][1] + d["box"][3] / 2, d["box"][2], d["box"][3])
    return F.array_join(F.transform(dets, one), "\n")


def answer_json(text: Column, key: str) -> Column:
    """The JSON text of the first object with a key in a model's answer, null if there is none.

    Fenced blocks come first, then the whole text, then what begins at each opening brace, nested objects included. Text
    behind an object does not matter, nor do braces that begin no object.
    """
    fenced = F.transform(F.regexp_extract_all(text, F.lit(r"(?is)```(?:json)?\s*(.*?)```"), 1), F.trim)
    whole = F.filter(F.concat(fenced, F.array(F.trim(text))), lambda c: F.try_parse_json(c).isNotNull())
    starts = F.filter(F.sequence(F.lit(1), F.greatest(F.length(text), F.lit(1))), lambda i: F.substring(text, i, F.lit(1)) == "{")
    braces = F.transform(starts, lambda i: F.substring(text, i, F.length(text)))
    return F.get(F.filter(F.concat(whole, braces), lambda c: F.get_json_object(c, f"$.{key}").isNotNull()), F.lit(0))


def parse_coco(docs: DataFrame, points: int | None = None, files: DataFrame | None = None) -> DataFrame:
    """docs(path, text) of COCO keypoint files to a row for each image: (path, file_name, image_id, width, height, n, bbox, keypoints, issue).

    Each image needs a file name of its own without folders, a positive size, one annotation, a valid box (the face box,
    else that of the extent) in it, and points times 3 finite numbers (a multiple of 3 where points is None). files(file_name): images that are
    there; others are missing_file. A file that is no such JSON gives one row with issue json_error.
    """
    kind = "struct<images:array<struct<id:bigint,file_name:string,width:double,height:double>>,annotations:array<struct<image_id:bigint,bbox:array<double>,face_box:array<double>,keypoints:array<double>>>>"
    x = docs.select("path", F.from_json("text", kind).alias("j"))
    broken = F.col("j.images").isNull() | F.col("j.annotations").isNull()
    i = x.where(~broken).select("path", F.inline("j.images")).withColumnRenamed("id", "image_id")
    a = x.where(~broken).select("path", F.inline("j.annotations"))
    a = a.groupBy("path", "image_id").agg(F.count("*").alias("n"), F.first(face_box(F.col("face_box"), F.col("bbox"))).alias("bbox"), F.first("keypoints").alias("keypoints"))
    names = i.groupBy("path", "file_name").agg(F.count("*").alias("same"))
    x = x.where(broken).select("path", F.lit("json_error").alias("issue"))
    i = i.join(a, ["path", "image_id"], "left").join(names, ["path", "file_name"], "left")
    i = i.join(files.select("file_name", F.lit(True).alias("there")).distinct(), "file_name", "left") if files is not None else i.withColumn("there", F.lit(True))
    size = lambda v: finite(v) & (v > 0) & (v == F.floor(v))
    few = F.size("keypoints") != 3 * points if points else F.size("keypoints") % 3 != 0
    bad = F.col("keypoints").isNull() | few | F.exists("keypoints", lambda v: ~finite(v))
    issue = (
        F.when(F.coalesce(F.col("file_name"), F.lit("")).isin("", ".", "..") | F.col("file_name").contains("/"), "bad_filename").when(F.col("same") > 1, "duplicate_filename")
        .when(~F.coalesce(size(F.col("width")) & size(F.col("height")), F.lit(False)), "bad_image_size").when(F.col("there").isNull(), "missing_file")
        .when(F.col("n").isNull(), "missing_annotation").when(F.col("n") > 1, "multiple_annotations").when(F.col("bbox").isNull(), "bad_box").when(bad, "bad_keypoints")
    )
    i = i.select("path", "file_name", "image_id", F.col("width").cast("int"), F.col("height").cast("int"), "n", "bbox", "keypoints", issue.alias("issue"))
    return i.unionByName(x, allowMissingColumns=True)


def parse_sidecar(docs: DataFrame, labels: list[str]) -> DataFrame:
    """docs(path, text) of shape files {sample_id, imagePath, imageWidth, imageHeight, shapes} to (path, sample_id, image_path, boxes, issue).

    Shapes are rectangles or polygons; any other kind, bad points of a wanted label, or a size that is not positive rejects
    the file.
    """
    kind = "struct<sample_id:string,description:string,imagePath:string,imageWidth:int,imageHeight:int,shapes:array<struct<label:string,shape_type:string,points:array<array<double>>>>>"
    x = docs.select("path", F.from_json("text", kind).alias("j"))
    wanted = F.filter("j.shapes", lambda s: s["label"].isin(*labels))
    xs = lambda s, k: F.transform(s["points"], lambda p: F.get(p, F.lit(k)))
    good = lambda s: (F.size(s["points"]) >= 2) & F.forall(s["points"], lambda p: (F.size(p) == 2) & p[0].isNotNull() & p[1].isNotNull())
    sized = F.coalesce((F.col("j.imageWidth") > 0) & (F.col("j.imageHeight") > 0), F.lit(False))
    issue = (
        F.when(F.col("j").isNull() | F.col("j.shapes").isNull(), "json_error").when(~sized, "bad_image_size")
        .when(F.exists("j.shapes", lambda s: ~F.coalesce(s["shape_type"], F.lit("")).isin("rectangle", "polygon")), "unsupported_shape").when(F.exists(wanted, lambda s: ~F.coalesce(good(s), F.lit(False))), "bad_points")
    )
    share = lambda v, size: F.bround(F.try_divide(v, F.col(size)), 6)
    left, top, right, bottom = (lambda s, f=f, k=k: f(xs(s, k)) for f, k in ((F.array_min, 0), (F.array_min, 1), (F.array_max, 0), (F.array_max, 1)))
    box = F.transform(wanted, lambda s: F.struct(s["label"].alias("label"), F.array(share(left(s), "j.imageWidth"), share(top(s), "j.imageHeight"), share(right(s) - left(s), "j.imageWidth"), share(bottom(s) - top(s), "j.imageHeight")).alias("box")))
    claimed = F.coalesce(F.nullif(F.trim("j.sample_id"), F.lit("")), F.nullif(F.regexp_extract("j.description", r"(?:^|[\s,])fo_sample_id=([^\s,]*)", 1), F.lit("")))
    return x.select("path", claimed.alias("sample_id"), F.col("j.imagePath").alias("image_path"), F.when(issue.isNull(), box).alias("boxes"), issue.alias("issue"))


def safe_name(text: Column, most: int = 20, most_bytes: int = 30) -> Column:
    """A name as part of a file name: at most so many characters and bytes (of UTF-8), class if nothing is left."""
    x = F.substring(F.btrim(F.regexp_replace(text, r"(?U)[^\w-]+", "_"), F.lit("_")), 1, most)
    x = F.when(x == "", "class").otherwise(x)
    cuts = F.transform(F.sequence(F.lit(1), F.length(x)), lambda n: F.substring(x, 1, n))
    return F.element_at(F.filter(cuts, lambda c: F.octet_length(c) <= most_bytes), -1)


def export_stem(present: Column, classes: list[str], n: Column) -> Column:
    """The name of an exported sample: its classes in the list's order, six at most and then more, and its number."""
    mine = F.filter(F.array(*[F.lit(c) for c in classes]), lambda c: F.array_contains(present, c))
    parts = F.transform(F.slice(mine, 1, 6), lambda c: safe_name(c))
    parts = F.when(F.size(mine) > 6, F.concat(parts, F.array(F.lit("more")))).otherwise(parts)
    return F.concat(F.when(F.size(parts) == 0, "negative").otherwise(F.array_join(parts, "__")), F.format_string("_%06d", n))


def dense_ids(rows: DataFrame, key: str, name: str) -> DataFrame:
    """rows with ids 1, 2, ... in order of a unique key: numbered within ranges of the key, and offset by the ranges before."""
    return numbered_within(rows, [], [key], name)
