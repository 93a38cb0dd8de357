"""Documents to be written: shape files, keypoint files, task sizes, directory groups."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from framesift.sources.textformats import dense_ids


def shape_documents(images: DataFrame) -> DataFrame:
    """images(path, sample_id, width, height, dets array<struct<label, box>>) to (target, text): a JSON file beside each image."""
    w, h = F.col("width"), F.col("height")
    corner = lambda d: F.array(F.array(d["box"][0] * w, d["box"][1] * h), F.array((d["box"][0] + d["box"][2]) * w, (d["box"][1] + d["box"][3]) * h))
    shapes = F.transform(F.coalesce("dets", F.array().cast(images.schema["dets"].dataType)), lambda d: F.struct(d["label"].alias("label"), F.lit("rectangle").alias("shape_type"), F.transform(corner(d), lambda p: F.transform(p, lambda v: F.bround(v, 3))).alias("points")))
    name = F.regexp_extract("path", "[^/]*$", 0)
    doc = F.struct("sample_id", name.alias("imagePath"), w.alias("imageWidth"), h.alias("imageHeight"), shapes.alias("shapes"))
    return images.select(F.regexp_replace("path", r"\.[^./]+$", ".json").alias("target"), F.to_json(doc).alias("text"))


def keypoint_triples(points: Column) -> Column:
    """points array<struct<x, y, v>> as x, y, v, x, y, v ...; absent and unlabelled points are 0, 0, 0."""
    there = lambda p: (p["v"] > 0) & ~F.isnan(p["x"]) & ~F.isnan(p["y"])
    one = lambda p: F.when(there(p), F.array(p["x"], p["y"], p["v"].cast("double"))).otherwise(F.array(F.lit(0.0), F.lit(0.0), F.lit(0.0)))
    return F.flatten(F.transform(points, one))


def keypoint_document(faces: DataFrame) -> DataFrame:
    """faces(file_name, width, height, bbox, points), a row an image, to one row (text): the whole file, ids from 1 by file name.

    The format is one JSON document, so that the file is one value; many faces belong into several files.
    """
    x = dense_ids(faces, "file_name", "id").withColumn("k", keypoint_triples(F.col("points")))
    seen = F.size(F.filter(F.transform(F.sequence(F.lit(2), F.size("k") - 1, F.lit(3)), lambda i: F.get("k", i)), lambda v: v > 0))
    image = F.struct("id", "file_name", "width", "height")
    note = F.struct("id", F.col("id").alias("image_id"), F.lit(1).alias("category_id"), "bbox", (F.get("bbox", F.lit(2)) * F.get("bbox", F.lit(3))).alias("area"), F.lit(0).alias("iscrowd"), F.col("k").alias("keypoints"), seen.alias("num_keypoints"))
    g = x.agg(F.array_sort(F.collect_list(image)).alias("images"), F.array_sort(F.collect_list(note)).alias("annotations"))
    return g.select(F.to_json(F.struct("images", "annotations")).alias("text"))


def task_size(sizes: Sequence[int], budget: int, most: int = 512) -> int:
    """Files for each task: by bisection, a count for which all consecutive chunks stay in the budget. Driver-side."""
    if any(s > budget for s in sizes):
        raise ValueError("a file is over the budget")
    low, high = 1, min(len(sizes), most)
    while low < high:
        n = (low + high + 1) // 2
        if all(sum(sizes[k : k + n]) <= budget for k in range(0, len(sizes), n)):
            low = n
        else:
            high = n - 1
    return max(low, 1)


def split_groups(files: DataFrame, key: str, groups: int) -> DataFrame:
    """files with group 0 to groups - 1: chunks of ceil(n / groups) in order of a unique key."""
    n = files.count()
    return dense_ids(files, key, "_n").withColumn("group", F.floor((F.col("_n") - 1) / max(1, -(-n // groups))).cast("bigint")).drop("_n")
