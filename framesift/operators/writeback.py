"""Plans for what comes back from annotation: boxes, tags, attributes and faces of each sample, before anything is applied.

A detection is struct<label, box, tags, attributes map>; a sample's detections are one bounded list in its row.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from functools import reduce
from operator import or_

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from framesift.functions import columns as C
from framesift.operators.annotations import perfect_matching, staged_assignment

# Tags that mark edited and checked samples.
CHANGED, CHECKED = "changed", "xlabel_checked"


def replaced_classes(old: Column, new: Column, classes: Sequence[str]) -> Column:
    """Old detections of other classes, then new ones of these classes."""
    return F.concat(F.filter(old, lambda d: ~F.coalesce(d["label"].isin(*classes), F.lit(False))), F.filter(new, lambda d: d["label"].isin(*classes)))


def batch_tags(tags: Column, extra: Sequence[str], changed: Column, checked: bool = False) -> Column:
    """Changed samples: the batch's tags and CHANGED go to the end, CHECKED follows if asked for and absent; others lose them."""
    rest = F.filter(C.tags_or_empty(tags), lambda t: ~t.isin(*extra, CHANGED))
    full = F.concat(rest, C.texts([*extra, CHANGED]))
    if checked:
        full = C.appended(full, [CHECKED])
    return F.when(changed, full).otherwise(rest)


def attribute_from_tags(dets: Column, name: str, low: int, high: int) -> Column:
    """Each detection as struct<det, issue, replaced>: its attribute is the largest code of its tags name_<code>, low if
    there is none; a code out of range is an issue and writes nothing; replaced: another value stood there."""

    def one(d: Column) -> Column:
        codes = C.family_codes(d["tags"], name)
        bad = F.exists(codes, lambda v: (v < low) | (v > high))
        new = F.coalesce(F.array_max(codes), F.lit(low)).cast("string")
        had = F.element_at(F.coalesce(d["attributes"], F.create_map().cast("map<string,string>")), F.lit(name))
        rest = F.map_filter(F.coalesce(d["attributes"], F.create_map().cast("map<string,string>")), lambda k, _: k != name)
        det = F.when(bad, d).otherwise(d.withField("attributes", F.map_concat(rest, F.create_map(F.lit(name), new))))
        return F.struct(det.alias("det"), F.when(bad, "out_of_range").alias("issue"), (~bad & had.isNotNull() & (had != new)).alias("replaced"))

    return F.transform(dets, one)


def tags_from_attribute(dets: Column, name: str, low: int, high: int) -> Column:
    """Each detection as struct<det, issue>: its tags name_<code> become the one of its attribute; a missing or unexpected
    value is an issue and leaves the tags."""

    def one(d: Column) -> Column:
        text = F.nullif(F.trim(F.element_at(d["attributes"], F.lit(name))), F.lit(""))
        value = text.try_cast("double")
        code = F.when(value == F.floor(value), value.cast("int"))
        issue = F.when(text.isNull(), "missing_value").when(code.isNull() | ~code.between(low, high), "unexpected_value")
        return F.struct(F.when(issue.isNull(), d.withField("tags", C.family_set(d["tags"], name, code))).otherwise(d).alias("det"), issue.alias("issue"))

    return F.transform(dets, one)


def _partners(samples: DataFrame, tol: float) -> DataFrame:
    """samples(sample_id, width, height, a, b: arrays of struct<label, box>) with, for each of b, its partner in a, by label.

    A label whose boxes have no perfect matching has no partners. Tolerance in pixels; without a size tol / 1000.
    """

    def boxes(dets, w: float, h: float) -> dict[str, list[tuple[int, list[float]]]]:
        out: dict[str, list] = {}
        for i, d in enumerate(dets):
            x, y, bw, bh = (float(v) for v in d["box"])
            out.setdefault(d["label"], []).append((i, [x * w, y * h, (x + bw) * w, (y + bh) * h]))
        return out

    def partner(r) -> list[int | None]:
        sized = bool(r.width and r.height and r.width == r.width and r.height == r.height)
        w, h, limit = (r.width, r.height, tol) if sized else (1.0, 1.0, tol / 1000)
        left, right = boxes(r.a, w, h), boxes(r.b, w, h)
        out: list[int | None] = [None] * len(r.b)
        for label in left.keys() & right.keys():
            found = perfect_matching([v for _, v in left[label]], [v for _, v in right[label]], limit)
            for (i, _), j in zip(left[label], found or [], strict=False):
                out[right[label][j][0]] = i
        return out

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for p in batches:
            yield pd.DataFrame({"sample_id": p["sample_id"], "partner": [partner(r) for r in p.itertuples(index=False)]})

    schema = f"sample_id {samples.schema['sample_id'].dataType.simpleString()}, partner array<int>"
    return samples.select("sample_id", F.col("width").cast("double").alias("width"), F.col("height").cast("double").alias("height"), "a", "b").mapInPandas(run, schema)


def pulled_boxes(samples: DataFrame, classes: Sequence[str], batch: Sequence[str], attributes: Sequence[str] = (), tol: float = 2.0) -> DataFrame:
    """samples(sample_id, tags, width, height, before, after) to (sample_id, dets, tags, changed).

    Detections of the classes come from after, others from before. Downloaded boxes without tags get those of the box
    that they match. A sample is changed when label sets differ, boxes of a label do not match perfectly within tol, or
    a named attribute of a matched pair differs; only then the batch's tags and CHANGED are appended.
    """
    mine = lambda c: F.filter(F.coalesce(c, F.array()), lambda d: d["label"].isin(*classes))
    short = lambda c: F.transform(c, lambda d: F.struct(d["label"].alias("label"), d["box"].alias("box")))
    x = samples.withColumn("_a", mine(F.col("before"))).withColumn("_b", mine(F.col("after")))
    found = _partners(x.select("sample_id", "width", "height", short(F.col("_a")).alias("a"), short(F.col("_b")).alias("b")), tol)
    x = x.join(found, "sample_id")
    pairs = F.zip_with("_b", "partner", lambda d, k: F.struct(d.alias("d"), F.get("_a", k).alias("was")))
    text = lambda d, n: F.nullif(F.trim(F.element_at(d["attributes"], F.lit(n))), F.lit(""))
    differs = lambda v: reduce(or_, [~text(v["d"], n).eqNullSafe(text(v["was"], n)) for n in attributes], F.lit(False))
    whole = (F.size("_a") == F.size("_b")) & ~F.exists("partner", lambda k: k.isNull())
    x = x.withColumn("_p", pairs).withColumn("changed", ~whole | F.exists("_p", differs))
    bare = lambda v: (F.size(C.tags_or_empty(v["d"]["tags"])) == 0) & v["was"].isNotNull()
    new = F.transform("_p", lambda v: v["d"].withField("tags", F.when(bare(v), v["was"]["tags"]).otherwise(v["d"]["tags"])))
    tags = F.when(F.col("changed"), C.appended(F.col("tags"), [*batch, CHANGED])).otherwise(C.tags_or_empty(F.col("tags")))
    return x.select("sample_id", replaced_classes(F.coalesce("before", F.array()), new, classes).alias("dets"), tags.alias("tags"), "changed")


def pair_by_group(boxes: DataFrame, faces: DataFrame) -> DataFrame:
    """boxes(frame, grp, ord, box), faces(frame, grp, ord, points) of a download to (frame, box, points, issue).

    Shapes of one group (not 0, not null) pair in order; a group with one kind alone is left out. Shapes without a group
    pair if a frame has one of each; if it has more, its row has the issue unpaired_shapes and nothing else.
    """
    keyed = lambda d: d.withColumn("grp", F.coalesce("grp", F.lit(0))).withColumn("n", F.row_number().over(Window.partitionBy("frame", "grp").orderBy("ord")))
    b, f = keyed(boxes), keyed(faces)
    grouped = b.where("grp <> 0").select("frame", "grp", "n", "box").join(f.where("grp <> 0").select("frame", "grp", "n", "points"), ["frame", "grp", "n"])
    one = lambda d, c: d.where("grp = 0").groupBy("frame").agg(F.count("*").alias(f"n_{c}"), F.any_value(c).alias(c))
    loose = one(b, "box").join(one(f, "points"), "frame")
    single = (F.col("n_box") == 1) & (F.col("n_points") == 1)
    loose = loose.select("frame", F.when(single, F.col("box")).alias("box"), F.when(single, F.col("points")).alias("points"), F.when(~single, "unpaired_shapes").alias("issue"))
    return grouped.select("frame", "box", "points", F.lit(None).cast("string").alias("issue")).unionByName(loose)


def pulled_faces(samples: DataFrame, tol: float = 5.0) -> DataFrame:
    """samples(sample_id, width, height, old, new): old array<struct<box, points, instance_id, tags>>, new
    array<struct<box, points>>, to (sample_id, faces, changed): new faces with instance and tags of the old ones.

    A new face takes the old one whose box lies within tol pixels, else whose points do, else the only one left on both
    sides. Changed: counts differ, a face has no old one, or its box or a point moved. Points: array<array<double>>.
    """
    absent = -1e9  # two hidden points agree, a hidden and a visible one do not

    def flat(f, w: float, h: float) -> tuple[list[float], list[float]]:
        x, y, bw, bh = (float(v) for v in f["box"])
        points = [absent if v is None or v != v else v * s for p in f["points"] for v, s in zip(p, (w, h), strict=True)]
        return [x * w, y * h, (x + bw) * w, (y + bh) * h], points

    def near(a: tuple, b: tuple) -> bool:
        return all(len(p) == len(q) and all(abs(u - v) <= tol for u, v in zip(p, q, strict=True)) for p, q in zip(a, b, strict=True))

    def plan(r) -> tuple[list[int | None], bool]:
        old, new = [flat(f, r.width, r.height) for f in r.old], [flat(f, r.width, r.height) for f in r.new]
        taken = staged_assignment(old, new, tol)
        return taken, len(old) != len(new) or any(j is None or not near(old[j], f) for j, f in zip(taken, new, strict=True))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for p in batches:
            out = [plan(r) for r in p.itertuples(index=False)]
            yield pd.DataFrame({"sample_id": p["sample_id"], "taken": [t for t, _ in out], "changed": [c for _, c in out]})

    part = lambda c: F.transform(c, lambda f: F.struct(f["box"].alias("box"), f["points"].alias("points")))
    x = samples.select("sample_id", F.col("width").cast("double").alias("width"), F.col("height").cast("double").alias("height"), part(F.coalesce("old", F.array())).alias("old"), part(F.coalesce("new", F.array())).alias("new"))
    found = x.mapInPandas(run, f"sample_id {samples.schema['sample_id'].dataType.simpleString()}, taken array<int>, changed boolean")
    x = samples.join(found, "sample_id")
    was = lambda j, n: F.get("old", j)[n]
    faces = F.zip_with("new", "taken", lambda f, j: F.struct(f["box"].alias("box"), f["points"].alias("points"), was(j, "instance_id").alias("instance_id"), C.tags_or_empty(was(j, "tags")).alias("tags")))
    return x.select("sample_id", F.coalesce(faces, F.array()).alias("faces"), "changed")


def attached_faces(faces: DataFrame, samples: DataFrame) -> DataFrame:
    """faces(path, sha256, phash) of a keypoint file to samples(sample_id, sha256, phash): (path, sample_id, status).

    A digest that occurs more than once among the faces is refused (duplicate_digest). Then content hash, several samples:
    ambiguous_sha256; without a hit the perceptual hash, under the same rule, but never a sample that a content hash took
    (phash_taken). Two faces of one perceptual hash are refused as well (duplicate_phash).
    """
    n = faces.groupBy("sha256").agg(F.count("*").alias("same"))
    a = samples.where("sha256 <> ''").groupBy("sha256").agg(F.count("*").alias("n_sha"), F.min("sample_id").alias("id_sha"))
    b = samples.where("phash <> ''").groupBy("phash").agg(F.count("*").alias("n_ph"), F.min("sample_id").alias("id_ph"))
    x = faces.join(n, "sha256", "left").join(a, "sha256", "left").join(b, "phash", "left")
    first = F.when(F.col("same") > 1, "duplicate_digest").when(F.col("n_sha") > 1, "ambiguous_sha256").when(F.col("n_sha") == 1, "sha256").when(F.col("n_ph") > 1, "ambiguous_phash").when(F.col("n_ph") == 1, "phash").otherwise("unmatched")
    x = x.withColumn("first", first)
    claimed = x.where("first = 'sha256'").select(F.col("id_sha").alias("id_ph"), F.lit(True).alias("claimed")).distinct()
    twice = x.where("first = 'phash'").groupBy("id_ph").agg(F.count("*").alias("askers"))
    x = x.join(claimed, "id_ph", "left").join(twice, "id_ph", "left")
    second = F.col("first") == "phash"
    st = F.when(second & F.col("claimed"), "phash_taken").when(second & (F.col("askers") > 1), "duplicate_phash").otherwise(F.col("first"))
    return x.withColumn("status", st).select("path", F.when(F.col("status") == "sha256", F.col("id_sha")).when(F.col("status") == "phash", F.col("id_ph")).alias("sample_id"), "status")


def normal_path(path: Column) -> Column:
    """A path without empty parts, "." and "..": lexically, as no file is looked at."""
    parts = F.filter(F.split(path, "/"), lambda p: ~p.isin("", "."))
    kept = F.aggregate(parts, F.array().cast("array<string>"), lambda a, p: F.when(p == "..", F.slice(a, 1, F.greatest(F.size(a) - 1, F.lit(0)))).otherwise(F.concat(a, F.array(p))))
    return F.concat(F.when(path.startswith("/"), "/").otherwise(""), F.array_join(kept, "/"))


def task_images(sidecars: DataFrame, images: DataFrame, suffixes: Sequence[str] = (".bmp", ".jpeg", ".jpg", ".png", ".webp")) -> DataFrame:
    """sidecars(path, image_path), images(path) of one task folder to (path, image): the image of each file, or null.

    A relative path counts from the file; an absolute one by its name beside the file, else by a name unique in the task;
    without a path the file's own stem with the first suffix, in order, that exists.
    """
    folder, name = F.regexp_extract("path", "^(.*/)?", 0), F.regexp_extract("image_path", "[^/]*$", 0)
    field = F.trim(F.coalesce("image_path", F.lit("")))
    x = sidecars.withColumn("_how", F.when(field == "", "stem").when(field.startswith("/"), "name").otherwise("relative"))
    x = x.withColumn("_beside", normal_path(F.when(F.col("_how") == "name", F.concat(folder, name)).when(F.col("_how") == "relative", F.concat(folder, field))))
    x = x.withColumn("_stem", F.when(F.col("_how") == "stem", F.regexp_replace("path", r"\.[^./]+$", ""))).withColumn("_name", F.when(F.col("_how") == "name", F.lower(name)))
    at = images.where(C.suffix(F.col("path")).isin(*suffixes)).select(F.col("path").alias("image"))
    beside = at.select(normal_path(F.col("image")).alias("_beside"), F.col("image").alias("_i1")).distinct()
    named = at.groupBy(F.lower(F.regexp_extract("image", "[^/]*$", 0)).alias("_name")).agg(F.count("*").alias("_n"), F.min("image").alias("_i2"))
    stems = at.groupBy(F.regexp_replace("image", r"\.[^./]+$", "").alias("_stem")).agg(F.min(F.struct(C.suffix(F.col("image")).alias("s"), "image"))["image"].alias("_i3"))
    x = x.join(beside, "_beside", "left").join(named, "_name", "left").join(stems, "_stem", "left")
    return x.select("path", F.coalesce("_i1", F.when(F.col("_n") == 1, F.col("_i2")), "_i3").alias("image"))
