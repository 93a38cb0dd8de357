"""Plans of exports: classes resolved, samples checked, issues as rows, counts; nothing is written here."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from framesift.functions.columns import family_codes, suffix, tags_or_empty
from framesift.functions.grammar import AttributeClasses
from framesift.sources.payloads import shape_documents
from framesift.sources.shared import numbered_within
from framesift.sources.textformats import parse_yolo_sized, yolo_lines


def require_tags(samples: DataFrame, wanted: list[str]) -> None:
    """An error if a wanted tag is at no sample, or if no sample has one of them. The driver gets the wanted tags alone."""
    known = samples.select(F.explode(tags_or_empty(F.col("tags"))).alias("tag")).where(F.col("tag").isin(*wanted)).distinct()
    missing = sorted(set(wanted) - {r.tag for r in known.collect()})
    if missing:
        raise ValueError("unknown tags: " + ", ".join(missing))


def require_rows(rows: DataFrame, what: str) -> DataFrame:
    if rows.isEmpty():
        raise ValueError(f"no {what}")
    return rows


def by_ids(samples: DataFrame, ids: DataFrame) -> DataFrame:
    """The samples with the ids of ids(sample_id), each once."""
    return samples.join(ids.select("sample_id").distinct(), "sample_id", "left_semi")


def new_only(files: DataFrame, samples: DataFrame) -> DataFrame:
    """files(path, ...) that no sample(filepath, ...) has."""
    return files.join(samples.select(F.col("filepath").alias("path")).distinct(), "path", "left_anti")


def attribute_labels(samples: DataFrame, rules: AttributeClasses) -> DataFrame:
    """samples(..., dets array<struct<label, tags, ...>>) with exported classes: kept, defaulted, omitted_default, unmapped.

    kept: dets of plain labels, and those of the attribute's labels under the class of their highest code, 0 without one.
    Codes without a class are left out: counted as omitted_default where the 0 was assumed, else named in unmapped. Other
    labels are left out and not counted.
    """
    code = lambda d: F.array_max(family_codes(d["tags"], rules.attribute))
    known = F.create_map(*[F.lit(x) for (label, n), name in sorted(rules.by_code.items()) for x in (f"{label}-{n}", name)])
    target = lambda d: F.when(d["label"].isin(*rules.plain), d["label"]).when(d["label"].isin(*rules.labels), F.try_element_at(known, F.concat(d["label"], F.lit("-"), F.coalesce(code(d), F.lit(0)).cast("string"))))
    tried = F.transform(F.coalesce("dets", F.array()), lambda d: F.struct(d.alias("d"), target(d).alias("to"), code(d).alias("code"), d["label"].isin(*rules.labels).alias("mine")))
    x = samples.withColumn("_t", F.filter(tried, lambda t: t["to"].isNotNull() | t["mine"]))
    count = lambda f: F.size(F.filter("_t", f)).cast("bigint")
    lost = F.filter("_t", lambda t: t["to"].isNull() & t["code"].isNotNull())
    return x.select(
        *samples.columns, F.transform(F.filter("_t", lambda t: t["to"].isNotNull()), lambda t: t["d"].withField("label", t["to"])).alias("kept"),
        count(lambda t: t["mine"] & t["to"].isNotNull() & t["code"].isNull()).alias("defaulted"), count(lambda t: t["to"].isNull() & t["code"].isNull()).alias("omitted_default"),
        F.transform(lost, lambda t: F.concat(t["d"]["label"], F.lit(f"-{rules.attribute}_"), t["code"].cast("string"))).alias("unmapped"),
    )


def inspected(labelled: DataFrame) -> DataFrame:
    """One row on attribute_labels(): boxes, negative_images, defaulted, omitted_default, omitted, and how often each class is there."""
    total = lambda c: F.coalesce(F.sum(c), F.lit(0)).cast("bigint")
    one = labelled.agg(total(F.size("kept")).alias("boxes"), F.count_if(F.size("kept") == 0).alias("negative_images"), total("defaulted").alias("defaulted"), total("omitted_default").alias("omitted_default"), total(F.size("unmapped")).alias("omitted"))
    classes = labelled.select(F.explode("kept.label").alias("label")).groupBy("label").agg(F.count("*").alias("n"))
    classes = classes.agg(F.array_sort(F.collect_list(F.struct("label", "n"))).alias("classes"))  # a row a class: few
    return one.crossJoin(classes)


def label_files(labelled: DataFrame, classes: list[str], stem: Column) -> DataFrame:
    """(target, text): the label file of each sample(kept array<struct<label, box>>), class ids by place in classes; empty
    for samples without boxes. Labels that classes lack are an error of the caller: their boxes are left out."""
    ids = F.create_map(*[F.lit(v) for k, c in enumerate(classes) for v in (c, k)])
    dets = F.filter(F.transform("kept", lambda d: F.struct(F.try_element_at(ids, d["label"]).alias("class_id"), d["box"].alias("box"))), lambda d: d["class_id"].isNotNull())
    return labelled.select(F.concat(F.lit("labels/"), stem, F.lit(".txt")).alias("target"), yolo_lines(dets).alias("text"))


def image_copies(samples: DataFrame, stem: Column) -> DataFrame:
    """(target, source): the image of each sample(filepath) under a name of its own."""
    return samples.select(F.concat(F.lit("images/"), stem, suffix(F.col("filepath"))).alias("target"), F.col("filepath").alias("source"))


def manifest(written: DataFrame) -> DataFrame:
    """(sample_id, relpath, sha256, shapes) of what shape_export() writes, to be a report beside it."""
    return written.select("sample_id", "relpath", F.coalesce("sha256", F.lit("")).alias("sha256"), F.coalesce(F.size("dets"), F.lit(0)).cast("bigint").alias("shapes"))


def converted(labels: DataFrame, images: DataFrame, classes: list[str]) -> DataFrame:
    """labels(stem, text), images(stem, path, width, height) to (stem, target, text, issue): a shape file for each image.

    Images without a label file and label files without an image are missing_label and missing_image; a label file with
    a bad line (strict: see parse_yolo()) is parse_error. A blank label file gives a shape file without shapes.
    """
    sized = labels.join(images, "stem")
    lines = sized.select("stem", "text", "width", "height")
    boxes = parse_yolo_sized(lines, "stem", len(classes))
    names = F.array(*[F.lit(c) for c in classes])
    one = boxes.groupBy("stem").agg(F.max("parse_error").alias("bad"), F.transform(F.array_sort(F.collect_list(F.struct("line", "class_id", "box"))), lambda b: F.struct(F.get(names, b["class_id"]).alias("label"), b["box"].alias("box"))).alias("dets"))
    x = labels.select("stem", "text").join(images, "stem", "full").join(one, "stem", "left")
    issue = F.when(F.col("path").isNull(), "missing_image").when(F.col("text").isNull(), "missing_label").when(F.col("bad"), "parse_error")
    x = x.withColumn("issue", issue)
    docs = shape_documents(x.where("issue is null").select(F.lit(None).cast("string").alias("sample_id"), "path", "width", "height", F.coalesce("dets", F.array().cast(one.schema["dets"].dataType)).alias("dets")))
    x = x.select("stem", "issue", F.regexp_replace("path", r"\.[^./]+$", ".json").alias("target"))
    return x.join(docs, "target", "left").select("stem", "target", "text", "issue")


def status_counts(rows: DataFrame, *by: str) -> DataFrame:
    """Rows by status, issue or whatever by names."""
    return rows.groupBy(*by).agg(F.count("*").alias("n"))


def label_counts(samples: DataFrame) -> DataFrame:
    """(label, n) over all dets."""
    return samples.select(F.explode("dets.label").alias("label")).groupBy("label").agg(F.count("*").alias("n"))


def upload_size(files: DataFrame, per_task: int) -> DataFrame:
    """One row on files(length): files, bytes, tasks of per_task files."""
    return files.agg(F.count("*").alias("files"), F.coalesce(F.sum("length"), F.lit(0)).cast("bigint").alias("bytes"), F.ceil(F.count("*") / per_task).cast("bigint").alias("tasks"))


def shape_export(samples: DataFrame, allowed: list[str] | None = None) -> tuple[DataFrame, DataFrame]:
    """samples(sample_id, relpath, filepath, file_exists, width, height, dets) to the samples to be written and the issues.

    A sample needs its file and a size. Boxes of other labels than allowed are an issue each (unknown_class); a sample
    that has no others is not written. Of samples with one relpath (the file's name where it is empty) the first to be
    written has it, in order of sample_id; all later ones are relpath_collision.
    """
    path = F.coalesce(F.nullif(F.trim("relpath"), F.lit("")), F.regexp_extract("filepath", "[^/]*$", 0))
    known = F.filter("dets", lambda d: d["label"].isin(*allowed)) if allowed is not None else F.col("dets")
    unknown = F.filter("dets", lambda d: ~d["label"].isin(*allowed)) if allowed is not None else F.filter("dets", lambda d: F.lit(False))
    own = F.when(~F.coalesce("file_exists", F.lit(False)), "missing_file").when(~F.coalesce((F.col("width") > 0) & (F.col("height") > 0), F.lit(False)), "missing_size")
    x = samples.withColumn("relpath", path).withColumn("own", own).withColumn("unknown", F.coalesce(unknown.getField("label"), F.array().cast("array<string>")))
    x = x.withColumn("dets", known).withColumn("fine", F.col("own").isNull() & ((F.size("unknown") == 0) | (F.size("dets") > 0)))
    first = x.where("fine").groupBy("relpath").agg(F.min("sample_id").alias("holder"))
    x = x.join(first, "relpath", "left")
    late = F.coalesce(F.col("sample_id") > F.col("holder"), F.lit(False))
    row = lambda issue, detail: F.struct(issue.alias("issue"), detail.cast("string").alias("detail"))
    rows = F.when(late, F.array(row(F.lit("relpath_collision"), F.concat(F.lit("already used by "), F.col("holder").cast("string"))))).when(F.col("own").isNotNull(), F.array(row(F.col("own"), F.col("filepath")))).otherwise(F.transform("unknown", lambda v: row(F.lit("unknown_class"), v)))
    issues = x.select("sample_id", "relpath", F.inline(rows))
    return x.where(F.col("fine") & ~late).drop("own", "unknown", "fine", "holder"), issues


def keypoint_export(samples: DataFrame) -> DataFrame:
    """samples(sample_id, filepath, file_exists, width, height, n_faces, paired) with issue and file_name.

    issue: missing_size, unpaired, no_face, and duplicate_name for all samples to be written that share a file name. A
    missing image stops the export, as do duplicate names once export_or_stop() sees them.
    """
    x = samples.withColumn("file_name", F.regexp_extract("filepath", "[^/]*$", 0))
    own = (
        F.when(~F.coalesce("file_exists", F.lit(False)), "missing_image").when(~F.coalesce((F.col("width") > 0) & (F.col("height") > 0), F.lit(False)), "missing_size")
        .when(~F.coalesce("paired", F.lit(False)), "unpaired").when(F.coalesce("n_faces", F.lit(0)) == 0, "no_face").when(F.col("file_name").isin("", ".", ".."), "bad_filename")
    )
    x = x.withColumn("issue", own)
    same = x.where("issue is null").groupBy("file_name").agg(F.count("*").alias("same"))
    x = x.join(same, "file_name", "left")
    return x.withColumn("issue", F.when(F.col("issue").isNull() & (F.col("same") > 1), "duplicate_name").otherwise(F.col("issue"))).drop("same")


def export_or_stop(planned: DataFrame) -> DataFrame:
    """The rows of keypoint_export() to be written; an error if an image is missing or a file name is taken twice."""
    stops = {r.issue: r.n for r in status_counts(planned.where("issue in ('missing_image', 'duplicate_name')"), "issue").collect()}
    if stops:
        raise ValueError("export stopped: " + ", ".join(f"{k} {n}" for k, n in sorted(stops.items())))
    return planned.where("issue is null")


def gate_copies(rows: DataFrame, existing: DataFrame) -> DataFrame:
    """rows(path, status, out_path, issue, detail) with to_write: those with a destination that existing(path) does not have.

    Where it has, dest_exists is put behind the issue and the detail.
    """
    taken = existing.select(F.col("path").alias("out_path"), F.lit(True).alias("taken")).distinct()
    x = rows.join(taken, "out_path", "left")
    there = F.col("taken").isNotNull()
    behind = lambda c: F.when(there, F.when(F.coalesce(F.col(c), F.lit("")) == "", "dest_exists").otherwise(F.concat(F.col(c), F.lit(";dest_exists")))).otherwise(F.col(c))
    return x.select(*[behind(c).alias(c) if c in ("issue", "detail") else F.col(c) for c in rows.columns], (F.coalesce("out_path", F.lit("")) != F.lit("")).alias("_has"), there.alias("_taken")).withColumn("to_write", F.col("_has") & ~F.col("_taken")).drop("_has", "_taken")


def bucket_path(root: str, bucket: Column, relative: Column) -> Column:
    """Where a file of a bucket goes: root/bucket/relative."""
    return F.concat(F.lit(root.rstrip("/") + "/"), bucket, F.lit("/"), relative)


def relative_path(path: Column, root: str) -> Column:
    """The part of a path below a root, with slashes; null outside of it."""
    path = F.replace(path, F.lit("\\"), F.lit("/"))
    return F.when(path.startswith(root.rstrip("/") + "/"), F.substring(path, len(root.rstrip("/")) + 2, 1 << 30))


def status_ranked(rows: DataFrame, order: list[str]) -> list[Column]:
    """The order of a report by status, as listed, then path; other statuses come last."""
    rank = F.coalesce(*[F.when(F.col("status") == s, k) for k, s in enumerate(order)], F.lit(len(order)))
    return [rank, F.col("path")]


def numbered_tasks(items: DataFrame, group: str, key: str, size: int) -> DataFrame:
    """items with chunk (from 0) and task: chunks of size in order of a unique key within each group.

    A task is named after its group, or group_1, group_2, ... where it has several chunks.
    """
    x = numbered_within(items, [group], [key], "_r")
    x = x.join(items.groupBy(group).agg(F.count("*").alias("_all")), group)
    x = x.withColumn("chunk", F.floor((F.col("_r") - 1) / size).cast("bigint"))
    name = F.when(F.col("_all") <= size, F.col(group)).otherwise(F.concat(F.col(group), F.lit("_"), (F.col("chunk") + 1).cast("string")))
    return x.withColumn("task", name).drop("_r", "_all")
