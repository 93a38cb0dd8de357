"""Matching joins with explicit outcomes for ambiguous, missing and colliding rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from framesift.functions.columns import name_key, stem, suffix
from framesift.sources.shared import numbered_within


def gate(candidates: DataFrame, samples: DataFrame) -> DataFrame:
    """candidates(path, sha256, phash) against samples(sample_id, sha256, phash): batch_dup, exact, near or new.

    Later candidates of the same content are batch_dup, with the first path as detail; near has the first such sample.
    """
    first = candidates.groupBy("sha256").agg(F.min("path").alias("first_path"))
    exact = samples.groupBy("sha256").agg(F.count("*").alias("hits"))
    near = samples.where("phash is not null and phash <> ''").groupBy("phash").agg(F.min("sample_id").alias("near_id"))
    x = candidates.join(first, "sha256", "left").join(exact, "sha256", "left").join(near, "phash", "left")
    status = F.when(F.col("path") > F.col("first_path"), "batch_dup").when(F.col("hits").isNotNull(), "exact").when(F.col("near_id").isNotNull(), "near").otherwise("new")
    return x.withColumn("status", status).withColumn("detail", F.when(F.col("status") == "batch_dup", F.col("first_path")).when(F.col("status") == "near", F.col("near_id")))


def unique_match(images: DataFrame, samples: DataFrame) -> DataFrame:
    """images(path, sha256, phash) to samples: by content hash; only without a hit by perceptual hash. Both must be unique."""
    a = samples.where("sha256 is not null").groupBy("sha256").agg(F.count("*").alias("n_sha"), F.min("sample_id").alias("id_sha"))
    b = samples.where("phash is not null").groupBy("phash").agg(F.count("*").alias("n_ph"), F.min("sample_id").alias("id_ph"))
    x = images.join(a, "sha256", "left").join(b, "phash", "left")
    how = F.when(F.col("n_sha") > 1, "ambiguous_sha256").when(F.col("n_sha") == 1, "sha256").when(F.col("n_ph") > 1, "ambiguous_phash").when(F.col("n_ph") == 1, "phash").otherwise("unmatched")
    return x.withColumn("how", how).withColumn("sample_id", F.when(F.col("how") == "sha256", F.col("id_sha")).when(F.col("how") == "phash", F.col("id_ph")))


def relink(samples: DataFrame, files: DataFrame) -> DataFrame:
    """samples(sample_id, filepath, sha256) to files(sha256, target) of the same content, with a status and target."""
    base = lambda p: F.regexp_extract(p, "[^/]*$", 0)
    t = files.groupBy("sha256").agg(F.sort_array(F.collect_set("target")).alias("targets"))
    x = samples.where("sha256 is not null").join(t, "sha256")
    x = x.withColumn("same", F.filter("targets", lambda p: base(p) == base(F.col("filepath"))))
    what = F.when(F.array_contains("targets", F.col("filepath")), "unchanged").when((F.size("targets") == 1) | (F.size("same") == 1), "move").otherwise("ambiguous_image_hash")
    x = x.withColumn("what", what).withColumn("target", F.when(F.size("targets") == 1, F.get("targets", F.lit(0))).when(F.size("same") == 1, F.get("same", F.lit(0))))
    owners = samples.select(F.col("filepath").alias("target"), F.lit(True).alias("owned")).distinct()
    takers = x.where("what = 'move'").groupBy("target").agg(F.count("*").alias("takers"))
    x = x.join(owners, "target", "left").join(takers, "target", "left")
    move = F.col("what") == "move"
    return x.withColumn("status", F.when(move & F.col("owned"), "target_already_registered").when(move & (F.col("takers") > 1), "sample_hash_collision").otherwise(F.col("what")))


def rename_plan(files: DataFrame) -> DataFrame:
    """files(parent, name, sha256) with target: <parent>/<sha256>[-n]<ext>; the canonical name first, then by name."""
    x = files.withColumn("_s", suffix(F.col("name"))).withColumn("_other", F.col("name") != F.concat("sha256", suffix(F.col("name"))))
    x = numbered_within(x, ["parent", "sha256", "_s"], ["_other", "name"], "n")
    return x.withColumn("target", F.concat("parent", F.lit("/"), "sha256", F.when(F.col("n") > 1, F.concat(F.lit("-"), F.col("n").cast("string"))).otherwise(""), "_s")).drop("_s", "_other")


def pair_full(images: DataFrame, labels: DataFrame) -> DataFrame:
    """images(path), labels(path) by stem: pair, path_collision, missing_image, missing_label."""
    a = images.groupBy(stem(F.col("path")).alias("stem")).agg(F.count("*").alias("n"))
    b = labels.groupBy(stem(F.col("path")).alias("stem")).agg(F.count("*").alias("m"))
    status = F.when((F.col("n") > 1) | (F.col("m") > 1), "path_collision").when(F.col("n").isNull(), "missing_image").when(F.col("m").isNull(), "missing_label").otherwise("pair")
    return a.join(b, "stem", "full").select("stem", status.alias("status"))


def orphan_labels(images: DataFrame, labels: DataFrame) -> DataFrame:
    return labels.select(stem(F.col("path")).alias("stem")).join(images.select(stem(F.col("path")).alias("stem")), "stem", "left_anti")


def rows_by_stem(rows: DataFrame, images: DataFrame, keep: bool) -> DataFrame:
    """Rows whose path has the stem of an image; those that have none, if not keep."""
    return rows.select(stem(F.col("path")).alias("stem")).join(images.select(stem(F.col("path")).alias("stem")), "stem", "left_semi" if keep else "left_anti")


def extraction_plan(sources: DataFrame, names: DataFrame, by: str = "stem", out: str = "", existing: DataFrame | None = None) -> DataFrame:
    """For each wanted name: copy, collision (several sources for one destination) or missing.

    out, existing(path): where files go, and what is there; a source whose destination out/name is taken is skipped.
    """
    n = names.select(name_key(F.col("path"), by).alias("stem")).distinct()
    c = sources.groupBy(name_key(F.col("path"), by).alias("stem")).agg(F.count("*").alias("k"), F.min("path").alias("source"))
    status = F.when(F.col("k").isNull(), "missing").when(F.col("k") > 1, "collision")
    if existing is None:
        return n.join(c, "stem", "left").select("stem", status.otherwise("copy").alias("status"))
    x = n.join(c, "stem", "left").withColumn("dest", F.concat(F.lit(out.rstrip("/") + "/"), F.regexp_extract("source", r"[^/\\]*$", 0)))
    x = x.join(existing.select(F.col("path").alias("dest"), F.lit(True).alias("taken")).distinct(), "dest", "left")
    return x.select("stem", status.when(F.col("taken"), "skipped").otherwise("copy").alias("status"))


def leaf_plan(images: DataFrame, labels: DataFrame, samples: DataFrame) -> DataFrame:
    """images(path), labels(path), samples(filepath) to (path, label, status) for each image: new, known, stem_collision.

    Images that samples have are known. Of images with one stem none is imported. label is the label file of the stem (the
    last by path), null for an unlabelled image.
    """
    same = images.groupBy(stem(F.col("path")).alias("stem")).agg(F.count("*").alias("same"))
    found = labels.groupBy(stem(F.col("path")).alias("stem")).agg(F.max("path").alias("label"))
    known = samples.select(F.col("filepath").alias("path"), F.lit(True).alias("known")).distinct()
    x = images.withColumn("stem", stem(F.col("path"))).join(same, "stem").join(found, "stem", "left").join(known, "path", "left")
    return x.select("path", "label", F.when(F.col("same") > 1, "stem_collision").when(F.col("known"), "known").otherwise("new").alias("status"))


def import_counts(planned: DataFrame, orphans: DataFrame) -> DataFrame:
    """One row on leaf_plan() and orphan_labels(): images, new, labelled, known, collisions, orphans."""
    new = F.col("status") == "new"
    return planned.agg(F.count("*").alias("images"), F.count_if(new).alias("new"), F.count_if(new & F.col("label").isNotNull()).alias("labelled"), F.count_if(F.col("status") == "known").alias("known"), F.count_if(F.col("status") == "stem_collision").alias("collisions")).crossJoin(orphans.agg(F.count("*").alias("orphans")))


def attach(files: DataFrame, samples: DataFrame) -> DataFrame:
    """files(path, claimed, sha256) to samples(sample_id, sha256): a claimed id decides alone; else a unique hash.

    The first file of a sample by path wins; later ones are sample_id_collision.
    """
    by_id = samples.select(F.col("sample_id").alias("claimed"), F.col("sample_id").alias("by_id")).distinct()
    by_hash = samples.groupBy("sha256").agg(F.count("*").alias("n"), F.min("sample_id").alias("by_hash"))
    x = files.join(by_id, "claimed", "left").join(by_hash, "sha256", "left")
    claimed = F.col("claimed").isNotNull()
    st = F.when(claimed & F.col("by_id").isNull(), "orphan_sample_id").when(claimed, "match").when(F.col("n").isNull(), "orphan").when(F.col("n") > 1, "ambiguous").otherwise("match")
    x = x.withColumn("st", st).withColumn("sample_id", F.when(claimed, F.col("by_id")).when(F.col("n") == 1, F.col("by_hash")))
    first = x.where("st = 'match'").groupBy("sample_id").agg(F.min("path").alias("first_path"))
    x = x.join(first, "sample_id", "left")
    return x.select("path", F.when((F.col("st") == "match") & (F.col("path") > F.col("first_path")), "sample_id_collision").otherwise(F.col("st")).alias("status"), "sample_id")
