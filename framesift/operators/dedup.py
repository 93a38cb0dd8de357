"""Exact and near duplicates: groups, ranked keepers, sticky decisions, tags, deletion set, report shards.

Groups are aggregated before they are joined back, so that a group of any size never meets in one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from framesift.functions.columns import DUP_TAGS, tags_or_empty, with_managed
from framesift.operators.similarity import clusters
from framesift.sources.shared import numbered_within


def keeper_rank() -> Column:
    """Smaller is better: image and boxes, boxes, image, more boxes, larger area, path, id."""
    boxes, file = F.col("box_count") > 0, F.col("file_exists")
    return F.struct(*[(~c).cast("int").alias(n) for n, c in (("a", boxes & file), ("b", boxes), ("c", file))], (-F.col("box_count")).alias("d"), (-F.col("area")).alias("e"), F.col("filepath").alias("f"), F.col("sample_id").alias("g"))


def group_roles(samples: DataFrame, key: str, keep_tag: str, drop_tag: str, kind: str) -> DataFrame:
    """Members of groups of at least two rows with one non-empty key, with role (keep, drop or null), group_id and keeper.

    Without decided members the best ranked keeps. Otherwise decisions stay: a keep tag keeps, a drop tag drops, new
    members drop if there is a keeper. The keeper is the best of those that keep; null if none does.
    """
    x = samples.where(F.coalesce(F.col(key), F.lit("")) != "").withColumn("rank", keeper_rank())
    x = x.withColumn("is_keep", F.array_contains(tags_or_empty(F.col("tags")), keep_tag)).withColumn("is_drop", ~F.col("is_keep") & F.array_contains(tags_or_empty(F.col("tags")), drop_tag))
    g = x.groupBy(key).agg(F.count("*").alias("members"), F.count_if("is_keep").alias("keeps"), F.count_if(F.col("is_keep") | F.col("is_drop")).alias("decided"), F.min("rank").alias("best"), F.min(F.when(F.col("is_keep"), F.col("rank"))).alias("best_keep"))
    g = g.where("members >= 2").withColumn("keeper", F.when(F.col("decided") == 0, F.col("best")).otherwise(F.col("best_keep")))
    x = x.join(g.select(key, "members", "keeps", "decided", "keeper"), key)
    chosen = F.when(F.col("rank") == F.col("keeper"), "keep").otherwise("drop")
    kept = F.when(F.col("is_keep"), "keep").when(F.col("is_drop"), "drop").when(F.col("keeps") > 0, "drop")
    x = x.withColumn("role", F.when(F.col("decided") == 0, chosen).otherwise(kept))
    x = x.withColumn("group_id", F.concat(F.lit(f"{kind}:"), F.col(key)))
    return x.withColumn("dup_of", F.when(F.col("role") == "drop", F.col("keeper.f")))


def summary(roles: DataFrame) -> DataFrame:
    """Counts over groups with roles: groups, members, keeps, drops, conflicts (groups whose keeps are not one)."""
    g = roles.groupBy("group_id").agg(F.count("*").alias("m"), F.count_if(F.col("role") == "keep").alias("k"), F.count_if(F.col("role") == "drop").alias("d"))
    return g.agg(F.count("*").alias("groups"), *[F.coalesce(F.sum(c), F.lit(0)).cast("bigint").alias(n) for c, n in (("m", "members"), ("k", "keeps"), ("d", "drops"))], F.count_if(F.col("k") != 1).alias("conflicts"))


def plan(samples: DataFrame, exact: DataFrame, near: DataFrame) -> DataFrame:
    """For each sample: exact_role, near_role, dup_group, dup_of, new_tags and whether anything changes."""
    e = exact.select("sample_id", F.lit(True).alias("in_exact"), F.col("role").alias("exact_role"), F.col("group_id").alias("eg"), F.col("dup_of").alias("eo"), F.col("is_keep").alias("e_keep"), F.array_contains(tags_or_empty(F.col("tags")), "dup_repeat_drop").alias("e_drop"))
    n = near.select("sample_id", F.lit(True).alias("in_near"), F.col("role").alias("near_role"), F.col("group_id").alias("ng"), F.col("dup_of").alias("no"), F.col("is_keep").alias("n_keep"), F.array_contains(tags_or_empty(F.col("tags")), "dup_near_drop").alias("n_drop"))
    x = samples.join(e, "sample_id", "left").join(n, "sample_id", "left")
    on = lambda c: F.coalesce(c, F.lit(False))
    want = F.array_compact(F.array(
        F.when(on(F.col("in_exact")), F.lit(DUP_TAGS[0])),
        F.when(on(F.col("exact_role") == "keep"), F.lit(DUP_TAGS[1])),
        F.when(on(F.col("exact_role") == "drop") | on(F.col("e_keep") & F.col("e_drop")), F.lit(DUP_TAGS[2])),
        F.when(on(F.col("in_near")), F.lit(DUP_TAGS[3])),
        F.when(on(F.col("near_role") == "keep"), F.lit(DUP_TAGS[4])),
        F.when(on(F.col("near_role") == "drop") | on(F.col("n_keep") & F.col("n_drop")), F.lit(DUP_TAGS[5])),
    ))
    x = x.withColumn("new_tags", with_managed(F.col("tags"), DUP_TAGS, want))
    x = x.withColumn("new_group", F.coalesce("eg", "ng", F.lit(""))).withColumn("new_of", F.coalesce(F.when(on(F.col("in_exact")), F.col("eo")).otherwise(F.col("no")), F.lit("")))
    return x.withColumn("changed", ~F.col("new_tags").eqNullSafe(tags_or_empty(F.col("tags"))) | (F.col("new_group") != F.coalesce("dup_group", F.lit(""))) | (F.col("new_of") != F.coalesce("dup_of", F.lit(""))))


def near_roles(samples: DataFrame, exact: DataFrame, k: int = 0) -> DataFrame:
    """Roles in groups of near hashes (phash) among the samples that no exact group drops."""
    rest = samples.join(exact.where("role = 'drop'").select("sample_id"), "sample_id", "left_anti")
    rest = rest.join(clusters(rest, k), "sample_id")
    return group_roles(rest, "near_key", "dup_near_keep", "dup_near_drop", "near")


def full_plan(samples: DataFrame, k: int = 0) -> DataFrame:
    """plan() of exact groups by sha256 and then of near groups by phash over what they leave."""
    exact = group_roles(samples, "sha256", "dup_repeat_keep", "dup_repeat_drop", "exact")
    return plan(samples, exact, near_roles(samples, exact, k))


def plan_counts(planned: DataFrame) -> DataFrame:
    """One row of a plan: samples, changed, and stale: samples with tags of duplicates that are in no group any more."""
    stale = F.exists(tags_or_empty(F.col("tags")), lambda t: t.isin(*DUP_TAGS)) & F.col("in_exact").isNull() & F.col("in_near").isNull()
    return planned.agg(F.count("*").alias("samples"), F.count_if("changed").alias("changed"), F.count_if(stale).alias("stale"))


def report(roles: DataFrame, kind: str) -> DataFrame:
    """Rows of a report on group_roles(): each member with its action (keep, drop, member) and its keeper."""
    return roles.select(
        F.lit(kind).alias("kind"), F.coalesce("role", F.lit("member")).alias("action"), F.col("group_id").alias("dup_group"), "sample_id", "filepath",
        F.col("keeper.g").alias("kept_sample_id"), F.coalesce("keeper.f", F.lit("")).alias("kept_filepath"),
    )


def report_order() -> list[Column]:
    """The order of a report: kind, group, keepers first, path, id."""
    return [F.col("kind"), F.col("dup_group"), F.when(F.col("action") == "keep", 0).otherwise(1), F.col("filepath"), F.col("sample_id")]


def delete_ids(planned: DataFrame) -> DataFrame:
    """Samples that drop and whose planned tags hold no keep tag."""
    drop = (F.col("exact_role") == "drop") | (F.col("near_role") == "drop")
    return planned.where(drop & ~F.coalesce(F.arrays_overlap("new_tags", F.array(F.lit(DUP_TAGS[1]), F.lit(DUP_TAGS[4]))), F.lit(False))).select("sample_id")


def report_shards(roles: DataFrame, per_shard: int = 200) -> DataFrame:
    """Report rows with the number of their shard: whole groups, per_shard of them, in order of group_id.

    Group numbers come from a sort of the groups alone, by ranges, so that no single task sorts them all.
    """
    n = numbered_within(roles.select("group_id").distinct(), [], ["group_id"], "n")
    n = n.select("group_id", F.floor((F.col("n") - 1) / per_shard).cast("bigint").alias("shard"))
    return roles.join(n, "group_id").select("shard", "group_id", "sample_id", "role")
