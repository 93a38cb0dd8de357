"""Operators on boxes, tags, attributes, keypoints and tracks."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from framesift.functions import columns as C

# The managed tags of box checks, in their order.
BOX_TAGS = ("bad_box", "changed_box")


def bounds(boxes: DataFrame, tol: float = 0.001, clip: float = 0.02) -> DataFrame:
    """boxes(..., box) with issue, action, overflow, overlap and clipped."""
    b = F.col("box")
    x = boxes.withColumn("issue", C.box_issue(b, tol)).withColumn("action", C.box_action(b, tol, clip))
    return x.withColumn("overflow", C.box_overflow(b)).withColumn("overlap", C.box_overlap(b)).withColumn("clipped", F.when(F.col("action") == "clip", C.box_clipped(b)))


def iou_partners(boxes: DataFrame, least: float = 0.9) -> DataFrame:
    """For each valid box the box of the same sample and label with the largest IoU of at least least; ties: lower idx.

    Boxes of a sample are compared inside its row, so that no pairs are shuffled: a sample's boxes are a bounded list.
    """
    x = boxes.where(C.box_valid(F.col("box")) & (F.coalesce("label", F.lit("")) != ""))
    g = x.groupBy("sample_id", "label").agg(F.array_sort(F.collect_list(F.struct("idx", "box"))).alias("all"))
    best = F.transform("all", lambda a: F.array_max(F.transform(F.filter("all", lambda b: (b["idx"] != a["idx"]) & (C.iou(a["box"], b["box"]) >= least)), lambda b: F.struct(C.iou(a["box"], b["box"]).alias("iou"), (-b["idx"]).alias("neg")))))
    g = g.select("sample_id", "label", F.explode(F.arrays_zip("all", best.alias("best"))).alias("e"))
    return g.where("e.best is not null").select("sample_id", "label", F.col("e.all.idx").alias("idx"), (-F.col("e.best.neg")).alias("partner"), F.col("e.best.iou").alias("iou"))


def box_issues(boxes: DataFrame, tol: float = 0.001, clip: float = 0.02, least: float = 0.9) -> DataFrame:
    """boxes(sample_id, idx, label, box) to a row for each issue: (sample_id, idx, label, issue, action, partner, iou).

    Bounds issues have the action that bounds() decides; high_iou issues name the partner, and have the same box's action.
    """
    x = bounds(boxes, tol, clip).select("sample_id", "idx", "label", "issue", "action")
    none = [F.lit(None).cast("bigint").alias("partner"), F.lit(None).cast("double").alias("iou")]
    twins = iou_partners(boxes, least).join(x.select("sample_id", "idx", "action"), ["sample_id", "idx"])
    twins = twins.select("sample_id", "idx", "label", F.lit("high_iou").alias("issue"), "action", F.col("partner").cast("bigint").alias("partner"), "iou")
    return x.where("issue is not null").select("sample_id", "idx", "label", "issue", "action", *none).unionByName(twins)


def plan_tags(samples: DataFrame, issues: DataFrame) -> DataFrame:
    """samples(sample_id, tags) with new_tags: bad_box for samples with an issue, changed_box for those with a box to be
    clipped or deleted, and neither for others; and whether that is a change."""
    g = issues.groupBy("sample_id").agg(F.max(F.col("action") != "keep").alias("edits"))
    x = samples.join(g, "sample_id", "left")
    want = F.array_compact(F.array(F.when(F.col("edits").isNotNull(), F.lit(BOX_TAGS[0])), F.when(F.col("edits"), F.lit(BOX_TAGS[1]))))
    x = x.withColumn("new_tags", C.with_managed(F.col("tags"), BOX_TAGS, want)).drop("edits")
    return x.withColumn("changed", ~F.col("new_tags").eqNullSafe(C.tags_or_empty(F.col("tags"))))


def edited(samples: DataFrame, edits: DataFrame) -> DataFrame:
    """samples(sample_id, dets array<struct<box,...>>) after edits(sample_id, idx, box): a box replaces, null deletes.

    A sample with an edit beyond its list is left as it is.
    """
    e = edits.groupBy("sample_id").agg(F.map_from_entries(F.collect_list(F.struct("idx", F.struct("box")))).alias("edits"))
    x = samples.join(e, "sample_id", "left")
    ok = F.col("edits").isNotNull() & (F.coalesce(F.array_max(F.map_keys("edits")), F.lit(-1)) < F.size("dets"))
    items = F.transform("dets", lambda d, i: F.struct(d.alias("d"), i.alias("i")))
    kept = F.filter(items, lambda t: ~F.map_contains_key("edits", t["i"]) | F.element_at("edits", t["i"])["box"].isNotNull())
    new = F.transform(kept, lambda t: F.when(F.map_contains_key("edits", t["i"]), t["d"].withField("box", F.element_at("edits", t["i"])["box"])).otherwise(t["d"]))
    return x.withColumn("dets", F.when(ok, new).otherwise(F.col("dets"))).drop("edits")


def interpolated(frames: DataFrame, keyframes: DataFrame) -> DataFrame:
    """frames(track, t), keyframes(track, t, value, outside) to the value at each frame.

    Before the first keyframe: outside, no value. Between two: linear. After the last: its value. Flags come from the
    keyframe at or before. One sort of each track's rows: frames and keyframes are united, no join.
    """
    from pyspark.sql import Window

    k = keyframes.select("track", "t", F.col("value").cast("double").alias("value"), "outside", F.lit(0).alias("kind"))
    f = frames.select("track", "t", F.lit(None).cast("double").alias("value"), F.lit(None).cast("boolean").alias("outside"), F.lit(1).alias("kind"))
    x = k.unionByName(f).withColumn("kt", F.when(F.col("kind") == 0, F.col("t")))
    back = Window.partitionBy("track").orderBy("t", "kind").rowsBetween(Window.unboundedPreceding, 0)
    ahead = Window.partitionBy("track").orderBy("t", F.desc("kind")).rowsBetween(0, Window.unboundedFollowing)
    x = x.select("track", "t", "kind", F.last("kt", True).over(back).alias("t0"), F.last("value", True).over(back).alias("v0"), F.last("outside", True).over(back).alias("o0"), F.first("kt", True).over(ahead).alias("t1"), F.first("value", True).over(ahead).alias("v1"))
    v = F.when(F.col("t0").isNull(), None).when(F.col("t1").isNull() | (F.col("t1") == F.col("t0")), F.col("v0")).otherwise(F.col("v0") + (F.col("v1") - F.col("v0")) * (F.col("t") - F.col("t0")) / (F.col("t1") - F.col("t0")))
    return x.where("kind = 1").select("track", "t", v.alias("value"), F.coalesce("o0", F.lit(True)).alias("outside"))


def pair_by_instance(boxes: DataFrame, points: DataFrame) -> DataFrame:
    """boxes(sample_id, instance_id, box_id), points(sample_id, instance_id, kpt_id): pairs, or unpaired samples.

    A single box and a single point set pair without ids; otherwise all need distinct ids that find each other.
    """
    b = boxes.groupBy("sample_id").agg(F.count("*").alias("nb"), F.count_distinct("instance_id").alias("db"), F.min("box_id").alias("one_b"))
    k = points.groupBy("sample_id").agg(F.count("*").alias("nk"), F.count_distinct("instance_id").alias("dk"), F.min("kpt_id").alias("one_k"))
    m = boxes.join(points, ["sample_id", "instance_id"])
    hits = m.groupBy("sample_id").agg(F.count("*").alias("hits"))
    s = b.join(k, "sample_id", "full").join(hits, "sample_id", "left")
    single = (F.col("nb") == 1) & (F.col("nk") == 1)
    all_ = (F.col("nb") == F.col("nk")) & (F.col("db") == F.col("nb")) & (F.col("dk") == F.col("nk")) & (F.col("hits") == F.col("nb"))
    s = s.select("sample_id", "one_b", "one_k", F.when(F.coalesce(single, F.lit(False)), "single").when(F.coalesce(all_, F.lit(False)), "instance").otherwise("unpaired").alias("how"))
    one = s.where("how <> 'instance'").select("sample_id", "how", F.when(F.col("how") == "single", F.col("one_b")).alias("box_id"), F.when(F.col("how") == "single", F.col("one_k")).alias("kpt_id"))
    return one.unionByName(m.join(s.where("how = 'instance'").select("sample_id", "how"), "sample_id").select("sample_id", "how", "box_id", "kpt_id"))


def perfect_matching(a: list, b: list, tol: float) -> list[int] | None:
    """For each box of a (lists of 4 numbers) one of b within tol per component, all different; null if there is none."""
    if len(a) != len(b):
        return None
    fits = [[j for j, y in enumerate(b) if all(abs(p - q) <= tol for p, q in zip(x, y, strict=True))] for x in a]
    owner: dict[int, int] = {}
    place: dict[int, int] = {}
    for start in range(len(a)):  # an augmenting path from each box, breadth first: no recursion
        came: dict[int, int] = {}  # b's box: the box of a that it was reached from
        queue, end = [start], None
        while queue and end is None:
            following = []
            for i in queue:
                for j in fits[i]:
                    if j not in came:
                        came[j] = i
                        if j not in owner:
                            end = j
                            break
                        following.append(owner[j])
                if end is not None:
                    break
            queue = following
        if end is None:
            return None
        while end is not None:
            i = came[end]
            owner[end], place[i], end = i, end, place.get(i)
    return [place[i] for i in range(len(a))]


def greedy_matching(a: list, b: list, tol: float) -> bool:
    """Whether each box of a, in order, takes the nearest free one of b by the largest difference, never over tol."""
    free = list(range(len(b)))
    for x in a:
        best = min(((max(abs(p - q) for p, q in zip(x, b[j], strict=True)), j) for j in free), default=None)
        if best is None or best[0] > tol:
            return False
        free.remove(best[1])
    return len(a) == len(b)


def staged_assignment(old: list, new: list, tol: float = 5.0) -> list[int | None]:
    """For each new face (box, points) an old one: first by box, then by points, then the only one left on both sides."""
    taken: dict[int, int] = {}
    for part in (0, 1):
        for i, f in enumerate(new):
            if i in taken:
                continue
            for j, o in enumerate(old):
                if j not in taken.values() and len(f[part]) == len(o[part]) and all(abs(p - q) <= tol for p, q in zip(f[part], o[part], strict=True)):
                    taken[i] = j
                    break
    rest = [i for i in range(len(new)) if i not in taken]
    left = [j for j in range(len(old)) if j not in taken.values()]
    if len(rest) == len(left) == 1:
        taken[rest[0]] = left[0]
    return [taken.get(i) for i in range(len(new))]


def compared(groups: DataFrame, tol: float) -> DataFrame:
    """groups(sample_id, a, b arrays of boxes) with perfect and greedy: whether the boxes match either way."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for p in batches:
            a = [[list(x) for x in v] for v in p["a"]]
            b = [[list(x) for x in v] for v in p["b"]]
            pairs = list(zip(a, b, strict=True))
            yield pd.DataFrame({"sample_id": p["sample_id"], "perfect": [perfect_matching(x, y, tol) is not None for x, y in pairs], "greedy": [greedy_matching(sorted(x), sorted(y), tol) for x, y in pairs]})

    return groups.select("sample_id", "a", "b").mapInPandas(run, "sample_id bigint, perfect boolean, greedy boolean")
