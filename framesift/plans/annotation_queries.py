"""Queries on tags, boxes, attributes, keypoints, tracks and text formats."""

from __future__ import annotations

from pyspark.sql import functions as F

from framesift.functions import columns as C
from framesift.operators import annotations as A
from framesift.plans.registry import query
from framesift.plans.standins import BOXES_SQL, TAGGED_SQL, boxes, table, tagged
from framesift.sources import payloads, textformats
from framesift.streaming import watch

_T = f"with {TAGGED_SQL}"


def _ids(x):
    return x.select("sample_id")


@query("tags_match_any", f"{_T} select sample_id from tagged where list_has_any(tags, ['purchase', 'age_3'])")
def match_any(spark, d):
    return _ids(tagged(spark, d).where(C.has_any(F.col("tags"), ["purchase", "age_3"])))


@query("tags_match_all", f"{_T} select sample_id from tagged where list_has_all(tags, ['click', 'age_0'])")
def match_all(spark, d):
    return _ids(tagged(spark, d).where(C.has_all(F.col("tags"), ["click", "age_0"])))


@query("tags_exclude_any", f"{_T} select sample_id from tagged where not list_has_any(tags, ['purchase', 'age_3'])")
def exclude_any(spark, d):
    return _ids(tagged(spark, d).where(C.has_none(F.col("tags"), ["purchase", "age_3"])))


@query("tags_distinct", f"{_T} select tag, count(*)::bigint as n from (select unnest(tags) as tag from tagged) group by 1")
def distinct_tags(spark, d):
    return tagged(spark, d).select(F.explode("tags").alias("tag")).groupBy("tag").agg(F.count("*").alias("n"))


@query("tags_appended", f"{_T} select sample_id, array_to_string(tags || list_filter(['reviewed', 'age_3'], lambda t: not list_contains(tags, t)), ',') as tags from tagged")
def append_tags(spark, d):
    return tagged(spark, d).select("sample_id", F.array_join(C.appended(F.col("tags"), ["reviewed", "age_3"]), ",").alias("tags"))


@query("attribute_from_tags", f"{_T}, c as (select sample_id, list_transform(list_filter(tags, lambda t: regexp_full_match(t, 'age_[0-9]+')), lambda t: split_part(t, '_', 2)::int) as codes from tagged) select sample_id, case when len(list_filter(codes, lambda v: v > 5)) > 0 then null else coalesce(list_max(codes), 0) end as age, len(list_filter(codes, lambda v: v > 5)) > 0 as out_of_range from c")
def attribute_from_tags(spark, d):
    codes = C.family_codes(F.col("tags"), "age")
    bad = F.exists(codes, lambda v: v > 5)
    return tagged(spark, d).select("sample_id", F.when(~bad, F.coalesce(F.array_max(codes), F.lit(0))).alias("age"), bad.alias("out_of_range"))


@query("tags_from_attribute", f"{_T}, c as (select sample_id, tags, 'age_' || (sample_id % 7) as tag, list_filter(tags, lambda t: regexp_full_match(t, 'age_[0-9]+')) as mine from tagged) select sample_id, array_to_string(case when mine = [tag] then tags else list_filter(tags, lambda t: not regexp_full_match(t, 'age_[0-9]+')) || [tag] end, ',') as tags from c")
def tags_from_attribute(spark, d):
    return tagged(spark, d).select("sample_id", F.array_join(C.family_set(F.col("tags"), "age", F.col("sample_id") % 7), ",").alias("tags"))


@query("exclusive_tag_to_field", f"{_T}, c as (select sample_id, list_distinct(list_filter(tags, lambda t: t in ('age_0', 'age_3', 'age_6'))) as hit, case when sample_id % 5 = 0 then 'age_3' end as old from tagged) select sample_id, case when len(hit) = 0 then 'skip' when len(hit) > 1 then 'several_tags' when old is null then 'write' when old = hit[1] then 'same' else 'different_value' end as status from c")
def exclusive(spark, d):
    hit = F.array_distinct(F.filter("tags", lambda t: t.isin("age_0", "age_3", "age_6")))
    old = F.when(F.col("sample_id") % 5 == 0, "age_3")
    st = F.when(F.size(hit) == 0, "skip").when(F.size(hit) > 1, "several_tags").when(old.isNull(), "write").when(old == F.get(hit, F.lit(0)), "same").otherwise("different_value")
    return tagged(spark, d).select("sample_id", st.alias("status"))


@query("rename_labels", f"with {BOXES_SQL} select sample_id, idx, case when label in ('A', 'R') then 'head' else label end as label, case label when 'A' then 'age_0' when 'R' then 'age_2' else '' end as tag from boxes")
def rename_labels(spark, d):
    dets = boxes(spark, d).groupBy("sample_id").agg(F.array_sort(F.collect_list(F.struct("idx", "label"))).alias("dets"))
    new = F.transform("dets", lambda x: F.struct(x["idx"].alias("idx"), F.when(x["label"].isin("A", "R"), "head").otherwise(x["label"]).alias("label"), F.when(x["label"] == "A", "age_0").when(x["label"] == "R", "age_2").otherwise("").alias("tag")))
    return dets.select("sample_id", F.inline(new))


@query("rename_conflicts", f"{_T} select sample_id, i - 1 as place, tags[i] as tag from (select sample_id, tags, unnest(range(1, len(tags) + 1)) as i from tagged) where tags[i] like 'age_%' and tags[i] not in ('age_0', 'age_2')")
def rename_conflicts(spark, d):
    return tagged(spark, d).select("sample_id", F.posexplode("tags").alias("p", "tag")).where("tag like 'age\\_%' and tag not in ('age_0', 'age_2')").select("sample_id", F.col("p").cast("bigint").alias("place"), "tag")


@query("labels_require_all", f"with {BOXES_SQL} select sample_id from boxes group by 1 having count_if(label = 'A') > 0 and count_if(label = 'N') > 0")
def require_all(spark, d):
    g = boxes(spark, d).groupBy("sample_id").agg(F.collect_set("label").alias("l"))
    return _ids(g.where(C.has_all(F.col("l"), ["A", "N"])))


@query("filter_boxes_by_class", f"with {BOXES_SQL} select sample_id, coalesce(string_agg(idx::varchar, ',' order by idx) filter (where label in ('A', 'N')), '') as kept from boxes group by 1")
def by_class(spark, d):
    dets = boxes(spark, d).groupBy("sample_id").agg(F.array_sort(F.collect_list(F.struct("idx", "label"))).alias("dets"))
    return dets.select("sample_id", F.array_join(F.transform(F.filter("dets", lambda x: x["label"].isin("A", "N")), lambda x: x["idx"].cast("string")), ",").alias("kept"))


_ISSUE = "case when w <= 0 or h <= 0 then 'invalid' when x >= -0.001 and y >= -0.001 and x + w <= 1.001 and y + h <= 1.001 then null when x >= 1 or y >= 1 or x + w <= 0 or y + h <= 0 then 'no_overlap' else 'partial' end"
_B = f"""with {BOXES_SQL}, o as (select *, {_ISSUE} as issue, greatest(-x, -y, x + w - 1, y + h - 1, 0.0) as overflow, greatest(x, 0.0) as x1, greatest(y, 0.0) as y1, least(x + w, 1.0) as x2, least(y + h, 1.0) as y2 from boxes),
b as (select *, case when issue is null then 'keep' when issue in ('invalid', 'no_overlap') or w > 1 or h > 1 or overflow > 0.02 or x2 - x1 <= 0.0000005 or y2 - y1 <= 0.0000005 then 'delete' else 'clip' end as action from o)"""


@query("box_bounds_issues", f"{_B} select sample_id, idx, label, issue, action from b where issue is not null")
def bounds_issues(spark, d):
    return A.bounds(boxes(spark, d)).where("issue is not null").select("sample_id", "idx", "label", "issue", "action")


@query("box_bounds_clip", f"{_B} select sample_id, idx, round_even(x1, 6) as x, round_even(y1, 6) as y, round_even(x2 - x1, 6) as w, round_even(y2 - y1, 6) as h from b where action = 'clip'")
def bounds_clip(spark, d):
    x = A.bounds(boxes(spark, d)).where("action = 'clip'")
    return x.select("sample_id", "idx", *[F.get("clipped", F.lit(k)).alias(n) for k, n in enumerate("xywh")])


@query("box_bounds_summary", f"{_B} select coalesce(issue, 'inside') as issue, action, count(*)::bigint as boxes, count(distinct sample_id)::bigint as samples from b group by 1, 2")
def bounds_summary(spark, d):
    x = A.bounds(boxes(spark, d)).groupBy(F.coalesce("issue", F.lit("inside")).alias("issue"), "action")
    return x.agg(F.count("*").alias("boxes"), F.count_distinct("sample_id").alias("samples"))


@query("box_iou_partners", f"""with {BOXES_SQL}, p as (select a.sample_id, a.label, a.idx, b.idx as partner, greatest(least(a.x + a.w, b.x + b.w) - greatest(a.x, b.x), 0.0) * greatest(least(a.y + a.h, b.y + b.h) - greatest(a.y, b.y), 0.0) as i, a.w * a.h + b.w * b.h as s
 from boxes a join boxes b on a.sample_id = b.sample_id and a.label = b.label and a.idx <> b.idx where a.w > 0 and a.h > 0 and b.w > 0 and b.h > 0)
select sample_id, label, idx, partner from p where i / (s - i) >= 0.5 qualify row_number() over (partition by sample_id, label, idx order by i / (s - i) desc, partner) = 1""")
def iou_partners(spark, d):
    return A.iou_partners(boxes(spark, d), 0.5).select("sample_id", "label", "idx", "partner")


@query("coordinate_conversions", f"with {BOXES_SQL} select sample_id, idx, round_even(x * 1920, 0) as x1, round_even(y * 1080, 0) as y1, round_even((x + w) * 1920, 0) as x2, round_even((y + h) * 1080, 0) as y2 from boxes")
def conversions(spark, d):
    x = boxes(spark, d).withColumn("p", C.pixel_corners(F.col("box"), F.lit(1920), F.lit(1080)))
    return x.select("sample_id", "idx", *[F.get("p", F.lit(k)).alias(n) for k, n in enumerate(("x1", "y1", "x2", "y2"))])


@query("export_class_resolution", f"{_T}, c as (select sample_id, coalesce(list_max(list_transform(list_filter(tags, lambda t: regexp_full_match(t, 'age_[0-9]+')), lambda t: split_part(t, '_', 2)::int)), -1) as code from tagged) select sample_id, case when greatest(code, 0) in (0, 3) then 'head-age_' || greatest(code, 0) end as class, case when greatest(code, 0) in (0, 3) then 'exported' when code < 0 then 'omitted_default' else 'omitted' end as status from c")
def class_resolution(spark, d):
    code = F.coalesce(F.array_max(C.family_codes(F.col("tags"), "age")), F.lit(-1))
    x = tagged(spark, d).select("sample_id", code.alias("code"), F.greatest(code, F.lit(0)).alias("used"))
    ok = F.col("used").isin(0, 3)
    return x.select("sample_id", F.when(ok, F.concat(F.lit("head-age_"), F.col("used").cast("string"))).alias("class"), F.when(ok, "exported").when(F.col("code") < 0, "omitted_default").otherwise("omitted").alias("status"))


_TRACK = "k as (select user_id as track, epoch_us(ts) as t, any_value(value order by event_id) as value, any_value(event_type order by event_id) = 'purchase' as outside from events where event_id % 2 = 0 and value is not null group by 1, 2), f as (select distinct user_id as track, epoch_us(ts) as t from events where event_id % 2 = 1)"


def _track(spark, d):
    e = table(spark, d, "events").withColumn("t", F.unix_micros(F.col("ts").cast("timestamp")))
    k = e.where("event_id % 2 = 0 and value is not null").groupBy(F.col("user_id").alias("track"), "t").agg(F.min(F.struct("event_id", "value", "event_type")).alias("s"))
    k = k.select("track", "t", F.col("s.value").alias("value"), (F.col("s.event_type") == "purchase").alias("outside"))
    return e.where("event_id % 2 = 1").select(F.col("user_id").alias("track"), "t").distinct(), k


@query("track_asof", f"with {_TRACK} select f.track, f.t, coalesce(k.outside, true) as outside from f asof left join k on f.track = k.track and f.t >= k.t")
def track_asof(spark, d):
    return A.interpolated(*_track(spark, d)).select("track", "t", "outside")


@query("track_interpolate", f"""with {_TRACK}, a as (select f.track, f.t, k.t as t0, k.value as v0 from f asof left join k on f.track = k.track and f.t >= k.t), b as (select f.track, f.t, k.t as t1, k.value as v1 from f asof left join k on f.track = k.track and f.t <= k.t)
select track, t, round(case when t0 is null then null when t1 is null or t1 = t0 then v0 else v0 + (v1 - v0) * (t - t0) / (t1 - t0) end, 4) as value from a join b using (track, t)""")
def track_interpolate(spark, d):
    return A.interpolated(*_track(spark, d)).select("track", "t", F.round("value", 4).alias("value"))


@query("pair_box_keypoint_by_instance", """with b as (select l_orderkey as s, l_partkey % 40 as i, min(l_partkey * 10 + l_linenumber) as box_id from lineitem group by 1, 2), k as (select l_orderkey as s, (l_partkey + (case when l_orderkey % 9 = 0 then 1 else 0 end)) % 40 as i, min(l_suppkey * 10 + l_linenumber) as kpt_id from lineitem group by 1, 2),
nb as (select s, count(*) n, min(box_id) o from b group by 1), nk as (select s, count(*) n, min(kpt_id) o from k group by 1), h as (select s, count(*) n from b join k using (s, i) group by 1),
w as (select nb.s, nb.o as ob, nk.o as ok, case when nb.n = 1 and nk.n = 1 then 'single' when nb.n = nk.n and h.n = nb.n then 'instance' else 'unpaired' end as how from nb full join nk using (s) left join h on h.s = nb.s)
select s as sample_id, how, case when how = 'single' then ob end as box_id, case when how = 'single' then ok end as kpt_id from w where how <> 'instance' union all select s, how, box_id, kpt_id from b join k using (s, i) join w using (s) where how = 'instance'""")
def pair_instances(spark, d):
    x = table(spark, d, "lineitem")
    b = x.groupBy(F.col("l_orderkey").alias("sample_id"), F.expr("l_partkey % 40").alias("instance_id")).agg(F.expr("min(l_partkey * 10 + l_linenumber)").alias("box_id"))
    k = x.groupBy(F.col("l_orderkey").alias("sample_id"), F.expr("(l_partkey + case when l_orderkey % 9 = 0 then 1 else 0 end) % 40").alias("instance_id")).agg(F.expr("min(l_suppkey * 10 + l_linenumber)").alias("kpt_id"))
    return A.pair_by_instance(b, k)


@query("keypoint_triples", "select vec_id, len(list_filter(embedding, lambda v: v > 0))::bigint as visible, round(list_max(embedding)::double - list_min(embedding)::double, 5) as extent from embeddings")
def keypoint_triples(spark, d):
    e = F.transform("embedding", lambda v: v.cast("double"))
    return table(spark, d, "embeddings").select("vec_id", F.size(F.filter(e, lambda v: v > 0)).cast("bigint").alias("visible"), F.round(F.array_max(e) - F.array_min(e), 5).alias("extent"))


@query("visibility_mapping", "select vec_id, array_to_string(list_transform(embedding, lambda v: case when v < -0.5 then 0 when v < 0.5 then 1 else 2 end), ',') as flags from embeddings")
def visibility(spark, d):
    return table(spark, d, "embeddings").select("vec_id", F.array_join(F.transform("embedding", lambda v: F.when(v < -0.5, "0").when(v < 0.5, "1").otherwise("2")), ",").alias("flags"))


@query("points_moved", "select a.vec_id, len(list_filter(range(1, 65), lambda k: abs(a.embedding[k]::double - b.embedding[k]::double) > 2.0)) > 0 as moved from embeddings a join embeddings b on b.vec_id = a.vec_id + 1")
def points_moved(spark, d):
    a = table(spark, d, "embeddings")
    b = a.select((F.col("vec_id") - 1).alias("vec_id"), F.col("embedding").alias("next"))
    return a.join(b, "vec_id").select("vec_id", F.exists(F.zip_with("embedding", "next", lambda p, q: F.abs(p.cast("double") - q.cast("double")) > 2.0), lambda v: v).alias("moved"))


@query("lenient_bool", "select event_id, case when k % 4 = 1 then true when k % 4 = 0 then false end as value from (select event_id, (props::json->>'k')::int as k from events)")
def lenient_bool(spark, d):
    k = F.get_json_object("props", "$.k").cast("int")
    text = F.when(k % 4 == 1, F.when(k % 8 == 1, ' ["Yes"] ').otherwise("true")).when(k % 4 == 0, F.when(k % 8 == 0, "0").otherwise("No")).otherwise(k.cast("string").substr(1, 0))
    return table(spark, d, "events").select("event_id", C.lenient_bool(text).alias("value"))


@query("json_answer_parse", "select event_id, (props::json->>'k')::int as k from events")
def answer_parse(spark, d):
    text = F.concat(F.lit("Sure! Here it is: ```json\n"), "props", F.lit("\n``` and {not json}"))
    return table(spark, d, "events").select("event_id", F.get_json_object(textformats.answer_json(text, "k"), "$.k").cast("int").alias("k"))


@query("yolo_text_parse", f"with {BOXES_SQL}, l as (select sample_id, idx, (ascii(label) % 4) as cls, x, y, w, h from boxes), f as (select sample_id, count_if(w <= 0 or h <= 0) as bad from l group by 1) select sample_id, idx as line, case when bad = 0 then cls end as class_id, case when bad = 0 then round(w, 4) end as w, bad > 0 as parse_error from l join f using (sample_id)")
def yolo_parse(spark, d):
    x = boxes(spark, d).select("sample_id", "idx", F.concat_ws(" ", (F.ascii("label") % 4).cast("string"), F.expr("cast(box[0] + box[2] / 2 as string)"), F.expr("cast(box[1] + box[3] / 2 as string)"), F.expr("cast(box[2] as string)"), F.expr("cast(box[3] as string)")).alias("line"))
    files = x.groupBy("sample_id").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("idx", "line"))), lambda v: v["line"]), "\n").alias("text"))
    p = textformats.parse_yolo(files, "sample_id")
    return p.select("sample_id", F.col("line").cast("bigint").alias("line"), "class_id", F.round(F.get("box", F.lit(2)), 4).alias("w"), F.col("parse_error"))


@query("coco_ids", "select l_orderkey as image, dense_rank() over (order by l_orderkey)::bigint as image_id, count(*)::bigint as annotations from lineitem group by 1")
def coco_ids(spark, d):
    x = table(spark, d, "lineitem").groupBy(F.col("l_orderkey").alias("image")).agg(F.count("*").alias("annotations"))
    return textformats.dense_ids(x, "image", "image_id")


@query("box_pairing")
def box_pairing(spark, d):
    x = boxes(spark, d).groupBy("sample_id").agg(F.transform(F.array_sort(F.collect_list(F.struct("idx", "box"))), lambda v: v["box"]).alias("a"))
    return A.compared(x.withColumn("b", F.reverse("a")), 0.005)


@query("stream_watch_once", "select event_type, count(*)::bigint as n from events group by 1")
def stream_once(spark, d):
    return watch.counted_once(spark, d)


@query("split_groups", "select doc_id, ((row_number() over (order by doc_id) - 1) // ceil(count(*) over () / 7.0)::bigint)::bigint as \"group\" from documents")
def split_groups(spark, d):
    return payloads.split_groups(table(spark, d, "documents").select("doc_id"), "doc_id", 7)


@query("shape_documents")
def shape_documents(spark, d):
    x = boxes(spark, d).groupBy("sample_id").agg(F.transform(F.array_sort(F.collect_list(F.struct("idx", "label", "box"))), lambda v: F.struct(v["label"].alias("label"), v["box"].alias("box"))).alias("dets"))
    x = x.select(F.concat(F.lit("t/"), F.col("sample_id").cast("string"), F.lit(".jpg")).alias("path"), F.col("sample_id").cast("string").alias("sample_id"), F.lit(1920).alias("width"), F.lit(1080).alias("height"), "dets")
    return payloads.shape_documents(x)
