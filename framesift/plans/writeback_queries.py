"""Queries on what goes to annotation and comes back: boxes, faces, attributes, drawings, hashes of images, exports."""

from __future__ import annotations

from pyspark.sql import functions as F

from framesift.functions import imagehash
from framesift.functions import keypoints as K
from framesift.operators import writeback as W
from framesift.plans.registry import query
from framesift.plans.standins import BOXES_SQL, TAGGED_SQL, boxes, samples, samples_sql, table, tagged
from framesift.sources import files, textformats

_T, _B = f"with {TAGGED_SQL}", f"with {BOXES_SQL}"


def _detections(spark, d, *fields):
    """A row for each sample, with its boxes in order."""
    x = boxes(spark, d).withColumn("tags", F.array(F.concat(F.lit("age_"), (F.col("idx") * 3).cast("string")), F.concat(F.lit("by_"), "label")))
    x = x.withColumn("attributes", F.when(F.col("idx") % 2 == 0, F.create_map(F.lit("age"), F.col("sample_id") % 8)).cast("map<string,string>"))
    g = x.groupBy("sample_id").agg(F.array_sort(F.collect_list(F.struct("idx", "label", "box", "tags", "attributes").dropFields("attributes"))).alias("s"), F.map_from_entries(F.collect_list(F.struct("idx", "attributes"))).alias("m"))
    det = lambda v: F.struct(v["idx"].alias("idx"), v["label"].alias("label"), v["box"].alias("box"), v["tags"].alias("tags"), F.element_at("m", v["idx"]).alias("attributes"))
    return g.select("sample_id", F.transform("s", det).alias("dets"))


@query("replace_class_boxes", f"{_B} select sample_id, coalesce(string_agg(idx::varchar, ',' order by idx) filter (where label <> 'A'), '') || '|' || coalesce(string_agg((idx + 100)::varchar, ',' order by idx) filter (where label = 'A'), '') as kept from boxes group by 1")
def replace_class_boxes(spark, d):
    new = F.transform("dets", lambda v: v.withField("idx", v["idx"] + 100))
    x = _detections(spark, d).select("sample_id", W.replaced_classes(F.col("dets"), new, ["A"]).alias("all"))
    part = lambda old: F.array_join(F.transform(F.filter("all", lambda v: (v["idx"] < 100) == F.lit(old)), lambda v: v["idx"].cast("string")), ",")
    return x.select("sample_id", F.concat(part(True), F.lit("|"), part(False)).alias("kept"))


@query("batch_tags", f"{_T}, r as (select sample_id, list_filter(tags, lambda t: t not in ('click', 'changed')) as rest from tagged) select sample_id, array_to_string(case when sample_id % 2 = 0 then rest || ['click', 'changed', 'xlabel_checked'] else rest end, ',') as tags from r")
def batch_tags(spark, d):
    return tagged(spark, d).select("sample_id", F.array_join(W.batch_tags(F.col("tags"), ["click"], F.col("sample_id") % 2 == 0, checked=True), ",").alias("tags"))


@query("attribute_on_boxes", f"{_B} select sample_id, idx, case when idx * 3 between 3 and 12 then (idx * 3)::varchar when idx % 2 = 0 then (sample_id % 8)::varchar end as age, case when idx * 3 between 3 and 12 then null else 'out_of_range' end as issue, idx * 3 between 3 and 12 and idx % 2 = 0 and idx * 3 <> sample_id % 8 as replaced from boxes")
def attribute_on_boxes(spark, d):
    x = _detections(spark, d).select("sample_id", F.inline(W.attribute_from_tags(F.col("dets"), "age", 3, 12)))
    return x.select("sample_id", "det.idx", F.element_at("det.attributes", "age").alias("age"), "issue", "replaced")


@query("tags_on_boxes", f"{_B} select sample_id, idx, case when idx % 2 = 1 or sample_id % 8 > 5 then 'age_' || idx * 3 || ',by_' || label when idx * 3 = sample_id % 8 then 'age_' || idx * 3 || ',by_' || label else 'by_' || label || ',age_' || sample_id % 8 end as tags, case when idx % 2 = 1 then 'missing_value' when sample_id % 8 > 5 then 'unexpected_value' end as issue from boxes")
def tags_on_boxes(spark, d):
    x = _detections(spark, d).select("sample_id", F.inline(W.tags_from_attribute(F.col("dets"), "age", 0, 5)))
    return x.select("sample_id", "det.idx", F.array_join("det.tags", ",").alias("tags"), "issue")


@query("boxes_pulled_back", f"{_B} select sample_id, count(*)::bigint as boxes, sample_id % 2 = 1 and count_if(label in ('A', 'N')) > 0 as changed, sample_id % 2 = 1 and count_if(label in ('A', 'N')) > 0 as tagged from boxes group by 1")
def boxes_pulled_back(spark, d):
    x = _detections(spark, d)
    far = F.when(F.col("sample_id") % 2 == 1, 0.01).otherwise(0.0001)
    after = F.transform("dets", lambda v: v.withField("box", F.array(v["box"][0] + far, v["box"][1], v["box"][2], v["box"][3])).withField("tags", F.array().cast("array<string>")))
    x = x.select("sample_id", F.array(F.lit("old")).alias("tags"), F.lit(1920).alias("width"), F.lit(1080).alias("height"), F.col("dets").alias("before"), after.alias("after"))
    p = W.pulled_boxes(x, ["A", "N"], ["batch1"], ["age"])
    return p.select("sample_id", F.size("dets").cast("bigint").alias("boxes"), "changed", F.array_contains("tags", "batch1").alias("tagged"))


@query("faces_pulled_back")
def faces_pulled_back(spark, d):
    far = F.when(F.col("sample_id") % 2 == 1, 0.01).otherwise(0.0001)
    corner = lambda v, k: F.array(v["box"][0] + v["box"][2] * k, v["box"][1] + v["box"][3] * k)
    old = F.transform("dets", lambda v: F.struct(v["box"].alias("box"), F.array(corner(v, 0), corner(v, 1)).alias("points"), F.concat(F.lit("i"), v["idx"].cast("string")).alias("instance_id"), v["tags"].alias("tags")))
    x = _detections(spark, d).select("sample_id", F.lit(1920).alias("width"), F.lit(1080).alias("height"), old.alias("old"))
    x = x.withColumn("new", F.transform("old", lambda v: F.struct(F.transform(v["box"], lambda q, k: F.when(k == 0, q + far).otherwise(q)).alias("box"), v["points"].alias("points"))))
    p = W.pulled_faces(x)
    return p.select("sample_id", F.size("faces").cast("bigint").alias("faces"), "changed", F.array_join(F.transform("faces", lambda v: F.coalesce(v["instance_id"], F.lit("new"))), ",").alias("instances"))


@query("pair_by_group", """with b as (select l_orderkey as frame, case when l_linenumber % 3 = 0 then 0 else l_linenumber end as grp, l_partkey as id from lineitem), f as (select l_orderkey as frame, case when l_linenumber % 3 = 0 then 0 else l_linenumber - l_orderkey % 2 end as grp, l_suppkey as id from lineitem),
bn as (select *, row_number() over (partition by frame, grp order by id) as n from b), fn as (select *, row_number() over (partition by frame, grp order by id) as n from f),
lb as (select frame, count(*) c, min(id) id from b where grp = 0 group by 1), lf as (select frame, count(*) c, min(id) id from f where grp = 0 group by 1)
select bn.frame, bn.id as box, fn.id as points, null::varchar as issue from bn join fn using (frame, grp, n) where grp <> 0
union all select frame, case when lb.c = 1 and lf.c = 1 then lb.id end, case when lb.c = 1 and lf.c = 1 then lf.id end, case when lb.c = 1 and lf.c = 1 then null else 'unpaired_shapes' end from lb join lf using (frame)""")
def pair_by_group(spark, d):
    x = table(spark, d, "lineitem")
    b = x.selectExpr("l_orderkey as frame", "if(l_linenumber % 3 = 0, null, l_linenumber) as grp", "l_partkey as ord", "l_partkey as box")
    f = x.selectExpr("l_orderkey as frame", "if(l_linenumber % 3 = 0, 0, l_linenumber - l_orderkey % 2) as grp", "l_suppkey as ord", "l_suppkey as points")
    return W.pair_by_group(b, f)


@query("attach_faces", """with f as (select page_id as path, sha256('d' || (page_id % 200)) as sha, (page_id % 90)::varchar as ph from pages), s as (select doc_id as id, sha256('d' || (doc_id * 7 % 240)) as sha, (doc_id % 400)::varchar as ph from documents),
n as (select sha, count(*) same from f group by 1), a as (select sha, count(*) k, min(id) id from s group by 1), b as (select ph, count(*) k, min(id) id from s group by 1),
x as (select path, a.id as ida, b.id as idb, case when same > 1 then 'duplicate_digest' when a.k > 1 then 'ambiguous_sha256' when a.k = 1 then 'sha256' when b.k > 1 then 'ambiguous_phash' when b.k = 1 then 'phash' else 'unmatched' end as st from f left join n using (sha) left join a using (sha) left join b using (ph)),
c as (select distinct ida as idb from x where st = 'sha256'), t as (select idb, count(*) askers from x where st = 'phash' group by 1),
y as (select path, ida, idb, case when st = 'phash' and idb in (select idb from c) then 'phash_taken' when st = 'phash' and askers > 1 then 'duplicate_phash' else st end as status from x left join t using (idb))
select path, case status when 'sha256' then ida when 'phash' then idb end as sample_id, status from y""")
def attach_faces(spark, d):
    f = table(spark, d, "pages").selectExpr("page_id as path", "sha2(concat('d', page_id % 200), 256) as sha256", "cast(page_id % 90 as string) as phash")
    s = table(spark, d, "documents").selectExpr("doc_id as sample_id", "sha2(concat('d', doc_id * 7 % 240), 256) as sha256", "cast(doc_id % 400 as string) as phash")
    return W.attached_faces(f, s)


@query("task_images", """with s as (select doc_id as path, case doc_id % 4 when 0 then 'stem' when 1 then 'relative' when 2 then 'absolute' else 'outside' end as how from documents)
select 't/a/' || path || '.json' as path, case how when 'stem' then 't/a/' || path || '.jpg' when 'relative' then 't/b/' || path || '.jpg' when 'absolute' then 't/a/' || path || '.jpg' end as image from s""")
def task_images(spark, d):
    x = table(spark, d, "documents")
    field = "case doc_id % 4 when 0 then ' ' when 1 then concat('./x/../../b/', doc_id, '.jpg') when 2 then concat('/mnt/else/', doc_id, '.jpg') else concat('../../', doc_id, '.jpg') end"
    sidecars = x.selectExpr("concat('t/a/', doc_id, '.json') as path", f"{field} as image_path")
    return W.task_images(sidecars, x.selectExpr("inline(transform(array('a', 'b'), f -> struct(concat('t/', f, '/', doc_id, '.jpg') as path)))"))


@query("skeleton_markup", """with n as (select n_regionkey as region, n_name as name, row_number() over (partition by n_regionkey order by n_name) - 1 as i from nation)
select region, string_agg('<circle r="0.75" cx="' || (8 + i % 7 * 12) || '" cy="' || (8 + i // 7 * 14) || '" data-type="element node" data-element-id="' || i || '" data-node-id="' || i || '" data-label-name="' || name || '"/>', '' order by i) || '<line x1="0" y1="0" x2="1" y2="1" data-type="edge" data-node-from="1" data-node-to="2"/>' as markup from n group by 1""")
def skeleton_markup(spark, d):
    g = table(spark, d, "nation").groupBy(F.col("n_regionkey").alias("region")).agg(F.array_sort(F.collect_list("n_name")).alias("names"))
    return g.select("region", K.skeleton_markup(F.col("names"), F.array(F.array(F.lit(1), F.lit(2)), F.array(F.lit(3)))).alias("markup"))


@query("upload_shapes", f"{_B}, c as (select sample_id, idx + 1 as grp, round_even(x * 1920, 0)::int as x1, round_even(y * 1080, 0)::int as y1, round_even((x + w) * 1920, 0)::int as x2, round_even((y + h) * 1080, 0)::int as y2 from boxes) select sample_id, grp, 'rectangle' as type, concat_ws(',', x1, y1, x2, y2) as points, 0::bigint as hidden from c union all select sample_id, grp, 'skeleton', '', 1 from c")
def upload_shapes(spark, d):
    point = lambda v, k, n: F.struct((v["box"][0] + v["box"][2] * k).alias("x"), v["box"][1].alias("y"), F.lit(n).alias("v"))
    pairs = F.transform("dets", lambda v: F.struct(v["box"].alias("box"), F.array(point(v, 0.0, 2), point(v, 0.5, 1), point(v, 1.0, 0)).alias("points")))
    s = K.upload_shapes(pairs, F.lit(1920), F.lit(1080), F.lit(0), 7, 8, [11, 12, 13])
    x = _detections(spark, d).select("sample_id", F.inline(s))
    return x.select("sample_id", F.col("group").cast("bigint").alias("grp"), "type", F.array_join(F.transform("points", lambda v: v.cast("string")), ",").alias("points"), F.size(F.filter("elements", lambda e: e["outside"])).cast("bigint").alias("hidden"))


@query("stored_visibility", "select event_id, case when k % 6 = 5 then 0 when k % 6 = 0 then 0 else 2 end as of_42, case when k % 6 = 5 then 0 when k % 6 = 0 then 2 else 1 end as of_68 from (select event_id, (props::json->>'k')::int as k from events)")
def stored_visibility(spark, d):
    k = F.get_json_object("props", "$.k").cast("int") % 6
    flag = F.when(k != 5, k)
    return table(spark, d, "events").select("event_id", K.stored_visibility(flag, 42).alias("of_42"), K.stored_visibility(flag, 68).alias("of_68"))


@query("size_outcomes", f"{_B} select sample_id, idx, case when sample_id % 3 = 0 then 'same' when least(x * 100, y * 100) >= -1 and x * 100 + w * 100 <= 101 and y * 100 + h * 100 <= 101 then 'rescaled' else 'size_mismatch' end as outcome from boxes")
def size_outcomes(spark, d):
    b = F.transform("box", lambda v: v * 100)
    points = F.array(F.struct(F.lit(float("nan")).alias("x"), F.lit(0.0).alias("y")))
    stated = F.when(F.col("sample_id") % 3 == 0, 100).otherwise(90)
    return boxes(spark, d).select("sample_id", "idx", K.size_outcome(b, points, (stated, F.lit(100)), (F.lit(100), F.lit(100))).alias("outcome"))


@query("media_phash")
def media_phash(spark, d):
    """Grey images of 8 x 8 made of the 64 components of vectors."""
    hexes = F.transform("embedding", lambda v: F.lpad(F.hex(F.greatest(F.lit(0), F.least(F.lit(255), F.floor(v * 40 + 128))).cast("bigint")), 2, "0"))
    image = F.struct(F.unhex(F.array_join(hexes, "")).alias("data"), F.lit(8).alias("height"), F.lit(8).alias("width"), F.lit(1).alias("nChannels"))
    return table(spark, d, "embeddings").select("vec_id", imagehash.perceptual_hash(image).alias("phash"))


@query("enrichment_work", "select count_if(doc_id % 3 = 0)::bigint as no_sha256, count_if(doc_id % 4 = 0 or doc_id % 5 = 0)::bigint as stale_phash from documents")
def enrichment_work(spark, d):
    x = table(spark, d, "documents").selectExpr("if(doc_id % 3 = 0, '', 'a') as sha256", "if(doc_id % 4 = 0, null, 'b') as phash", f"if(doc_id % 5 = 0, 'older', '{imagehash.ALGORITHM}') as algorithm")
    return x.agg(F.count_if(F.coalesce("sha256", F.lit("")) == "").alias("no_sha256"), F.count_if(~imagehash.hash_is_current(F.col("phash"), F.col("algorithm"))).alias("stale_phash"))


@query("export_sequence_names", f"with b as (select sample_id, list(distinct label) as present from (with {BOXES_SQL} select * from boxes) group by 1), n as (select *, row_number() over (order by sample_id) as n from b) select sample_id, coalesce(nullif(array_to_string(list_filter(['R', 'A'], lambda c: list_contains(present, c)), '__'), ''), 'negative') || '_' || case when n < 1000000 then lpad(n::varchar, 6, '0') else n::varchar end as name from n")
def sequence_names(spark, d):
    g = boxes(spark, d).groupBy("sample_id").agg(F.collect_set("label").alias("present"))
    return textformats.dense_ids(g, "sample_id", "n").select("sample_id", textformats.export_stem(F.col("present"), ["R", "A"], F.col("n")).alias("name"))


@query("updates_applied", f"with {samples_sql()} select sample_id, case when sample_id % 3 = 0 then null else dup end as dup_group, area from (select sample_id, '' as dup, area from samples where sample_id % 5 <> 1)")
def updates_applied(spark, d):
    s = samples(spark, d)
    changes = s.where("sample_id % 3 = 0").select("sample_id", F.lit(None).cast("string").alias("dup_group"))
    x = files.without_ids(files.with_updates(s, changes, "sample_id"), s.where("sample_id % 5 = 1"), "sample_id")
    return x.select("sample_id", "dup_group", "area")


@query("finished_label_files", "with p as (select doc_id, case doc_id % 4 when 0 then '.' else '' end || 'n' || (doc_id % 37) as stem, case when doc_id % 5 = 0 then '.part' else '.TXT' end as ext from documents) select stem, max('t/' || doc_id || '/' || stem || ext) as path from p where doc_id % 4 <> 0 and ext = '.TXT' group by 1")
def finished_label_files(spark, d):
    p = table(spark, d, "documents").selectExpr("concat('t/', doc_id, '/', if(doc_id % 4 = 0, '.', ''), 'n', doc_id % 37, if(doc_id % 5 = 0, '.part', '.TXT')) as path")
    return files.label_index(files.finished_files(p))
