"""Queries for near roles, whole dedup plans, exports, attach plans, downloads, and text formats."""

from __future__ import annotations

from pyspark.sql import functions as F

from framesift.functions import columns as C
from framesift.functions.grammar import attribute_classes, same_number
from framesift.operators import annotations, attaching, dedup, exports, similarity
from framesift.plans.registry import query
from framesift.plans.standins import BOXES_SQL, boxes, samples, samples_sql, table
from framesift.sources import textformats

# --- duplicates: exact groups, then near groups over what they leave

_NEAR_TAG = "case when doc_id % 7 = 0 then 'dup_near_keep' when doc_id % 4 = 0 then 'dup_near_drop' else 'w' end"


def _hashed(spark, d, n):
    """Samples with earlier decisions of both kinds, and a hash of the signs of n components of the vector of their number."""
    bits = F.expr(" + ".join(f"if(embedding[{k}] > 0, {1 << k}, 0)" for k in range(n)))
    h = table(spark, d, "embeddings").select(F.col("vec_id").alias("sample_id"), F.format_string("%016x", bits.cast("bigint")).alias("phash"))
    tag = F.expr(_NEAR_TAG.replace("doc_id", "sample_id"))
    return samples(spark, d, True).join(h, "sample_id", "left").withColumn("tags", F.concat("tags", F.array(tag)))


def _hashed_sql(n):
    bits = " + ".join(f"(case when embedding[{k + 1}] > 0 then {1 << k} else 0 end)" for k in range(n))
    return f"{samples_sql(True)}, hs as (select vec_id as sample_id, lower(lpad(hex(({bits})::bigint), 16, '0')) as phash from embeddings), sh as (select s.* replace (tags || [{_NEAR_TAG.replace('doc_id', 's.sample_id')}] as tags), phash from samples s left join hs using (sample_id))"


_RANK = "(case when box_count > 0 and file_exists then 0 else 1 end), (case when box_count > 0 then 0 else 1 end), (case when file_exists then 0 else 1 end), box_count desc, area desc, filepath, sample_id"


def _roles_sql(name, source, key, tag, kind):
    """CTEs that end in name(sample_id, key, group_id, role, dup_of, k): the roles of group_roles()."""
    return f"""{name}f as (select *, list_contains(tags, '{tag}_keep') as k, not list_contains(tags, '{tag}_keep') and list_contains(tags, '{tag}_drop') as dr from {source}),
{name}g as (select {key} as key, count(*) as members, count_if(k) as keeps, count_if(k or dr) as decided from {name}f where {key} <> '' group by 1 having count(*) >= 2),
{name}x as (select f.*, g.key, keeps, decided, row_number() over (partition by g.key order by {_RANK}) as r, first_value(filepath) over (partition by g.key order by {_RANK}) as best, first_value(filepath) over (partition by g.key order by k desc, {_RANK}) as bk from {name}f f join {name}g g on f.{key} = g.key),
{name}r as (select *, '{kind}:' || key as group_id, case when decided = 0 then (case when r = 1 then 'keep' else 'drop' end) when k then 'keep' when dr then 'drop' when keeps > 0 then 'drop' end as role from {name}x),
{name} as (select sample_id, filepath, group_id, role, case when role = 'drop' then (case when decided = 0 then best when keeps > 0 then bk end) end as dup_of, case when decided = 0 then best when keeps > 0 then bk end as keeper from {name}r)"""


_EXACT = _roles_sql("ex", "sh", "sha256", "dup_repeat", "exact")
_REST = "rest as (select * from sh where sample_id not in (select sample_id from ex where role = 'drop'))"
_BOTH = f"with {_hashed_sql(8)}, {_EXACT}, {_REST}, {_roles_sql('ne', 'rest', 'phash', 'dup_near', 'near')}"
_CLOSE = f"""with recursive {_hashed_sql(12)}, {_EXACT}, {_REST}, ds as (select distinct phash as h, ('0x' || phash)::bigint as b from rest where phash <> ''),
e as (select x.h as a, y.h as b from ds x join ds y on x.h <> y.h and bit_count(xor(x.b, y.b)) <= 1), c as (select h, h as root from ds union select e.b, c.root from c join e on e.a = c.h), l as (select h, min(root) as near_key from c group by 1),
keyed as (select rest.*, near_key from rest join l on l.h = rest.phash), {_roles_sql('ne', 'keyed', 'near_key', 'dup_near', 'near')}"""
_WANT = "(case when e.sample_id is not null then ['dup_repeat'] else [] end) || (case when e.role = 'keep' then ['dup_repeat_keep'] else [] end) || (case when e.role = 'drop' then ['dup_repeat_drop'] else [] end) || (case when n.sample_id is not null then ['dup_near'] else [] end) || (case when n.role = 'keep' then ['dup_near_keep'] else [] end) || (case when n.role = 'drop' then ['dup_near_drop'] else [] end)"
_PLAN = f"""{_BOTH}, w as (select s.sample_id, s.tags, {_WANT} as want, e.role as er, n.role as nr, e.sample_id is null and n.sample_id is null as alone from sh s left join ex e using (sample_id) left join ne n on n.sample_id = s.sample_id),
p as (select *, list_filter(tags, lambda t: t like 'dup\\_%' escape '\\') as have from w), q as (select *, case when have = want then tags else list_filter(tags, lambda t: t not like 'dup\\_%' escape '\\') || want end as new from p)"""


def _near(spark, d, n, k):
    x = _hashed(spark, d, n)
    return dedup.near_roles(x, dedup.group_roles(x, "sha256", "dup_repeat_keep", "dup_repeat_drop", "exact"), k)


@query("dedup_near_roles", f"{_BOTH} select sample_id, group_id, role, dup_of from ne")
def near_roles(spark, d):
    return _near(spark, d, 8, 0).select("sample_id", "group_id", "role", "dup_of")


@query("dedup_near_roles_by_distance", f"{_CLOSE} select sample_id, group_id, role, dup_of from ne")
def near_roles_by_distance(spark, d):
    return _near(spark, d, 12, 1).select("sample_id", "group_id", "role", "dup_of")


@query("dedup_near_summary", f"{_BOTH}, g as (select group_id, count(*) m, count_if(role = 'keep') k, count_if(role = 'drop') dr from ne group by 1) select count(*)::bigint as groups, sum(m)::bigint as members, sum(k)::bigint as keeps, sum(dr)::bigint as drops, count_if(k <> 1)::bigint as conflicts from g")
def near_summary(spark, d):
    return dedup.summary(_near(spark, d, 8, 0))


@query("dedup_plan_tags", f"{_PLAN} select sample_id, array_to_string(new, ',') as new_tags from q where new is distinct from tags")
def plan_tags(spark, d):
    p = dedup.full_plan(_hashed(spark, d, 8))
    return p.where(~F.col("new_tags").eqNullSafe(F.col("tags"))).select("sample_id", F.array_join("new_tags", ",").alias("new_tags"))


@query("dedup_plan_counts", f"{_PLAN} select count(*)::bigint as samples, count_if(new <> tags or not alone)::bigint as changed, count_if(alone and len(have) > 0)::bigint as stale from q")
def plan_counts(spark, d):
    return dedup.plan_counts(dedup.full_plan(_hashed(spark, d, 8)))


@query("dedup_delete_ids", f"{_PLAN} select sample_id from q where (er = 'drop' or nr = 'drop') and not list_has_any(new, ['dup_repeat_keep', 'dup_near_keep'])")
def delete_ids(spark, d):
    return dedup.delete_ids(dedup.full_plan(_hashed(spark, d, 8)))


@query("dedup_report", f"{_BOTH}, r as (select 'exact' as kind, * from ex union all select 'near', * from ne) select kind, coalesce(role, 'member') as action, group_id as dup_group, sample_id, filepath, coalesce(keeper, '') as kept_filepath, row_number() over (order by kind, group_id, case when role = 'keep' then 0 else 1 end, filepath, sample_id)::bigint as place from r")
def report(spark, d):
    x = _hashed(spark, d, 8)
    exact = dedup.group_roles(x, "sha256", "dup_repeat_keep", "dup_repeat_drop", "exact")
    rows = dedup.report(exact, "exact").unionByName(dedup.report(dedup.near_roles(x, exact), "near"))
    rows = rows.withColumn("key", F.struct(*[c.alias(f"k{i}") for i, c in enumerate(dedup.report_order())]))
    return textformats.dense_ids(rows, "key", "place").select("kind", "action", "dup_group", "sample_id", "filepath", "kept_filepath", F.col("place").cast("bigint"))


@query("near_clusters", f"with recursive {_hashed_sql(12)}, ds as (select distinct phash as h, ('0x' || phash)::bigint as b from sh where phash <> ''), e as (select x.h as a, y.h as b from ds x join ds y on x.h <> y.h and bit_count(xor(x.b, y.b)) <= 1), c as (select h, h as root from ds union select e.b, c.root from c join e on e.a = c.h), l as (select h, min(root) as near_key from c group by 1) select sample_id, near_key from sh join l on l.h = phash")
def near_clusters(spark, d):
    return similarity.clusters(_hashed(spark, d, 12), 1)


# --- exports

_RULES = ["A-age_0", "A-age_2", "N", "R-age_1"]
_DETS = f"""{BOXES_SQL.replace('from lineitem)', ', l_partkey % 4 as code, l_suppkey % 3 as has from lineitem)')},
t as (select sample_id, idx, label, case when has = 0 then code end as code, case when label = 'N' then 'N' when label in ('A', 'R') then label || '-age_' || coalesce(case when has = 0 then code end, 0) end as want from boxes),
u as (select *, case when want in ('A-age_0', 'A-age_2', 'N', 'R-age_1') then want end as got, label in ('A', 'R') as mine from t),
lab as (select sample_id, coalesce(string_agg(got, ',' order by idx) filter (where got is not null), '') as kept, count(got) as n_kept, count_if(mine and got is not null and code is null)::bigint as defaulted, count_if(mine and got is null and code is null)::bigint as omitted_default, coalesce(string_agg(want, ',' order by idx) filter (where mine and got is null and code is not null), '') as unmapped, count_if(mine and got is null and code is not null) as n_unmapped from u group by 1)"""


def _labelled(spark, d):
    x = table(spark, d, "lineitem")
    from pyspark.sql import Window

    w = Window.partitionBy("l_orderkey").orderBy("l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_discount", "l_tax", "l_extendedprice", "l_shipdate", "l_returnflag")
    tags = F.when(F.col("l_suppkey") % 3 == 0, F.array(F.lit("x"), F.concat(F.lit("age_"), (F.col("l_partkey") % 4).cast("string")))).otherwise(F.array(F.lit("age_x")))
    x = x.select(F.col("l_orderkey").alias("sample_id"), F.row_number().over(w).alias("idx"), F.col("l_returnflag").alias("label"), tags.alias("tags"))
    return x.groupBy("sample_id").agg(F.transform(F.array_sort(F.collect_list(F.struct("idx", "label", "tags"))), lambda v: F.struct(v["label"].alias("label"), v["tags"].alias("tags"))).alias("dets"))


@query("export_attribute_labels", f"with {_DETS} select sample_id, kept, defaulted, omitted_default, unmapped from lab")
def attribute_labels(spark, d):
    x = exports.attribute_labels(_labelled(spark, d), attribute_classes(_RULES))
    return x.select("sample_id", F.array_join("kept.label", ",").alias("kept"), "defaulted", "omitted_default", F.array_join("unmapped", ",").alias("unmapped"))


@query("export_inspection", f"with {_DETS} select sum(n_kept)::bigint as boxes, count_if(n_kept = 0)::bigint as negative_images, sum(defaulted)::bigint as defaulted, sum(omitted_default)::bigint as omitted_default, sum(n_unmapped)::bigint as omitted, (select string_agg(got || ':' || n, ',' order by got) from (select got, count(*) as n from u where got is not null group by 1)) as classes from lab")
def inspection(spark, d):
    x = exports.inspected(exports.attribute_labels(_labelled(spark, d), attribute_classes(_RULES)))
    return x.withColumn("classes", F.array_join(F.transform("classes", lambda c: F.concat(c["label"], F.lit(":"), c["n"].cast("string"))), ","))


@query("label_counts", "select case when l_returnflag in ('A', 'R') then 'head' else l_returnflag end as label, count(*)::bigint as n from lineitem group by 1")
def label_counts(spark, d):
    x = _labelled(spark, d).withColumn("dets", F.transform("dets", lambda v: v.withField("label", F.when(v["label"].isin("A", "R"), "head").otherwise(v["label"]))))
    return exports.label_counts(x)


_SHAPES = """s as (select doc_id, source || '/' || (doc_id % 97) || '.jpg' as relpath, '/x/' || doc_id || '.jpg' as filepath, lang <> 'fr' as file_exists, case when doc_id % 11 <> 0 then 640 end as width, (doc_id % 4) as m from documents),
o as (select *, case when not file_exists then 'missing_file' when width is null then 'missing_size' end as own, case m when 0 then ['b'] when 1 then ['a', 'b'] when 2 then ['a'] else [] end as labels from s),
f as (select *, list_filter(labels, lambda l: l <> 'a') as unknown, own is null and (m <> 0) as fine from o), h as (select relpath, min(doc_id) as holder from f where fine group by 1),
j as (select f.*, holder, coalesce(doc_id > holder, false) as late from f left join h using (relpath))"""


def _shape_samples(spark, d):
    dets = F.expr("transform(case doc_id % 4 when 0 then array('b') when 1 then array('a', 'b') when 2 then array('a') else cast(array() as array<string>) end, l -> named_struct('label', l, 'box', array(0.1D, 0.1D, 0.2D, 0.2D)))")
    return table(spark, d, "documents").select(
        F.col("doc_id").alias("sample_id"), F.expr("concat(source, '/', doc_id % 97, '.jpg')").alias("relpath"), F.expr("concat('/x/', doc_id, '.jpg')").alias("filepath"),
        (F.col("lang") != "fr").alias("file_exists"), F.expr("if(doc_id % 11 <> 0, 640, null)").alias("width"), F.lit(480).alias("height"), dets.alias("dets"),
    )


@query("export_shape_plan", f"with {_SHAPES} select doc_id as sample_id, relpath, len(labels) - len(unknown) as boxes from j where fine and not late")
def shape_plan(spark, d):
    return exports.shape_export(_shape_samples(spark, d), ["a"])[0].select("sample_id", "relpath", F.size("dets").cast("bigint").alias("boxes"))


@query("export_shape_issues", f"with {_SHAPES} select doc_id as sample_id, relpath, case when late then 'relpath_collision' when own is not null then own else 'unknown_class' end as issue, case when late then 'already used by ' || holder when own is not null then filepath else 'b' end as detail from j where late or own is not null or len(unknown) > 0")
def shape_issues(spark, d):
    return exports.shape_export(_shape_samples(spark, d), ["a"])[1]


_KEYPOINT = """s as (select page_id, 'f' || (page_id * 7 % 211) || '.jpg' as file_name, case when page_id % 13 = 0 then 'missing_size' when page_id % 9 = 0 then 'unpaired' when page_id % 8 = 0 then 'no_face' end as own from pages),
n as (select file_name, count(*) as same from s where own is null group by 1), k as (select page_id as sample_id, file_name, case when own is null and same > 1 then 'duplicate_name' else own end as issue from s left join n using (file_name))"""


def _keypoint_plan(spark, d):
    x = table(spark, d, "pages").select(F.col("page_id").alias("sample_id"), F.expr("concat('/q/', page_id, '/f', page_id * 7 % 211, '.jpg')").alias("filepath"), F.lit(True).alias("file_exists"), F.expr("if(page_id % 13 = 0, null, 100)").alias("width"), F.lit(50).alias("height"), F.expr("if(page_id % 8 = 0, 0, 2)").alias("n_faces"), F.expr("page_id % 9 <> 0").alias("paired"))
    return exports.keypoint_export(x)


@query("export_keypoint_plan", f"with {_KEYPOINT} select sample_id, file_name, issue from k")
def keypoint_plan(spark, d):
    return _keypoint_plan(spark, d).select("sample_id", "file_name", "issue")


@query("export_keypoint_skips", f"with {_KEYPOINT} select issue, count(*)::bigint as n from k where issue is not null group by 1")
def keypoint_skips(spark, d):
    return exports.status_counts(_keypoint_plan(spark, d).where("issue is not null"), "issue")


@query("gate_copy_plan", "select page_id, case when page_id % 5 = 0 then null when page_id % 3 = 0 then 'near;dest_exists' when page_id % 2 = 0 then 'near' end as issue, page_id % 5 <> 0 and page_id % 3 <> 0 as to_write from (select page_id from pages) where page_id % 2 = 0 union all select page_id, case when page_id % 5 <> 0 and page_id % 3 = 0 then 'dest_exists' else '' end, page_id % 5 <> 0 and page_id % 3 <> 0 from pages where page_id % 2 = 1")
def gate_copies(spark, d):
    p = table(spark, d, "pages")
    rows = p.select("page_id", F.lit("new").alias("status"), F.expr("if(page_id % 5 = 0, '', concat('out/', page_id))").alias("out_path"), F.expr("case when page_id % 2 = 1 then '' when page_id % 5 = 0 then null else 'near' end").alias("issue"), F.lit("").alias("detail"))
    return exports.gate_copies(rows, p.where("page_id % 3 = 0").select(F.expr("concat('out/', page_id)").alias("path"))).select("page_id", "issue", "to_write")


@query("upload_size", "select count(*)::bigint as files, sum(n_chars)::bigint as bytes, ceil(count(*) / 512.0)::bigint as tasks from documents")
def upload_size(spark, d):
    return exports.upload_size(table(spark, d, "documents").select(F.col("n_chars").alias("length")), 512)


@query("task_chunks", "select source, ((row_number() over (partition by source order by doc_id) - 1) // 16)::bigint as chunk, doc_id, case when count(*) over (partition by source) <= 16 then source else source || '_' || ((row_number() over (partition by source order by doc_id) - 1) // 16 + 1) end as task from documents")
def task_chunks(spark, d):
    return exports.numbered_tasks(table(spark, d, "documents").select("source", "doc_id"), "source", "doc_id", 16)


@query("new_images_only", "select page_id from pages where page_id not in (select doc_id from documents where doc_id % 3 = 0)")
def new_images(spark, d):
    files = table(spark, d, "pages").select("page_id", F.expr("concat('/i/', page_id, '.jpg')").alias("path"))
    return exports.new_only(files, table(spark, d, "documents").where("doc_id % 3 = 0").select(F.expr("concat('/i/', doc_id, '.jpg')").alias("filepath"))).select("page_id")


@query("select_by_ids", "select doc_id as sample_id from documents where doc_id in (select page_id * 2 from pages)")
def select_by_ids(spark, d):
    x = table(spark, d, "documents").select(F.col("doc_id").alias("sample_id"))
    return exports.by_ids(x, table(spark, d, "pages").select((F.col("page_id") * 2).alias("sample_id")))


@query("relative_paths", "select doc_id, case when doc_id % 2 = 0 then source || '/' || doc_id || '.jpg' end as relative, 'out/' || lang || '/' || source as target from documents")
def relative_paths(spark, d):
    path = F.expr("concat(if(doc_id % 2 = 0, '/data/root/', '/data/rootless/'), source, if(doc_id % 4 = 0, '\\\\', '/'), doc_id, '.jpg')")
    return table(spark, d, "documents").select("doc_id", exports.relative_path(path, "/data/root").alias("relative"), exports.bucket_path("out/", F.col("lang"), F.col("source")).alias("target"))


@query("status_ranked_report", "select page_id, row_number() over (order by case page_id % 4 when 0 then 0 when 1 then 1 when 2 then 2 else 3 end, 'p' || page_id)::bigint as place from pages")
def ranked_report(spark, d):
    status = F.expr("case page_id % 4 when 0 then 'collision' when 1 then 'missing' when 2 then 'skipped' else 'copied' end")
    x = table(spark, d, "pages").select("page_id", F.expr("concat('p', page_id)").alias("path"), status.alias("status"))
    x = x.withColumn("key", F.struct(*[c.alias(f"k{i}") for i, c in enumerate(exports.status_ranked(x, ["collision", "missing", "skipped", "copied"]))]))
    return textformats.dense_ids(x, "key", "place").select("page_id", F.col("place").cast("bigint"))


@query("same_number", "select event_id, (k % 3 <> 0 and k % 5 = 2) as same from (select event_id, (props::json->>'k')::int as k from events)")
def same_numbers(spark, d):
    k = F.get_json_object("props", "$.k").cast("int")
    return table(spark, d, "events").select("event_id", same_number(F.when(k % 3 == 0, F.concat((k % 5).cast("string"), F.lit(".0"))).otherwise((k % 5).cast("string")), F.lit(2)).alias("same"))


# --- boxes

_ISSUE = "case when w <= 0 or h <= 0 then 'invalid' when x >= -0.001 and y >= -0.001 and x + w <= 1.001 and y + h <= 1.001 then null when x >= 1 or y >= 1 or x + w <= 0 or y + h <= 0 then 'no_overlap' else 'partial' end"
_PLANNED = f"""with {BOXES_SQL}, o as (select *, {_ISSUE} as issue, greatest(-x, -y, x + w - 1, y + h - 1, 0.0) as overflow, least(x + w, 1.0) - greatest(x, 0.0) as cw, least(y + h, 1.0) - greatest(y, 0.0) as ch from boxes),
b as (select *, case when issue is null then 'keep' when issue in ('invalid', 'no_overlap') or w > 1 or h > 1 or overflow > 0.02 or cw <= 0.0000005 or ch <= 0.0000005 then 'delete' else 'clip' end as action from o),
p as (select a.sample_id, a.label, a.idx, b.idx as partner, greatest(least(a.x + a.w, b.x + b.w) - greatest(a.x, b.x), 0.0) * greatest(least(a.y + a.h, b.y + b.h) - greatest(a.y, b.y), 0.0) as i, a.w * a.h + b.w * b.h as s from boxes a join boxes b on a.sample_id = b.sample_id and a.label = b.label and a.idx <> b.idx where a.w > 0 and a.h > 0 and b.w > 0 and b.h > 0),
q as (select * from p where i / (s - i) >= 0.5 qualify row_number() over (partition by sample_id, label, idx order by i / (s - i) desc, partner) = 1),
iss as (select sample_id, idx, label, issue, action, null::bigint as partner from b where issue is not null union all select sample_id, idx, q.label, 'high_iou', action, partner from q join b using (sample_id, idx))"""


@query("box_plan_issues", f"{_PLANNED} select * from iss")
def box_plan_issues(spark, d):
    return annotations.box_issues(boxes(spark, d), least=0.5).select("sample_id", "idx", "label", "issue", "action", "partner")


@query("sample_plan_tags", f"{_PLANNED}, g as (select sample_id, bool_or(action <> 'keep') as edits from iss group by 1), t as (select o_orderkey as sample_id, case when o_orderkey % 3 = 0 then ['bad_box', 'z'] else ['z', 'changed_box'] end as tags, (case when edits is null then [] when edits then ['bad_box', 'changed_box'] else ['bad_box'] end) as want from orders left join g on g.sample_id = o_orderkey) select sample_id, array_to_string(case when list_filter(tags, lambda v: v <> 'z') = want then tags else ['z'] || want end, ',') as new_tags, case when list_filter(tags, lambda v: v <> 'z') = want then false else (['z'] || want) <> tags end as changed from t")
def sample_plan_tags(spark, d):
    x = table(spark, d, "orders").select(F.col("o_orderkey").alias("sample_id"), F.expr("if(o_orderkey % 3 = 0, array('bad_box', 'z'), array('z', 'changed_box'))").alias("tags"))
    return annotations.plan_tags(x, annotations.box_issues(boxes(spark, d), least=0.5)).select("sample_id", F.array_join("new_tags", ",").alias("new_tags"), "changed")


@query("box_overlap_shares", f"with {BOXES_SQL} select sample_id, idx, round(case when w * h > 0 then greatest(least(x + w, 1.0) - greatest(x, 0.0), 0.0) * greatest(least(y + h, 1.0) - greatest(y, 0.0), 0.0) / (w * h) else 0 end, 6) as overlap, round(greatest(-x, -y, x + w - 1, y + h - 1, 0.0), 6) as overflow from boxes")
def overlap_shares(spark, d):
    return annotations.bounds(boxes(spark, d)).select("sample_id", "idx", F.round("overlap", 6).alias("overlap"), F.round("overflow", 6).alias("overflow"))


@query("relative_boxes", f"with {BOXES_SQL} select sample_id, idx, round_even(round_even(x * 1920, 0) / 1920, 6) as x, round_even((round_even((y + h) * 1080, 0) - round_even(y * 1080, 0)) / 1080, 6) as h from boxes")
def relative_boxes(spark, d):
    px = C.pixel_corners(F.col("box"), F.lit(1920), F.lit(1080))
    r = boxes(spark, d).withColumn("r", C.relative_box(px, F.lit(1920), F.lit(1080)))
    return r.select("sample_id", "idx", F.get("r", F.lit(0)).alias("x"), F.get("r", F.lit(3)).alias("h"))


# --- attach plans

_ATTACH = """f as (select page_id as path, case when page_id % 4 = 0 then page_id % 50 + (case when page_id % 8 = 0 then 100000 else 0 end) end as claimed, case when page_id % 10 <> 7 then sha256('d' || (page_id % 90)) end as sha, case when page_id % 17 = 0 then 'json_error' end as bad, page_id % 5 as m from pages),
s as (select doc_id as sample_id, sha256('d' || (doc_id % 80 + (case when doc_id > 100 then 1000 else 0 end))) as sha from documents), h as (select sha, count(*) n, min(sample_id) id from s group by 1),
m as (select f.*, c.sample_id as by_id, n, h.id as by_hash from f left join s c on c.sample_id = claimed left join h on h.sha = f.sha where bad is null and f.sha is not null),
k as (select *, case when claimed is not null and by_id is null then 'orphan_sample_id' when claimed is not null then 'match' when n is null then 'orphan' when n > 1 then 'ambiguous' else 'match' end as st, case when claimed is not null then by_id when n = 1 then by_hash end as sample_id from m),
g as (select sha, count(*) as images, count(distinct case when st = 'match' then sample_id end) as targets from k group by 1),
t as (select k.*, images, case when st = 'match' and images > 1 and targets > 1 then 'skipped' else st end as s2 from k join g using (sha)),
fp as (select sample_id, min(path) as first_path from t where s2 = 'match' group by 1),
z as (select t.*, case when s2 = 'match' and path > first_path then 'sample_id_collision' when s2 = 'match' then (case when m = sample_id % 5 then 'unchanged' else 'write' end) else s2 end as outcome from t left join fp using (sample_id))"""


def _label_plan(spark, d):
    box = lambda n: F.array(F.struct(F.lit("b").alias("label"), F.array(F.lit(0.5), F.lit(0.5), F.lit(0.1), F.lit(0.1)).alias("box")), F.struct(F.lit("a").alias("label"), F.array(F.lit(0.1), F.lit(0.1), F.lit(0.2), (n % 5) / 10 + 0.1).alias("box")))
    p = table(spark, d, "pages").select(F.col("page_id").alias("path"), F.expr("case when page_id % 4 = 0 then page_id % 50 + case when page_id % 8 = 0 then 100000 else 0 end end").alias("claimed"), F.expr("if(page_id % 10 <> 7, sha2(concat('d', page_id % 90), 256), null)").alias("sha256"), F.lit(1000).alias("width"), F.lit(800).alias("height"), F.reverse(box(F.col("page_id"))).alias("boxes"), F.expr("if(page_id % 17 = 0, 'json_error', null)").alias("parse_issue"))
    s = table(spark, d, "documents").select(F.col("doc_id").alias("sample_id"), F.expr("sha2(concat('d', doc_id % 80 + case when doc_id > 100 then 1000 else 0 end), 256)").alias("sha256"), box(F.col("doc_id")).alias("boxes"))
    return attaching.label_plan(p, s, ["a", "b"])


@query("label_attach_plan", f"with {_ATTACH} select path, sample_id, outcome from z")
def label_attach_plan(spark, d):
    return _label_plan(spark, d)[0]


@query("label_attach_issues", f"with {_ATTACH} select path, null::bigint as sample_id, coalesce(bad, 'missing_image') as issue from f where bad is not null or sha is null union all select path, sample_id, 'duplicate_task_image_hash' from z where images > 1 union all select path, sample_id, outcome from z where outcome not in ('write', 'unchanged', 'skipped')")
def label_attach_issues(spark, d):
    return _label_plan(spark, d)[1]


@query("face_attach_plan", """with e as (select event_id, (props::json->>'k')::int as k from events), x as (select *, case when k % 4 = 0 then null when k % 4 = 1 then 1920 when k % 4 = 2 then 960 else 50 end as width from e)
select event_id as sample_id, case when width = 50 then 'size_mismatch' when k % 3 = 1 and k % 4 <> 2 and k % 7 <> 1 then 'unchanged' when k % 3 = 1 and k % 4 = 2 and k % 7 <> 1 and k % 5 = 0 then 'write' else 'write' end as outcome,
 k % 5 = 0 and k % 3 > 0 as locked, case when k % 3 > 0 then 'i' || k else null end as instance_id, round_even((case when k % 5 = 0 and k % 3 > 0 then 0.05 else 96 / coalesce(width, 1920) end)::double, 6) as x, case when k % 7 = 1 then 'z,new' else 'new' end as new_tags from x""")
def face_attach_plan(spark, d):
    k = F.get_json_object("props", "$.k").cast("int")
    x = table(spark, d, "events").select(F.col("event_id").alias("sample_id"), k.alias("k"))
    point = "named_struct('x', {}, 'y', {})"
    here = "named_struct('box', array(0.05D, 0.1D, 0.05D, 0.1D), 'instance_id', concat('i', k))"
    dots = f"named_struct('points', array({point.format('0.05D', '0.1D')}, {point.format(*['double(\"NaN\")'] * 2)}), 'instance_id', '')"
    return attaching.face_plan(x.select(
        "sample_id", "k", F.lit(1920).alias("json_width"), F.lit(1080).alias("json_height"), F.expr("case k % 4 when 0 then null when 1 then 1920 when 2 then 960 else 50 end").alias("width"), F.expr("if(k % 4 = 0, null, 1080)").alias("height"),
        F.expr("array(96D, 108D, 96D, 108D)").alias("box_px"), F.expr(f"array({point.format('96D', '108D')}, {point.format(*['double(\"NaN\")'] * 2)})").alias("points_px"),
        F.expr(f"case k % 3 when 0 then cast(array() as array<struct<box:array<double>,instance_id:string>>) when 1 then array({here}) else array({here}) end").alias("now_boxes"),
        F.expr(f"if(k % 3 = 1, array({dots}), cast(array() as array<struct<points:array<struct<x:double,y:double>>,instance_id:string>>))").alias("now_points"),
        F.expr("if(k % 5 = 0, 1, 0)").alias("other_points"), F.expr("if(k % 7 = 1, array('z'), array('new'))").alias("tags"),
    ), ["new"]).select("sample_id", "outcome", "locked", "instance_id", F.get("box", F.lit(0)).alias("x"), F.array_join("new_tags", ",").alias("new_tags"))


# --- downloads

_ELEMENTS = "array(named_struct('label_id', 12, 'outside', k % 4 = 0, 'occluded', k % 3 = 0, 'points', array(double(k), double(k) * 2)), named_struct('label_id', 11, 'outside', false, 'occluded', false, 'points', array(100D, 50D)))"


def _payload(spark, d):
    """One download for each event: a skeleton and a rectangle, and a track with an element."""
    x = table(spark, d, "events").select(F.col("event_id").alias("task"), F.get_json_object("props", "$.k").cast("int").alias("k"))
    skeleton = f"named_struct('frame', k % 5, 'type', 'skeleton', 'label_id', 10, 'group', k % 2, 'points', cast(array() as array<double>), 'elements', {_ELEMENTS})"
    box = f"named_struct('frame', k % 5, 'type', 'rectangle', 'label_id', 20, 'group', k % 2, 'points', array(10D, 20D, double(k) + 30, 60D), 'elements', slice({_ELEMENTS}, 1, 0))"
    keys = "array(named_struct('frame', 2, 'outside', false, 'occluded', k % 2 = 0, 'points', array(double(k), 0D)), named_struct('frame', 6, 'outside', k % 3 = 0, 'occluded', false, 'points', array(double(k) + 8, 4D)))"
    track = f"named_struct('label_id', 30, 'group', 1, 'shapes', {keys}, 'elements', array(named_struct('label_id', 11, 'shapes', slice({keys}, 2, 1))))"
    return x.select("task", F.to_json(F.struct(F.expr(f"array({skeleton}, {box})").alias("shapes"), F.expr(f"array({track})").alias("tracks"))).alias("text"))


_EV = "with e as (select event_id as task, (props::json->>'k')::int as k from events)"


@query("download_skeletons", f"{_EV} select task, (k % 5)::bigint as frame, (k % 2)::bigint as \"group\", '2,' || (case when k % 4 = 0 then 0 when k % 3 = 0 then 1 else 2 end) || ',0' as flags, case when k % 4 <> 0 then round_even(k / 640.0, 6) end as x from e")
def download_skeletons(spark, d):
    shapes, _ = attaching.payload_shapes(_payload(spark, d))
    s = attaching.shape_skeletons(shapes.select(F.struct("task", "frame").alias("frame"), "kind", "label_id", "group", "elements", F.lit(640).alias("width"), F.lit(480).alias("height")), 10, [11, 12, 13])
    x = F.get("points", F.lit(1))["x"]
    return s.select("frame.task", "frame.frame", "group", F.array_join(F.transform("flags", lambda v: v.cast("string")), ",").alias("flags"), F.when(~F.isnan(x), x).alias("x"))


@query("download_boxes", f"{_EV} select task, (k % 2)::bigint as \"group\", round_even(10 / 640.0, 6) as x, round_even((k + 20) / 640.0, 6) as w from e")
def download_boxes(spark, d):
    shapes, _ = attaching.payload_shapes(_payload(spark, d))
    b = attaching.shape_boxes(shapes.select(F.struct("task", "frame").alias("frame"), "kind", "label_id", "group", "points", F.lit(640).alias("width"), F.lit(480).alias("height")), 20)
    return b.select("frame.task", "group", F.get("box", F.lit(0)).alias("x"), F.get("box", F.lit(2)).alias("w"))


@query("download_tracks", f"{_EV}, f as (select unnest([0, 3, 6, 9])::bigint as frame) select task, frame, n.node, case when frame < 2 or (node = 11 and frame < 6) then null when frame >= 6 then k + 8.0 else k + 2.0 end as x, case when frame < 2 or (node = 11 and frame < 6) then true when frame >= 6 then k % 3 = 0 else false end as outside, case when frame = 3 and node is null then k % 2 = 0 else false end as occluded from e, f, (select null::bigint as node union all select 11) n")
def download_tracks(spark, d):
    _, keys = attaching.payload_shapes(_payload(spark, d))
    frames = table(spark, d, "events").select(F.col("event_id").alias("task"), F.explode(F.expr("array(0L, 3L, 6L, 9L)")).alias("frame"))
    return attaching.track_points(frames, keys).select("task", "frame", "node", F.get("points", F.lit(0)).alias("x"), "outside", "occluded")


# --- text formats

@query("yolo_strict_parse", f"with {BOXES_SQL}, l as (select sample_id, idx, ascii(label) % 4 as cls, x, y, w, h, greatest(-x * 190, (x + w - 1) * 190, -y * 90, (y + h - 1) * 90) as over from boxes), f as (select sample_id, count_if(w <= 0 or h <= 0 or over > 5 or cls >= 3) as bad from l group by 1) select sample_id, idx as line, case when bad = 0 then cls end as class_id, case when bad = 0 then round(least(x + w, 1) - greatest(x, 0), 4) end as w, bad > 0 as parse_error from l join f using (sample_id)")
def yolo_strict(spark, d):
    x = boxes(spark, d).select("sample_id", "idx", F.concat_ws(" ", (F.ascii("label") % 4).cast("string"), F.expr("cast(box[0] + box[2] / 2 as string)"), F.expr("cast(box[1] + box[3] / 2 as string)"), F.expr("cast(box[2] as string)"), F.expr("cast(box[3] as string)")).alias("line"))
    files = x.groupBy("sample_id").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("idx", "line"))), lambda v: v["line"]), "\n").alias("text"))
    p = textformats.parse_yolo(files, "sample_id", strict=(190, 90), classes=3)
    return p.select("sample_id", F.col("line").cast("bigint").alias("line"), "class_id", F.round(F.get("box", F.lit(2)), 4).alias("w"), "parse_error")


@query("sidecar_parse", "select page_id, case when page_id % 7 = 0 then 'json_error' when page_id % 5 = 0 then 'bad_image_size' when page_id % 4 = 0 then 'unsupported_shape' when page_id % 3 = 0 then 'bad_points' end as issue, case when page_id % 7 <> 0 and page_id % 5 <> 0 and page_id % 4 <> 0 and page_id % 3 <> 0 then 1 end as boxes, case when page_id % 7 <> 0 then 's' || page_id end as sample_id from pages")
def sidecar_parse(spark, d):
    shape = "concat('{\"label\":\"a\",\"shape_type\":\"', if(page_id % 4 = 0, 'circle', 'rectangle'), '\",\"points\":', if(page_id % 3 = 0, '[[1,2],[3]]', '[[1,2],[30,40]]'), '},{\"label\":\"other\",\"shape_type\":\"polygon\",\"points\":[]}')"
    text = F.expr(f"if(page_id % 7 = 0, '{{broken', concat('{{\"sample_id\":\" s', page_id, '\",\"imagePath\":\"i.jpg\",\"imageWidth\":', if(page_id % 5 = 0, 0, 64), ',\"imageHeight\":48,\"shapes\":[', {shape}, ']}}'))")
    x = textformats.parse_sidecar(table(spark, d, "pages").select(F.col("page_id").alias("path"), text.alias("text")), ["a"])
    return x.select(F.col("path").alias("page_id"), "issue", F.when(F.col("boxes").isNotNull(), F.size("boxes")).alias("boxes"), "sample_id")


@query("coco_parse", "select page_id, 'f' || page_id || '.jpg' as file_name, case when page_id % 7 = 0 then 'bad_image_size' when page_id % 5 = 0 then 'missing_annotation' when page_id % 6 = 0 then 'multiple_annotations' when page_id % 4 = 0 then 'bad_box' when page_id % 3 = 0 then 'bad_keypoints' end as issue, case when page_id % 5 <> 0 and page_id % 4 <> 0 then (case when page_id % 2 = 0 then 9.0 else 8.0 end) end as w from pages")
def coco_parse(spark, d):
    note = "concat('{\"image_id\":', page_id, ',\"bbox\":[1,2,8,9],\"face_box\":', case when page_id % 4 = 0 then '[0,0,0,0]' when page_id % 2 = 0 then '[1,1,9,9]' else '[0,0,0,0]' end, ',\"keypoints\":', if(page_id % 3 = 0, '[1,2,2,4]', '[1,2,2,3,4,1]'), '}')"
    note = note.replace("[1,2,8,9]", "', if(page_id % 4 = 0, '[1,2,0,9]', '[1,2,8,9]'), '")
    notes = f"case when page_id % 5 = 0 then '' when page_id % 6 = 0 then concat({note}, ',', {note}) else {note} end"
    text = F.expr(f"concat('{{\"images\":[{{\"id\":', page_id, ',\"file_name\":\"f', page_id, '.jpg\",\"width\":', if(page_id % 7 = 0, '0', '64'), ',\"height\":48}}],\"annotations\":[', {notes}, ']}}')")
    x = textformats.parse_coco(table(spark, d, "pages").select(F.col("page_id").alias("path"), text.alias("text")), 2)
    return x.select(F.col("path").alias("page_id"), "file_name", "issue", F.get("bbox", F.lit(2)).alias("w"))


@query("nested_answer_parse", "select event_id, (props::json->>'k')::int as k from events")
def nested_answer(spark, d):
    text = F.concat(F.lit('So {this} is it: {"more": {"x": 1}, "k": '), F.get_json_object("props", "$.k"), F.lit(', "list": [{"y": {}}]} and that is all {"k": -1}'))
    return table(spark, d, "events").select("event_id", F.get_json_object(textformats.answer_json(text, "k"), "$.k").cast("int").alias("k"))
