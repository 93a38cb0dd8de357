"""Queries for imports, conversions, label files, and the plans of a watch loop."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from framesift.functions import columns as C
from framesift.operators import exports, matching
from framesift.plans.registry import query
from framesift.plans.standins import table
from framesift.sources import files as S
from framesift.sources.shared import shared_folder
from framesift.streaming import watch

_LEAF = """i as (select page_id, '/i/' || (case when page_id % 10 = 0 then 'twin' || (page_id // 20) else 'img' || page_id end) || (case when page_id % 20 = 0 then '.png' else '.jpg' end) as path, case when page_id % 10 = 0 then 'twin' || (page_id // 20) else 'img' || page_id end as stem from pages),
l as (select 'img' || doc_id * 2 as stem, '/l/' || (doc_id % 3) || '/img' || doc_id * 2 || '.txt' as path from documents), n as (select stem, count(*) as same from i group by 1), p as (select stem, max(path) as label from l group by 1),
z as (select i.path, label, case when same > 1 then 'stem_collision' when page_id % 7 = 0 then 'known' else 'new' end as status from i join n using (stem) left join p using (stem))"""


def _leaf(spark, d):
    p = table(spark, d, "pages")
    path = F.expr("concat('/i/', if(page_id % 10 = 0, concat('twin', page_id div 20), concat('img', page_id)), if(page_id % 20 = 0, '.png', '.jpg'))")
    labels = table(spark, d, "documents").select(F.expr("concat('/l/', doc_id % 3, '/img', doc_id * 2, '.txt')").alias("path"))
    images = p.select(path.alias("path"))
    return matching.leaf_plan(images, labels, p.where("page_id % 7 = 0").select(path.alias("filepath"))), matching.orphan_labels(images, labels)


@query("import_leaf_plan", f"with {_LEAF} select * from z")
def leaf_plan(spark, d):
    return _leaf(spark, d)[0]


@query("import_leaf_counts", f"with {_LEAF} select count(*)::bigint as images, count_if(status = 'new')::bigint as new, count_if(status = 'new' and label is not null)::bigint as labelled, count_if(status = 'known')::bigint as known, count_if(status = 'stem_collision')::bigint as collisions, (select count(*)::bigint from l where stem not in (select stem from i)) as orphans from z")
def leaf_counts(spark, d):
    return matching.import_counts(*_leaf(spark, d))


@query("extract_by_name", "with s as (select 'a' || (doc_id % 150) || (case when doc_id % 2 = 0 then '.JPG' else '.png' end) as name from documents), n as (select distinct 'a' || page_id || (case when page_id % 2 = 0 then '.jpg' else '.jpg' end) as key, page_id from pages), c as (select replace(name, 'JPG', 'jpg') as key, count(*) as k from s group by 1) select n.key as stem, case when k is null then 'missing' when k > 1 then 'collision' when page_id % 3 = 0 then 'skipped' else 'copy' end as status from n left join c using (key)")
def extract_by_name(spark, d):
    s = table(spark, d, "documents").select(F.expr("concat('/s/', doc_id, '/a', doc_id % 150, if(doc_id % 2 = 0, '.JPG', '.png'))").alias("path"))
    n = table(spark, d, "pages").select(F.expr("concat('/n/a', page_id, '.jpg')").alias("path"))
    taken = table(spark, d, "pages").where("page_id % 3 = 0").select(F.expr("concat('/o/a', page_id, '.JPG')").alias("path"))
    return matching.extraction_plan(s, n, "name", "/o/", taken)


@query("fitted_sizes", "select doc_id, greatest(1, floor(n_chars * least(1.0::double, 1024.0::double / greatest(n_chars, 300 + doc_id % 2000))))::int as width, greatest(1, floor((300 + doc_id % 2000) * least(1.0::double, 1024.0::double / greatest(n_chars, 300 + doc_id % 2000))))::int as height from documents where n_chars > 0")
def fitted_sizes(spark, d):
    x = table(spark, d, "documents").where("n_chars > 0")
    return x.select("doc_id", watch.fitted_size(F.col("n_chars"), 300 + F.col("doc_id") % 2000).alias("s")).select("doc_id", "s.width", "s.height")


@query("watch_unfinished", "select page_id from pages where page_id % 4 <> 0 or page_id % 3 = 0")
def watch_unfinished(spark, d):
    p = table(spark, d, "pages")
    work = p.select("page_id", F.expr("concat('/in/', page_id)").alias("path"), F.expr("concat('/out/', page_id)").alias("target"))
    done = p.where("page_id % 4 = 0").select(F.expr("concat('/out/', page_id)").alias("target"), F.expr("if(page_id % 3 = 0, 0, 9)").alias("length"))
    return watch.unfinished(work, done).select("page_id")


_VERDICT = "v as (select event_id, k, case when k % 5 = 0 then null when k % 2 = 0 then true else false end as value from (select event_id, (props::json->>'k')::int as k from events))"


def _verdicts(spark, d):
    k = F.get_json_object("props", "$.k").cast("int")
    answer = F.when(k % 5 == 0, F.lit('I can {not} say: {"other": {"has_person": [1, 2]}}')).when(k % 2 == 0, F.lit('```json\n{"why": {"x": 1}, "has_person": "Yes"}\n```')).otherwise(F.lit('{"has_person": 0} is it'))
    return watch.verdicts(table(spark, d, "events").select("event_id", F.expr("concat('/in/', event_type, '/', event_id, '.jpg')").alias("path"), answer.alias("answer")), "has_person")


@query("answer_verdicts", f"with {_VERDICT} select event_id, value, case when value is null then 'fail' else 'ok' end as status from v")
def answer_verdicts(spark, d):
    return _verdicts(spark, d).select("event_id", "value", "status")


@query("mirrored_results", f"with {_VERDICT} select '/out/' || event_type || '/' || event_id || '.json' as target, '{{\"path\":\"' || event_type || '/' || event_id || '.jpg\",\"has_person\":' || v.value || '}}' as text from v join events using (event_id) where v.value is not null")
def mirrored_results(spark, d):
    return watch.mirrored(_verdicts(spark, d), "/in", "/out", "has_person")


@query("streamed_answers", "select event_id, event_type || k as answer from (select event_id, event_type, (props::json->>'k')::int as k from events)")
def streamed_answers(spark, d):
    part = lambda c: F.concat(F.lit('data: {"choices": [{"delta": {"content": "'), c, F.lit('"}}]}'))
    lines = F.array(F.lit('data: {"choices": [{"delta": {}}]}'), part(F.col("event_type")), F.lit(""), part(F.get_json_object("props", "$.k")), F.lit("data: [DONE]"))
    return table(spark, d, "events").select("event_id", watch.streamed_answer(lines).alias("answer"))


_NAMES = ["a", "b"]


@query("label_to_shape_files", "with l as (select doc_id % 400 as k, min(doc_id) as id from documents group by 1), i as (select page_id as k from pages) select coalesce(l.k, i.k)::varchar as stem, case when l.k is null then 'missing_label' when i.k is null then 'missing_image' when l.k % 5 = 0 then 'parse_error' end as issue, case when l.k is not null and i.k is not null and l.k % 5 <> 0 then l.k % 3 end as shapes from l full join i using (k)")
def label_to_shape_files(spark, d):
    line = "concat(doc_id % 2, if(doc_id % 5 = 0, ' 0.5 0.5 0.2', ' 0.25 0.5 0.5 0.5'))"
    text = f"case when doc_id % 5 = 0 then {line} when doc_id % 3 = 0 then '' when doc_id % 3 = 1 then {line} else concat({line}, '\\n', {line}) end"
    labels = table(spark, d, "documents").groupBy((F.col("doc_id") % 400).alias("doc_id")).agg(F.min("text").alias("t")).select(F.col("doc_id").cast("string").alias("stem"), F.expr(text).alias("text"))
    images = table(spark, d, "pages").select(F.col("page_id").cast("string").alias("stem"), F.expr("concat('t/', page_id, '.jpg')").alias("path"), F.lit(100).alias("width"), F.lit(80).alias("height"))
    x = exports.converted(labels, images, _NAMES)
    return x.select("stem", "issue", F.size(F.from_json(F.get_json_object("text", "$.shapes"), "array<string>")).cast("bigint").alias("shapes")).withColumn("shapes", F.when(F.col("shapes") >= 0, F.col("shapes")))


@query("label_file_texts", "select 'labels/' || doc_id || '.txt' as target, case doc_id % 3 when 0 then '' when 1 then '1 0.250000 0.500000 0.500000 0.250000' else '1 0.250000 0.500000 0.500000 0.250000' || chr(10) || '0 0.500000 0.500000 1.000000 1.000000' end as text from documents")
def label_file_texts(spark, d):
    kept = F.expr("slice(array(named_struct('label', 'b', 'box', array(0D, 0.375D, 0.5D, 0.25D)), named_struct('label', 'a', 'box', array(0D, 0D, 1D, 1D)), named_struct('label', 'z', 'box', array(0D, 0D, 1D, 1D))), 1, cast(if(doc_id % 3 = 2, 3, doc_id % 3) as int))")
    return exports.label_files(table(spark, d, "documents").select("doc_id", kept.alias("kept")), _NAMES, F.col("doc_id").cast("string"))


@query("image_copy_names", "select 'images/' || doc_id || '.jpg' as target, '/x/' || source || '.JPG' as source from documents")
def image_copy_names(spark, d):
    x = table(spark, d, "documents").select("doc_id", F.concat(F.lit("/x/"), "source", F.lit(".JPG")).alias("filepath"))
    return exports.image_copies(x, F.col("doc_id").cast("string"))


@query("task_file_kinds", "select page_id, page_id % 4 = 0 as sidecar, page_id % 4 = 1 as image from pages where page_id % 4 in (0, 1)")
def task_file_kinds(spark, d):
    name = "concat('/t/', page_id, '/', case page_id % 4 when 0 then 'a.json' when 1 then 'b.JPG' when 2 then 'Manifest.json' else 'c.txt' end)"
    sidecars, images = S.task_files(table(spark, d, "pages").select("page_id", F.expr(name).alias("path")))
    mark = lambda x, side: x.select("page_id", F.lit(side).alias("sidecar"), F.lit(not side).alias("image"))
    return mark(sidecars, True).unionByName(mark(images, False))


@query("name_keys", "select doc_id, source || '.tar' as stem, source || '.tar.gz' as name from documents")
def name_keys(spark, d):
    path = F.concat(F.lit("/a.b/"), "source", F.lit(".tar.GZ"))
    return table(spark, d, "documents").select("doc_id", C.name_key(path).alias("stem"), C.name_key(path, "name").alias("name"))


@query("watch_loop", "select event_id::varchar as path, case when k % 5 = 0 then 'fail' else 'ok' end as status, case when k % 5 <> 0 then k * 2 end as value from (select event_id, (props::json->>'k')::int as k from events)")
def watch_loop(spark, d):
    """The whole loop over what is there now: rows are scored, failures tried again, the last result of each kept."""
    schema = spark.read.parquet(f"{d}/events.parquet").schema
    stream = spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet").parquet(d)
    stream = stream.select(F.col("event_id").cast("string").alias("path"), F.get_json_object("props", "$.k").cast("int").alias("k"))
    place = f"{shared_folder(spark)}/framesift-watch-{uuid.uuid4().hex}"
    failed = F.col("k") % 5 == 0
    score = lambda rows: rows.select("path", F.when(failed, "fail").otherwise("ok").alias("status"), F.when(~failed, F.col("k") * 2).alias("value"))
    watch.keep_scored(stream, score, f"{place}/results", f"{place}/checkpoint", every=None).awaitTermination()
    return watch.latest_results(spark, f"{place}/results")
