"""Queries for duplicates, similarity and content matching."""

from __future__ import annotations

from pyspark.sql import functions as F

from framesift.operators import dedup, matching, similarity
from framesift.plans.registry import query
from framesift.plans.standins import samples, samples_sql, table

_RANK = "order by (case when box_count > 0 and file_exists then 0 else 1 end), (case when box_count > 0 then 0 else 1 end), (case when file_exists then 0 else 1 end), box_count desc, area desc, filepath, sample_id"
_ROLES = f"""x as (select *, count(*) over (partition by sha256) as members, row_number() over (partition by sha256 {_RANK}) as r, first_value(filepath) over (partition by sha256 {_RANK}) as best from samples),
roles as (select sample_id, sha256, 'exact:' || sha256 as group_id, case when r = 1 then 'keep' else 'drop' end as role, case when r > 1 then best end as dup_of from x where members >= 2)"""
_EXACT = f"with {samples_sql()}, {_ROLES}"
_STICKY = f"""with {samples_sql(True)},
f as (select *, list_contains(tags, 'dup_repeat_keep') as k, not list_contains(tags, 'dup_repeat_keep') and list_contains(tags, 'dup_repeat_drop') as d from samples),
g as (select sha256, count(*) as members, count_if(k) as keeps, count_if(k or d) as decided from f group by 1 having count(*) >= 2),
x as (select f.*, keeps, decided, row_number() over (partition by sha256 {_RANK}) as r, first_value(filepath) over (partition by sha256 {_RANK}) as best,
  first_value(filepath) over (partition by sha256 order by k desc, {_RANK[9:]}) as bk from f join g using (sha256)),
roles as (select sample_id, tags, 'exact:' || sha256 as group_id, case when decided = 0 then (case when r = 1 then 'keep' else 'drop' end) when k then 'keep' when d then 'drop' when keeps > 0 then 'drop' end as role,
  case when decided = 0 then best when keeps > 0 then bk end as keeper from x)"""


def _exact(spark, d, decided=False):
    return dedup.group_roles(samples(spark, d, decided), "sha256", "dup_repeat_keep", "dup_repeat_drop", "exact")


@query("dedup_exact_roles", f"{_EXACT} select sample_id, group_id, role, dup_of from roles")
def exact_roles(spark, d):
    return _exact(spark, d).select("sample_id", "group_id", "role", "dup_of")


@query("dedup_exact_summary", f"{_EXACT}, g as (select group_id, count(*) m, count_if(role = 'keep') k, count_if(role = 'drop') dr from roles group by 1) select count(*)::bigint as groups, sum(m)::bigint as members, sum(k)::bigint as keeps, sum(dr)::bigint as drops, count_if(k <> 1)::bigint as conflicts from g")
def exact_summary(spark, d):
    return dedup.summary(_exact(spark, d))


@query("dedup_sticky_roles", f"{_STICKY} select sample_id, group_id, role, case when role = 'drop' then keeper end as dup_of from roles")
def sticky_roles(spark, d):
    return _exact(spark, d, True).select("sample_id", "group_id", "role", "dup_of")


@query("dedup_report_shards", f"{_EXACT} select ((dense_rank() over (order by group_id) - 1) // 20)::bigint as shard, group_id, sample_id, role from roles")
def report_shards(spark, d):
    return dedup.report_shards(_exact(spark, d), 20)


def _bits(spark, d, n=64):
    sign = " | ".join(f"if(embedding[{k}] > 0, {1 << k}L, 0L)" if k < 63 else f"if(embedding[63] > 0, -9223372036854775807L - 1L, 0L)" for k in range(n))
    return table(spark, d, "embeddings").select(F.col("vec_id").alias("id"), F.expr(sign).alias("bits"))


def _bits_sql(n=64):
    return "h as (select vec_id as id, " + " + ".join(f"(case when embedding[{k + 1}] > 0 then {1 << k if k < 63 else -(1 << 63)} else 0 end)::bigint" for k in range(n)) + " as bits from embeddings)"


_PAIRS = f"{_bits_sql()}, r as (select bits, min(id) as id from h group by 1), p as (select x.id as a, y.id as b, bit_count(xor(x.bits, y.bits))::bigint as distance from r x join r y on x.id < y.id where bit_count(xor(x.bits, y.bits)) <= 17)"


@query("near_pairs_hamming", f"with {_PAIRS} select a, b, distance from p")
def near_pairs(spark, d):
    return similarity.hamming_pairs(_bits(spark, d), 17)


@query("near_components", f"with recursive {_PAIRS}, e as (select a, b from p union select b, a from p), c as (select a as id, a as root from e union select e.b, c.root from c join e on e.a = c.id) select id, min(root) as root from c group by 1")
def near_components(spark, d):
    return similarity.components(similarity.hamming_pairs(_bits(spark, d), 17))


@query("near_components_low_bits", f"with recursive {_bits_sql(12)}, r as (select bits, min(id) as id from h group by 1), e as (select x.id as a, y.id as b from r x join r y on x.id <> y.id where bit_count(xor(x.bits, y.bits)) <= 1), c as (select a as id, a as root from e union select e.b, c.root from c join e on e.a = c.id) select id, min(root) as root from c group by 1")
def near_components_low_bits(spark, d):
    return similarity.components(similarity.hamming_pairs(_bits(spark, d, 12), 1))


@query("content_gate", """with c as (select item_id, sha256(text) as sha, length(text)::varchar as near, row_number() over (partition by sha256(text) order by item_id) as n, min(item_id) over (partition by sha256(text)) as first_id from benchmark),
s as (select sha256(text) as sha, count(*) as hits from documents group by 1), m as (select length(text)::varchar as near, min(doc_id) as doc from documents group by 1)
select item_id, case when n > 1 then 'batch_dup' when hits is not null then 'exact' when doc is not null then 'near' else 'new' end as status, case when n > 1 then first_id when hits is null then doc end as detail from c left join s using (sha) left join m using (near)""")
def content_gate(spark, d):
    c = table(spark, d, "benchmark").select(F.col("item_id").alias("path"), F.sha2("text", 256).alias("sha256"), F.length("text").cast("string").alias("phash"))
    s = table(spark, d, "documents").select(F.col("doc_id").alias("sample_id"), F.sha2("text", 256).alias("sha256"), F.length("text").cast("string").alias("phash"))
    return matching.gate(c, s).select(F.col("path").alias("item_id"), "status", "detail")


_IMG = "i as (select page_id as path, case when page_id % 3 = 0 then sha256('d' || (page_id % 40)) else sha256('p' || page_id) end as sha, (page_id % 30)::varchar as ph from pages), s as (select doc_id as sample_id, sha256('d' || (doc_id % 60)) as sha, (doc_id % 700)::varchar as ph from documents)"


@query("match_unique_sha_then_hash", f"""with {_IMG}, a as (select sha, count(*) n, min(sample_id) id from s group by 1), b as (select ph, count(*) n, min(sample_id) id from s group by 1)
select path, case when a.n > 1 then 'ambiguous_sha256' when a.n = 1 then 'sha256' when b.n > 1 then 'ambiguous_phash' when b.n = 1 then 'phash' else 'unmatched' end as how, case when a.n = 1 then a.id when a.n is null and b.n = 1 then b.id end as sample_id from i left join a using (sha) left join b using (ph)""")
def match_unique(spark, d):
    i = table(spark, d, "pages").select(F.col("page_id").alias("path"), F.expr("case when page_id % 3 = 0 then sha2(concat('d', page_id % 40), 256) else sha2(concat('p', page_id), 256) end").alias("sha256"), F.expr("cast(page_id % 30 as string)").alias("phash"))
    s = table(spark, d, "documents").select(F.col("doc_id").alias("sample_id"), F.expr("sha2(concat('d', doc_id % 60), 256)").alias("sha256"), F.expr("cast(doc_id % 700 as string)").alias("phash"))
    return matching.unique_match(i, s).select("path", "how", "sample_id")


@query("relink_paths", """with s as (select doc_id as sample_id, '/old/' || (doc_id % 9) || '/' || (doc_id % 17) || '.jpg' as old, sha256(text) as sha from documents),
f as (select distinct sha256(text) as sha, case when doc_id % 4 = 0 then '/old/' || (doc_id % 9) || '/' || (doc_id % 17) || '.jpg' else '/new/' || (doc_id % 17) || '.jpg' end as target from documents),
t as (select sha, list(target order by target) as targets from f group by 1),
m as (select sample_id, old, targets, list_filter(targets, lambda p: regexp_extract(p, '[^/]*$') = regexp_extract(old, '[^/]*$')) as same from s join t using (sha)),
c as (select sample_id, old, case when list_contains(targets, old) then 'unchanged' when len(targets) = 1 or len(same) = 1 then 'move' else 'ambiguous_image_hash' end as what, case when len(targets) = 1 then targets[1] when len(same) = 1 then same[1] end as target from m),
o as (select old as target, count(*) as owners from s group by 1), n as (select target, count(*) as takers from c where what = 'move' group by 1)
select sample_id, case when what = 'move' and owners is not null then 'target_already_registered' when what = 'move' and takers > 1 then 'sample_hash_collision' else what end as status from c left join o using (target) left join n using (target)""")
def relink(spark, d):
    x = table(spark, d, "documents")
    s = x.select(F.col("doc_id").alias("sample_id"), F.expr("concat('/old/', doc_id % 9, '/', doc_id % 17, '.jpg')").alias("filepath"), F.sha2("text", 256).alias("sha256"))
    f = x.select(F.sha2("text", 256).alias("sha256"), F.expr("case when doc_id % 4 = 0 then concat('/old/', doc_id % 9, '/', doc_id % 17, '.jpg') else concat('/new/', doc_id % 17, '.jpg') end").alias("target"))
    return matching.relink(s, f).select("sample_id", "status")


@query("hash_rename_plan", "with f as (select doc_id, source as parent, doc_id || '.JPG' as name, sha256(text) as sha from documents) select doc_id, parent || '/' || sha || (case when r > 1 then '-' || r else '' end) || '.jpg' as target from (select *, row_number() over (partition by parent, sha order by (name <> sha || '.jpg'), name) as r from f)")
def hash_rename(spark, d):
    f = table(spark, d, "documents").select("doc_id", F.col("source").alias("parent"), F.concat(F.col("doc_id").cast("string"), F.lit(".JPG")).alias("name"), F.sha2("text", 256).alias("sha256"))
    return matching.rename_plan(f).select("doc_id", "target")


_STEMS = "i as (select page_id as id, 'img' || (page_id % 180) as stem from pages), l as (select doc_id as id, 'img' || doc_id * 2 as stem from documents)"


def _stems(spark, d):
    i = table(spark, d, "pages").select(F.expr("concat('img', page_id % 180, '.jpg')").alias("path"))
    return i, table(spark, d, "documents").select(F.expr("concat('img', doc_id * 2, '.txt')").alias("path"))


@query("pair_by_stem_full_outer", f"with {_STEMS}, a as (select stem, count(*) n from i group by 1), b as (select stem, count(*) m from l group by 1) select stem, case when n > 1 or m > 1 then 'path_collision' when n is null then 'missing_image' when m is null then 'missing_label' else 'pair' end as status from a full join b using (stem)")
def pair_full_outer(spark, d):
    return matching.pair_full(*_stems(spark, d))


@query("orphan_anti_join", f"with {_STEMS} select stem from l where stem not in (select stem from i)")
def orphans(spark, d):
    return matching.orphan_labels(*_stems(spark, d))


@query("filter_rows_keep", f"with {_STEMS} select stem from l where stem in (select stem from i)")
def rows_keep(spark, d):
    return matching.rows_by_stem(*reversed(_stems(spark, d)), keep=True)


@query("filter_rows_delete", f"with {_STEMS} select stem from l where stem not in (select stem from i)")
def rows_delete(spark, d):
    return matching.rows_by_stem(*reversed(_stems(spark, d)), keep=False)


@query("extract_by_stem", f"with {_STEMS}, n as (select distinct stem from l), c as (select stem, count(*) k from i group by 1) select stem, case when k is null then 'missing' when k > 1 then 'collision' else 'copy' end as status from n left join c using (stem)")
def extract(spark, d):
    return matching.extraction_plan(*_stems(spark, d))


@query("attach_issue_cascade", """with f as (select page_id as path, case when page_id % 4 = 0 then page_id % 50 + (case when page_id % 8 = 0 then 100000 else 0 end) end as claimed, sha256('d' || (page_id % 90)) as sha from pages),
s as (select doc_id as sample_id, sha256('d' || (doc_id % 80 + (case when doc_id > 100 then 1000 else 0 end))) as sha from documents), h as (select sha, count(*) n, min(sample_id) id from s group by 1),
m as (select path, claimed, c.sample_id as by_id, n, h.id as by_hash from f left join s c on c.sample_id = claimed left join h on h.sha = f.sha),
k as (select path, case when claimed is not null and by_id is null then 'orphan_sample_id' when claimed is not null then 'match' when n is null then 'orphan' when n > 1 then 'ambiguous' else 'match' end as st, case when claimed is not null then by_id when n = 1 then by_hash end as sample_id from m)
select path, case when st = 'match' and row_number() over (partition by st, sample_id order by path) > 1 then 'sample_id_collision' else st end as status, sample_id from k""")
def attach(spark, d):
    f = table(spark, d, "pages").select(F.col("page_id").alias("path"), F.expr("case when page_id % 4 = 0 then page_id % 50 + case when page_id % 8 = 0 then 100000 else 0 end end").alias("claimed"), F.expr("sha2(concat('d', page_id % 90), 256)").alias("sha256"))
    s = table(spark, d, "documents").select(F.col("doc_id").alias("sample_id"), F.expr("sha2(concat('d', doc_id % 80 + case when doc_id > 100 then 1000 else 0 end), 256)").alias("sha256"))
    return matching.attach(f, s)


@query("media_hash", "select doc_id, sha256(text) as sha256 from documents")
def media_hash(spark, d):
    return table(spark, d, "documents").select("doc_id", F.sha2(F.encode("text", "utf-8"), 256).alias("sha256"))


@query("import_counts", "select case when grouping(source) = 1 then 'all' else source end as split, count(*)::bigint as samples, count_if(lang = 'en')::bigint as labelled, count_if(n_chars < 1000)::bigint as negatives from documents group by rollup (source)")
def import_counts(spark, d):
    x = table(spark, d, "documents").rollup("source").agg(F.count("*").alias("samples"), F.count_if(F.col("lang") == "en").alias("labelled"), F.count_if(F.col("n_chars") < 1000).alias("negatives"), F.grouping("source").alias("g"))
    return x.select(F.when(F.col("g") == 1, "all").otherwise(F.col("source")).alias("split"), "samples", "labelled", "negatives")


@query("group_paths", "select sha256(text) as sha256, array_to_string(list(distinct 'p' || doc_id order by 'p' || doc_id), ',') as paths from documents group by 1 having count(*) > 1")
def group_paths(spark, d):
    x = table(spark, d, "documents").groupBy(F.sha2("text", 256).alias("sha256")).agg(F.sort_array(F.collect_set(F.concat(F.lit("p"), F.col("doc_id").cast("string")))).alias("p"), F.count("*").alias("n"))
    return x.where("n > 1").select("sha256", F.array_join("p", ",").alias("paths"))
