"""Samples, boxes, tags and tracks built from the generic tables, as DataFrames and as SQL for the same."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def samples(spark: SparkSession, sf_dir: str, decided: bool = False) -> DataFrame:
    """Documents as samples; decided: some carry tags of earlier decisions."""
    labels = table(spark, sf_dir, "labels").select("doc_id", (F.col("quality") + F.col("toxic")).alias("boxes"))
    d = table(spark, sf_dir, "documents").join(labels, "doc_id", "left")
    tags = F.expr("case when doc_id % 5 = 0 then array('x', 'dup_repeat_keep') when doc_id % 3 = 0 then array('dup_repeat_drop', 'y') else array('z') end") if decided else F.array(F.lit("z"))
    return d.select(
        F.col("doc_id").alias("sample_id"), F.concat(F.lit("/images/"), "source", F.lit("/"), F.col("doc_id").cast("string"), F.lit(".jpg")).alias("filepath"), F.sha2("text", 256).alias("sha256"),
        F.col("n_chars").alias("area"), F.coalesce("boxes", F.lit(0)).cast("bigint").alias("box_count"), (F.col("lang") != "fr").alias("file_exists"), tags.alias("tags"),
        F.lit("").alias("dup_group"), F.lit("").alias("dup_of"),
    )


def samples_sql(decided: bool = False) -> str:
    tags = "case when doc_id % 5 = 0 then ['x', 'dup_repeat_keep'] when doc_id % 3 = 0 then ['dup_repeat_drop', 'y'] else ['z'] end" if decided else "['z']"
    return f"""samples as (select doc_id as sample_id, '/images/' || source || '/' || doc_id || '.jpg' as filepath, sha256(text) as sha256, n_chars as area,
  coalesce(quality + toxic, 0)::bigint as box_count, lang <> 'fr' as file_exists, {tags} as tags from documents left join labels using (doc_id))"""


def boxes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items as boxes of one sample for each order: (sample_id, idx, label, box)."""
    x = table(spark, sf_dir, "lineitem")
    x = x.select(F.col("l_orderkey").alias("sample_id"), "l_returnflag", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_discount", "l_tax", "l_extendedprice", "l_shipdate")
    from pyspark.sql import Window

    w = Window.partitionBy("sample_id").orderBy("l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_discount", "l_tax", "l_extendedprice", "l_shipdate", "l_returnflag")
    box = F.array(F.expr("l_discount * 8 - 0.1"), F.expr("l_tax * 10 - 0.05"), F.expr("(l_quantity - 1) / 50 + 0.0005"), F.expr("cast(l_partkey % 100 as double) / 90"))
    return x.select("sample_id", (F.row_number().over(w) - 1).alias("idx"), F.col("l_returnflag").alias("label"), box.alias("box"))


BOXES_SQL = """boxes as (select l_orderkey as sample_id, row_number() over (partition by l_orderkey order by l_linenumber, l_partkey, l_suppkey, l_quantity, l_discount, l_tax, l_extendedprice, l_shipdate, l_returnflag) - 1 as idx,
  l_returnflag as label, l_discount * 8 - 0.1 as x, l_tax * 10 - 0.05 as y, (l_quantity - 1) / 50 + 0.0005 as w, (l_partkey % 100)::double / 90 as h from lineitem)"""


def tagged(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Users of events as samples: their event types and age tags, in order of time."""
    e = table(spark, sf_dir, "events").select("user_id", "ts", "event_id", "event_type", F.get_json_object("props", "$.k").cast("int").alias("k"))
    g = e.groupBy("user_id").agg(F.array_sort(F.collect_list(F.struct("ts", "event_id", "event_type", "k"))).alias("s"))
    kinds = F.transform("s", lambda v: v["event_type"])
    ages = F.transform(F.filter("s", lambda v: v["k"] % 3 == 0), lambda v: F.concat(F.lit("age_"), (v["k"] % 7).cast("string")))
    return g.select(F.col("user_id").alias("sample_id"), F.concat(kinds, ages).alias("tags"))


TAGGED_SQL = """e as (select user_id, event_type, (props::json->>'k')::int as k, row_number() over (partition by user_id order by ts, event_id) as r from events),
tagged as (select user_id as sample_id, list(event_type order by r) || coalesce(list('age_' || (k % 7) order by r) filter (where k % 3 = 0), []) as tags from e group by 1)"""
