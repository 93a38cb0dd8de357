"""The watch loop: new files or rows are scored once; failures are retried on the next trigger."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from framesift.functions.columns import lenient_bool
from framesift.operators.exports import relative_path
from framesift.sources.files import finished_files
from framesift.sources.shared import shared_folder
from framesift.sources.textformats import answer_json


def watched(spark: SparkSession, folder: str, every: str | None = "30 seconds"):
    """A stream of the images that come up in a folder; every=None: what is there now, once."""
    x = spark.readStream.format("binaryFile").option("recursiveFileLookup", "true").load(folder)
    x = finished_files(x).withColumn("relative", relative_path(F.regexp_replace("path", "^file:/*", "/"), folder))
    return x.writeStream.trigger(**({"processingTime": every} if every else {"availableNow": True}))


def fitted_size(width: Column, height: Column, longest: int = 1024) -> Column:
    """struct<width, height>: a size scaled down so that its longer side is at most longest; whole pixels, at least 1."""
    scale = F.least(F.lit(1.0), F.try_divide(F.lit(float(longest)), F.greatest(width, height)))
    side = lambda v: F.greatest(F.lit(1), F.floor(v * scale)).cast("int")
    return F.struct(side(width).alias("width"), side(height).alias("height"))


def call_payload(prompt: str, image: Column, model: str) -> Column:
    """The JSON body of a chat call about one image, given as bytes of a JPEG file."""
    url = F.concat(F.lit("data:image/jpeg;base64,"), F.base64(image))
    content = F.array(F.struct(F.lit("text").alias("type"), F.lit(prompt).alias("text"), F.lit(None).cast("struct<url:string>").alias("image_url")), F.struct(F.lit("image_url").alias("type"), F.lit(None).cast("string").alias("text"), F.struct(url.alias("url")).alias("image_url")))
    return F.to_json(F.struct(F.lit(model).alias("model"), F.array(F.struct(F.lit("user").alias("role"), content.alias("content"))).alias("messages")))


def streamed_answer(lines: Column) -> Column:
    """The text of an answer that came as lines "data: {...}" of choices with deltas, up to [DONE]."""
    data = F.filter(F.transform(lines, lambda v: F.regexp_extract(v, r"^data:\s*(.*)$", 1)), lambda v: (v != "") & (v != "[DONE]"))
    parts = F.transform(data, lambda v: F.coalesce(F.get_json_object(v, "$.choices[0].delta.content"), F.lit("")))
    return F.array_join(parts, "")


def verdicts(answers: DataFrame, key: str) -> DataFrame:
    """answers(path, answer) with value, the boolean of a key in the answer's JSON, and status: ok, or fail without one."""
    value = lenient_bool(F.get_json_object(answer_json(F.col("answer"), key), f"$.{key}"))
    return answers.withColumn("value", value).withColumn("status", F.when(F.col("value").isNull(), "fail").otherwise("ok"))


def mirrored(results: DataFrame, root: str, out: str, key: str) -> DataFrame:
    """results(path, status, value) of files below root to (target, text): a JSON file for each ok one, at the same place below out."""
    relative = relative_path(F.col("path"), root)
    name = F.concat(F.lit(out.rstrip("/") + "/"), F.regexp_replace(relative, r"\.[^./]+$", ""), F.lit(".json"))
    return results.where("status = 'ok'").select(name.alias("target"), F.to_json(F.struct(relative.alias("path"), F.col("value").alias(key))).alias("text"))


def unfinished(work: DataFrame, outputs: DataFrame, empty_is_done: bool = False) -> DataFrame:
    """work(path, target) whose output is not complete: outputs(target, length) lacks it, or has it empty."""
    done = outputs if empty_is_done else outputs.where("length > 0")
    return work.join(done.select("target").distinct(), "target", "left_anti").select(*work.columns)


def score_new(batch: DataFrame, done: DataFrame, score) -> DataFrame:
    """Rows of a batch without a finished result, scored; those that fail keep status fail and come again."""
    return score(batch.join(done.where("status = 'ok'").select("path"), "path", "left_anti"))


def keep_scored(stream: DataFrame, score, results: str, checkpoint: str, every: str | None = "30 seconds", retries: int = 1):
    """Scores the rows (path, ...) of a stream into the table results(path, status, ...): a started query.

    score takes a DataFrame of new rows and returns path, status (ok or fail) and more columns. A row whose result of
    an earlier round is ok is never scored again; a round that runs twice replaces its own results. Rows that fail are
    scored again in the same round, retries times, and come again with each later round until they are ok.
    """
    spark = stream.sparkSession
    hidden = f"{results.rstrip('/')}_pending"

    def table(path: str) -> DataFrame | None:
        p = spark._jvm.org.apache.hadoop.fs.Path(path)
        return spark.read.parquet(path) if p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p) else None

    def one_round(batch: DataFrame, n: int) -> None:
        if n:
            before = table(f"{hidden}/round={n - 1}")
            batch = batch if before is None else batch.unionByName(before.select(*batch.columns)).dropDuplicates(["path"])
        done = table(results)
        rows = batch if done is None else batch.join(done.where(f"status = 'ok' and round < {n}").select("path").distinct(), "path", "left_anti")
        for k in range(retries + 1):
            part = f"{results}/round={n}/try={k}"
            score(rows).write.mode("overwrite").parquet(part)
            failed = spark.read.parquet(part).where("status <> 'ok'").select("path").distinct()
            rows = rows.join(failed, "path", "left_semi")
        rows.write.mode("overwrite").parquet(f"{hidden}/round={n}")

    trigger = {"processingTime": every} if every else {"availableNow": True}
    return stream.writeStream.foreachBatch(one_round).option("checkpointLocation", checkpoint).trigger(**trigger).start()


def latest_results(spark: SparkSession, results: str) -> DataFrame:
    """The last result of each path."""
    x = spark.read.parquet(results)
    last = x.groupBy("path").agg(F.max(F.struct("round", "try", F.struct(*[c for c in x.columns if c not in ("path", "round", "try")]).alias("r"))).alias("m"))
    return last.select("path", "m.r.*")


def counted_once(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events by type, through a stream over what is there now."""
    schema = spark.read.parquet(f"{sf_dir}/events.parquet").schema
    x = spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet").parquet(sf_dir)
    name = f"framesift_watch_{abs(hash(sf_dir))}"
    q = x.groupBy("event_type").agg(F.count("*").alias("n")).writeStream.outputMode("complete").format("memory").queryName(name)
    q = q.option("checkpointLocation", f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}").trigger(availableNow=True).start()
    q.awaitTermination()
    return spark.table(name)
