"""The folder that driver and executors share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

_own: dict[str, str] = {}


def shared_folder(spark: SparkSession) -> str:
    """spark.checkpoint.dir. Where it is unset, a temporary folder in local mode, as in tests; on a cluster an error."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not folder:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        folder = _own["dir"] if "dir" in _own else _own.setdefault("dir", tempfile.mkdtemp(prefix="framesift-"))
    return folder.rstrip("/")


def shared_copy(df: DataFrame) -> DataFrame:
    """df written to the shared folder and read back."""
    path = f"{shared_folder(df.sparkSession)}/framesift-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def dropped_copy(df: DataFrame) -> None:
    """Deletes the files behind what shared_copy() has returned, when nothing reads them any more."""
    jvm, conf = df.sparkSession._jvm, df.sparkSession._jsc.hadoopConfiguration()
    for folder in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
        path = jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(conf).delete(path, True)


def numbered_within(rows: DataFrame, groups: list[str], order: list[str], name: str) -> DataFrame:
    """rows with name: 1, 2, ... in order of the columns order within each group of the columns groups; equal rows in any order.

    Rows are dealt out by ranges of both, so that one group that holds most rows is numbered by many tasks; numbers then
    go on from those of the ranges before. The ranges are written once: a second look at them would draw them anew.
    """
    x = shared_copy(rows.repartitionByRange(*[F.col(c) for c in (*groups, *order)]).withColumn("_part", F.spark_partition_id()))
    counts = x.groupBy(*groups, "_part").agg(F.count("*").alias("_n"))  # a row for each group in a range
    before = Window.partitionBy(*groups).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    base = counts.select(*[F.col(c).alias(f"_g{k}") for k, c in enumerate(groups)], F.col("_part").alias("_p"), F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_base"))
    on = F.col("_part") == F.col("_p")
    for k, c in enumerate(groups):
        on = on & F.col(c).eqNullSafe(F.col(f"_g{k}"))
    r = F.row_number().over(Window.partitionBy("_part", *groups).orderBy(*order))
    return x.join(base, on).withColumn(name, (F.col("_base") + r).cast("bigint")).select(*rows.columns, name)
