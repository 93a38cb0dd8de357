"""What the operators of this subpackage share: tables, written intermediates, hashing of texts."""

from __future__ import annotations

import atexit
import itertools
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from framesift.sources.shared import shared_folder

_written: list[tuple[SparkSession, str]] = []
_count = itertools.count()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def written(df: DataFrame, what: str) -> DataFrame:
    """df, cut from its lineage: written to the shared folder and read back, so that a lost executor costs no recomputation.

    The files are removed when the driver ends.
    """
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/framesift-{what}-{next(_count)}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    _written.append((spark, path))
    return spark.read.schema(df.schema).parquet(path)


def drop_written(*frames: DataFrame) -> None:
    """Deletes the files behind frames that written() has returned and nothing needs any more."""
    for df in frames:
        for path in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
            for spark, known in list(_written):
                if path.endswith(known.split(":", 1)[-1].lstrip("/")):
                    _delete(spark, known)
                    _written.remove((spark, known))


def _delete(spark: SparkSession, path: str) -> None:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)


@atexit.register
def _clean() -> None:
    for spark, path in _written:
        try:
            _delete(spark, path)
        except Exception:  # noqa: BLE001  the JVM may be gone already
            return


def partitions_for(spark: SparkSession, least: int = 1) -> int:
    return max(least, int(spark.conf.get("spark.sql.shuffle.partitions")))


def spread(df: DataFrame, *key: str) -> DataFrame:
    """df dealt out evenly: file splits of a large table are used as they are."""
    return df.repartition(partitions_for(df.sparkSession), *[F.col(k) for k in key])


def kept_in_process(what: str, key, make):
    """make(), or what it returned before in this Python process: later tasks of an executor's worker find it warm."""
    import builtins

    known = builtins.__dict__.setdefault("_framesift_kept", {})
    if known.get(what, (None,))[0] != key:
        known[what] = (key, make())
    return known[what][1]


def sorted_groups(batches: Iterator[pa.RecordBatch], n: int) -> Iterator[pa.Table]:
    """The groups of rows with equal first n columns (whole numbers), of batches sorted by them."""
    held: list[pa.RecordBatch] = []
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        keys = np.stack([batch.column(k).to_numpy(zero_copy_only=False).astype(np.int64) for k in range(n)], axis=1)
        cuts = [0, *(np.flatnonzero((keys[1:] != keys[:-1]).any(axis=1)) + 1).tolist(), len(keys)]
        for k, (a, b) in enumerate(zip(cuts, cuts[1:], strict=False)):
            if held and (k or last != tuple(keys[a])):
                yield pa.Table.from_batches(held)
                held = []
            held.append(batch.slice(a, b - a))
            last = tuple(keys[a])
    if held:
        yield pa.Table.from_batches(held)
