"""Files: listings as tables, and writers that carry out a plan (a table of targets) with guards.

Writers run in the tasks: a file is written beside its target under a name of its own and then moved into place, so that
a task that is run again, or twice at a time, leaves one whole file. Targets lie in a folder that all executors share.
"""

from __future__ import annotations

import os
import shutil
import uuid
from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from framesift.functions.columns import stem, suffix

# Suffixes of images, of files still being copied, and the field separators of tables as text.
IMAGES = (".bmp", ".gif", ".jpeg", ".jpg", ".png", ".tif", ".tiff", ".webp")
UNFINISHED = (".crdownload", ".part", ".tmp")
SEPARATORS = (",", ";", "\t", "|")


def listed(spark: SparkSession, folder: str, suffixes: Sequence[str] = IMAGES, recursive: bool = True) -> DataFrame:
    """(path, length, modified) of the files under a folder of any file system. No content is read; Spark lists large trees
    in tasks. A link counts as a file of its own. Empty and hidden files are absent: those need listed_locally()."""
    x = spark.read.format("binaryFile").option("recursiveFileLookup", str(recursive).lower()).load(folder)
    x = x.select("path", "length", F.col("modificationTime").alias("modified"))
    return x.where(suffix(F.col("path")).isin(*suffixes)) if suffixes else x


def listed_locally(spark: SparkSession, folder: str, suffixes: Sequence[str] = (), recursive: bool = True, links: str = "resolve") -> DataFrame:
    """(path, relative, length, is_link), of a mounted folder, empty and hidden files too, in order of path, each real file once.

    links: resolve (a dangling one is an error), skip. Linked folders are not entered.
    """
    if links not in ("resolve", "skip"):
        raise ValueError(f"links: resolve or skip, not {links}")

    def walk(at: str) -> Iterator[tuple[str, str, int, bool]]:
        with os.scandir(at) as entries:
            for e in sorted(entries, key=lambda e: e.name):
                if e.is_dir(follow_symlinks=False):
                    if recursive:
                        yield from walk(e.path)
                elif e.is_symlink() and (links == "skip" or os.path.isdir(e.path)):
                    continue
                elif not suffixes or os.path.splitext(e.name)[1].lower() in suffixes:
                    real = os.path.realpath(e.path, strict=True)
                    yield real, os.path.relpath(e.path, folder), os.stat(real).st_size, e.is_symlink()

    rows = {r[0]: r for r in walk(os.path.abspath(folder))}
    return spark.createDataFrame(list(rows.values()), "path string, relative string, length bigint, is_link boolean")


def scanned_folder(spark: SparkSession, folder: str, suffixes: Sequence[str] = IMAGES) -> tuple[DataFrame, int]:
    """The files of one mounted folder, each real file once, and how many folders are in it (these are not entered)."""
    return listed_locally(spark, folder, suffixes, recursive=False), len(split_names(folder))


def split_folders(root: str, split: str) -> tuple[str, str | None]:
    """The folders of images and of labels of a split; None where a split has no labels."""
    images, labels = (os.path.join(root, kind, split) for kind in ("images", "labels"))
    if not os.path.isdir(images):
        raise FileNotFoundError(images)
    return images, labels if os.path.isdir(labels) else None


def task_files(files: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The shape files and the images of a listing of a task's folder."""
    return sidecar_files(files), files.where(suffix(F.col("path")).isin(*IMAGES))


def first_files(files: DataFrame, limit: int | None = None) -> tuple[DataFrame, int, int]:
    """The first files(path, length) in order of path, all without a limit; their number and bytes."""
    x = files if limit is None else files.orderBy("path").limit(limit)
    n, size = x.agg(F.count("*"), F.coalesce(F.sum("length"), F.lit(0))).first()
    return x, n, int(size)


def split_names(folder: str) -> list[str]:
    """The names of the folders in a folder, sorted."""
    with os.scandir(folder) as entries:
        return sorted(e.name for e in entries if e.is_dir())


def sidecar_files(files: DataFrame) -> DataFrame:
    """The .json files of a listing other than manifests."""
    return files.where((suffix(F.col("path")) == ".json") & (F.lower(F.regexp_extract("path", "[^/]*$", 0)) != "manifest.json"))


def label_index(files: DataFrame) -> DataFrame:
    """(stem, path): of text files with one stem the last in order of path."""
    return files.where(suffix(F.col("path")) == ".txt").groupBy(stem(F.col("path")).alias("stem")).agg(F.max("path").alias("path"))


def finished_files(files: DataFrame) -> DataFrame:
    """A listing without dot files and files still being copied."""
    name = F.regexp_extract("path", "[^/]*$", 0)
    return files.where(~name.startswith(".") & ~suffix(F.col("path")).isin(*UNFINISHED))


def read_table(spark: SparkSession, path: str) -> DataFrame:
    """A table as text with a header: the separator is the one most frequent in the first line; a byte order mark goes."""
    first = spark.read.text(path).first()
    line = first[0] if first else ""
    x = spark.read.csv(path, sep=max(SEPARATORS, key=line.count), header=True)
    return x.toDF(*[c.lstrip("﻿") for c in x.columns])


def path_inside(path: Column, folder: str) -> Column:
    """Whether a normal path lies in a folder, by its text."""
    return path.startswith(folder.rstrip("/") + "/")


def write_files(files: DataFrame, root: str, existing: str = "error") -> DataFrame:
    """Writes files(target, and text or content or source) below root; (target, status) says what came of each.

    text and content are written, source is copied (links are followed). existing: error (status exists, nothing is
    written), skip or replace. A target outside root, or one that several rows name, is refused. Runs when the result is
    evaluated: write it to a table, do not evaluate it twice.
    """
    kind = next(c for c in ("text", "content", "source") if c in files.columns)
    at = os.path.abspath(root)
    again = files.groupBy("target").agg(F.count("*").alias("_n"))
    x = files.select("target", kind).join(again, "target")

    def put(target: str, value, n: int) -> str:
        path = os.path.normpath(os.path.join(at, target))
        if not path.startswith(at + os.sep):
            return "outside"
        if n > 1:
            return "collision"
        if existing != "replace" and os.path.lexists(path):
            return "exists" if existing == "error" else "skipped"
        if value is None or kind == "source" and not os.path.isfile(value):
            return "missing"
        os.makedirs(os.path.dirname(path), exist_ok=True)
        temp = f"{path}.{uuid.uuid4().hex}.tmp"
        try:
            if kind == "source":
                shutil.copyfile(value, temp)
            else:
                with open(temp, "wb") as f:
                    f.write(value.encode() if kind == "text" else value)
            os.replace(temp, path)
        finally:
            if os.path.exists(temp):
                os.remove(temp)
        return "written"

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for p in batches:
            yield pd.DataFrame({"target": p["target"], "status": [put(t, v, n) for t, v, n in zip(p["target"], p[kind], p["_n"], strict=True)]})

    return x.mapInPandas(run, "target string, status string")


def rename_all(moves: DataFrame) -> int:
    """Renames files of moves(source, target), all or none: first to names of their own, then to the targets, so that
    targets may be sources of others. What has been moved goes back if a step fails. The plan of one folder, by the driver."""
    plan = [(r.source, r.target) for r in moves.where("source <> target").orderBy("source").toLocalIterator()]
    if len({t for _, t in plan}) < len(plan):
        raise ValueError("several files for one target")
    steps = [(s, os.path.join(os.path.dirname(s), f".{uuid.uuid4().hex}.tmp")) for s, _ in plan]
    steps += [(aside, target) for (_, aside), (_, target) in zip(list(steps), plan, strict=True)]
    done: list[tuple[str, str]] = []
    try:
        for a, b in steps:
            if os.path.lexists(b):
                raise FileExistsError(b)
            os.rename(a, b)
            done.append((a, b))
    except OSError:
        for a, b in reversed(done):
            os.rename(b, a)
        raise
    return len(plan)


def append_rows(rows: DataFrame, path: str) -> None:
    rows.write.mode("append").parquet(path)


def replace_table(rows: DataFrame, path: str) -> None:
    """A table in place of another, which stays until the new one is whole; a failed write leaves the old one."""
    spark = rows.sparkSession
    at = lambda p: spark._jvm.org.apache.hadoop.fs.Path(p)
    fs = at(path).getFileSystem(spark._jsc.hadoopConfiguration())
    new, old = f"{path.rstrip('/')}.new-{uuid.uuid4().hex}", f"{path.rstrip('/')}.old-{uuid.uuid4().hex}"
    try:
        rows.write.parquet(new)
    except Exception:
        fs.delete(at(new), True)
        raise
    if fs.exists(at(path)):
        fs.rename(at(path), at(old))
    fs.rename(at(new), at(path))
    fs.delete(at(old), True)


def with_updates(rows: DataFrame, updates: DataFrame, key: str) -> DataFrame:
    """rows with the columns of updates, for the keys that updates has (each once); nulls there are values."""
    names = [c for c in updates.columns if c != key]
    u = updates.select(key, F.struct(*names).alias("_u"))
    return rows.join(u, key, "left").select(*[F.when(F.col("_u").isNotNull(), F.col(f"_u.{c}")).otherwise(F.col(c)).alias(c) if c in names else F.col(c) for c in rows.columns])


def without_ids(rows: DataFrame, gone: DataFrame, key: str) -> DataFrame:
    return rows.join(gone.select(key).distinct(), key, "left_anti").select(*rows.columns)


def write_report(rows: DataFrame, path: str, order: Sequence[str]) -> bool:
    """Rows as CSV files in order; without rows a report of before is removed. Whether there is a report now."""
    spark = rows.sparkSession
    if rows.isEmpty():
        p = spark._jvm.org.apache.hadoop.fs.Path(path)
        p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)
        return False
    rows.orderBy(*order).write.mode("overwrite").option("header", True).csv(path)
    return True


def rewrite_table(spark: SparkSession, path: str, change) -> int:
    """Puts change(rows) in place of a table as text, one file: written beside it, with its separator, then moved. The rows left."""
    with open(path, encoding="utf-8-sig") as f:
        line = f.readline()
    rows = change(read_table(spark, path))
    temp = f"{path}.{uuid.uuid4().hex}.tmp"
    try:
        rows.coalesce(1).write.csv(temp, sep=max(SEPARATORS, key=line.count), header=True)
        part = next((e.path for e in os.scandir(temp) if e.name.endswith(".csv")), None)
        left = spark.read.csv(temp, header=True, schema=rows.schema, sep=max(SEPARATORS, key=line.count)).count()
        if part is None:  # no rows: the header alone
            with open(path, "w", encoding="utf-8") as f:
                f.write(line)
        else:
            os.replace(part, path)
    finally:
        shutil.rmtree(temp, ignore_errors=True)
    return left


def require_new(path: str) -> None:
    """Refuses an output file that is there already, as a link too."""
    if os.path.lexists(path):
        raise FileExistsError(path)


def require_empty(folder: str) -> None:
    """Refuses an output folder that is a link or holds anything."""
    if os.path.islink(folder) or os.path.isdir(folder) and os.listdir(folder):
        raise FileExistsError(f"not an empty folder: {folder}")
