"""Packing of documents into sequences: large items by matching, the rest by best fit, over a histogram of lengths.

Lengths are whole numbers up to the capacity, so that the work to be packed is a count for each length, of bounded
size whatever the number of documents. The driver packs counts; documents then find their places by their rank
within their length.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, bisect_right, insort
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from framesift.llm.common import kept_in_process, table, written
from framesift.llm.tokenids import Encoder, vocabulary

CAPACITY = 2048
BUCKETS = 256  # of each length, so that ranks need no task with all documents of a length


def pieces(docs: DataFrame, model_path: str, capacity: int = CAPACITY, end_id: int = 0, with_ids: bool = False) -> DataFrame:
    """docs(doc_id, text) to a row for each piece: doc_id, piece, start, length, ids_crc32 (and ids).

    A document is its ids and end_id. Only one longer than capacity is cut: all pieces have capacity ids, but for the
    first one. Null and empty texts are the end id alone; repeated rows give repeated pieces; a null doc_id stays null.
    """
    model = vocabulary(model_path)
    shared, digest = docs.sparkSession.sparkContext.broadcast(model), hash(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = kept_in_process("encoder", digest, lambda: Encoder(shared.value))
        for batch in batches:
            of, rows, ids = [], [], []
            for k, text in enumerate(batch.column(1).to_pylist()):
                x = np.append(encoder.ids(text), np.uint32(end_id)).astype("<u4")
                first = len(x) % capacity or capacity
                cuts = [0, *range(min(first, len(x)), len(x) + 1, capacity)]
                for n, (a, b) in enumerate(zip(cuts, cuts[1:], strict=False)):
                    data = x[a:b].tobytes()
                    of.append(k)
                    rows.append((n, a, b - a, zlib.crc32(data)))
                    ids.append(data if with_ids else None)
            ids_of = [batch.column(0).take(pa.array(of, pa.int64()))]
            columns = [pa.array([r[k] for r in rows], t) for k, t in enumerate((pa.int32(), pa.int64(), pa.int64(), pa.int64()))]
            yield pa.RecordBatch.from_arrays([*ids_of, *columns, pa.array(ids, pa.binary())], names=["doc_id", "piece", "start", "length", "ids_crc32", "ids"])

    out = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, "doc_id long, piece int, start long, length long, ids_crc32 long, ids binary")
    return out if with_ids else out.drop("ids")


def pack_counts(counts: dict[int, int], capacity: int = CAPACITY) -> list[tuple[int, int, list[tuple[int, int]]]]:
    """counts of items by length to bins: (first bin, number of bins, [(length, items of it in each bin), ...]).

    Items over a third of the capacity come first, at most two to a bin: the longest with the longest that still fits
    beside it. Then the others, longest first, each into the smallest gap that holds it, or into a new bin.
    """
    third = capacity // 3
    large = {n: c for n, c in counts.items() if c and n > third}
    lengths = sorted(large)
    done: list[tuple[int, list]] = []
    gaps: dict[int, list[tuple[int, list]]] = {}
    order: list[int] = []

    def put(n: int, items: list) -> None:
        gap = capacity - sum(a * b for a, b in items)
        if not gap:
            done.append((n, items))
        else:
            if gap not in gaps:
                insort(order, gap)
            gaps.setdefault(gap, []).append((n, items))

    while lengths:
        big = lengths[-1]
        at = bisect_right(lengths, capacity - big) - 1
        if at < 0:
            put(large.pop(lengths.pop()), [(big, 1)])
            continue
        mate = lengths[at]
        n = large[big] // 2 if mate == big else min(large[big], large[mate])
        if not n:  # one of this length is left, and it cannot be its own mate
            mate = lengths[at - 1] if at else 0
            large[big] = 0
            if mate:
                large[mate] -= 1
            put(1, [(big, 1), (mate, 1)] if mate else [(big, 1)])
        else:
            large[big] -= n
            large[mate] -= n
            put(n, [(big, 2)] if mate == big else [(big, 1), (mate, 1)])
        for x in (big, mate):
            if x and x in large and not large[x]:
                del large[x]
                lengths.remove(x)

    for size in sorted((n for n in counts if counts[n] and n <= third), reverse=True):
        left = counts[size]
        while left:
            at = bisect_left(order, size)
            if at == len(order):
                each = capacity // size
                if left >= each:
                    put(left // each, [(size, each)])
                    left %= each
                if left:
                    put(1, [(size, left)])
                left = 0
                continue
            gap = order[at]
            n, items = gaps[gap].pop()
            if not gaps[gap]:
                del gaps[gap], order[at]
            each = gap // size
            full = min(n, left // each)
            if full:
                put(full, [*items, (size, each)])
                left -= full * each
            if full < n and left and left < each:
                put(1, [*items, (size, left)])
                left, full = 0, full + 1
            if full < n:
                put(n - full, items)
    out, first = [], 0
    for n, items in [*done, *(x for gap in order for x in gaps[gap])]:
        out.append((first, n, items))
        first += n
    return out


def places(bins: list[tuple[int, int, list[tuple[int, int]]]]) -> dict[int, np.ndarray]:
    """By length: rows (first rank, first bin, items in each bin, offset), ascending by rank."""
    rows: dict[int, list] = {}
    ranks: dict[int, int] = {}
    for first, n, items in bins:
        offset = 0
        for size, each in items:
            r = ranks.get(size, 0)
            rows.setdefault(size, []).append((r, first, each, offset))
            ranks[size] = r + n * each
            offset += size * each
    return {k: np.array(v, dtype=np.int64) for k, v in rows.items()}


def packed(items: DataFrame, capacity: int = CAPACITY, buckets: int = BUCKETS) -> DataFrame:
    """items(doc_id, piece, length, ...) with sequence_id and offset: their place, without gaps from offset 0.

    items should be written already: it is read twice. Lengths are 1 to capacity. Repeated rows get places of their
    own; no rows give no rows. Ranks are counted in buckets by a hash, so that no length gathers in one task. The driver
    gets a count for each length, and the tasks the list of places and a count for each length and bucket: all are
    bounded by the capacity, not by the number of items.
    """
    spark = items.sparkSession
    x = items.withColumn("_bucket", F.expr(f"cast(pmod(xxhash64(doc_id, piece), {buckets}) as int)"))
    counts = written(x.groupBy("length", "_bucket").agg(F.count("*").alias("n")), "lengths")
    place = places(pack_counts({r[0]: r[1] for r in counts.groupBy("length").agg(F.sum("n")).collect()}, capacity))
    shared = spark.sparkContext.broadcast(place)
    before = Window.partitionBy("length").orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)  # of buckets, not of items
    base = counts.select("length", "_bucket", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("_base"))
    names = items.columns
    w = Window.partitionBy("length", "_bucket").orderBy("doc_id", "piece", *[c for c in names if c not in ("doc_id", "piece", "length")])
    ranked = x.withColumn("_rank", F.row_number().over(w) - 1).join(F.broadcast(base), ["length", "_bucket"]).withColumn("_rank", F.col("_rank") + F.col("_base"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place, at = shared.value, names.index("length")
        for batch in batches:
            size, rank = (batch.column(k).to_numpy(zero_copy_only=False).astype(np.int64) for k in (at, len(names)))
            seq, offset = np.zeros(len(size), np.int64), np.zeros(len(size), np.int64)
            for n in np.unique(size).tolist():
                of = np.flatnonzero(size == n)
                r, rows = rank[of], place[n]
                rows = rows[np.searchsorted(rows[:, 0], r, side="right") - 1]
                r = r - rows[:, 0]
                seq[of] = rows[:, 1] + r // rows[:, 2]
                offset[of] = rows[:, 3] + r % rows[:, 2] * n
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(names)], pa.array(seq), pa.array(offset)], names=[*names, "sequence_id", "offset"])

    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in items.schema)
    return ranked.select(*names, F.col("_rank").cast("long")).mapInArrow(run, f"{kinds}, sequence_id long, offset long")


def op8_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Places of all pieces of all documents under byte_bpe_50k.json: see pieces() and packed()."""
    import public_tokenizers

    items = pieces(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))
    return packed(written(items, "pieces"))
