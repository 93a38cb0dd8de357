"""Near-duplicate documents: universal hash minima, banding, signature verification, exact confirmation, components."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from framesift.llm.common import drop_written, sorted_groups, table, written
from framesift.llm.components import connected_components
from framesift.llm.wordsets import sets_and_words, shingle_sets

ROWS, BANDS = 4, 32  # 128 minima; two sets of similarity 0.75 miss each other with probability (1 - 0.75^4)^32 = 5e-6
SIMILAR = (75, 100)  # intersection/union of the shingle sets
LEAST_EQUAL = 75  # of 128 minima; at similarity 0.75 fewer are equal with probability under 1e-5
BLOCK = 2048  # members of a bucket compared with as many at once
BLOCK_SHINGLES = 1 << 20  # shingles of a block's members, about: more are cut into more blocks
STRIP = 1 << 20  # pairs looked at in one step
SALTS = 256  # parts of a key that many rows share
PART = 1000  # pairs of one leader that are compared one after another


def _coefficients(n: int) -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng(20240229)
    return rng.integers(0, 1 << 32, n, dtype=np.uint32) | np.uint32(1), rng.integers(0, 1 << 32, n, dtype=np.uint32)


def _slices(sigs: np.ndarray) -> np.ndarray:
    """The minima of each band of each signature, as pairs of 64 bits."""
    return np.ascontiguousarray(sigs).view(np.uint64).reshape(len(sigs), BANDS, -1)


def _buckets(sig: Column) -> Column:
    """The bucket of a signature in each band: a hash of the band's minima."""
    return F.transform(F.sequence(F.lit(0), F.lit(BANDS - 1)), lambda k: F.xxhash64(k, F.substring(sig, k * (4 * ROWS) + 1, F.lit(4 * ROWS))))


def signatures(docs: DataFrame) -> DataFrame:
    """docs(doc_id, text) to (doc_id, n_shingles, set_key, sig): a row for each row.

    set_key is the SHA-256 of the words in order: texts of one key are the same words, so their shingle sets are equal.
    Texts without words have null in set_key and sig.
    """
    out = pa.schema([("doc_id", pa.int64()), ("n_shingles", pa.int64()), ("set_key", pa.binary()), ("sig", pa.binary())])
    rows, bands = ROWS, BANDS
    coefficients = _coefficients(ROWS * BANDS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        a, b = (x[:, None] for x in coefficients)
        for batch in batches:
            n, keys, sigs = [], [], []
            for x, key in sets_and_words(batch.column(1)):
                n.append(len(x))
                keys.append(key)
                if key is None:
                    sigs.append(None)
                    continue
                low = (x >> np.uint64(32)).astype(np.uint32)
                sig = np.full(rows * bands, 0xFFFFFFFF, dtype=np.uint32)
                for k in range(0, len(low), 1024):
                    h = a * low[None, k : k + 1024]
                    h += b
                    np.minimum(sig, h.min(axis=1), out=sig)
                sigs.append(sig.tobytes())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n, pa.int64()), pa.array(keys, pa.binary()), pa.array(sigs, pa.binary())], schema=out)

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, "doc_id long, n_shingles long, set_key binary, sig binary")


def _parts(pairs: DataFrame, rows: DataFrame, *values: str) -> DataFrame:
    """pairs(a, b, n), rows(doc_id, values) to (b, salt, tail, doc_id, n, values), partitioned and sorted by the first three.

    The pairs of a b that is in large buckets (of n members) are dealt to parts of about PART by a. A part has the values of
    b ahead (tail 0) and those of its a behind (tail 1): b's are sent once a part, not once a pair, and no part is large.
    Values are fetched by a merge join at every size, so that the plan of small tables is that of large ones.
    """
    pairs = pairs.withColumn("salt", F.expr(f"pmod(xxhash64(a), ceil(n / {PART}))"))
    heads = pairs.select(F.col("b").alias("doc_id"), "b", "salt", F.lit(0).alias("tail"), F.lit(0).cast("long").alias("n")).distinct()
    x = heads.unionByName(pairs.select(F.col("a").alias("doc_id"), "b", "salt", F.lit(1).alias("tail"), "n")).join(rows.hint("merge"), "doc_id")
    return x.select("b", "salt", "tail", "doc_id", "n", *values).repartition("b", "salt").sortWithinPartitions("b", "salt", "tail")


def _tested(parts: DataFrame, decoded, alike) -> DataFrame:
    """The pairs (a, b, n) of _parts() for which alike(one of b's values, a's value) holds; decoded(batch): its rows' (key, value).

    A document whose rows have several texts has several values; equal ones, by key, are held once.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, known = None, {}
        for batch in batches:
            keep = []
            for b, salt, tail, (key, value) in zip(*(batch.column(k).to_pylist() for k in range(3)), decoded(batch), strict=True):
                if part != (b, salt):
                    part, known = (b, salt), {}
                if not tail:
                    known[key] = value
                keep.append(bool(tail) and any(alike(x, value) for x in known.values()))
            yield pa.RecordBatch.from_arrays([batch.column(k) for k in (3, 0, 4)], names=["a", "b", "n"]).filter(pa.array(keep, pa.bool_()))

    return parts.mapInArrow(run, "a long, b long, n long")


def _alike(pairs: DataFrame, reps: DataFrame) -> DataFrame:
    """The pairs whose signatures agree in LEAST_EQUAL minima, and whose sizes allow the similarity."""
    least, (num, den) = LEAST_EQUAL, SIMILAR

    def decoded(batch: pa.RecordBatch) -> Iterator[tuple]:
        for sig, n in zip(batch.column(5).to_pylist(), batch.column(6).to_pylist(), strict=True):
            yield (sig, n), (np.frombuffer(sig, dtype=np.uint32), n)

    def alike(x: tuple, y: tuple) -> bool:
        return den * min(x[1], y[1]) >= num * max(x[1], y[1]) and np.count_nonzero(x[0] == y[0]) >= least

    return _tested(_parts(pairs, reps.select("doc_id", "sig", "n_shingles"), "sig", "n_shingles"), decoded, alike)


def _confirmed(pairs: DataFrame, docs: DataFrame) -> DataFrame:
    """The pairs whose whole shingle sets are similar."""
    num, den = SIMILAR
    texts = docs.where("doc_id is not null").select(F.col("doc_id").cast("long"), F.col("text").cast("string"))

    def decoded(batch: pa.RecordBatch) -> Iterator[tuple]:
        for x in shingle_sets(batch.column(5)):
            yield x.tobytes(), x

    def alike(x: np.ndarray, y: np.ndarray) -> bool:
        both = len(np.intersect1d(x, y, assume_unique=True))
        return both > 0 and den * both >= num * (len(x) + len(y) - both)

    return _tested(_parts(pairs, texts, "text"), decoded, alike)


def _spanning(pairs: Iterator[tuple[int, np.ndarray]], a: np.ndarray, c: np.ndarray, texts: pa.ChunkedArray) -> list[tuple[int, int]]:
    """Of pairs (row, rows) those links (a, a) of similar whole sets that connect components c not connected yet."""
    num, den = SIMILAR
    codes: list[np.ndarray] | None = None
    label, links = c.copy(), []
    for p, q in pairs:
        q = q[label[q] != label[p]]
        if not len(q):
            continue
        if codes is None:
            sets = list(shingle_sets(texts))
            sizes = np.array([len(x) for x in sets])
            _, codes = np.unique(np.concatenate(sets), return_inverse=True)
            has = np.zeros(len(codes), dtype=bool)
            codes = np.split(codes.astype(np.int32), np.cumsum(sizes)[:-1])
            del sets
        has[codes[p]] = True
        both = np.add.reduceat(has[np.concatenate([codes[k] for k in q])], np.cumsum(sizes[q]) - sizes[q], dtype=np.int64)
        has[codes[p]] = False
        for k in q[den * both >= num * (sizes[p] + sizes[q] - both)].tolist():
            if label[k] != label[p]:
                low, high = sorted((label[k], label[p]))
                label[label == high] = low
                links.append((int(a[p]), int(a[k])))
    return links


def _between(placed: DataFrame, sigs: DataFrame, docs: DataFrame | None) -> DataFrame:
    """Of placed(bucket, i, j, own, band, a, c): the rows with a similar signature in another component.

    With docs: links (a, b) instead, as few as connect what similar sets connect in each group.
    """
    least = LEAST_EQUAL
    names = ["bucket", "i", "j", "own", "band", "a", "c"]
    x, confirm = placed.join(sigs.hint("merge"), "a"), docs is not None
    if confirm:
        x = x.join(docs.select(F.col("doc_id").cast("long").alias("a"), F.col("text").cast("string")).hint("merge"), "a")
    x = x.repartition(F.col("bucket"), F.col("i"), F.col("j")).sortWithinPartitions("bucket", "i", "j")

    def close_pairs(c: np.ndarray, own: np.ndarray | None, s: np.ndarray, band: int) -> Iterator[tuple[int, np.ndarray]]:
        """Of each row its later partners: in another component (and block, if own is given), with a similar signature,
        and without a common bucket before band. Rows are taken in strips, so that few pairs are held at once."""
        n, keys = len(c), _slices(s)[:, :band]
        step = max(1, STRIP // n)
        for p in range(0, n, step):
            q = min(n, p + step)
            fresh = c[p:q, None] < c[None, :]
            if own is not None:
                fresh &= own[p:q, None] != own[None, :]
            for k in range(band):  # a pair is compared in its first bucket
                if not fresh.any():
                    break
                fresh &= (keys[p:q, None, k] != keys[None, :, k]).any(axis=2)
            for r in range(q - p):
                at = np.flatnonzero(fresh[r])
                if len(at):
                    at = at[np.count_nonzero(s[at] == s[p + r], axis=1) >= least]
                    if len(at):
                        yield p + r, at

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for g in sorted_groups(batches, 3):
            c = g.column(6).to_numpy()
            if c.min() == c.max():
                continue
            n = g.num_rows
            s = np.frombuffer(b"".join(g.column(7).to_pylist()), dtype=np.uint32).reshape(n, -1)
            own = g.column(3).to_numpy() if g.column(1)[0].as_py() != g.column(2)[0].as_py() else None
            pairs = close_pairs(c, own, s, int(g.column(4)[0].as_py()))
            if not confirm:
                hit = np.zeros(n, dtype=bool)
                for p, q in pairs:
                    hit[p] = hit[q] = True
                if hit.any():
                    yield from g.select(names).filter(pa.array(hit)).to_batches()
                continue
            links = _spanning(pairs, g.column(5).to_numpy(), c, g.column(8))
            if links:
                yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in zip(*links, strict=True)], names=["a", "b"])

    if not confirm:
        return x.select(*names, "sig").mapInArrow(run, "bucket long, i int, j int, own int, band int, a long, c long")
    return x.select(*names, "sig", "text").mapInArrow(run, "a long, b long")


def near_duplicates(docs: DataFrame) -> DataFrame:
    """docs(doc_id, text) to (doc_id, n_shingles, component_id, kept), a row for each row.

    Documents are linked where 100 * |A and B| >= 75 * |A or B| for their sets of 5-word shingles; component_id is the
    smallest doc_id reachable, kept marks it. Nulls and texts without words have empty sets and are linked with
    nothing. Rows that repeat a doc_id are one node and share its result. A null doc_id gets a null component_id and is
    kept. No rows give no rows; other columns are ignored.

    1. Texts of the same words become one class, led by its smallest doc_id: an aggregation, whatever the number of copies.
    2. In each bucket of each band, members are compared with its smallest one only: as many pairs as members.
    3. Components so far. Where a bucket's members are in different ones, members of different components are compared,
       so that no link is lost: in blocks of BLOCK by BLOCK inside a task, each pair in the first bucket that both share.
       A task puts out no pairs, only members that have a similar signature there, and then at most one link a member.
    Pairs are tested by signature, then confirmed on whole sets.
    """
    sigs = written(signatures(docs), "minhash")
    rows = sigs.where("doc_id is not null and set_key is not null").withColumn("salt", F.expr(f"cast(pmod(xxhash64(doc_id), {SALTS}) as int)"))
    parts = rows.groupBy("set_key", "salt").agg(F.min("doc_id").alias("least"))  # so that no task gets all copies of a text
    classes = parts.join(parts.groupBy("set_key").agg(F.min("least").alias("rep")), "set_key").select("set_key", "salt", "rep")
    led = rows.join(classes, ["set_key", "salt"])
    same = written(led.where("doc_id <> rep").select(F.col("doc_id").alias("a"), F.col("rep").alias("b")).distinct(), "minhash-classes")
    reps = led.where("doc_id = rep").dropDuplicates(["set_key", "salt", "doc_id"])  # within the join's partitions
    reps = written(reps.select("doc_id", "n_shingles", "sig"), "minhash-reps")
    members = reps.select(F.posexplode(_buckets(F.col("sig"))).alias("band", "bucket"), F.col("doc_id").alias("a"), "n_shingles")
    first = members.groupBy("bucket").agg(F.min("a").alias("b"), F.max("a").alias("most"), F.count("*").alias("n")).where("b < most").select("bucket", "b", "n")
    buckets = written(members.join(first, "bucket"), "minhash-buckets")
    star = buckets.where("a > b").groupBy("a", "b").agg(F.max("n").alias("n"))
    near = written(_alike(star, reps), "minhash-alike")
    links = written(_confirmed(near, docs).select("a", "b"), "minhash-links")
    drop_written(near)
    found = written(connected_components(links), "minhash-found")

    placed = buckets.join(found.withColumnRenamed("node", "a"), "a", "left").select("bucket", "band", "a", "n_shingles", F.coalesce("component", "a").alias("c"))
    mixed_up = placed.groupBy("bucket").agg(F.min("c").alias("lead"), F.max("c").alias("other"), F.count("*").alias("n"), F.sum("n_shingles").alias("shingles")).where("lead < other")
    n = F.ceil(F.greatest(F.col("n") / BLOCK, F.col("shingles") / BLOCK_SHINGLES)).cast("int")
    placed = placed.join(mixed_up.select("bucket", n.alias("blocks")), "bucket").withColumn("own", F.expr("cast(pmod(xxhash64(a), blocks) as int)"))
    placed = placed.withColumn("with", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    placed = placed.select("bucket", F.least("own", "with").alias("i"), F.greatest("own", "with").alias("j"), "own", "band", "a", "c")
    placed = written(placed, "minhash-placed")
    near = written(_between(placed, reps.select(F.col("doc_id").alias("a"), "sig"), None), "minhash-near")
    links2 = written(_between(near, reps.select(F.col("doc_id").alias("a"), "sig"), docs), "minhash-links")

    edges = same.unionByName(links).unionByName(links2)
    comps = connected_components(edges)
    drop_written(same, reps, buckets, placed, near, links, links2, found)
    return (
        sigs.select("doc_id", "n_shingles")
        .join(comps.withColumnRenamed("node", "doc_id"), "doc_id", "left")
        .select("doc_id", "n_shingles", F.coalesce("component", "doc_id").alias("component_id"))
        .withColumn("kept", F.coalesce(F.col("component_id") == F.col("doc_id"), F.lit(True)))
    )


def op6_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicates of all documents: see near_duplicates()."""
    return near_duplicates(table(spark, sf_dir, "documents"))
