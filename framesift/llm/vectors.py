"""Near-duplicate vectors by a robust-pruned flat graph.

Vectors are dealt to the cells of their nearest few centroids, so that cells overlap; a cell of too many vectors is dealt
to cells of its own in the same way, level by level, with centroids fitted on a bounded sample. In each last cell, a
shard, a graph is built: a vector's candidates are its nearest ones, some random ones and the medoid, robustly pruned, as
are its reverse edges. The adjacency lists of all shards are united. Each vector is then searched for in its shards:
greedily from the medoid, and, while similar vectors turn up, on through their neighbours; only vectors that the search
reaches are compared. Links are verified in double precision. An audit compares a bounded set of vectors with all others;
while the search has found too few of their links, all is done again with more overlap, candidates and beam.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from framesift.llm.common import drop_written, sorted_groups, table, written
from framesift.llm.components import connected_components

SIMILAR = 0.95
SLACK = 0.80  # the search goes on through vectors at least so similar: two links of SIMILAR in a row keep within 0.805
SHARD = 600  # vectors of a shard, about
CHILDREN = 1024  # parts of a cell, at most
OVERLAP, LATER = 4, 2  # parts that a vector is put in, at the first level and at later ones
SAMPLE = 20_000  # vectors of a cell that its centroids are fitted on, about
LARGEST = 8000  # a cell of more vectors is dealt to parts
BLOCK = 1500  # a shard of more vectors is cut into blocks, which are paired
NEAREST, RANDOM, DEGREE, ALPHA, BEAM = 32, 8, 16, 1.2, 24
AUDIT, TARGET = 1000, 0.995  # vectors compared with all others, and the share of their links that must have been found
_DIMS = 1 << 20  # a cell's number is its path in the tree of cells times this, and the length of its vectors


def unit_vectors(embeddings: DataFrame) -> DataFrame:
    """embeddings(vec_id, embedding) to (vec_id, raw, unit): double components as bytes, null where there is no direction."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw, unit = [], []
            for x in batch.column(1).to_pylist():
                x = None if not x or any(v is None for v in x) else np.array(x, dtype=np.float64)
                with np.errstate(over="ignore", invalid="ignore"):
                    peak = np.abs(x).max() if x is not None and np.isfinite(x).all() else 0.0
                if peak:
                    scaled = x / peak
                    raw.append(x.tobytes())
                    unit.append((scaled / np.sqrt((scaled * scaled).sum())).tobytes())
                else:
                    raw.append(None)
                    unit.append(None)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(raw, pa.binary()), pa.array(unit, pa.binary())], names=["vec_id", "raw", "unit"])

    x = embeddings.select(F.col("vec_id").cast("long"), F.col("embedding").cast("array<double>"))
    return x.mapInArrow(run, "vec_id long, raw binary, unit binary")


def centroids_of(sample: np.ndarray, k: int) -> np.ndarray:
    """k directions by spherical k-means; fixed start."""
    rng = np.random.default_rng(7)
    c = sample[np.sort(rng.choice(len(sample), size=min(k, len(sample)), replace=False))]
    for _ in range(6):
        of = (sample @ c.T).argmax(axis=1)
        sums = np.zeros_like(c)
        np.add.at(sums, of, sample)
        size = np.sqrt((sums * sums).sum(axis=1))
        c = np.where(size[:, None] > 0, sums / np.maximum(size, 1e-12)[:, None], c)
    return c


def pruned_graph(x: np.ndarray, wider: int = 1) -> list[np.ndarray]:
    """Neighbours of each row of x: robustly pruned candidates and all reverse edges, which may be many for a central row."""
    n = len(x)
    if n == 1:
        return [np.zeros(0, np.int64)]
    rng = np.random.default_rng(n)
    medoid = int((x @ x.mean(axis=0)).argmax())
    k, degree = min(NEAREST * wider, n - 1), DEGREE * wider
    edges = []
    for a in range(0, n, 256):
        rows = np.arange(a, min(a + 256, n))
        s = x[rows] @ x.T
        s[np.arange(len(rows)), rows] = -np.inf
        near = np.argpartition(-s, k - 1, axis=1)[:, :k]
        c = np.concatenate([near, rng.integers(0, n, (len(rows), RANDOM)), np.full((len(rows), 1), medoid)], axis=1)
        d = 1 - np.take_along_axis(s, c, axis=1)  # infinite for the row itself
        order = np.argsort(d, axis=1, kind="stable")
        c, d = np.take_along_axis(c, order, axis=1), np.take_along_axis(d, order, axis=1)
        open_ = np.isfinite(d)
        at = np.arange(len(rows))
        for _ in range(degree):
            pick = open_.argmax(axis=1)  # the nearest that is left
            on = open_[at, pick]
            if not on.any():
                break
            chosen = c[at, pick]
            edges.append(np.stack([rows[on], chosen[on]], axis=1))
            open_ &= ALPHA * (1 - np.einsum("icd,id->ic", x[c], x[chosen], optimize=True)) > d
            open_[at, pick] = False
    e = np.concatenate(edges)
    e = np.unique(np.concatenate([e, e[:, ::-1]]), axis=0)
    return np.split(e[:, 1], np.searchsorted(e[:, 0], np.arange(1, n)))


def _similar(x: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The cosines of rows a and b of x, pairwise."""
    return np.concatenate([np.einsum("ij,ij->i", x[a[k : k + 100_000]], x[b[k : k + 100_000]]) for k in range(0, max(1, len(a)), 100_000)])


def searched(x: np.ndarray, near: list[np.ndarray], wider: int = 1) -> tuple[np.ndarray, np.ndarray]:
    """Pairs (i, j) of rows of x, i <> j, that the search of each i finds with a cosine of SIMILAR or more."""
    n = len(x)
    small = x.astype(np.float32)
    flat, degree = np.concatenate([*near, np.zeros(0, np.int64)]).astype(np.int64), np.array([len(v) for v in near])
    if not len(flat):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    begin = np.cumsum(degree) - degree

    def neighbours(c: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """All neighbours of the rows c: the place in c, the neighbour."""
        k = np.repeat(np.arange(len(c)), degree[c])
        return k, flat[np.arange(len(k)) - np.repeat(np.cumsum(degree[c]) - degree[c], degree[c]) + begin[c][k]]

    medoid, beam = int((x @ x.mean(axis=0)).argmax()), BEAM * wider
    one, other = [], []
    for a in range(0, n, 512):
        q = np.arange(a, min(a + 512, n))
        at = np.arange(len(q))
        seen = np.zeros((len(q), n + 1), dtype=bool)
        seen[:, medoid] = seen[:, n] = seen[at, q] = True
        ids = np.full((len(q), beam), n, dtype=np.int64)
        sims = np.full((len(q), beam), -np.inf, dtype=np.float32)
        done = np.ones((len(q), beam), dtype=bool)
        ids[:, 0], sims[:, 0], done[:, 0] = medoid, small[q] @ small[medoid], False
        within = np.zeros((len(q), n), dtype=bool)
        within[:, medoid] = sims[:, 0] >= SLACK
        within[at, q] = True  # a vector's own place in the graph
        while True:  # greedily: the best of the beam that was not followed yet, until all were
            best = np.where(done, -np.inf, sims).argmax(axis=1)
            live = np.flatnonzero(~done[at, best])
            if not len(live):
                break
            done[live, best[live]] = True
            r, to = neighbours(ids[live, best[live]])
            fresh = ~seen[live[r], to]
            r, to = r[fresh], to[fresh]
            seen[live[r], to] = True
            c = np.arange(len(r)) - np.searchsorted(r, r)  # the neighbour's number among those of its query
            new = np.full((len(live), max(1, int(c.max(initial=0)) + 1)), n, dtype=np.int64)
            s = np.full(new.shape, -np.inf, dtype=np.float32)
            new[r, c] = to
            s[r, c] = near_q = _similar(small, q[live[r]], to)
            close = near_q >= SLACK
            within[live[r[close]], to[close]] = True
            s_all = np.concatenate([sims[live], s], axis=1)
            top = np.argpartition(-s_all, beam - 1, axis=1)[:, :beam]
            ids[live] = np.take_along_axis(np.concatenate([ids[live], new], axis=1), top, axis=1)
            done[live] = np.take_along_axis(np.concatenate([done[live], np.isneginf(s)], axis=1), top, axis=1)
            sims[live] = np.take_along_axis(s_all, top, axis=1)
        front = within.copy()
        while True:  # range expansion: on through the neighbours of all that is similar
            r, c = np.nonzero(front)
            if not len(r):
                break
            step = np.zeros((len(q), n + 1), dtype=bool)
            for k in range(0, len(r), 20_000):
                of, to = neighbours(c[k : k + 20_000])
                step[r[k : k + 20_000][of], to] = True
            step &= ~seen
            seen |= step
            r, c = np.nonzero(step)
            close = _similar(small, q[r], c) >= SLACK
            front = np.zeros_like(within)
            front[r[close], c[close]] = True
            within |= front
        r, c = np.nonzero(within)
        keep = (q[r] != c) & (_similar(x, q[r], c) >= SIMILAR)
        one.append(q[r[keep]])
        other.append(c[keep])
    return np.concatenate(one), np.concatenate(other)


def _matrix(column) -> np.ndarray:
    data = column.to_pylist()
    return np.frombuffer(b"".join(data), dtype=np.float64).reshape(len(data), -1)


def _split(cells: DataFrame, sizes: DataFrame, overlap: int, level: int) -> DataFrame:
    """cells(cell, vec_id, weight, unit) of which sizes(cell, n) has all: each vector in the overlap nearest parts of its cell.

    A part's number is that of its cell with one digit more. Centroids come from a sample that a hash chooses; they go to
    the tasks as one row ahead of some 20,000 vectors.
    """
    x = cells.join(sizes, "cell").withColumn("h", F.xxhash64(F.lit(level), "vec_id"))
    chosen = x.where(F.pmod("h", F.lit(1_000_000_007)).cast("double") * F.col("n") < float(SAMPLE) * 1_000_000_007)

    def fit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for g in sorted_groups(batches, 1):
            k = min(CHILDREN, -(-g.column(1)[0].as_py() // SHARD), g.num_rows)
            yield pa.RecordBatch.from_arrays([pa.array([g.column(0)[0].as_py()]), pa.array([centroids_of(_matrix(g.column(2)), k).tobytes()], pa.binary())], names=["cell", "centroids"])

    fitted = chosen.select("cell", "n", "unit", "h", "vec_id").repartition("cell").sortWithinPartitions("cell", "h", "vec_id").select("cell", "n", "unit")
    fitted = written(fitted.mapInArrow(fit, "cell long, centroids binary"), "centroids")
    salts = F.greatest(F.lit(1), F.ceil(F.col("n") / SAMPLE)).cast("int")
    heads = fitted.join(sizes, "cell").select("cell", F.explode(F.sequence(F.lit(0), salts - 1)).alias("salt"), F.lit(None).cast("long").alias("vec_id"), F.lit(None).cast("long").alias("weight"), F.col("centroids").alias("unit"))
    tails = x.select("cell", F.pmod(F.pmod("h", F.lit(1_000_003)), salts).cast("int").alias("salt"), "vec_id", "weight", "unit")

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = None
        for batch in batches:
            cell = batch.column(0).to_numpy()
            heads = np.flatnonzero(batch.column(2).is_null().to_numpy(zero_copy_only=False))
            for a, b in zip([0, *heads.tolist()], [*heads.tolist(), batch.num_rows], strict=True):
                if a < b and len(heads) and a in heads:
                    c = np.frombuffer(batch.column(4)[a].as_py(), dtype=np.float64).reshape(-1, int(cell[a] % _DIMS))
                    a += 1
                if a < b:
                    s = _matrix(batch.column(4).slice(a, b - a)) @ c.T
                    o = min(overlap, len(c))
                    top = np.argpartition(-s, o - 1, axis=1)[:, :o]
                    child = (cell[a:b, None] // _DIMS * (CHILDREN + 1) + 1 + top) * _DIMS + cell[a:b, None] % _DIMS
                    rows = np.repeat(np.arange(a, b), o)
                    yield pa.RecordBatch.from_arrays([pa.array(child.reshape(-1)), *(batch.column(k).take(pa.array(rows)) for k in (2, 3, 4)), pa.array(cell[rows])], names=["cell", "vec_id", "weight", "unit", "above"])

    x = heads.unionByName(tails).repartition("cell", "salt").sortWithinPartitions("cell", "salt", F.col("vec_id").asc_nulls_first())
    return x.mapInArrow(assign, "cell long, vec_id long, weight long, unit binary, above long")


def placed(units: DataFrame, wider: int = 1) -> DataFrame:
    """units(vec_id, weight, unit) to (shard, i, j, own, shards, vec_id, weight, unit), a row for each vector and group.

    Cells of more than LARGEST vectors are dealt to parts until none is left but those that hardly get smaller: their
    vectors are alike. Shards are cut into blocks, and each two blocks (and each block alone) are a group, so that no
    group grows with the data. Vectors of different lengths are in different cells from the start.
    """
    cells = units.select((F.octet_length("unit") / 8).cast("long").alias("cell"), "vec_id", "weight", "unit")
    shards, above, level = None, None, 0
    while True:
        sizes = cells.groupBy("cell").agg(F.count("*").alias("n"), *([F.first("above").alias("above")] if level else []))
        grown = sizes.where(F.col("n") > LARGEST * wider)
        if level:
            grown = grown.join(above.select(F.col("cell").alias("above"), F.col("n").alias("before")), "above").where("n < 0.9 * before")
        grown = written(grown.select("cell", "n"), "cells") if level < 3 else None
        ready = cells.join(grown, "cell", "left_anti") if grown is not None else cells
        ready = ready.select(F.col("cell").alias("shard"), "vec_id", "weight", "unit")
        shards = ready if shards is None else shards.unionByName(ready)
        if grown is None or grown.isEmpty():
            break
        cells = written(_split(cells.join(grown, "cell", "left_semi").select("cell", "vec_id", "weight", "unit"), grown, (LATER if level else OVERLAP) * wider, level), "assigned")
        above, level = grown, level + 1
    x = shards.join(shards.groupBy("vec_id").agg(F.sort_array(F.collect_set("shard")).alias("shards")), "vec_id")  # at most OVERLAP * LATER^2, wider by the audit
    x = x.join(shards.groupBy("shard").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("blocks")), "shard")
    x = x.withColumn("own", F.expr("cast(pmod(xxhash64(vec_id), blocks) as int)")).withColumn("with", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    x = x.select("shard", F.least("own", "with").alias("i"), F.greatest("own", "with").alias("j"), "own", "shards", "vec_id", "weight", "unit")
    return written(x, "shards")


def graph(groups: DataFrame, wider: int = 1) -> DataFrame:
    """The union of the blocks' adjacency lists: (vec_id, near), with at most BLOCK neighbours from a shard."""

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for g in sorted_groups(batches, 2):
            ids = g.column(2).to_numpy()
            near = pruned_graph(_matrix(g.column(3)), wider)
            yield pa.RecordBatch.from_arrays([pa.array(ids), pa.array([ids[v] for v in near], pa.list_(pa.int64()))], names=["vec_id", "near"])

    x = groups.where("i = j").select("shard", "i", "vec_id", "unit").repartition("shard", "i").sortWithinPartitions("shard", "i", "vec_id")
    x = x.mapInArrow(build, "vec_id long, near array<long>")
    return x.groupBy("vec_id").agg(F.array_distinct(F.flatten(F.collect_list("near"))).alias("near"))


def links(groups: DataFrame, adjacency: DataFrame, wider: int = 1) -> DataFrame:
    """(vec_id, other, n): the links that each group adds to a vector, weighted, and the smallest vector it is connected with there."""

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for g in sorted_groups(batches, 3):
            shard, two = g.column(0)[0].as_py(), g.column(1)[0].as_py() != g.column(2)[0].as_py()
            own, ids, weight = (g.column(k).to_numpy() for k in (3, 5, 6))
            x = _matrix(g.column(7))
            order = np.argsort(ids)
            near = []
            for v in g.column(8).to_pylist():  # those in this group
                v = np.array(v, dtype=np.int64)
                p = np.minimum(np.searchsorted(ids[order], v), len(ids) - 1)
                near.append(order[p[ids[order][p] == v]])
            if two:  # edges between the blocks
                near = [np.union1d(v, w) for v, w in zip(near, pruned_graph(x, wider), strict=True)]
            a, b = searched(x, near, wider)
            if not len(a):
                continue
            pairs = np.unique(np.concatenate([np.stack([a, b], 1), np.stack([b, a], 1)]), axis=0)
            a, b = pairs[:, 0], pairs[:, 1]
            label = ids.copy()
            while True:
                new = label.copy()
                np.minimum.at(new, a, label[b])
                if (new == label).all():
                    break
                label = new
            # a pair is counted in the first shard that both are in, and there in one group
            lists = g.column(4).to_pylist()
            shards = np.full((len(ids), max(map(len, lists))), -1)
            for k, v in enumerate(lists):
                shards[k, : len(v)] = v
            first = np.full(len(a), np.iinfo(np.int64).max)
            for p in range(shards.shape[1]):
                for q in range(shards.shape[1]):
                    same = (shards[a, p] == shards[b, q]) & (shards[a, p] >= 0)
                    first = np.where(same, np.minimum(first, shards[a, p]), first)
            count = (first == shard) & ((own[a] != own[b]) if two else True)
            n = np.bincount(a[count], weights=weight[b[count]], minlength=len(ids)).astype(np.int64)
            hit = np.unique(a)
            yield pa.RecordBatch.from_arrays([pa.array(ids[hit]), pa.array(label[hit]), pa.array(n[hit])], names=["vec_id", "other", "n"])

    x = groups.join(adjacency, "vec_id").select("shard", "i", "j", "own", "shards", "vec_id", "weight", "unit", "near")
    x = x.repartition("shard", "i", "j").sortWithinPartitions("shard", "i", "j")
    return x.mapInArrow(search, "vec_id long, other long, n long")


def audited(units: DataFrame) -> DataFrame:
    """AUDIT vectors, chosen by a hash, against all of units(vec_id, weight, unit): (vec_id, other, n) as in links().

    The weights of a chosen vector's links add up to its n; other connects all that are linked with one of them. The
    chosen vectors are a bounded set, so that this is one pass over the data; it puts out at most two rows a vector.
    """
    chosen = units.select("vec_id", "unit", F.xxhash64(F.lit("audit"), "vec_id").alias("h")).orderBy("h", "vec_id").limit(AUDIT).collect()
    by_length: dict[int, tuple] = {}
    for r in chosen:
        by_length.setdefault(len(r.unit), ([], []))
        by_length[len(r.unit)][0].append(r.vec_id)
        by_length[len(r.unit)][1].append(r.unit)
    by_length = {n: (np.array(v), np.frombuffer(b"".join(u), dtype=np.float64).reshape(len(v), -1)) for n, (v, u) in by_length.items()}
    shared = units.sparkSession.sparkContext.broadcast(by_length)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lengths = np.array([len(v) for v in batch.column(2).to_pylist()])
            for length, (names, q) in shared.value.items():
                at = np.flatnonzero(lengths == length)
                if not len(at):
                    continue
                ids, weight = (batch.column(k).to_numpy()[at] for k in (0, 1))
                hit = (_matrix(batch.column(2).take(pa.array(at))) @ q.T >= SIMILAR) & (ids[:, None] != names[None, :])
                n = weight @ hit
                first = names[hit.argmax(axis=1)]
                r, c = np.nonzero(hit)
                rows = {(int(names[k]), int(names[k]), int(n[k])) for k in np.flatnonzero(n)}
                rows |= {(x, y, 0) for x, y in zip(ids[r].tolist(), first[r].tolist(), strict=True)} | {(x, y, 0) for x, y in zip(names[c].tolist(), first[r].tolist(), strict=True)}
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(v, pa.int64()) for v in zip(*rows, strict=True)], names=["vec_id", "other", "n"])

    return units.select("vec_id", "weight", "unit").mapInArrow(run, "vec_id long, other long, n long")


def near_links(units: DataFrame) -> DataFrame:
    """units(vec_id, weight, unit) to (vec_id, other, n) as in links(); those of audited vectors are complete."""
    exact = written(audited(units), "audited")
    truth = exact.groupBy("vec_id").agg(F.sum("n").alias("truth")).where("truth > 0")  # at most AUDIT rows
    wider = 1
    while True:
        groups = placed(units, wider)
        found = written(links(groups, graph(groups, wider), wider), "vector-links")
        drop_written(groups)
        per = found.join(F.broadcast(truth), "vec_id").groupBy("vec_id", "truth").agg(F.sum("n").alias("n"))
        hits = per.agg(F.sum("n")).first()[0] or 0
        total = truth.agg(F.sum("truth")).first()[0] or 0
        if hits >= TARGET * total or OVERLAP * wider >= CHILDREN:
            break
        wider *= 2
        drop_written(found)
    rest = found.join(F.broadcast(truth.select("vec_id")), "vec_id", "left_anti")
    kept = found.join(F.broadcast(truth.select("vec_id")), "vec_id", "left_semi").withColumn("n", F.lit(0).cast("long"))
    return rest.unionByName(kept).unionByName(exact)


def near_vectors(embeddings: DataFrame) -> DataFrame:
    """embeddings(vec_id, embedding) to (vec_id, n_links, component_id, kept), a row for each row.

    Vectors link with cosine SIMILAR or more. Null vectors, those with null or non-finite components, of length 0 or
    without components link with nothing. Equal vectors are one node of the graph, with their number as its weight.
    Rows that repeat a vec_id are one vector (its first by bytes); a null vec_id has no links, a null component_id, and
    is kept. Vectors of different lengths are not linked. No rows give no rows; other columns are ignored.
    """
    rows = written(unit_vectors(embeddings), "units")
    valid = rows.where("vec_id is not null and raw is not null").groupBy("vec_id").agg(F.min(F.struct("raw", "unit")).alias("s")).select("vec_id", "s.raw", "s.unit")
    classes = valid.groupBy("raw").agg(F.min("vec_id").alias("rep"), F.count("*").alias("weight"), F.first("unit").alias("unit"))
    members = written(valid.select("vec_id", "raw").join(classes.select("raw", "rep", "weight"), "raw").select("vec_id", "rep", "weight"), "classes")
    units = written(classes.select(F.col("rep").alias("vec_id"), "weight", "unit"), "class-units")
    if units.isEmpty():
        return rows.select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"), F.lit(True).alias("kept"))
    found = near_links(units)
    comps = connected_components(found.select(F.col("vec_id").alias("a"), F.col("other").alias("b")))
    counts = found.groupBy("vec_id").agg(F.sum("n").alias("n"))
    x = members.join(counts.withColumnRenamed("vec_id", "rep"), "rep", "left").join(comps.withColumnRenamed("node", "rep"), "rep", "left")
    x = x.select("vec_id", (F.coalesce("n", F.lit(0)) + F.col("weight") - 1).alias("n_links"), F.coalesce("component", "rep").alias("component_id"))
    x = rows.select("vec_id").join(x, "vec_id", "left").select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), F.coalesce("component_id", "vec_id").alias("component_id"))
    return x.withColumn("kept", F.coalesce(F.col("component_id") == F.col("vec_id"), F.lit(True)))


def op10_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicates of all embeddings: see near_vectors()."""
    return near_vectors(table(spark, sf_dir, "embeddings"))
