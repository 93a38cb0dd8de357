"""Hamming similarity joins by bit blocks, and connected components."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from framesift.functions.columns import hash_bits, normal_hash
from framesift.sources.shared import dropped_copy, shared_copy

NARROW, PART = 7, 4096  # bits up to which blocks of bits are joined; numbers of a part

def bit_blocks(bits, k: int):
    """(block number, block value) pairs: two numbers at most k bits apart agree in at least one of k + 1 blocks."""
    n = k + 1
    cuts = [round(i * 64 / n) for i in range(n + 1)]
    return F.array(*[F.struct(F.lit(i).alias("n"), F.shiftrightunsigned(bits, a).bitwiseAND(F.lit((1 << (b - a)) - 1 if b - a < 64 else -1)).alias("v")) for i, (a, b) in enumerate(zip(cuts, cuts[1:], strict=False)) if b > a])


def hamming_pairs(hashes: DataFrame, k: int) -> DataFrame:
    """hashes(id, bits bigint) to (a, b, distance), a < b, distance at most k, a row for each pair of different bits.

    Equal bits are one class, led by its smallest id, so that copies make no pairs; members() gives the rest of a class.
    Up to NARROW bits, numbers meet that agree in one of k + 1 blocks of bits, and a pair is made in its first common
    block. Beyond that, blocks are so short that nearly all numbers meet: then all are compared, in groups of two parts
    of about PART numbers each.
    """
    reps = hashes.where("bits is not null").groupBy("bits").agg(F.min("id").alias("id"))
    if k > NARROW:
        return _all_compared(reps, k)
    x = reps.select("id", "bits", F.explode(bit_blocks(F.col("bits"), k)).alias("k")).select("id", "bits", "k.n", "k.v")
    y = x.select(F.col("id").alias("b"), F.col("bits").alias("bb"), "n", "v")
    p = x.select(F.col("id").alias("a"), F.col("bits").alias("ab"), "n", "v").join(y, ["n", "v"]).where("a < b")
    differ = F.col("ab").bitwiseXOR(F.col("bb"))
    first = F.array_min(F.transform(F.filter(bit_blocks(differ, k), lambda v: v["v"] == 0), lambda v: v["n"]))
    p = p.withColumn("distance", F.bit_count(differ).cast("bigint")).where((F.col("distance") <= k) & (F.col("n") == first))
    return p.select("a", "b", "distance")


def _all_compared(reps: DataFrame, k: int) -> DataFrame:
    parts = max(1, -(-reps.count() // PART))
    x = reps.withColumn("own", F.expr(f"cast(pmod(xxhash64(id), {parts}) as int)")).withColumn("with", F.explode(F.sequence(F.lit(0), F.lit(parts - 1))))
    x = x.select(F.least("own", "with").alias("i"), F.greatest("own", "with").alias("j"), "own", "id", F.col("bits").cast("bigint"))
    kind = reps.schema["id"].dataType.simpleString()

    def compare(group: pd.DataFrame) -> pd.DataFrame:
        bits, own, ids = group["bits"].to_numpy().view(np.uint64), group["own"].to_numpy(), group["id"].to_numpy()
        two = group["i"].iloc[0] != group["j"].iloc[0]
        out = []
        for at in range(len(bits)):
            distance = np.bitwise_count(bits[at + 1 :] ^ bits[at])
            near = np.flatnonzero((distance <= k) & ((own[at + 1 :] != own[at]) | (not two)))
            out.append(pd.DataFrame({"a": np.minimum(ids[at], ids[at + 1 :][near]), "b": np.maximum(ids[at], ids[at + 1 :][near]), "distance": distance[near].astype(np.int64)}))
        return pd.concat(out)

    return x.groupBy("i", "j").applyInPandas(compare, f"a {kind}, b {kind}, distance bigint")


def members(hashes: DataFrame) -> DataFrame:
    """hashes(id, bits) to links (a, b) of each row to the smallest id of its bits: with hamming_pairs(), all that is near."""
    reps = hashes.where("bits is not null").groupBy("bits").agg(F.min("id").alias("a"))
    return hashes.join(reps, "bits").where("id <> a").select("a", F.col("id").alias("b"))


def clusters(samples: DataFrame, k: int = 0) -> DataFrame:
    """samples(sample_id, phash) to (sample_id, near_key): groups of samples whose hashes reach each other by steps of at
    most k bits. near_key is the smallest hash text of the group; samples without a hash of hex digits are left out.

    Distinct hashes are clustered, then samples join: copies of one hash are in one group at any k, 0 included.
    """
    x = samples.select("sample_id", normal_hash(F.col("phash")).alias("near_key")).where("near_key rlike '^[0-9a-f]{1,16}$'")
    if not k:
        return x
    h = x.select(F.col("near_key").alias("id")).distinct().withColumn("bits", hash_bits(F.col("id")))
    links = hamming_pairs(h, k).select("a", "b").unionByName(members(h))  # one number may be written in two ways
    c = components(links)
    return x.join(c.withColumnRenamed("id", "near_key"), "near_key", "left").select("sample_id", F.coalesce("root", "near_key").alias("near_key"))


def components(edges: DataFrame) -> DataFrame:
    """edges(a, b) to (id, root): the smallest id reachable (of any type with an order). Large-star and small-star rounds until nothing changes."""
    e = shared_copy(edges.select(F.greatest("a", "b").alias("v"), F.least("a", "b").alias("u")).where("u < v").distinct())
    while True:
        both = e.unionByName(e.select(F.col("u").alias("v"), F.col("v").alias("u")))
        low = both.groupBy("v").agg(F.least(F.min("u"), F.col("v")).alias("m"))
        large = both.join(low, "v").where("u > v and u > m").select(F.col("u").alias("v"), F.col("m").alias("u")).distinct()
        low = large.groupBy("v").agg(F.min("u").alias("m"))
        small = large.join(low, "v").select(F.inline(F.array(F.struct(F.col("v"), F.col("m").alias("u")), F.struct(F.col("u").alias("v"), F.col("m").alias("u"))))).where("u < v").distinct()
        new = shared_copy(small)
        same = new.exceptAll(e).isEmpty() and e.exceptAll(new).isEmpty()
        dropped_copy(e)
        e = new
        if same:
            return e.select(F.col("v").alias("id"), F.col("u").alias("root")).unionByName(e.select(F.col("u").alias("id"), F.col("u").alias("root")).distinct())
