"""Connected components by alternating large-star and small-star steps (Kiveris et al., 2014)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from framesift.llm.common import drop_written, written


def connected_components(edges: DataFrame, what: str = "components") -> DataFrame:
    """edges(a, b long) to (node, component): the smallest node that each node of an edge reaches, itself included.

    Rows with a null and loops add nothing; repeated edges count once; no edges give no rows. A node with many
    neighbours never meets them in one task: minima are aggregated before the shuffle and joined back, where
    skewed keys are split. Each round is written to the shared folder; the driver sees only two numbers a round.
    """
    e = edges.select(F.greatest("a", "b").alias("v"), F.least("a", "b").alias("u")).where("u < v").distinct()
    e = written(e, what)
    seen = None
    while True:
        both = e.select(F.col("v").alias("x"), F.col("u").alias("y")).unionByName(e.select(F.col("u").alias("x"), F.col("v").alias("y")))
        least = both.groupBy("x").agg(F.least(F.min("y"), F.col("x")).alias("m"))
        large = both.where("y > x").join(least, "x").where("y > m").select(F.col("y").alias("v"), F.col("m").alias("u")).distinct()
        least = large.groupBy("v").agg(F.min("u").alias("m"))
        small = large.join(least, "v").select(F.explode(F.array(F.struct(F.col("v"), F.col("m").alias("u")), F.struct(F.col("u").alias("v"), F.col("m").alias("u")))).alias("e")).select("e.v", "e.u").where("u < v").distinct()
        new = written(small, what)
        now = new.agg(F.count("*"), F.sum(F.xxhash64("v", "u").cast("decimal(38,0)"))).first()
        old = e.agg(F.count("*"), F.sum(F.xxhash64("v", "u").cast("decimal(38,0)"))).first() if seen is None else seen
        drop_written(e)
        e = new
        if now == old:
            break
        seen = now
    return e.select(F.col("v").alias("node"), F.col("u").alias("component")).unionByName(e.select(F.col("u").alias("node"), F.col("u").alias("component")).distinct())
