"""Connected components by alternating large-star and small-star steps (Kiveris et al., 2014).

Edges stay distributed; the driver sees a count and a checksum per round.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .staging import Staging


def components(edges: DataFrame, staging: Staging, name: str) -> DataFrame:
    """``node, component`` for the nodes of ``edges`` (a, b); a component is named by its smallest node."""

    def least(pairs: DataFrame, label: str) -> DataFrame:
        # written, so that the join below has a plain exchange on either side and can split a hot node
        return staging.put(pairs.groupBy("u").agg(F.min("v").alias("m")), label)

    def mark(pairs: DataFrame) -> tuple:
        row = pairs.agg(F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("s")).first()
        return row["n"], row["s"]

    now = staging.put(
        edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), f"{name}-0"
    )
    before, turn, used = mark(now), 0, [f"{name}-0"]
    while before[0]:
        turn += 1
        both = now.union(now.select("v", "u"))
        low = least(both, f"{name}-large-{turn}").select("u", F.least("u", "m").alias("m"))
        large = both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = staging.put(large.where("u <> v").distinct(), f"{name}-mid-{turn}")
        low = least(large, f"{name}-small-{turn}")
        small = large.join(low, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).union(low.select("u", F.col("m").alias("v")))
        now = staging.put(small.where("u <> v").distinct(), f"{name}-{turn}")
        after = mark(now)
        staging.drop(*used, f"{name}-large-{turn}", f"{name}-mid-{turn}", f"{name}-small-{turn}")
        used = [f"{name}-{turn}"]
        if after == before:
            break
        before = after
    return now.select(F.col("u").alias("node"), F.col("v").alias("component")).union(
        now.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    )
