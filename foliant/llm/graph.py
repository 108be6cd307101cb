"""Connected components of a table of edges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from foliant.session import written


def _stamp(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v")), F.sum(F.pmod(F.xxhash64("v", "u"), F.lit(1 << 31)))).first())


def components(edges: DataFrame) -> DataFrame:
    """(node, component) of every node of edges (a, b): component is the smallest node it reaches.

    Alternates large stars and small stars until the edges stay as they are:
    first each node ties its larger neighbours to its smallest one, then its
    smaller ones. Minima are aggregated before the shuffle; the join that
    deals them out has one row per node on its other side, so that adaptive
    execution can split a hub. Each round is written to the shared folder, and
    only counts and checksums reach the driver. Self loops and null ends are
    left out; repeated edges count once.
    """
    edges = written(
        edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "edges"
    )
    stamp = _stamp(edges)
    while stamp[0]:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        tied = large.join(least, "u")
        ends = F.array(F.struct(F.col("u"), F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v")))
        small = tied.select(F.explode(ends).alias("e")).select("e.u", "e.v").where("u <> v").distinct()
        edges = written(small, "edges")
        before, stamp = stamp, _stamp(edges)
        if before == stamp:
            break
    leaves = edges.groupBy("u").agg(F.min("v").alias("component")).select(F.col("u").alias("node"), "component")
    roots = edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return leaves.unionByName(roots)
