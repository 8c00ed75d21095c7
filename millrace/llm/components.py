"""Connected components of a link table, by joins and grouped minima."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.session import shared_dir


def components(links: DataFrame) -> DataFrame:
    """``node`` and ``root``, the smallest node reachable, for each node of ``links`` (``a``, ``b``).

    Alternates two moves until nothing changes: each node hands its larger neighbours, then its smaller
    ones, to its smallest. Both keep reachability; the rounds grow as the logarithm of the nodes. A
    node's neighbours meet as a grouped minimum and a join Spark can split, never as one list. Each
    round is a checkpoint in the shared folder. Nulls and links of a node to itself are left out.
    """
    shared_dir(links.sparkSession)
    pairs = links.where("a is not null and b is not null and a <> b")
    pairs = pairs.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct().checkpoint()
    while True:
        large = _to_smallest(pairs.union(pairs.select(F.col("b"), F.col("a"))), larger=True)
        small = _to_smallest(large, larger=False).checkpoint()
        if not _differ(pairs, small):
            return small.select(F.col("a").alias("node"), F.col("b").alias("root")).union(
                small.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
            )
        pairs = small


def _to_smallest(pairs: DataFrame, larger: bool) -> DataFrame:
    """Each neighbour ``b`` of ``a`` (the larger ones, or all smaller ones and ``a``) to ``a``'s smallest."""
    least = pairs.groupBy("a").agg(F.min("b").alias("least")).withColumn("least", F.least("least", "a"))
    moved = pairs.join(least, "a")
    if larger:
        found = moved.where("b > a").select(F.col("b").alias("a"), F.col("least").alias("b"))
    else:
        found = moved.select(F.col("b").alias("a"), F.col("least").alias("b")).union(
            least.select("a", F.col("least").alias("b"))
        )
    return found.where("a <> b").distinct()


def _differ(left: DataFrame, right: DataFrame) -> bool:
    """Whether two sets of pairs differ, by count and by a sum of hashes each way."""

    def digest(df: DataFrame) -> tuple:
        sums = [F.sum(F.xxhash64("a", "b", F.lit(k)).cast("decimal(38,0)")) for k in (1, 2)]
        return tuple(df.agg(F.count("*"), *sums).first())

    return digest(left) != digest(right)
