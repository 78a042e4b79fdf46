"""Connected components of links that no single machine has to hold."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterfold import scratch


def _digest(edges: DataFrame) -> tuple:
    return tuple(
        edges.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b")), F.sum(F.col("a") % 1_000_003)).first()
    )


def components(edges: DataFrame) -> DataFrame:
    """``node``, ``root``: the smallest node that each linked node reaches.

    ``edges`` has the bigint columns ``a`` and ``b``. Nodes without a link are not in
    the result. Two steps alternate until the links stop changing: every node
    passes its larger neighbours, then its smaller ones, to its smallest
    neighbour. The links end as one star for each component. A round is an
    aggregate and a join, so a node with very many links is combined before the
    shuffle and split by the join; each round is written to the shared folder.
    """
    links = edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    links = scratch.stored(links.distinct(), "links")
    seen = _digest(links)
    while True:
        both = links.union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        larger = (
            both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
            .where("a <> b").distinct()
        )
        larger = scratch.stored(larger, "links")
        least = larger.groupBy("a").agg(F.min("b").alias("m"))
        smaller = larger.join(least, "a").select(
            F.explode(F.array(F.struct("a", F.col("m").alias("b")), F.struct(F.col("b").alias("a"), F.col("m").alias("b"))))
        ).select("col.*").where("a <> b").distinct()
        links = scratch.stored(smaller, "links")
        now = _digest(links)
        if now == seen:
            return links.select(F.col("a").alias("node"), F.col("b").alias("root")).union(
                links.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
            )
        seen = now
