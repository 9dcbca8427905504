"""Connected components of an edge table, with DataFrame operations alone.

Alternating large-star / small-star rounds (Kiveris et al., "Connected
Components in MapReduce and Beyond", 2014): a distributed union-find whose
edge table never grows. Every round is written to the shared folder; nothing
but one row of statistics reaches the driver. A node's minimum is a partially
aggregated ``min`` and joins back to its edges, so one node that holds a third
of the edges is split by adaptive skew handling instead of landing in a task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from curbline.llm.common import forget, written


def _canonical(edges: DataFrame) -> DataFrame:
    return (edges.where(F.col("a").isNotNull() & F.col("b").isNotNull() & (F.col("a") != F.col("b")))
            .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
            .distinct())


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    low = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    return (both.where("b > a").join(low, "a")
            .select(F.col("b").alias("a"), F.col("m").alias("b")).distinct())


def _small_star(edges: DataFrame) -> DataFrame:
    low = edges.groupBy("a").agg(F.min("b").alias("m"))
    moved = (edges.join(low, "a").where("b > m")
             .select(F.col("b").alias("a"), F.col("m").alias("b")))
    return moved.union(low.select("a", F.col("m").alias("b"))).distinct()


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b"))).first())


def connected_components(edges: DataFrame) -> DataFrame:
    """(``node``, ``component``) for every node of ``edges`` (columns ``a``, ``b``).

    ``component`` is the smallest node reachable. Null ends, self-links and
    repeated links are ignored; an empty edge table gives an empty result.
    """
    cur = written(_canonical(edges), "cc")
    state = _state(cur)
    while state[0]:
        nxt = written(_small_star(_large_star(cur)), "cc")
        new = _state(nxt)
        forget(cur)
        cur, done, state = nxt, new == state, new
        if done:
            break
    nodes = cur.select(F.col("a").alias("node"), F.col("b").alias("component"))
    return nodes.union(cur.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())
