"""Connected components of a table of links, by alternating large-star and small-star rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common
from .common import saved


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b")), F.sum(F.xxhash64("b", "a") % 1000003)).first())


def components(links: DataFrame, a: str = "a", b: str = "b", rounds: int = 60) -> DataFrame:
    """node, root: every node that has a link, with the smallest node it can reach.

    Links may repeat, point either way or at themselves; null ends are ignored. A node with a very long list of neighbours
    stays a join of rows with one row of its least neighbour, dealt over as many tasks as it needs, never a gathered list.
    """
    links = links.select(F.col(a).alias("a"), F.col(b).alias("b")).where("a is not null and b is not null")
    nodes = links.select(F.explode(F.array("a", "b")).alias("node")).distinct()
    # every edge points from the greater node to the smaller
    edges = saved(links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    state = _state(edges)
    for _ in range(rounds):
        if not state[0]:
            break
        # nodes of very many links, as the greater or the smaller end
        ends = edges.select(F.explode(F.array(F.struct(F.col("a").alias("at"), F.lit(True).alias("greater")), F.struct(F.col("b").alias("at"), F.lit(False).alias("greater")))).alias("e"))
        hubs = common.frequent(ends.groupBy("e").agg(F.count("*").alias("n")), "e", state[0])
        # large star: the greater neighbours of a node go to its least neighbour, or stay with it where it has none smaller
        least = edges.groupBy(F.col("a").alias("at")).agg(F.min("b").alias("m"))
        up = common.spread_join(edges.select(F.col("b").alias("at"), "a"), least, "at", [(e["at"], k) for e, k in hubs if not e["greater"]], "left")
        large = up.select("a", F.coalesce("m", "at").alias("b")).distinct()
        # small star: the smaller neighbours of a node go to the least of them, and so does the node
        down = large.groupBy("a").agg(F.min("b").alias("m"))
        met = common.spread_join(large, down, "a", [(e["at"], k) for e, k in hubs if e["greater"]], "inner")
        small = met.select(F.explode(F.array(F.struct("a", F.col("m").alias("b")), F.struct(F.col("b").alias("a"), F.col("m").alias("b")))).alias("e")).select("e.a", "e.b")
        edges = saved(small.where("a <> b").distinct())
        now = _state(edges)
        if now == state:
            break
        state = now
    else:
        raise RuntimeError(f"links did not settle in {rounds} rounds")
    return nodes.join(edges.withColumnRenamed("a", "node"), "node", "left").select("node", F.coalesce("b", "node").alias("root"))
