"""Recursive graph operators as semi-naive loops: each round joins only what the round before found.

Spark's recursive SQL has no deduplicating union and so doesn't end on a cycle; these loops do. Every round is written to
the shared folder, so plans stay short and a lost executor costs one round.
"""

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spoor.sources.tables import written


def closure(
    edges: DataFrame, src: str, dst: str, seeds: DataFrame | None = None, max_depth: int | None = None, reflexive: bool = True, payload: str | None = None
) -> DataFrame:
    """(seed, node, depth[, payload]): every node reachable from each seed and the least number of edges to it.

    ``seeds`` has one column, by default every end of an edge. The payload is that of the last edge, the least of several
    that reach a node first. A reflexive closure holds each seed at depth 0; otherwise the seed itself is never returned.
    """
    keep = [F.col(payload).alias("_load")] if payload else []
    hops = written(edges.select(F.col(src).alias("_src"), F.col(dst).alias("_dst"), *keep).distinct())
    if seeds is None:
        seeds = hops.select(F.col("_src").alias("seed")).union(hops.select("_dst"))
    seeds = seeds.toDF("seed").distinct()
    load = [F.lit(None).cast(hops.schema["_load"].dataType).alias("_load")] if payload else []
    frontier = written(seeds.select("seed", F.col("seed").alias("node"), F.lit(0).alias("depth"), *load))
    rounds, depth = [frontier], 0
    while max_depth is None or depth < max_depth:
        depth += 1
        reached = frontier.join(hops, F.col("node") == F.col("_src")).select("seed", F.col("_dst").alias("node"), *([hops["_load"]] if payload else []))
        reached = reached.groupBy("seed", "node").agg(*([F.min("_load").alias("_load")] if payload else [F.lit(1).alias("_one")])).select("seed", "node", F.lit(depth).alias("depth"), *(["_load"] if payload else []))
        visited = reduce(DataFrame.unionByName, rounds).select("seed", "node")
        frontier = written(reached.join(visited, ["seed", "node"], "left_anti").select("seed", "node", "depth", *(["_load"] if payload else [])))
        if frontier.isEmpty():
            break
        rounds.append(frontier)
    out = reduce(DataFrame.unionByName, rounds)
    out = out if reflexive else out.where("depth > 0")
    return out.withColumnRenamed("_load", payload) if payload else out


def wave(edges: DataFrame, src: str, dst: str, seeds: DataFrame, max_depth: int = 3) -> DataFrame:
    """(node, depth): nodes within ``max_depth`` edges of any seed, at their least depth; breadth first, seeds not returned.

    Unlike :func:`closure` it keeps one row a node and not one for each seed.
    """
    hops = written(edges.select(F.col(src).alias("_src"), F.col(dst).alias("node")).distinct())
    frontier = written(seeds.toDF("node").distinct().withColumn("depth", F.lit(0)))
    rounds = [frontier]
    for depth in range(1, max_depth + 1):
        reached = frontier.select(F.col("node").alias("_src")).join(hops, "_src").select("node").distinct()
        frontier = written(reached.join(reduce(DataFrame.unionByName, rounds), "node", "left_anti").withColumn("depth", F.lit(depth)))
        if frontier.isEmpty():
            break
        rounds.append(frontier)
    return reduce(DataFrame.unionByName, rounds).where("depth > 0")


def chain(edges: DataFrame, src: str, dst: str, seeds: DataFrame | None = None) -> DataFrame:
    """(seed, node): ancestors and descendants of each seed, itself too, but none of its siblings."""
    if seeds is None:
        seeds = edges.select(src).union(edges.select(dst))
    up = closure(edges, src, dst, seeds).select("seed", "node")
    return up.unionByName(closure(edges, dst, src, seeds).select("seed", "node")).distinct()


def oriented(edges: DataFrame, older: Column, newer: Column) -> DataFrame:
    """Edges whose target is strictly older than their source: what is left has no cycle. Null dates are dropped."""
    return edges.where(older < newer)


def _least_neighbour(links: DataFrame) -> DataFrame:
    """(u, m): the least of u and its neighbours, combined on the map side and dealt evenly, so that a hub can be split."""
    return links.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("m")).hint("rebalance")


def components(links: DataFrame, a: str, b: str) -> DataFrame:
    """(node, root) for every node of a link but the root itself: the least node that it can reach either way.

    Alternating large and small stars: rounds grow with the logarithm of the longest chain. Links with a null end and
    self-links are ignored; an empty table gives an empty one.
    """
    now = written(links.select(F.col(a).alias("u"), F.col(b).alias("v")).where("u <> v"))
    before = None
    while True:
        mark = now.agg(F.count("*").alias("n"), F.bit_xor(F.xxhash64("u", "v")).alias("x")).first()
        if mark["n"] == 0 or mark == before:
            return now.select(F.col("u").alias("node"), F.col("v").alias("root"))
        before = mark
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = both.join(_least_neighbour(both), "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        down = large.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).where("u > v")
        least = _least_neighbour(down)
        hooks = down.join(least, "u").where("v > m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        now = written(hooks.unionByName(least.select("u", F.col("m").alias("v"))).distinct())


def spread_marks(edges: DataFrame, seeds: DataFrame) -> DataFrame:
    """(node, marks): for every node the bits of all marks that reach it along edges (src, dst) from ``seeds`` (node, marks).

    The sum over a node's ancestors without the pairs: a node goes on only with bits that it didn't have, so that a bit passes an
    edge once, cycles end, and there is at most a row for each node and bit. A seed may repeat; one without bits marks nothing.
    """
    hops = written(edges.select("src", "dst").where("src is not null and dst is not null").distinct())
    new = written(seeds.where("node is not null").groupBy("node").agg(F.bit_or("marks").alias("marks")).where("marks <> 0"))
    rounds = [new]
    while not new.isEmpty():
        sent = new.join(hops, F.col("node") == F.col("src")).groupBy(F.col("dst").alias("node")).agg(F.bit_or("marks").alias("marks"))
        known = reduce(DataFrame.unionByName, rounds).groupBy("node").agg(F.bit_or("marks").alias("_known"))
        fresh = F.col("marks").bitwiseAND(F.bitwise_not(F.coalesce("_known", F.lit(0))))
        new = written(sent.join(known, "node", "left").select("node", fresh.alias("marks")).where("marks <> 0"))
        rounds.append(new)
    return reduce(DataFrame.unionByName, rounds).groupBy("node").agg(F.bit_or("marks").alias("marks"))
