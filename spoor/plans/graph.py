"""Recursive operators on graphs of parts."""

from pyspark.sql import functions as F

from spoor.operators.closure import chain, closure, components, oriented, wave
from spoor.registry import query
from spoor.sources.tables import table

#: The arithmetic graph on the keys of all parts, and its edges to smaller keys, which have no cycle.
_EDGES = "m AS (SELECT count(*) AS n FROM part), e AS (SELECT p_partkey AS src, (17 * p_partkey + 5) % n AS dst FROM part, m UNION SELECT p_partkey, (31 * p_partkey + 11) % n FROM part, m)"
_DOWN = "d AS (SELECT src, dst FROM e WHERE dst < src)"


def _edges(spark, sf_dir):
    part = table(spark, sf_dir, "part")
    n = F.lit(part.count())
    targets = F.array(F.pmod(17 * F.col("p_partkey") + 5, n), F.pmod(31 * F.col("p_partkey") + 11, n))
    return part.select(F.col("p_partkey").alias("src"), F.explode(targets).alias("dst")).distinct()


def _down(spark, sf_dir):
    return oriented(_edges(spark, sf_dir), F.col("dst"), F.col("src"))


@query(
    f"""WITH RECURSIVE {_EDGES}, {_DOWN}, r(seed, node) AS (SELECT src, dst FROM d UNION SELECT r.seed, d.dst FROM r JOIN d ON r.node = d.src)
SELECT seed, count(*) AS ancestors, min(node) AS oldest FROM r GROUP BY seed"""
)
def closure_ancestors(spark, sf_dir):
    down = _down(spark, sf_dir)
    return closure(down, "src", "dst", down.select("src"), reflexive=False).groupBy("seed").agg(F.count("*").alias("ancestors"), F.min("node").alias("oldest"))


@query(
    f"""WITH RECURSIVE {_EDGES}, {_DOWN}, r(seed, node) AS (SELECT dst, src FROM d UNION SELECT r.seed, d.src FROM r JOIN d ON r.node = d.dst)
SELECT seed, count(*) AS descendants FROM r GROUP BY seed"""
)
def closure_descendants(spark, sf_dir):
    down = _down(spark, sf_dir)
    return closure(down, "dst", "src", down.select("dst"), reflexive=False).groupBy("seed").agg(F.count("*").alias("descendants"))


@query(
    f"""WITH RECURSIVE {_EDGES}, r(node, depth) AS (SELECT p_partkey, 0 FROM part WHERE p_size = 1 UNION SELECT e.dst, depth + 1 FROM r JOIN e ON r.node = e.src WHERE depth < 3)
SELECT node, min(depth) AS depth FROM r GROUP BY node HAVING min(depth) > 0"""
)
def impact_wave(spark, sf_dir):
    seeds = table(spark, sf_dir, "part").where("p_size = 1").select("p_partkey")
    return wave(_edges(spark, sf_dir), "src", "dst", seeds, 3)


@query(
    f"""WITH RECURSIVE {_EDGES}, {_DOWN}, s AS (SELECT DISTINCT src AS seed FROM d),
u(seed, node) AS (SELECT seed, seed FROM s UNION SELECT u.seed, d.dst FROM u JOIN d ON u.node = d.src),
w(seed, node) AS (SELECT seed, seed FROM s UNION SELECT w.seed, d.src FROM w JOIN d ON w.node = d.dst)
SELECT seed, node FROM u UNION SELECT seed, node FROM w"""
)
def chain_no_siblings(spark, sf_dir):
    down = _down(spark, sf_dir)
    return chain(down, "src", "dst", down.select("src"))


@query(
    f"""WITH RECURSIVE {_EDGES}, {_DOWN}, s AS (SELECT src, dst, ((src * 7 + dst) % 100) / 100.0 AS share FROM d),
r(seed, node, depth) AS (SELECT DISTINCT src, src, 0 FROM s UNION SELECT r.seed, s.dst, depth + 1 FROM r JOIN s ON r.node = s.src),
z AS (SELECT seed, node, min(depth) AS depth FROM r GROUP BY ALL)
SELECT z.seed, z.node, z.depth, CAST(min(s.share) AS DOUBLE) AS share FROM z JOIN z p ON p.seed = z.seed AND p.depth = z.depth - 1 JOIN s ON s.src = p.node AND s.dst = z.node GROUP BY ALL"""
)
def segment_ancestry_payload(spark, sf_dir):
    edges = _down(spark, sf_dir).withColumn("share", F.pmod(F.col("src") * 7 + F.col("dst"), F.lit(100)) / 100.0)
    return closure(edges, "src", "dst", edges.select("src"), reflexive=False, payload="share")


@query(
    f"""WITH RECURSIVE {_EDGES}, x AS (SELECT p_partkey AS src, (17 * p_partkey + 5) % n AS dst FROM part, m WHERE p_partkey <> (17 * p_partkey + 5) % n), u AS (SELECT src AS a, dst AS b FROM x UNION SELECT dst, src FROM x),
r(node, reach) AS (SELECT a, a FROM u UNION SELECT r.node, u.b FROM r JOIN u ON r.reach = u.a)
SELECT min_reach AS component, count(*) AS members FROM (SELECT node, min(reach) AS min_reach FROM r GROUP BY node) AS x GROUP BY 1"""
)
def undirected_classes(spark, sf_dir):
    part = table(spark, sf_dir, "part")
    hops = part.select(F.col("p_partkey").alias("src"), F.pmod(17 * F.col("p_partkey") + 5, F.lit(part.count())).alias("dst"))
    found = components(hops, "src", "dst")
    return found.groupBy(F.col("root").alias("component")).agg((F.count("*") + 1).alias("members"))
