"""Edges derived through a graph: parts as articles, brands as statutes, sizes as dossiers."""

from pyspark.sql import functions as F

from spoor.operators.closure import closure
from spoor.operators.edges import ancestor_dossiers, motivates_declared, motivates_paired, verdicts
from spoor.plans.graph import _DOWN, _EDGES, _down
from spoor.registry import query
from spoor.sources.tables import table


def _statutes(spark, sf_dir):
    part = table(spark, sf_dir, "part")
    produced = part.select(F.col("p_partkey").alias("article"), F.col("p_brand").alias("statute"))
    return produced, part.groupBy(F.col("p_brand").alias("statute")).agg(F.min("p_size").alias("dossier"))


@query(
    f"""WITH RECURSIVE {_EDGES}, {_DOWN}, r(seed, node) AS (SELECT src, src FROM d UNION SELECT r.seed, d.dst FROM r JOIN d ON r.node = d.src),
o AS (SELECT p_brand, min(p_size) AS dossier FROM part GROUP BY 1) SELECT DISTINCT seed AS article, dossier FROM r JOIN part ON node = p_partkey JOIN o USING (p_brand)"""
)
def dossiers_through_ancestors(spark, sf_dir):
    down = _down(spark, sf_dir)
    produced, origins = _statutes(spark, sf_dir)
    return ancestor_dossiers(closure(down, "src", "dst", down.select("src")), produced, origins)


@query(
    """WITH a AS (SELECT p_partkey AS article, p_brand FROM part), x AS (SELECT DISTINCT l_partkey AS article FROM lineitem WHERE l_returnflag = 'R' AND l_quantity >= 45), y AS (SELECT DISTINCT l_partkey AS article FROM lineitem WHERE l_discount >= 0.1 AND l_quantity < 10)
SELECT article, CASE WHEN x.article IS NOT NULL THEN 1 ELSE 0 END AS passage, CASE WHEN y.article IS NOT NULL THEN 1 ELSE 0 END AS proposal, CASE WHEN x.article IS NOT NULL THEN 'reasoned' WHEN y.article IS NOT NULL THEN 'traced' ELSE 'undocumented' END AS verdict
FROM a LEFT JOIN x USING (article) LEFT JOIN y USING (article)"""
)
def article_verdicts(spark, sf_dir):
    items = table(spark, sf_dir, "lineitem")
    key = F.col("l_partkey").alias("article")
    routes = [("passage", items.where("l_returnflag = 'R' and l_quantity >= 45").select(key)), ("proposal", items.where("l_discount >= 0.1 and l_quantity < 10").select(key))]
    return verdicts(table(spark, sf_dir, "part").select(F.col("p_partkey").alias("article")), routes, [("reasoned", ["passage"]), ("traced", ["proposal"])])


_SECTIONS = """s AS (SELECT o_orderkey AS document, o_custkey AS dossier, l_linenumber AS bill_article, l_partkey % 200 AS article, CASE WHEN o_orderstatus = 'P' THEN 'impact_study' ELSE 'report' END AS kind, CAST(l_linenumber * 1000 AS BIGINT) AS start, l_quantity AS q FROM lineitem JOIN orders ON l_orderkey = o_orderkey),
k AS (SELECT DISTINCT article, dossier FROM s WHERE q >= 25)"""


def _sections(spark, sf_dir):
    items = table(spark, sf_dir, "lineitem").join(table(spark, sf_dir, "orders"), F.col("l_orderkey") == F.col("o_orderkey"))
    start, article = (F.col("l_linenumber") * 1000).cast("long"), F.col("l_partkey") % 200
    rows = items.select(
        F.col("o_orderkey").alias("document"), F.col("o_custkey").alias("dossier"), F.col("l_linenumber").alias("bill_article"), F.array(article).alias("declared"),
        F.when(F.col("o_orderstatus") == "P", "impact_study").otherwise("report").alias("kind"), start.alias("start"), (start + 900).alias("end"),
    )
    known = items.where("l_quantity >= 25").select(article.alias("article"), F.col("o_custkey").alias("dossier")).distinct()
    return rows, known


@query(f"WITH {_SECTIONS} SELECT document, s.article, min(start) AS start, min(start) + 900 AS \"end\" FROM s JOIN k ON s.article = k.article AND s.dossier = k.dossier GROUP BY ALL")
def declared_motives(spark, sf_dir):
    return motivates_declared(*_sections(spark, sf_dir))


@query(
    f"""WITH {_SECTIONS}, t AS (SELECT DISTINCT dossier, bill_article, article FROM s WHERE kind = 'report'), f AS (SELECT DISTINCT dossier, bill_article, article FROM s WHERE kind = 'impact_study'),
d AS (SELECT DISTINCT document, s.article FROM s JOIN k ON s.article = k.article AND s.dossier = k.dossier),
p AS (SELECT s.document, f.article, s.dossier, start FROM s JOIN f USING (dossier, bill_article) WHERE kind = 'impact_study' UNION ALL SELECT s.document, t.article, s.dossier, start FROM s JOIN t USING (dossier, bill_article) WHERE kind <> 'impact_study')
SELECT p.document, p.article, min(start) AS start, min(start) + 900 AS "end" FROM p JOIN k ON p.article = k.article AND p.dossier = k.dossier WHERE NOT EXISTS (SELECT 1 FROM d WHERE d.document = p.document AND d.article = p.article) GROUP BY ALL"""
)
def paired_motives(spark, sf_dir):
    rows, known = _sections(spark, sf_dir)
    covers = lambda kind: rows.where(F.col("kind") == kind).select("dossier", "bill_article", F.col("declared")[0].alias("article"))
    return motivates_paired(rows, covers("report"), covers("impact_study"), known, motivates_declared(rows, known))
