"""A graph of provenance that Spark derives from the documents, and the routes through it.

A document is an article of two versions, its long lines are the segments of the second. A line that an earlier document holds
is carried over: from the first holder of its block of 64 documents, and that one's from the first of all. Numbers, lineages,
statutes, dossiers and texts are arithmetic on the key, so that they grow with the table and chains of renumberings with its logarithm.
"""

from pyspark.sql import functions as F

from spoor.operators.changes import replay_moved
from spoor.operators.routes import Graph, discussed, documented, silence
from spoor.registry import query
from spoor.sources.tables import table, written

DAY = "2016-06-01"
NEVER = "state = 'stillborn'"
MIN_LINE = 60

_GRAPH = f"""articles AS (SELECT doc_id AS article, CASE doc_id % 6 WHEN 0 THEN 'L' WHEN 1 THEN 'L' WHEN 2 THEN 'R' WHEN 3 THEN 'D' WHEN 4 THEN 'Annexe a l''article R' ELSE 'X' END || (doc_id // 12 * 12 + doc_id % 6) AS number, 1 + doc_id % 12 // 6 AS lineage FROM documents),
versions AS (SELECT 2 * doc_id AS version, doc_id AS article, DATE '2000-01-01' + CAST(doc_id % 1000 AS INTEGER) AS start, DATE '2010-01-01' + CAST(doc_id * 7 % 3000 AS INTEGER) AS "end", 'effective' AS state FROM documents
  UNION ALL SELECT 2 * doc_id + 1, doc_id, DATE '2010-01-01' + CAST(doc_id * 7 % 3000 AS INTEGER), CASE WHEN doc_id % 9 = 0 THEN DATE '2014-01-01' + CAST(doc_id % 1500 AS INTEGER) END, CASE WHEN doc_id % 10 = 4 THEN 'stillborn' ELSE 'effective' END FROM documents),
lines AS (SELECT doc_id, doc_id * 10000000 + i AS segment, body FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS body, generate_subscripts(string_split(text, chr(10)), 1) AS i FROM documents) AS x WHERE length(body) >= {MIN_LINE}),
firsts AS (SELECT *, min(segment) OVER (PARTITION BY body, doc_id // 64) AS near, min(segment) OVER (PARTITION BY body) AS first FROM lines),
carried AS (SELECT segment, near AS source FROM firsts WHERE segment <> near UNION SELECT near, first FROM firsts WHERE near <> first),
produced AS (SELECT 2 * doc_id AS version, doc_id // 10 AS statute, 'creation' AS link FROM documents UNION ALL SELECT 2 * doc_id + 1, doc_id * 3 // 11, CASE WHEN doc_id % 5 = 0 THEN 'repeal' ELSE 'modification' END FROM documents WHERE doc_id % 3 = 0),
renumbered AS (SELECT doc_id AS article, doc_id // 3 AS former FROM documents WHERE doc_id % 4 IN (1, 2) AND doc_id // 3 < doc_id),
origins AS (SELECT DISTINCT statute, statute // 3 AS dossier FROM produced WHERE statute % 5 < 3),
texts AS (SELECT DISTINCT doc_id // 15 AS text, doc_id // 15 // 2 AS dossier FROM documents),
aims AS (SELECT doc_id // 15 AS text, doc_id % 7 AS bill_article, doc_id AS article, 'L' || doc_id AS cited FROM documents WHERE doc_id % 8 = 3),
now AS (SELECT article, arg_max(version, (start, -version)) AS version FROM versions WHERE state <> 'stillborn' AND start <= DATE '{DAY}' AND ("end" IS NULL OR "end" > DATE '{DAY}') GROUP BY 1),
made AS (SELECT DISTINCT article, p.statute, dossier, link FROM produced p JOIN versions v USING (version) LEFT JOIN origins o ON o.statute = p.statute),
up(seed, node) AS (SELECT doc_id, doc_id FROM documents UNION SELECT seed, former FROM up JOIN renumbered ON node = article),
survival AS (SELECT a.*, t.dossier, EXISTS (SELECT 1 FROM made m WHERE m.dossier = t.dossier AND m.article = a.article AND link <> 'repeal') AS survived FROM aims a JOIN texts t USING (text))"""

_ROUTES = f"""{_GRAPH},
back(seed, node) AS (SELECT segment, segment FROM lines UNION SELECT seed, source FROM back JOIN carried ON node = segment),
current AS (SELECT number, arg_max(article, (lineage, article)) AS article FROM articles WHERE article IN (SELECT article FROM versions WHERE state <> 'stillborn') GROUP BY 1),
passage AS (SELECT DISTINCT seed AS article FROM up JOIN documents ON node = doc_id WHERE n_chars % 13 = 0),
amendment AS (SELECT DISTINCT b.seed // 10000000 AS article FROM back b JOIN lines l ON b.node = l.segment WHERE length(body) % 37 = 0),
bill_article AS (SELECT DISTINCT c.article FROM survival s JOIN up ON up.node = s.article JOIN now n ON n.article = up.seed JOIN articles a ON a.article = up.seed JOIN current c ON c.number = a.number WHERE survived),
paper AS (SELECT DISTINCT seed AS article FROM up JOIN made m ON m.article = node WHERE dossier % 4 = 0 AND (link = 'modification' OR (link = 'creation' AND node NOT IN (SELECT article FROM renumbered)))),
eu_act AS (SELECT c.article FROM lines l JOIN now n ON n.version = 2 * l.doc_id + 1 JOIN articles a ON a.article = n.article JOIN current c ON c.number = a.number WHERE length(body) % 41 = 0 UNION SELECT article FROM made WHERE statute % 50 = 7),
flags AS (SELECT a.article, number, CASE WHEN number LIKE 'Annexe%' THEN 'R' WHEN left(number, 1) IN ('L', 'R', 'D') THEN left(number, 1) END AS part,
  CAST(a.article IN (FROM passage) AS INTEGER) AS passage, CAST(a.article IN (FROM amendment) AS INTEGER) AS amendment, CAST(a.article IN (FROM bill_article) AS INTEGER) AS bill_article, CAST(a.article IN (FROM paper) AS INTEGER) AS paper, CAST(a.article IN (FROM eu_act) AS INTEGER) AS eu_act
  FROM articles a JOIN now USING (article)),
verdicts AS (SELECT *, CASE WHEN passage + amendment > 0 THEN 'motivating_passage' WHEN bill_article > 0 THEN 'situated_origin' WHEN paper + eu_act > 0 THEN 'statute_motivated' ELSE 'undocumented' END AS verdict FROM flags)"""


def _lines(docs):
    """(segment, version, key, block, n): long lines; ``key`` stands for a line's text, ``n`` is its length."""
    each = docs.select("doc_id", F.posexplode(F.split("text", "\n")).alias("i", "body")).where(F.length("body") >= MIN_LINE)
    return each.select(
        (F.col("doc_id") * 10_000_000 + F.col("i") + 1).alias("segment"), (2 * F.col("doc_id") + 1).alias("version"), F.unhex(F.sha2("body", 256)).alias("key"),
        F.expr("doc_id div 64").alias("block"), F.length("body").alias("n"),
    )


def _carried(lines):
    """(segment, source) in two hops. A line that all documents hold is counted on the map side and meets its block's first holder only."""
    near = lines.groupBy("key", "block").agg(F.min("segment").alias("near"), F.count("*").alias("n"))
    first = near.groupBy("key").agg(F.min("near").alias("first"), F.count("*").alias("blocks"))
    inside = lines.join(near.where("n > 1").drop("n"), ["key", "block"]).where("segment <> near").select("segment", F.col("near").alias("source"))
    between = near.join(first.where("blocks > 1"), "key").where("near <> first").select(F.col("near").alias("segment"), F.col("first").alias("source"))
    return inside.unionByName(between)


def _graph(spark, sf_dir):
    """The tables of the graph; of the texts nothing is written but a digest for each long line."""
    docs = table(spark, sf_dir, "documents")
    lines = written(_lines(docs))
    ids = docs.select("doc_id")
    letter = F.element_at(F.array(*map(F.lit, ["L", "L", "R", "D", "Annexe a l'article R", "X"])), (F.col("doc_id") % 6).cast("int") + 1)
    second = F.date_add(F.lit("2010-01-01").cast("date"), (F.col("doc_id") * 7 % 3000).cast("int"))
    versions = ids.select(
        F.col("doc_id").alias("article"),
        F.inline(
            F.array(
                F.struct((2 * F.col("doc_id")).alias("version"), F.date_add(F.lit("2000-01-01").cast("date"), (F.col("doc_id") % 1000).cast("int")).alias("start"), second.alias("end"), F.lit("effective").alias("state")),
                F.struct(
                    (2 * F.col("doc_id") + 1).alias("version"), second.alias("start"),
                    F.when(F.col("doc_id") % 9 == 0, F.date_add(F.lit("2014-01-01").cast("date"), (F.col("doc_id") % 1500).cast("int"))).alias("end"),
                    F.when(F.col("doc_id") % 10 == 4, "stillborn").otherwise("effective").alias("state"),
                ),
            )
        ),
    )
    created = ids.selectExpr("2 * doc_id as version", "doc_id div 10 as statute", "'creation' as link")
    changed = ids.where("doc_id % 3 = 0").selectExpr("2 * doc_id + 1 as version", "doc_id * 3 div 11 as statute", "if(doc_id % 5 = 0, 'repeal', 'modification') as link")
    produced = created.unionByName(changed)
    graph = Graph(
        articles=ids.select(F.col("doc_id").alias("article"), F.concat(letter, F.expr("cast(doc_id div 12 * 12 + doc_id % 6 as string)")).alias("number"), F.expr("1 + doc_id % 12 div 6").alias("lineage")),
        versions=versions,
        segments=lines.select("segment", "version"),
        produced=produced,
        renumbered=ids.where("doc_id % 4 in (1, 2) and doc_id div 3 < doc_id").selectExpr("doc_id as article", "doc_id div 3 as former"),
        carried=_carried(lines),
        origins=produced.where("statute % 5 < 3").selectExpr("statute", "statute div 3 as dossier").distinct(),
        texts=ids.selectExpr("doc_id div 15 as text", "doc_id div 15 div 2 as dossier").distinct(),
        aims=ids.where("doc_id % 8 = 3").selectExpr("doc_id div 15 as text", "doc_id % 7 as bill_article", "doc_id as article", "concat('L', doc_id) as cited"),
    )
    return docs, lines, graph


def _verdicts(spark, sf_dir):
    docs, lines, graph = _graph(spark, sf_dir)
    return documented(
        graph,
        motives=docs.where("n_chars % 13 = 0").select(F.col("doc_id").alias("article")),
        results=lines.where("n % 37 = 0").select("segment"),
        papers=graph.origins.where("dossier % 4 = 0").select("dossier"),
        citations=lines.where("n % 41 = 0").select("segment"),
        transposed=graph.produced.where("statute % 50 = 7").select("statute"),
        day=F.lit(DAY).cast("date"), never=F.expr(NEVER),
    )


@query(f"WITH RECURSIVE {_ROUTES} FROM verdicts")
def route_verdicts(spark, sf_dir):
    """Every article in force with the five routes that document it and its verdict."""
    return _verdicts(spark, sf_dir)


@query(
    f"""WITH RECURSIVE {_ROUTES} SELECT part, count(*) AS articles, count(*) FILTER (WHERE verdict = 'motivating_passage') AS motivating_passage, count(*) FILTER (WHERE verdict = 'situated_origin') AS situated_origin,
count(*) FILTER (WHERE verdict = 'statute_motivated') AS statute_motivated, count(*) FILTER (WHERE verdict = 'undocumented') AS undocumented, round(100.0 * count(*) FILTER (WHERE verdict = 'undocumented') / count(*), 1) AS silent_share FROM verdicts GROUP BY part"""
)
def silence_by_part(spark, sf_dir):
    """Verdicts counted by part; articles of no part stand under null."""
    return silence(_verdicts(spark, sf_dir))


@query(
    f"""WITH RECURSIVE {_GRAPH} SELECT DISTINCT up.seed AS article, number, dossier, text, bill_article, cited, up.seed = s.article AS direct, survived
FROM survival s JOIN up ON up.node = s.article JOIN now n ON n.article = up.seed JOIN articles a ON a.article = up.seed"""
)
def bills_discussed(spark, sf_dir):
    """Articles in force with the articles of texts under which they were debated, themselves or under a former number."""
    return discussed(_graph(spark, sf_dir)[2], F.lit(DAY).cast("date"), F.expr(NEVER))


_JUDGED = """d AS (SELECT *, CASE doc_id % 4 WHEN 0 THEN 'filed_on' WHEN 1 THEN 'aims_at' WHEN 2 THEN 'targets' ELSE 'results_from' END AS family, sha256(text) AS stable FROM documents),
j1 AS (SELECT d.*, 'a' || doc_id % 3 AS sheet, DATE '2024-01-01' AS day, quality = 1 AS good FROM d JOIN labels USING (doc_id)),
j2 AS (SELECT * REPLACE ('z' AS sheet, CASE WHEN doc_id % 21 = 0 THEN DATE '2023-01-01' ELSE DATE '2024-06-01' END AS day, NOT good AS good) FROM j1 WHERE doc_id % 7 = 0),
j AS (SELECT family, 'k' || doc_id AS key, stable, sheet, day, good, 'L' || doc_id % 50 AS number, CASE WHEN doc_id % 2 = 0 THEN DATE '2001-01-01' + CAST(doc_id % 5 AS INTEGER) END AS lineage, CASE WHEN family = 'filed_on' THEN 'named' END AS route
  FROM (FROM j1 UNION ALL FROM j2) AS x WHERE good IS NOT NULL),
e AS (SELECT family, CASE WHEN doc_id % 5 = 3 THEN 'm' ELSE 'k' END || doc_id AS key, stable, 'L' || (doc_id % 50 + CASE WHEN doc_id % 9 = 1 THEN 1 ELSE 0 END) AS number, DATE '2001-01-01' + CAST(doc_id % 5 + CASE WHEN doc_id % 22 = 2 THEN 1 ELSE 0 END AS INTEGER) AS lineage,
  CASE WHEN family = 'filed_on' THEN CASE WHEN doc_id % 3 = 0 THEN 'whole' ELSE 'named' END END AS route FROM d WHERE n_chars >= 900)"""


@query(
    f"""WITH {_JUDGED}, l AS (SELECT family, key, arg_max(sheet, (day, sheet)) AS latest FROM j GROUP BY ALL),
o AS (SELECT family, key, stable, (lineage, coalesce(route, ''), number) AS x, lineage FROM e),
a1 AS (SELECT family, key, lineage, min(x) AS x FROM o GROUP BY 1, 2, 3), a2 AS (SELECT family, key, min(x) AS x FROM o GROUP BY 1, 2), a3 AS (SELECT family, stable, lineage, min(x) AS x FROM o GROUP BY 1, 2, 3), a4 AS (SELECT family, stable, min(x) AS x FROM o GROUP BY 1, 2),
h AS (SELECT j.*, latest, coalesce(a1.x, a2.x, a3.x, a4.x) AS x FROM j LEFT JOIN l USING (family, key) LEFT JOIN a1 ON a1.family = j.family AND a1.key = j.key AND a1.lineage = j.lineage LEFT JOIN a2 ON a2.family = j.family AND a2.key = j.key
  LEFT JOIN a3 ON a3.family = j.family AND a3.stable = j.stable AND a3.lineage = j.lineage LEFT JOIN a4 ON a4.family = j.family AND a4.stable = j.stable)
SELECT family, sheet, CASE WHEN latest <> sheet THEN 'judged_elsewhere' WHEN x IS NOT NULL AND lineage IS NOT NULL AND x[1] <> lineage THEN 'other_lineage' WHEN x IS NOT NULL AND NOT good AND route IS NOT NULL AND x[2] <> route THEN 'other_route'
  WHEN NOT good THEN CASE WHEN x IS NULL THEN 'absent' ELSE 'returned' END WHEN x IS NULL THEN 'lost' WHEN family <> 'aims_at' AND x[3] <> number THEN 'moved' ELSE 'held' END AS status, count(*) AS n FROM h GROUP BY ALL"""
)
def verdicts_replayed(spark, sf_dir):
    """Labels as verdicts of sheets, some judged twice, against documents as edges, some of which slid to another key, number, lineage or route."""
    kind = F.element_at(F.array(*map(F.lit, ["filed_on", "aims_at", "targets", "results_from"])), (F.col("doc_id") % 4).cast("int") + 1)
    docs = table(spark, sf_dir, "documents").select("doc_id", "n_chars", kind.alias("family"), F.sha2("text", 256).alias("stable"))
    filed = F.col("family") == "filed_on"
    day = lambda d: F.lit(d).cast("date")
    first = docs.join(table(spark, sf_dir, "labels").select("doc_id", (F.col("quality") == 1).alias("good")), "doc_id").withColumns({"sheet": F.concat(F.lit("a"), F.col("doc_id") % 3), "day": day("2024-01-01")})
    again = first.where("doc_id % 7 = 0").withColumns({"sheet": F.lit("z"), "day": F.when(F.col("doc_id") % 21 == 0, day("2023-01-01")).otherwise(day("2024-06-01")), "good": ~F.col("good")})
    judged = first.unionByName(again).select(
        "family", F.concat(F.lit("k"), "doc_id").alias("key"), "stable", "sheet", "day", "good", F.concat(F.lit("L"), F.col("doc_id") % 50).alias("number"),
        F.when(F.col("doc_id") % 2 == 0, F.date_add(day("2001-01-01"), (F.col("doc_id") % 5).cast("int"))).alias("lineage"), F.when(filed, "named").alias("route"),
    )
    edges = docs.where("n_chars >= 900").select(
        "family", F.concat(F.when(F.col("doc_id") % 5 == 3, "m").otherwise("k"), "doc_id").alias("key"), "stable", F.concat(F.lit("L"), F.col("doc_id") % 50 + F.when(F.col("doc_id") % 9 == 1, 1).otherwise(0)).alias("number"),
        F.date_add(day("2001-01-01"), (F.col("doc_id") % 5 + F.when(F.col("doc_id") % 22 == 2, 1).otherwise(0)).cast("int")).alias("lineage"),
        F.when(filed, F.when(F.col("doc_id") % 3 == 0, "whole").otherwise("named")).alias("route"),
    )
    return replay_moved(judged, edges, ["aims_at"]).groupBy("family", "sheet", "status").agg(F.sum("n").alias("n"))
