"""Highlights over articles that Spark writes from the documents: a document's lines are an article's segments in four versions.

A line enters in one of the versions, and is there in those that follow; in one of five it gets an addition, so it is
carried on in part. The last version is shown. A segment is carried from the one of the version before that begins alike.
"""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spoor.operators import highlights
from spoor.registry import query
from spoor.sources.tables import table, written

_VERSIONS, _LEAST, _ALIKE, _ADDED = 4, 15, 40, 10


def _segments(spark, sf_dir) -> DataFrame:
    """document, v, i, version, segment, head, size."""
    docs = table(spark, sf_dir, "documents").where("doc_id is not null").select(F.col("doc_id").alias("document"), F.posexplode(F.split("text", "\n")).alias("i", "x")).where(F.length("x") >= _LEAST)
    lines = docs.select("document", "i", F.md5(F.substring("x", 1, _ALIKE)).alias("head"), F.length("x").alias("n"), F.pmod(F.col("document") + F.col("i"), F.lit(_VERSIONS)).alias("enters"))
    rows = lines.select("document", "i", "head", "n", "enters", F.explode(F.sequence(F.col("enters").cast("int"), F.lit(_VERSIONS - 1))).alias("v"))
    added = F.aggregate(F.sequence(F.col("enters").cast("int"), "v"), F.lit(0), lambda s, w: s + F.when(F.pmod(F.col("document") + F.col("i") + 2 * w, F.lit(5)) == 0, _ADDED).otherwise(0))
    version = F.col("document") * _VERSIONS + F.col("v")
    return rows.select("document", "v", "i", version.alias("version"), (version * 1_000_000 + F.col("i")).alias("segment"), "head", (F.col("n") + added).alias("size"))


def _carried(rows: DataFrame) -> DataFrame:
    before = rows.groupBy("document", "head", (F.col("v") + 1).alias("v")).agg(F.min(F.struct("segment", "size")).alias("b"))
    share = F.least("size", "b.size") / F.greatest("size", "b.size")
    return rows.join(before, ["document", "head", "v"]).select("segment", F.col("b.segment").alias("source"), share.alias("share"))


def _shown(spark, sf_dir) -> DataFrame:
    rows = written(_segments(spark, sf_dir))
    versions = rows.select("document", "v", "version").distinct()
    start = lambda x: F.date_add(F.lit("1990-01-01").cast("date"), x.cast("int"))
    d, v = F.col("document"), F.col("v")
    dated = versions.select("version", start(d % 1000 + v * 1500).alias("start"))
    link = F.when((d + v) % 4 == 0, "repeal").otherwise("modification")
    statute = lambda k, kind: F.struct(F.concat(F.lit("S"), ((d + 3 * v + k) % 60).cast("string")).alias("statute"), kind.alias("link"))
    two = F.when((d + v) % 3 == 0, F.array(statute(0, link), statute(7, F.lit("creation")))).otherwise(F.array(statute(0, link)))
    produced = versions.select("version", F.explode(two).alias("x")).select("version", "x.*")
    statutes = spark.range(60).select(F.concat(F.lit("S"), F.col("id").cast("string")).alias("statute"), start(F.col("id") % 17 * 100).alias("date"))
    results = rows.where((d + v + F.col("i")) % 9 == 0).select("segment", F.concat(F.lit("A"), (d % 50).cast("string"), F.lit("-"), v.cast("string")).alias("amendment"))
    shown = versions.where(v == _VERSIONS - 1).select("version")
    return highlights.highlighted(shown, rows.select("segment", "version", F.col("i").alias("rank")), dated, _carried(rows), produced, statutes, results)


_SQL = f"""x AS (SELECT doc_id AS document, unnest(string_split(text, chr(10))) AS x, generate_subscripts(string_split(text, chr(10)), 1) - 1 AS i FROM documents WHERE doc_id IS NOT NULL),
l AS (SELECT document, i, substr(x, 1, {_ALIKE}) AS head, length(x) AS n, (document + i) % {_VERSIONS} AS enters FROM x WHERE length(x) >= {_LEAST}),
r AS (SELECT l.*, v, (document * {_VERSIONS} + v) AS version, (document * {_VERSIONS} + v) * 1000000 + i AS segment, n + {_ADDED} * CAST((SELECT count(*) FROM range({_VERSIONS}) AS y(w) WHERE w BETWEEN enters AND v AND (document + i + 2 * w) % 5 = 0) AS BIGINT) AS size FROM l, range({_VERSIONS}) AS z(v) WHERE v >= enters),
b AS (SELECT document, head, v, min(segment) AS segment FROM r GROUP BY ALL),
c AS (SELECT r.segment, p.segment AS source, r.size <> p.size AS changed FROM r JOIN b ON b.document = r.document AND b.head = r.head AND b.v = r.v - 1 JOIN r AS p ON p.segment = b.segment),
h AS (SELECT segment AS seed, segment AS node FROM r WHERE v = {_VERSIONS - 1} UNION SELECT h.seed, c.source FROM h JOIN c ON c.segment = h.node),
t AS (SELECT seed, count(*) - 1 AS ancestors, min(r.v) AS v0, coalesce(bool_or(c.changed), false) AS touched FROM h JOIN r ON r.segment = h.node LEFT JOIN c ON c.segment = h.node GROUP BY seed),
s AS (SELECT 'S' || k AS statute, DATE '1990-01-01' + CAST(k % 17 * 100 AS INTEGER) AS date FROM range(60) AS q(k)),
m AS (SELECT DISTINCT version, unnest(CASE WHEN (document + v) % 4 <> 0 THEN CASE WHEN (document + v) % 3 = 0 THEN ['S' || (document + 3 * v) % 60, 'S' || (document + 3 * v + 7) % 60] ELSE ['S' || (document + 3 * v) % 60] END WHEN (document + v) % 3 = 0 THEN ['S' || (document + 3 * v + 7) % 60] ELSE [] END) AS statute FROM r),
o AS (SELECT r.version, r.segment, statute, dense_rank() OVER (PARTITION BY r.version ORDER BY date, statute) AS rank FROM t JOIN r ON r.segment = t.seed JOIN m ON m.version = r.document * {_VERSIONS} + v0 JOIN s USING (statute)),
i AS (SELECT segment, string_agg(rank || ':' || statute, ' ' ORDER BY rank) AS introduced_by, (min(rank) - 1) % 10 AS colour FROM o GROUP BY segment),
a AS (SELECT seed, string_agg(a, ' ' ORDER BY a) AS amendments FROM (SELECT DISTINCT seed, 'A' || document % 50 || '-' || v AS a FROM h JOIN r ON r.segment = h.node WHERE (document + v + i) % 9 = 0) AS y GROUP BY seed)"""


@query(
    f"""WITH RECURSIVE {_SQL} SELECT version, r.segment, CAST(r.i AS INTEGER) AS rank, ancestors, CAST(DATE '1990-01-01' + CAST(document % 1000 + v0 * 1500 AS INTEGER) AS VARCHAR) AS since, coalesce(introduced_by, '') AS introduced_by, CAST(colour AS INTEGER) AS colour, touched, coalesce(amendments, '') AS amendments
FROM t JOIN r ON r.segment = t.seed LEFT JOIN i ON i.segment = t.seed LEFT JOIN a USING (seed)"""
)
def highlight_by_ancestry(spark, sf_dir):
    """Each paragraph of the version shown with the statutes that introduced it, whether it was touched since, and by which amendments."""
    by = F.array_join(F.transform("introduced_by", lambda x: F.concat_ws(":", x["rank"].cast("string"), x["statute"])), " ")
    return _shown(spark, sf_dir).withColumns({"introduced_by": by, "amendments": F.array_join("amendments", " "), "since": F.col("since").cast("string")})


@query(
    f"""WITH RECURSIVE {_SQL} SELECT r.version, statute, CAST((o.rank - 1) % 10 AS INTEGER) AS colour, count(*) AS paragraphs FROM t JOIN r ON r.segment = t.seed LEFT JOIN o ON o.segment = t.seed GROUP BY ALL"""
)
def highlight_legend(spark, sf_dir):
    """The statutes in a highlighted version, their colours and how many paragraphs each introduced; those of unknown origin too."""
    return highlights.legend(_shown(spark, sf_dir))
