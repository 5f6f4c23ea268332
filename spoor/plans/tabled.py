"""Tables of concordance, over pages that Spark writes from the documents: a document's lines are the lines of a study's tables.

A page has two lines of its table and every fifth page begins one; the fourth after that is an annex. Of four documents two
have their pages turned by a quarter. Lines lack their anchor or quote an article of the code in its place; cells name the
code, another one or none, quote, comment, or stand above their line by more and by less than is forgiven.
"""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spoor.operators import tables
from spoor.registry import query
from spoor.sources.tables import table, written

_PLACES = (-12, -5, 0, 6)


def _lines(spark, sf_dir) -> DataFrame:
    docs = table(spark, sf_dir, "documents").where("doc_id is not null").select(F.col("doc_id").alias("document"), F.posexplode(F.split("text", "\n")).alias("i", "x"))
    rows = docs.select("document", "i", F.length("x").alias("n"), (F.floor(F.col("i") / 2) + 1).cast("int").alias("page"), (F.col("i") % 2).alias("k"))
    return rows.withColumns({"book": ((F.col("n") * 7 + F.col("i")) % 900 + 100).cast("string"), "a": ((F.col("n") + F.col("i")) % 30 + 1).cast("string"), "q": (F.col("n") % 9 + 1).cast("string")})


def study_pages(lines: DataFrame) -> DataFrame:
    c, s, d = F.concat, F.lit, F.col("document")
    rank, year = (d % 500 + 1).cast("string"), (d % 20 + 2000).cast("string")
    act = F.when(d % 2 == 0, c(s("directive "), year, s("/"), rank, s("/CE"))).otherwise(c(s("règlement (UE) n° "), rank, s("/"), year))
    title = F.when(d % 7 == 3, s("Annexe 4\nTableau de concordance")).otherwise(c(s("Annexe 4\nTableau de\ntransposition de la "), act))
    text = F.when(F.col("page") % 5 == 1, title).when(F.col("page") % 5 == 4, s("Étude\n12 ANNEXE\nListe")).otherwise(s("Suite"))
    return lines.select("document", "page").distinct().select("document", "page", text.alias("text"))


def study_blocks(lines: DataFrame) -> DataFrame:
    c, s, n, i = F.concat, F.lit, F.col("n"), F.col("i")
    pick = lambda of, *xs: F.element_at(F.array(*xs), (of + 1).cast("int"))
    anchor = pick((n + 2 * i) % 5, c(s("Article "), "a", s(" §"), "q"), c(s("Art. "), "a"), c(s("« Art. L. "), "book", s("-1 »")), c(s("Article "), "a", s(" ("), "q", s(")\nDéfinitions")), s("Suite des dispositions"))
    cell = pick(
        (n + i) % 7,
        c(s("•\nArt. L. "), "book", s("-"), (i % 3 + 1).cast("string"), s(" 1° du code de la consommation")),
        c(s("Articles L. "), "book", s("-1 et R. "), "book", s("-2")),
        c(s("L. "), "book", s("-3 du code civil")),
        c(s("« Art. L. "), "book", s("-9. – Le vendeur »")),
        c(s("Commentaire\nArticle 9 de la directive ; voir L. "), "book", s("-1 du code de la consommation")),
        c(s("Art. D "), "book", s("-4-1\nmodifié, code de la consommation")),
        c(s("Art. L. "), "book", s("‑1 C. conso")),
    )
    y = 100 + 40 * F.col("k")
    block = lambda line, column, text: F.struct(line.cast("double").alias("line"), column.cast("double").alias("column"), text.alias("text"))
    own = F.array(block(y, 50 + n % 3 * 5, anchor), block(y + pick((n + 3 * i) % 4, *map(F.lit, _PLACES)), s(300), cell))
    header = F.array(block(s(60), s(300), s("Dispositions du code de la consommation")))
    headed = (F.col("page") % 5 == 1) & (F.col("k") == 0) & (F.col("document") % 3 != 0)
    rows = lines.select("document", "page", F.explode(F.when(headed, F.concat(own, header)).otherwise(own)).alias("b"))
    turned = F.col("document") % 4 >= 2
    x0, y0 = F.when(turned, F.col("b.line")).otherwise(F.col("b.column")), F.when(turned, 700 - F.col("b.column")).otherwise(F.col("b.line"))
    return rows.select("document", "page", (~turned).cast("int").alias("dx"), (-turned.cast("int")).alias("dy"), x0.alias("x0"), y0.alias("y0"), (x0 + 100).alias("x1"), F.when(turned, 800 - F.col("b.column")).otherwise(y0 + 20).alias("y1"), "b.text")


def _acts(spark, sf_dir) -> DataFrame:
    """Acts whose tables are read, of every five documents' four; each has 26 articles."""
    d = F.col("doc_id")
    celex = F.concat(F.lit("3"), (d % 20 + 2000).cast("string"), F.when(d % 2 == 0, "L").otherwise("R"), F.lpad((d % 500 + 1).cast("string"), 4, "0"))
    return table(spark, sf_dir, "documents").where("doc_id is not null and doc_id % 5 <> 4").select(celex.alias("celex")).distinct()


def _found(spark, sf_dir) -> DataFrame:
    lines = _lines(spark, sf_dir)
    return tables.concordances(study_pages(lines), study_blocks(lines), _acts(spark, sf_dir))


_SQL = """x AS (SELECT doc_id AS document, unnest(string_split(text, chr(10))) AS x, generate_subscripts(string_split(text, chr(10)), 1) - 1 AS i FROM documents WHERE doc_id IS NOT NULL),
l AS (SELECT document, i, length(x) AS n, i // 2 + 1 AS page, i % 2 AS k, CAST((length(x) * 7 + i) % 900 + 100 AS VARCHAR) AS book, CAST((length(x) + i) % 30 + 1 AS VARCHAR) AS a, CAST(length(x) % 9 + 1 AS VARCHAR) AS q FROM x),
w AS (SELECT *, document % 3 <> 0 OR max((n + i) % 7 IN (0, 4, 5, 6)) OVER (PARTITION BY document, page // 5 ORDER BY page) AS named FROM l WHERE page % 5 IN (1, 2, 3) AND document % 7 <> 3 AND document % 5 <> 4),
s AS (SELECT document, page, k, a, CASE (n + 2 * i) % 5 WHEN 1 THEN '' ELSE q END AS q, CASE (n + 2 * i) % 5 WHEN 0 THEN 'Article ' || a || ' §' || q WHEN 1 THEN 'Art. ' || a ELSE 'Article ' || a || ' (' || q END AS said FROM w WHERE (n + 2 * i) % 5 IN (0, 1, 3)),
c AS (SELECT *, k - CASE WHEN (n + 3 * i) % 4 = 0 THEN 1 ELSE 0 END AS band, CASE (n + i) % 7 WHEN 0 THEN 'Art. L. ' || book || '-' || (i % 3 + 1) || ' 1° du code de la consommation' WHEN 1 THEN 'Articles L. ' || book || '-1 et R. ' || book || '-2' WHEN 5 THEN 'Art. D ' || book || '-4-1' WHEN 6 THEN 'Art. L. ' || book || '‑1 C. conso' END AS head,
  CASE (n + i) % 7 WHEN 0 THEN ['L' || book || '-' || (i % 3 + 1)] WHEN 1 THEN ['L' || book || '-1', 'R' || book || '-2'] WHEN 5 THEN ['D' || book || '-4-1'] WHEN 6 THEN ['L' || book || '-1'] END AS numbers,
  CAST(100 + 40 * k + [-12, -5, 0, 6][(n + 3 * i) % 4 + 1] AS DOUBLE) AS line FROM w WHERE (n + i) % 7 IN (0, 5, 6) OR ((n + i) % 7 = 1 AND named)),
b AS (SELECT c.*, s.a AS act_article, s.q AS paragraph, said, row_number() OVER (PARTITION BY c.document, c.i ORDER BY s.k DESC) AS best FROM c JOIN s ON s.document = c.document AND s.page = c.page AND s.k <= c.band),
f AS (SELECT document, CAST(page AS INTEGER) AS page, '3' || (document % 20 + 2000) || CASE WHEN document % 2 = 0 THEN 'L' ELSE 'R' END || lpad(CAST(document % 500 + 1 AS VARCHAR), 4, '0') AS celex, act_article, paragraph, unnest(numbers) AS number, said || ' — ' || head AS proof,
  line, CASE WHEN document % 4 >= 2 THEN -500.0 ELSE 300.0 END AS "column", CAST(generate_subscripts(numbers, 1) - 1 AS INTEGER) AS ordinal FROM b WHERE best = 1)"""


@query(f"WITH {_SQL} SELECT * REPLACE (CAST(\"column\" AS DOUBLE) AS \"column\") FROM f")
def concordance_tables(spark, sf_dir):
    """Articles of acts and the code's articles that tables of studies set against them, upright and turned."""
    return _found(spark, sf_dir)


@query(
    f"""WITH {_SQL}, n AS (SELECT DISTINCT p_partkey % 900 + 100 AS book FROM part), m AS (SELECT book, unnest(['L' || book || '-1', 'L' || book || '-2', 'L' || book || '-3', 'R' || book || '-2', 'D' || book || '-4-1']) AS number FROM n),
r AS (SELECT f.*, CASE WHEN TRY_CAST(act_article AS INTEGER) > 26 THEN 'unknown_act_article' WHEN document % 11 = 5 THEN 'no_document' WHEN m.number IS NULL THEN 'unresolved' END AS reason,
  CASE WHEN document % 10 = 0 OR book % 2 = 0 OR DATE '2000-01-01' + CAST(document % 4000 AS INTEGER) < DATE '2005-01-01' THEN 1 ELSE 2 END AS lineage FROM f LEFT JOIN m USING (number)),
t AS (SELECT *, row_number() OVER (PARTITION BY document, celex, act_article, paragraph, number, lineage, reason ORDER BY page, line, "column", ordinal) AS k FROM r)
SELECT document, page, celex, act_article, paragraph, number, proof, CASE WHEN reason IS NULL THEN lineage END AS lineage, CASE WHEN reason IS NULL AND k > 1 THEN 'repeated' ELSE reason END AS reason FROM t"""
)
def transposed_articles(spark, sf_dir):
    """Which lineage of the code transposes which article of an act, or why a table's line tells none."""
    found = written(_found(spark, sf_dir))
    studies = table(spark, sf_dir, "documents").where("doc_id is not null and doc_id % 11 <> 5").select(F.col("doc_id").alias("document"), F.col("doc_id").alias("dossier"), F.expr("date_add(date'2000-01-01', cast(doc_id % 4000 as int))").alias("day")).distinct()
    declared = _acts(spark, sf_dir).select("celex", F.explode(F.sequence(F.lit(1), F.lit(26)).cast("array<string>")).alias("number"))
    book = F.col("book").cast("string")
    named = F.array(*[F.concat(F.lit(p), book, F.lit(e)) for p, e in (("L", "-1"), ("L", "-2"), ("L", "-3"), ("R", "-2"), ("D", "-4-1"))])
    numbers = table(spark, sf_dir, "part").select((F.col("p_partkey") % 900 + 100).alias("book")).distinct().select("book", F.explode(named).alias("number"))
    ends = F.expr("case when book % 2 = 0 then array(struct(1 as lineage, cast(null as date) as end)) else array(struct(1 as lineage, date'2005-01-01' as end), struct(2 as lineage, cast(null as date) as end)) end")
    lineages = numbers.select("number", F.explode(ends).alias("x")).select("number", "x.*")
    wrote = found.where("document % 10 = 0").select("number", F.col("document").alias("dossier"), F.lit(1).alias("lineage")).distinct().join(lineages.select("number").distinct(), "number", "left_semi")
    return tables.transposes_article(found, studies, declared, lineages, wrote).drop("line", "column", "ordinal")
