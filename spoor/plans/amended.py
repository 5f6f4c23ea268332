"""Paragraphs of texts under discussion and what amendments to them are filed on, over texts that Spark writes from the line items.

An order is a text of one article, whose lines are its items: an article written in a quotation, a quoted title, a line that may
wrap one, a lettered line. Of the orders with odd keys the paragraph numbers are printed, each fifth of those with a break of one
kind. An item is an amendment too: it may quote a paragraph's head, name an article, a paragraph, or the article as a whole.
"""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spoor.operators import filing, paragraphs
from spoor.operators.closure import chain
from spoor.registry import query
from spoor.sources.tables import table, written

#: Line items of an order in the order of these columns make its lines.
_ORDER = "l_linenumber, l_partkey, l_suppkey, l_returnflag, l_linestatus"


def _articles(items: DataFrame) -> DataFrame:
    """Adds dotted, the number of the article of the code that an item stands for."""
    return items.withColumn("dotted", F.concat(F.lit("L. "), (100 + F.col("l_partkey") % 400).cast("string"), F.lit("-"), F.col("l_linenumber").cast("string")))


def items(spark, sf_dir) -> DataFrame:
    """(text, rank, dotted, line, l_partkey, l_suppkey, l_returnflag, l_linestatus): the lines of the texts, ranked from 1."""
    read = _articles(table(spark, sf_dir, "lineitem").select("l_orderkey", *_ORDER.split(", ")))
    product = F.concat(F.lit("PRODUIT "), F.col("l_partkey").cast("string"))
    line = (
        F.when(F.col("l_returnflag") == "A", F.concat(F.lit("« Art. "), F.col("dotted"), F.lit(". – Le "), F.lower(product)))
        .when(F.col("l_returnflag") == "R", F.concat(F.lit("« SECTION DES RÈGLES DU "), product))
        .when(F.col("l_linenumber") % 2 == 1, F.concat(F.lit("RELEVANT DU "), product))
        .otherwise(F.concat(F.lit("a) Le "), F.lower(product)))
    )
    own = F.struct(*[F.col(c) for c in _ORDER.split(", ")], "dotted", line.alias("line"))
    per = read.groupBy(F.col("l_orderkey").alias("text")).agg(F.array_sort(F.collect_list(own)).alias("xs"))
    return per.select("text", F.posexplode("xs").alias("at", "x")).select("text", (F.col("at") + 1).alias("rank"), "x.*")


def articles(lines: DataFrame) -> DataFrame:
    """(text, article, body, offset): what each text says, with the breaks of its key."""
    odd, form, r = F.col("text") % 2 == 1, (F.floor(F.col("text") / 2) % 10).cast("int"), F.col("rank").cast("int")
    number = paragraphs.printed(F.when((form == 1) & (r >= 3), r + 1).otherwise(r))
    numbered = F.concat_ws(
        "\n", number, F.when(~((form == 2) & (r == 2)), F.col("line")), F.when((form == 3) & (r == 2), F.lit("une ligne de plus"))
    )
    each = lines.select("text", odd.alias("odd"), form.alias("form"), F.struct("rank", F.when(odd, numbered).otherwise(F.col("line")).alias("line")).alias("x"))
    per = each.groupBy("text", "odd", "form").agg(F.array_sort(F.collect_list("x")).alias("xs"))
    above = F.when(F.col("odd") & (F.col("form") == 4), "une fin d'article").when(F.col("text") % 3 == 0, "(Non modifié)")
    below = F.when(F.col("odd") & (F.col("form") == 5), "Chapitre II")
    lines_ = F.transform("xs", lambda x: x["line"])
    return per.select("text", F.lit("1").alias("article"), F.concat_ws("\n", F.concat(above, F.lit("\n")), F.array_join(lines_, "\n"), below).alias("body"), F.lit(0).alias("offset"))


def amendments(lines: DataFrame) -> DataFrame:
    """(amendment, text, declared, subdivision, dispositif): one for each line, of a form that its part decides."""
    form, d = (F.col("l_partkey") % 16).cast("int"), F.col("dotted")
    rank, number = F.col("rank"), lambda shift: (F.col("rank") + shift).cast("string")
    told = (
        F.when(form == 0, F.concat(F.lit("Alinéa "), number(F.when(F.col("l_suppkey") % 5 == 0, 1).otherwise(0)), F.lit("\nRédiger ainsi cet alinéa :\n« Art. "), d, F.lit(". – Autrement. »")))
        .when(form == 3, F.concat(F.lit("Après l'alinéa "), number(0), F.lit(", insérer un alinéa ainsi rédigé :\n« Art. "), d, F.lit("-1. – De plus. »")))
        .when(form.isin(4, 5), F.concat(F.lit("Alinéas "), F.greatest(rank - 1, F.lit(1)).cast("string"), F.lit(" et "), number(0), F.lit("\nSupprimer ces alinéas.")))
        .when(form == 6, F.lit("Compléter cet article par un alinéa ainsi rédigé : « Il en est de même. »"))
        .when(form == 7, F.concat(F.lit("Rédiger ainsi cet article :\n« L'article "), d, F.lit(" du code de la consommation est abrogé. »")))
        .when(form == 8, F.lit("À l'article 3 de la loi n° 93-949, le mot est supprimé."))
        .when(form.isin(9, 10), F.lit("Supprimer cet article."))
        .when(form == 11, F.lit("Le mot : « et » est remplacé par le mot : « ou »."))
        .otherwise(F.concat(F.lit("À l'article "), d, F.lit(", le mot est supprimé.")))
    )
    label = F.when(form == 12, "art. add. après Article 1").when(form == 13, "Annexe").when(form == 14, "Article 9").otherwise("Article 1")
    plain = F.replace(d, F.lit("L. "), F.lit("L"))
    declared = F.when(form.isin(1, 15), F.array(plain)).when(form == 2, F.array(_former(d))).otherwise(F.array().cast("array<string>"))
    return lines.select(F.concat_ws(":", "text", "rank").alias("amendment"), "text", declared.alias("declared"), label.alias("subdivision"), told.alias("dispositif"))


def _former(dotted):
    """The number that an article had before."""
    return F.replace(F.replace(dotted, F.lit("L. "), F.lit("L")), F.lit("-"), F.lit("-9"))


def renumberings(lines: DataFrame) -> DataFrame:
    """(old, new): articles of the first two items have a former number; and of the second item two later articles each."""
    now = F.replace(F.col("dotted"), F.lit("L. "), F.lit("L"))
    first = lines.where("l_linenumber <= 2").select(_former(F.col("dotted")).alias("old"), now.alias("new"))
    return first.unionByName(lines.where("l_linenumber = 2").select(_former(F.col("dotted")).alias("old"), F.concat(now, F.lit("-0")).alias("new"))).distinct()


_GLYPHS = "chr(61440 + ascii(substr('{letters}', CAST({k} AS INTEGER) + 1, 1)))"
_GLYPH = "CASE WHEN {r} < 10 THEN " + _GLYPHS.format(letters=paragraphs.ONES, k="({r} - 1)") + " ELSE chr(61440 + 48 + CAST({r} // 10 AS INTEGER)) || " + _GLYPHS.format(letters=paragraphs.UNITS, k="({r} % 10)") + " END"
_BODIES = f"""x AS (SELECT l_orderkey AS text, row_number() OVER (PARTITION BY l_orderkey ORDER BY {_ORDER}) AS rank, {_ORDER}, 'L. ' || CAST(100 + l_partkey % 400 AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR) AS dotted,
  l_orderkey % 2 = 1 AS odd, (l_orderkey // 2) % 10 AS form FROM lineitem),
l AS (SELECT *, CASE WHEN l_returnflag = 'A' THEN '« Art. ' || dotted || '. – Le produit ' || l_partkey WHEN l_returnflag = 'R' THEN '« SECTION DES RÈGLES DU PRODUIT ' || l_partkey WHEN l_linenumber % 2 = 1 THEN 'RELEVANT DU PRODUIT ' || l_partkey ELSE 'a) Le produit ' || l_partkey END AS line,
  CASE WHEN form = 1 AND rank >= 3 THEN rank + 1 ELSE rank END AS told FROM x),
b AS (SELECT text, concat_ws(chr(10), CASE WHEN odd AND form = 4 THEN 'une fin d''article' || chr(10) WHEN text % 3 = 0 THEN '(Non modifié)' || chr(10) END,
  string_agg(CASE WHEN odd THEN concat_ws(chr(10), {_GLYPH.format(r='told')}, CASE WHEN NOT (form = 2 AND rank = 2) THEN line END, CASE WHEN form = 3 AND rank = 2 THEN 'une ligne de plus' END) ELSE line END, chr(10) ORDER BY rank),
  CASE WHEN odd AND form = 5 THEN 'Chapitre II' END) AS body FROM l GROUP BY text, odd, form),
u AS (SELECT text, i, line, CAST(sum(length(line) + 1) OVER (PARTITION BY text ORDER BY i) - length(line) - 1 AS BIGINT) AS start FROM (SELECT text, unnest(string_split(body, chr(10))) AS line, unnest(range(len(string_split(body, chr(10))))) AS i FROM b) AS y),
n AS MATERIALIZED (SELECT text, row_number() OVER (PARTITION BY text ORDER BY i) AS i, line, start, start + length(line) AS fin, ascii(line) BETWEEN 57344 AND 63743 AS g,
  CASE WHEN ascii(line) >= 57344 THEN CASE WHEN length(line) = 1 THEN ascii(line) - 61440 - 75 ELSE (ascii(line) - 61440 - 48) * 10 + ascii(substr(line, 2)) - 61440 - 97 END END AS num,
  line[1] = '(' AS status, line[1] = '«' AS quoted, regexp_matches(line, '^(«|\\(|[a-z]\\))') AS head FROM u WHERE trim(line) <> ''),
w AS (SELECT *, bool_or(g) OVER (PARTITION BY text) AS has, NOT head AND NOT g AND coalesce(lag(quoted) OVER o, false) AND coalesce(lead(quoted) OVER o, false) AS wraps, count(*) FILTER (g) OVER (PARTITION BY text ORDER BY i) AS k FROM n WINDOW o AS (PARTITION BY text ORDER BY i)),
c AS (SELECT text, 'counted' AS mode, row_number() OVER (PARTITION BY text ORDER BY i) AS number, start, coalesce(wrapped, fin) AS fin, line FROM (SELECT *, CASE WHEN lead(wraps) OVER (PARTITION BY text ORDER BY i) THEN lead(fin) OVER (PARTITION BY text ORDER BY i) END AS wrapped FROM w WHERE NOT has) AS z WHERE NOT wraps AND NOT status),
q AS (SELECT text, k, max(num) AS num, count(*) FILTER (NOT g) AS under, min(i) FILTER (NOT g) AS first, max(k) OVER (PARTITION BY text) AS most FROM w WHERE has AND k > 0 GROUP BY text, k),
s AS (SELECT *, CASE WHEN num IS NULL OR num <> k THEN 'out_of_turn' WHEN under = 0 THEN 'no_line' WHEN k < most AND under > 1 THEN 'two_lines' END AS trouble FROM q),
a AS (SELECT text, bool_or(k = 0 AND NOT status) AS above FROM w WHERE has GROUP BY text),
f AS (SELECT text, min(k) FILTER (trouble IS NOT NULL) AS stop, arg_min(trouble, k) FILTER (trouble IS NOT NULL) AS why FROM s GROUP BY text),
p AS MATERIALIZED (SELECT text, mode, number, start, fin, line FROM c UNION ALL SELECT s.text, 'printed', s.k, w.start, w.fin, w.line FROM s JOIN a USING (text) JOIN f USING (text) JOIN w ON w.text = s.text AND w.i = s.first WHERE NOT above AND (stop IS NULL OR s.k < stop)),
m AS (SELECT text, rank, l_partkey % 16 AS form, rank + CASE WHEN l_suppkey % 5 = 0 THEN 1 ELSE 0 END AS says, 'Art. ' || dotted AS heads FROM x WHERE l_partkey % 16 = 0),
h AS MATERIALIZED (SELECT m.text, m.rank, EXISTS (SELECT 1 FROM p WHERE p.text = m.text AND p.number = m.says AND starts_with(p.line, '« ' || heads)) AS confirmed FROM m)"""


@query(
    f"""WITH {_BODIES}
SELECT text, '1' AS article, number, CAST(start AS INTEGER) AS start, CAST(fin AS INTEGER) AS "end" FROM p WHERE text NOT IN (SELECT text FROM h WHERE NOT confirmed)"""
)
def bill_paragraphs(spark, sf_dir):
    """Paragraph numbers of all texts, printed or counted, but of articles whose numbering an amendment contradicts."""
    lines = written(items(spark, sf_dir))
    read = written(paragraphs.numberings(articles(lines)))
    said = filing.proposals(amendments(lines)).where("article is not null and not additional")
    return paragraphs.paragraph_numbers(read, paragraphs.anchors(said, read))


@query(
    f"""WITH {_BODIES}, e AS (SELECT t.text, has, CASE WHEN above THEN 'line_above' ELSE why END AS stopped, (SELECT count(*) FROM p WHERE p.text = t.text) AS paragraphs FROM (SELECT text, bool_or(has) AS has FROM w GROUP BY text) AS t LEFT JOIN a USING (text) LEFT JOIN f USING (text)),
d AS (SELECT text, count(*) FILTER (confirmed) AS confirmed, count(*) FILTER (NOT confirmed) AS contradicted FROM h GROUP BY text)
SELECT CASE WHEN has THEN 'printed' ELSE 'counted' END AS mode, coalesce(stopped, 'whole') AS stopped, count(*) AS articles, CAST(sum(paragraphs) AS BIGINT) AS paragraphs, CAST(coalesce(sum(confirmed), 0) AS BIGINT) AS anchors_confirmed, CAST(coalesce(sum(contradicted), 0) AS BIGINT) AS anchors_contradicted, count(*) FILTER (contradicted > 0) AS articles_out FROM e LEFT JOIN d USING (text) GROUP BY 1, 2"""
)
def paragraph_readings(spark, sf_dir):
    """How the numbering of articles was read and where it stopped, and what the anchors of amendments say of each reading."""
    lines = written(items(spark, sf_dir))
    read = written(paragraphs.numberings(articles(lines)))
    said = paragraphs.anchors(filing.proposals(amendments(lines)).where("article is not null and not additional"), read)
    each = said.groupBy("text", "article").agg(F.count_if("confirmed").alias("yes"), F.count_if(~F.col("confirmed")).alias("no"))
    both = read.select("text", "article", "mode", F.coalesce("stopped", F.lit("whole")).alias("stopped"), F.size("paragraphs").alias("n")).join(each, ["text", "article"], "left")
    none = F.lit(0)
    return both.groupBy("mode", "stopped").agg(
        F.count("*").alias("articles"), F.sum("n").alias("paragraphs"), F.coalesce(F.sum("yes"), none).alias("anchors_confirmed"), F.coalesce(F.sum("no"), none).alias("anchors_contradicted"), F.count_if(F.col("no") > 0).alias("articles_out")
    )


#: Of a text, what its quoted articles make it change: with an item that was returned and is done, something outside the code too.
_COVERED = "cov AS (SELECT DISTINCT text, CASE WHEN l_returnflag = 'A' THEN replace(dotted, 'L. ', 'L') END AS target FROM x WHERE l_returnflag = 'A' OR (l_returnflag = 'R' AND l_linestatus = 'O') OR (l_returnflag = 'N' AND l_partkey % 7 = 0))"
_MARKS = "mk AS (SELECT text, bool_or(l_partkey % 11 = 0) AS other_norm, bool_or(l_partkey % 13 = 0) AS hidden FROM x GROUP BY text)"


@query(
    f"""WITH RECURSIVE {_BODIES}, {_COVERED}, {_MARKS},
ren AS (SELECT DISTINCT * FROM (SELECT replace(replace(dotted, 'L. ', 'L'), '-', '-9') AS old, replace(dotted, 'L. ', 'L') AS new FROM x WHERE l_linenumber <= 2 UNION ALL SELECT replace(replace(dotted, 'L. ', 'L'), '-', '-9'), replace(dotted, 'L. ', 'L') || '-0' FROM x WHERE l_linenumber = 2) AS y),
up(seed, node) AS (SELECT DISTINCT target, target FROM cov WHERE target IS NOT NULL UNION SELECT seed, old FROM up JOIN ren ON node = new),
dn(seed, node) AS (SELECT DISTINCT target, target FROM cov WHERE target IS NOT NULL UNION SELECT seed, new FROM dn JOIN ren ON node = old),
ch AS MATERIALIZED (SELECT * FROM up UNION SELECT * FROM dn),
am AS (SELECT text, rank, l_partkey % 16 AS form, replace(dotted, 'L. ', 'L') AS plain, CASE WHEN l_partkey % 16 IN (1, 15) THEN replace(dotted, 'L. ', 'L') WHEN l_partkey % 16 = 2 THEN replace(replace(dotted, 'L. ', 'L'), '-', '-9') END AS declared, l_suppkey % 5 = 0 AS shifted FROM x),
ct AS (SELECT text, count(target) AS n_targets, bool_or(target IS NULL) AS outside, min(target) AS sole FROM cov GROUP BY text),
ins AS (SELECT p.text, p.start, CASE WHEN x.l_returnflag = 'A' THEN replace(x.dotted, 'L. ', 'L') END AS target, CASE WHEN x.l_returnflag = 'A' THEN 'internal' WHEN x.l_partkey % 7 = 0 THEN 'external' END AS scope
  FROM (SELECT b.text, l.rank, l.l_returnflag, l.l_partkey, l.dotted, l.line FROM b JOIN l USING (text)) x JOIN (SELECT u.*, row_number() OVER (PARTITION BY text ORDER BY i) AS r FROM u WHERE line[1] <> '(' AND ascii(line) < 57344 AND line NOT IN ('une fin d''article', 'une ligne de plus', 'Chapitre II', '')) AS p ON p.text = x.text AND p.line = x.line
  WHERE x.l_returnflag = 'A' OR x.l_partkey % 7 = 0),
gv AS MATERIALIZED (SELECT p.text, p.number, (SELECT arg_max({{'t': ins.target, 's': ins.scope}}, ins.start) FROM ins WHERE ins.text = p.text AND ins.start <= p.fin) AS g, p.line[1:9] = '« SECTION' AS division FROM p),
nm AS (SELECT am.*, CASE WHEN form IN (4, 5) AND rank > 1 THEN [rank - 1, rank] WHEN form IN (4, 5) THEN [1, 1] WHEN form = 0 THEN [rank + CASE WHEN shifted THEN 1 ELSE 0 END] WHEN form = 3 THEN [rank] END AS named FROM am),
ev AS (SELECT nm.text, nm.rank, t.i, CASE WHEN gv.text IS NULL OR division OR g.s IS NULL THEN 'unreadable' WHEN g.s <> 'internal' THEN 'outside' ELSE 'target' END AS status, g.t AS target FROM nm, LATERAL (SELECT unnest(named) AS number, unnest(range(len(named))) AS i) AS t LEFT JOIN gv ON gv.text = nm.text AND gv.number = t.number),
pr AS (SELECT text, rank, arg_min(status, i) FILTER (status <> 'target') AS trouble, list_sort(list_distinct(list(target) FILTER (status = 'target'))) AS governed FROM ev GROUP BY text, rank),
fx AS (SELECT nm.*, ct.n_targets, ct.outside, ct.sole, pr.trouble, pr.governed, mk.other_norm, mk.hidden, text IN (SELECT text FROM h WHERE NOT confirmed) AS unfit,
  (SELECT list(target) FROM cov WHERE cov.text = nm.text AND cov.target = nm.declared) AS exact, (SELECT list(DISTINCT cov.target) FROM cov JOIN ch ON ch.seed = cov.target WHERE cov.text = nm.text AND ch.node = nm.declared) AS chained,
  EXISTS (SELECT 1 FROM cov JOIN ch ON ch.seed = cov.target WHERE cov.text = nm.text AND ch.node = nm.plain) AS near FROM nm LEFT JOIN ct USING (text) LEFT JOIN pr USING (text, rank) LEFT JOIN mk USING (text)),
rs AS (SELECT *, CASE WHEN form = 12 THEN 'additional_article' WHEN form = 13 THEN 'unreadable_subdivision' WHEN form = 14 OR coalesce(n_targets, 0) = 0 THEN 'nothing_covered'
  WHEN declared IS NOT NULL AND coalesce(len(exact), 0) <> 1 AND coalesce(len(chained), 0) <> 1 THEN 'contradicted' WHEN declared IS NOT NULL THEN NULL
  WHEN named IS NOT NULL THEN CASE WHEN unfit THEN 'numbering_contradicted' WHEN form = 3 THEN 'inserts_instruction' WHEN trouble = 'unreadable' THEN 'unreadable_paragraph' WHEN trouble = 'outside' THEN 'outside_code' END
  WHEN form = 6 THEN 'appends' WHEN n_targets + CASE WHEN outside THEN 1 ELSE 0 END > 1 THEN 'several_targets' WHEN other_norm OR form = 8 THEN 'other_norm' WHEN hidden THEN 'hidden_paragraph' WHEN form = 7 AND NOT near THEN 'neighbour_rewritten' END AS reason FROM fx),
ot AS (SELECT reason, CASE WHEN reason IS NULL THEN CASE WHEN declared IS NOT NULL THEN CASE WHEN len(exact) = 1 THEN 'named' ELSE 'named_before_or_after' END WHEN named IS NOT NULL THEN 'paragraph' WHEN form IN (7, 9, 10) THEN 'whole' ELSE 'whole_by_default' END END AS route,
  CASE WHEN reason IS NOT NULL THEN 1 WHEN declared IS NULL AND named IS NOT NULL THEN len(governed) ELSE 1 END AS rows, CASE WHEN reason IS NOT NULL THEN NULL WHEN declared IS NOT NULL THEN CASE WHEN len(exact) = 1 THEN exact[1] ELSE chained[1] END WHEN named IS NOT NULL THEN governed[1] ELSE sole END AS target FROM rs)
SELECT coalesce(route, 'none') AS route, coalesce(reason, 'kept') AS reason, CAST(sum(rows) AS BIGINT) AS n, min(target) AS least FROM ot GROUP BY 1, 2"""
)
def amendments_filed(spark, sf_dir):
    """Routes by which amendments are filed on articles of the code, and every reason why one isn't, counted."""
    lines = written(items(spark, sf_dir))
    read = written(paragraphs.numberings(articles(lines)))
    asked = written(filing.proposals(amendments(lines)).withColumnRenamed("amendment", "proposal"))
    checked = paragraphs.anchors(asked.where("article is not null and not additional").withColumnRenamed("proposal", "amendment"), read)
    plain = F.replace(F.col("dotted"), F.lit("L. "), F.lit("L"))
    is_article, elsewhere = F.col("l_returnflag") == "A", F.col("l_partkey") % 7 == 0
    outside = ((F.col("l_returnflag") == "R") & (F.col("l_linestatus") == "O")) | ((F.col("l_returnflag") == "N") & elsewhere)
    covered = lines.where(is_article | outside).select("text", F.lit("1").alias("article"), F.when(is_article, plain).alias("target")).distinct()
    found = paragraphs.paragraph_numbers(read)
    acts = lines.where(is_article | elsewhere).select("text", "line", F.when(is_article, plain).alias("target"), F.when(is_article, "internal").otherwise("external").alias("scope")).distinct()
    instructions = paragraphs.lines(articles(lines)).join(acts, ["text", "line"])
    divisions = read.select("text", "article", F.explode("paragraphs").alias("p")).where(F.col("p.opening").startswith("section")).select("text", "article", "p.start")
    marks = lines.groupBy("text").agg(F.max(F.col("l_partkey") % 11 == 0).alias("other_norm"), F.max(F.col("l_partkey") % 13 == 0).alias("hidden")).withColumn("article", F.lit("1"))
    unfit = checked.where("not confirmed")
    aliases = chain(renumberings(lines), "new", "old", covered.where("target is not null").select("target"))
    out = filing.filings(asked, covered, aliases, paragraphs.governed(found, instructions, divisions), unfit, marks)
    return out.groupBy(F.coalesce("route", F.lit("none")).alias("route"), F.coalesce("reason", F.lit("kept")).alias("reason")).agg(F.count("*").alias("n"), F.min("target").alias("least"))
