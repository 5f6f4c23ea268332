"""Composite results: sheets, highlights, attempts, metrics and change reports."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from spoor.operators.aggregates import percentage, preferred_mode, wilson_lower
from spoor.operators.ranking import idf, rank_units
from spoor.operators.shingles import PROBE_STEP, WIDTH, block_windows, carried_share
from spoor.operators.temporal import in_force, with_intervals
from spoor.plans.reuse import _WINDOWS
from spoor.plans.texts import _sql_terms
from spoor.registry import query
from spoor.sources.tables import spread, table


def sheets(spark, sf_dir):
    """One nested row a customer, from one aggregate of each table: what is in force and what was before it, the ten latest orders
    with their flags, failed attempts by route, what is cited most and by whom, preferred value, span, and what is missing."""
    t = lambda n: table(spark, sf_dir, n)
    orders = t("orders").select("o_custkey", "o_orderkey", "o_orderstatus", "o_totalprice", "o_orderpriority", F.to_date("o_orderdate").alias("start"))
    by_start = Window.partitionBy("o_custkey").orderBy("start", "o_orderkey")
    versions = with_intervals(orders, "o_custkey", "start", ["o_orderkey"]).withColumn("before", F.lag("o_orderkey").over(by_start))
    now = in_force(versions, "o_custkey", "start", "end", F.lit("1998-06-30").cast("date"), ["o_orderkey"])
    now = now.select("o_custkey", F.struct("o_orderkey", "o_orderstatus", F.col("start").cast("string").alias("start"), "before").alias("in_force"))
    latest = versions.withColumn("n", F.row_number().over(Window.partitionBy("o_custkey").orderBy(F.col("start").desc(), "o_orderkey"))).where("n <= 10")
    history = latest.groupBy("o_custkey").agg(F.array_sort(F.collect_list(F.struct("n", "o_orderkey", (F.col("o_totalprice") > 400000).alias("large")))).alias("history"))
    counts = orders.groupBy("o_custkey").agg(
        F.struct(
            F.count("*").alias("orders"), F.count_if(F.col("o_orderstatus") == "P").alias("pending"), F.count_if(F.col("o_totalprice") > 400000).alias("large"),
            F.min("start").cast("string").alias("first"), F.max("start").cast("string").alias("last"), F.max("o_totalprice").alias("dearest"),
        ).alias("counts")
    )
    preferred = preferred_mode(orders, "o_custkey", "o_orderpriority", F.col("o_orderstatus") == "F").withColumnRenamed("o_orderpriority", "preferred")
    items = t("lineitem").join(orders.select(F.col("o_orderkey").alias("l_orderkey"), "o_custkey", "o_orderstatus"), "l_orderkey")
    attempts = items.groupBy("o_custkey").agg(
        F.struct(
            F.count_if(F.col("l_returnflag") == "R").alias("returned"), F.count_if(F.col("o_orderstatus") == "P").alias("unfinished"), F.count_if((F.col("l_returnflag") == "R") & (F.col("o_orderstatus") == "P")).alias("twice"),
            F.countDistinct("l_suppkey").alias("suppliers"), F.countDistinct("l_partkey").alias("parts"),
        ).alias("attempts")
    )
    cited = items.groupBy("o_custkey", "l_partkey").agg(F.countDistinct("l_orderkey").alias("citers"))
    cited = cited.withColumn("n", F.row_number().over(Window.partitionBy("o_custkey").orderBy(F.col("citers").desc(), "l_partkey"))).where("n <= 3")
    cited = cited.groupBy("o_custkey").agg(F.array_sort(F.collect_list(F.struct("n", "l_partkey", "citers"))).alias("cited"))
    customers = t("customer").join(F.broadcast(t("nation")), F.col("c_nationkey") == F.col("n_nationkey"), "left").select(F.col("c_custkey").alias("o_custkey"), "c_name", "n_name")
    out = customers
    for part in (now, history, counts, preferred, attempts, cited):
        out = out.join(part, "o_custkey", "left")
    missing = F.filter(F.array(*[F.when(F.col(c).isNull(), c) for c in ("in_force", "history", "attempts")]), lambda x: x.isNotNull())
    return out.withColumn("missing", missing)


@query(
    """WITH o AS (SELECT o_custkey, o_orderkey, o_orderstatus, o_totalprice, o_orderpriority, CAST(o_orderdate AS DATE) AS start FROM orders),
v AS (SELECT *, lead(start) OVER w AS "end", lag(o_orderkey) OVER w AS before FROM o WINDOW w AS (PARTITION BY o_custkey ORDER BY start, o_orderkey)),
n AS (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY start DESC, o_orderkey) AS k FROM v WHERE start <= DATE '1998-06-30' AND ("end" IS NULL OR "end" > DATE '1998-06-30')),
h AS (SELECT o_custkey, string_agg(CAST(o_orderkey AS VARCHAR) || CASE WHEN o_totalprice > 400000 THEN '!' ELSE '' END, ' ' ORDER BY k) AS history FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY start DESC, o_orderkey) AS k FROM o) AS x WHERE k <= 10 GROUP BY 1),
c AS (SELECT o_custkey, count(*) AS orders, count(*) FILTER (WHERE o_orderstatus = 'P') AS pending, count(*) FILTER (WHERE o_totalprice > 400000) AS large, CAST(min(start) AS VARCHAR) AS first, CAST(max(start) AS VARCHAR) AS last, max(o_totalprice) AS dearest FROM o GROUP BY 1),
m AS (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY p > 0 DESC, CASE WHEN p > 0 THEN p ELSE q END DESC, v) AS k FROM (SELECT o_custkey, o_orderpriority AS v, count(*) AS q, count(*) FILTER (WHERE o_orderstatus = 'F') AS p FROM o GROUP BY ALL) AS x),
i AS (SELECT o_custkey, o_orderstatus, l.* FROM lineitem l JOIN o ON l_orderkey = o_orderkey),
a AS (SELECT o_custkey, count(*) FILTER (WHERE l_returnflag = 'R') AS returned, count(*) FILTER (WHERE o_orderstatus = 'P') AS unfinished, count(*) FILTER (WHERE l_returnflag = 'R' AND o_orderstatus = 'P') AS twice, count(DISTINCT l_suppkey) AS suppliers, count(DISTINCT l_partkey) AS parts FROM i GROUP BY 1),
t AS (SELECT o_custkey, string_agg(CAST(l_partkey AS VARCHAR) || ':' || CAST(citers AS VARCHAR), ' ' ORDER BY k) AS cited FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY citers DESC, l_partkey) AS k FROM (SELECT o_custkey, l_partkey, count(DISTINCT l_orderkey) AS citers FROM i GROUP BY ALL) AS x) AS y WHERE k <= 3 GROUP BY 1)
SELECT c_custkey AS o_custkey, c_name, n_name, n.o_orderkey AS in_force, n.o_orderstatus AS state, CAST(n.start AS VARCHAR) AS since, n.before, history, orders, pending, large, first, last, dearest, m.v AS preferred, returned, unfinished, twice, suppliers, parts, cited,
  concat_ws(' ', CASE WHEN n.o_orderkey IS NULL THEN 'in_force' END, CASE WHEN history IS NULL THEN 'history' END, CASE WHEN parts IS NULL THEN 'attempts' END) AS missing
FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey LEFT JOIN (SELECT * FROM n WHERE k = 1) n ON n.o_custkey = c_custkey LEFT JOIN h ON h.o_custkey = c_custkey LEFT JOIN c ON c.o_custkey = c_custkey
LEFT JOIN (SELECT * FROM m WHERE k = 1) m ON m.o_custkey = c_custkey LEFT JOIN a ON a.o_custkey = c_custkey LEFT JOIN t ON t.o_custkey = c_custkey"""
)
def sheet_struct(spark, sf_dir):
    """The sheets of all customers, their nested parts laid out in columns."""
    listed = lambda c, f: F.when(F.col(c).isNotNull(), F.array_join(F.transform(c, f), " ")).alias(c)
    return sheets(spark, sf_dir).select(
        "o_custkey", "c_name", "n_name", F.col("in_force.o_orderkey").alias("in_force"), F.col("in_force.o_orderstatus").alias("state"), F.col("in_force.start").alias("since"), F.col("in_force.before").alias("before"),
        listed("history", lambda x: F.concat(x["o_orderkey"].cast("string"), F.when(x["large"], "!").otherwise(""))), "counts.*", "preferred", "attempts.*",
        listed("cited", lambda x: F.concat_ws(":", x["l_partkey"].cast("string"), x["citers"].cast("string"))), F.array_join("missing", " ").alias("missing"),
    )


@query(
    """WITH l AS (SELECT DISTINCT source, doc_id, line FROM (SELECT source, doc_id, unnest(string_split(text, chr(10))) AS line FROM documents) AS x WHERE length(line) >= 15),
f AS (SELECT *, min(doc_id) OVER (PARTITION BY source, line) AS first FROM l)
SELECT doc_id, first, dense_rank() OVER (PARTITION BY doc_id ORDER BY first) AS colour, count(*) AS lines FROM f GROUP BY doc_id, first"""
)
def highlight(spark, sf_dir):
    """Which document of its source introduced each line, with a colour by the order of the introducing ones."""
    lines = table(spark, sf_dir, "documents").select("source", "doc_id", F.explode(F.split("text", "\n")).alias("line")).where(F.length("line") >= 15)
    keyed = lines.select("source", "doc_id", F.sha2("line", 256).alias("key")).distinct()
    first = keyed.groupBy("source", "key").agg(F.min("doc_id").alias("first"))
    per = keyed.join(first, ["source", "key"]).groupBy("doc_id", "first").agg(F.count("*").alias("lines"))
    return per.select("doc_id", "first", F.dense_rank().over(Window.partitionBy("doc_id").orderBy("first")).cast("long").alias("colour"), "lines")


@query(
    """WITH m AS (SELECT 'orders' AS family, o_orderstatus AS measure, count(*) AS value, (SELECT count(*) FROM orders) AS total FROM orders GROUP BY 2
UNION ALL SELECT 'returns', l_returnflag, count(*), (SELECT count(*) FROM lineitem) FROM lineitem GROUP BY 2
UNION ALL SELECT 'labels', 'good', count(*) FILTER (WHERE quality = 1), count(*) FROM labels
UNION ALL SELECT 'languages', lang, count(*), (SELECT count(*) FROM documents) FROM documents GROUP BY 2)
SELECT family, measure, value, total, round(100.0 * value / total, 1) AS percent FROM m"""
)
def hygiene_metrics(spark, sf_dir):
    t = lambda n: table(spark, sf_dir, n)

    def shares(family, rows, column):
        counts = rows.groupBy(F.col(column).alias("measure")).agg(F.count("*").alias("value"))
        return counts.select(F.lit(family).alias("family"), "measure", "value", F.sum("value").over(Window.partitionBy(F.lit(1))).alias("total"))

    good = t("labels").agg(F.count_if(F.col("quality") == 1).alias("value"), F.count("*").alias("total")).select(F.lit("labels").alias("family"), F.lit("good").alias("measure"), "value", "total")
    every = shares("orders", t("orders"), "o_orderstatus").unionByName(shares("returns", t("lineitem"), "l_returnflag")).unionByName(good).unionByName(shares("languages", t("documents"), "lang"))
    return every.withColumn("percent", percentage(F.col("value"), F.col("total")).cast("double"))


@query(
    """WITH f AS (SELECT DISTINCT o_custkey FROM orders WHERE o_orderstatus = 'F'), g AS (SELECT DISTINCT o_custkey FROM orders WHERE o_totalprice > 450000)
SELECT c_mktsegment, count(*) AS customers, count(*) FILTER (WHERE c_custkey IN (SELECT o_custkey FROM f)) AS finished, count(*) FILTER (WHERE c_custkey IN (SELECT o_custkey FROM g)) AS large,
  count(*) FILTER (WHERE c_custkey IN (SELECT o_custkey FROM f) AND c_custkey IN (SELECT o_custkey FROM g)) AS both FROM customer GROUP BY 1"""
)
def grain_table(spark, sf_dir):
    per = table(spark, sf_dir, "orders").groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.bool_or(F.col("o_orderstatus") == "F").alias("f"), F.bool_or(F.col("o_totalprice") > 450000).alias("g"))
    rows = table(spark, sf_dir, "customer").join(per, "c_custkey", "left")
    return rows.groupBy("c_mktsegment").agg(F.count("*").alias("customers"), F.count_if("f").alias("finished"), F.count_if("g").alias("large"), F.count_if(F.col("f") & F.col("g")).alias("both"))


@query(
    f"""WITH {_WINDOWS}, h AS (SELECT item_id, doc_id, count(DISTINCT iw.w) AS common FROM iw JOIN dw USING (w) GROUP BY ALL),
b AS (SELECT item_id, doc_id AS truth FROM (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY common DESC, doc_id) AS n FROM h) AS x WHERE n = 1),
t AS (SELECT doc_id, unnest({_sql_terms("text")}) AS term FROM documents), c AS (SELECT term, ln((SELECT count(*) FROM documents) / count(*)) AS weight FROM t GROUP BY term),
q AS (SELECT item_id, unnest({_sql_terms("text")}) AS term FROM benchmark),
s AS (SELECT item_id, doc_id, round(CAST(sum(CAST(weight AS DECIMAL(20, 10))) AS DOUBLE), 6) AS score FROM q JOIN c USING (term) JOIN t USING (term) GROUP BY ALL HAVING count(*) >= 2),
r AS (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank FROM s),
k AS (SELECT b.item_id, min(rank) AS rank FROM b LEFT JOIN r ON r.item_id = b.item_id AND doc_id = truth AND rank <= 3 GROUP BY 1),
o AS (SELECT count(*) AS items, count(rank) AS found, count(*) FILTER (WHERE rank = 1) AS first FROM k)
SELECT *, CASE WHEN items = 0 THEN 0 ELSE round((found / items + 1.96 * 1.96 / (2 * items) - 1.96 * sqrt((found / items) * (1 - found / items) / items + 1.96 * 1.96 / (4 * items * items))) / (1 + 1.96 * 1.96 / items), 4) END AS lower FROM o"""
)
def ranking_recall(spark, sf_dir):
    """How often an item's true source is among the three documents that rank highest by rarity, with Wilson's lower bound."""
    items, docs = table(spark, sf_dir, "benchmark"), spread(table(spark, sf_dir, "documents"))
    truth = carried_share(block_windows(items, "item_id", "text", WIDTH, PROBE_STEP), block_windows(docs, "doc_id", "text", hashed=True), "item_id", "doc_id").select("item_id", F.col("doc_id").alias("truth"))
    ranked = rank_units(items, docs, idf(docs, "doc_id", "text"), "item_id", "doc_id", "text", k=3)
    hit = truth.join(ranked, "item_id", "left").groupBy("item_id").agg(F.bool_or(F.col("doc_id") == F.col("truth")).alias("hit"), F.min(F.when(F.col("doc_id") == F.col("truth"), F.col("rank"))).alias("rank"))
    out = hit.agg(F.count("*").alias("items"), F.count_if("hit").alias("found"), F.count_if(F.col("rank") == 1).alias("first"))
    return out.withColumn("lower", F.round(wilson_lower(F.col("found"), F.col("items")), 4))


@query(
    """WITH a AS (SELECT doc_id, source AS v FROM documents WHERE n_chars >= 500), b AS (SELECT doc_id, CASE WHEN n_chars >= 5000 THEN 'moved' ELSE source END AS v FROM documents WHERE lang <> 'es'),
d AS (SELECT CASE WHEN a.doc_id IS NULL THEN 'entered' WHEN b.doc_id IS NULL THEN 'left' WHEN a.v <> b.v THEN 'flipped' END AS change FROM a FULL JOIN b USING (doc_id)) SELECT change, count(*) AS n FROM d WHERE change IS NOT NULL GROUP BY 1"""
)
def change_report(spark, sf_dir):
    from spoor.operators.changes import snapshot_diff

    docs = table(spark, sf_dir, "documents").select("doc_id", "n_chars", "lang", F.col("source").alias("v"))
    new = docs.where("lang <> 'es'").withColumn("v", F.when(F.col("n_chars") >= 5000, "moved").otherwise(F.col("v")))
    return snapshot_diff(docs.where("n_chars >= 500"), new, "doc_id", "v").groupBy("change").agg(F.count("*").alias("n"))


@query(
    """SELECT doc_id, length(text) AS n_chars, sha256(CASE WHEN length(text) > 400 THEN left(text, 400) || '…' WHEN length(text) = 0 THEN '(no text)' ELSE text END) AS sha FROM documents"""
)
def excerpts(spark, sf_dir):
    from spoor.functions.text import excerpt

    return table(spark, sf_dir, "documents").select("doc_id", F.length("text").cast("long").alias("n_chars"), F.sha2(excerpt(F.col("text")), 256).alias("sha"))


@query(
    """SELECT n_name, 'Order ' || CAST(o_orderkey AS VARCHAR) || ' of ' || c_name AS sentence FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey WHERE o_totalprice > 499000 AND o_orderstatus <> 'P'"""
)
def sourced_notes(spark, sf_dir):
    """Sentences by template; those without a source are left out."""
    rows = table(spark, sf_dir, "orders").where("o_totalprice > 499000").join(table(spark, sf_dir, "customer"), F.col("o_custkey") == F.col("c_custkey")).join(table(spark, sf_dir, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
    source = F.when(F.col("o_orderstatus") != "P", F.col("c_name"))
    return rows.where(source.isNotNull()).select("n_name", F.format_string("Order %d of %s", "o_orderkey", "c_name").alias("sentence"))
