"""Validity, as-of resolution and lineages over orders, line items and events."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from spoor.operators.sections import overlap_summary
from spoor.operators.similarity import word_jaccard
from spoor.operators.temporal import asof_forward, asof_interval, in_force, last_before, lineage_rank, with_intervals
from spoor.registry import query
from spoor.sources.tables import table

DAY = "1997-06-30"


def _orders(spark, sf_dir):
    rows = table(spark, sf_dir, "orders")
    return rows.select("o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority", "o_totalprice", F.to_date("o_orderdate").alias("start"))


_INTERVALS = """v AS (SELECT o_orderkey, o_custkey, o_orderstatus, o_orderpriority, CAST(o_orderdate AS DATE) AS start,
  lead(CAST(o_orderdate AS DATE)) OVER (PARTITION BY o_custkey ORDER BY CAST(o_orderdate AS DATE), o_orderkey) AS "end" FROM orders)"""


@query(
    f"""WITH {_INTERVALS}, f AS (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY start DESC, o_orderkey) AS n FROM v
  WHERE o_orderstatus <> 'P' AND start <= DATE '{DAY}' AND ("end" IS NULL OR "end" > DATE '{DAY}'))
SELECT o_custkey, o_orderkey, CAST(start AS VARCHAR) AS start FROM f WHERE n = 1"""
)
def inforce_version(spark, sf_dir):
    versions = with_intervals(_orders(spark, sf_dir), "o_custkey", "start", ["o_orderkey"])
    found = in_force(versions, "o_custkey", "start", "end", F.lit(DAY).cast("date"), ["o_orderkey"], F.col("o_orderstatus") == "P")
    return found.select("o_custkey", "o_orderkey", F.col("start").cast("string").alias("start"))


@query(
    f"""WITH {_INTERVALS} SELECT o_custkey, CAST(min(start) AS VARCHAR) AS first, CAST(max(coalesce("end", DATE '9999-12-31')) AS VARCHAR) AS last, count(*) AS versions,
  count(*) FILTER (WHERE "end" = start) AS empty FROM v GROUP BY o_custkey"""
)
def validity_intervals(spark, sf_dir):
    versions = with_intervals(_orders(spark, sf_dir), "o_custkey", "start", ["o_orderkey"])
    open_end = F.coalesce("end", F.lit("9999-12-31").cast("date"))
    return versions.groupBy("o_custkey").agg(
        F.min("start").cast("string").alias("first"), F.max(open_end).cast("string").alias("last"), F.count("*").alias("versions"), F.count_if(F.col("end") == F.col("start")).alias("empty")
    )


@query(
    f"""WITH {_INTERVALS}, s AS (SELECT l_orderkey, l_linenumber, l_partkey, CAST(l_shipdate AS DATE) AS day, o_custkey, row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY l_partkey) AS n FROM lineitem JOIN orders ON l_orderkey = o_orderkey)
SELECT s.l_orderkey, s.l_linenumber, s.l_partkey, CAST(s.day AS VARCHAR) AS day, v.o_orderkey AS resolved FROM s JOIN v ON s.o_custkey = v.o_custkey AND v.start <= s.day AND (v."end" IS NULL OR v."end" > s.day)"""
)
def asof_resolve(spark, sf_dir):
    versions = with_intervals(_orders(spark, sf_dir), "o_custkey", "start", ["o_orderkey"]).select("o_custkey", F.col("o_orderkey").alias("resolved"), "start", "end")
    items = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", F.to_date("l_shipdate").alias("day"))
    facts = items.join(_orders(spark, sf_dir).select(F.col("o_orderkey").alias("l_orderkey"), "o_custkey"), "l_orderkey")
    found = asof_interval(facts, versions, "o_custkey", "day", "start", "end", ["resolved"])
    return found.select("l_orderkey", "l_linenumber", "l_partkey", F.col("day").cast("string").alias("day"), "resolved")


@query(
    f"""WITH {_INTERVALS}, l AS (SELECT o_custkey, "end", row_number() OVER (PARTITION BY o_custkey ORDER BY start, o_orderkey) AS rank FROM v),
d AS (SELECT c_custkey AS o_custkey, day FROM customer CROSS JOIN (VALUES (DATE '1990-01-01'), (DATE '1998-02-01'), (DATE '2099-01-01')) AS t(day))
SELECT o_custkey, CAST(day AS VARCHAR) AS day, coalesce(min(rank) FILTER (WHERE "end" IS NULL OR "end" > day), max(rank)) AS rank FROM d JOIN l USING (o_custkey) GROUP BY ALL"""
)
def forward_asof(spark, sf_dir):
    versions = with_intervals(_orders(spark, sf_dir), "o_custkey", "start", ["o_orderkey"])
    lineages = versions.withColumn("rank", F.row_number().over(Window.partitionBy("o_custkey").orderBy("start", "o_orderkey"))).select("o_custkey", "end", "rank")
    days = F.array(*[F.lit(d).cast("date") for d in ("1990-01-01", "1998-02-01", "2099-01-01")])
    facts = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("o_custkey"), F.explode(days).alias("day"))
    return asof_forward(facts, lineages, "o_custkey", "day", "end", "rank").select("o_custkey", F.col("day").cast("string").alias("day"), F.col("rank").cast("long").alias("rank"))


@query(
    """WITH w AS (SELECT o_custkey, o_orderkey, o_orderstatus, list_distinct(regexp_extract_all(lower(o_orderpriority), '[a-z0-9_]{4,}')) AS words,
  CAST(o_orderdate AS DATE) AS start FROM orders),
p AS (SELECT *, lag(o_orderstatus) OVER k AS prev_status, lag(words) OVER k AS prev_words FROM w WINDOW k AS (PARTITION BY o_custkey ORDER BY start, o_orderkey)),
f AS (SELECT *, CASE WHEN prev_status = 'F' AND (CASE WHEN len(words) + len(prev_words) = 0 THEN 1.0 ELSE len(list_intersect(words, prev_words)) / (len(words) + len(prev_words) - len(list_intersect(words, prev_words))) END) < 0.5 THEN 1 ELSE 0 END AS step FROM p)
SELECT o_custkey, o_orderkey, CAST(1 + sum(step) OVER (PARTITION BY o_custkey ORDER BY start, o_orderkey) AS BIGINT) AS lineage FROM f"""
)
def lineage_ranks(spark, sf_dir):
    is_new = (F.col("prev_status") == "F") & (word_jaccard(F.col("o_orderpriority"), F.col("prev_text")) < 0.5)
    ranked = lineage_rank(_orders(spark, sf_dir), "o_custkey", ["start", "o_orderkey"], is_new, {"prev_status": "o_orderstatus", "prev_text": "o_orderpriority"})
    return ranked.select("o_custkey", "o_orderkey", "lineage")


@query(
    """SELECT c.event_id, c.user_id, e.event_id AS error_id FROM (SELECT * FROM events WHERE event_type = 'click') c
ASOF LEFT JOIN (SELECT * FROM events WHERE event_type = 'error') e ON c.user_id = e.user_id AND c.ts > e.ts"""
)
def last_mention(spark, sf_dir):
    found = last_before(table(spark, sf_dir, "events").select("event_id", "user_id", "ts", "event_type"), "user_id", ["ts", "event_id"], "event_type", "error", "event_id", "error_id")
    return found.where("event_type = 'click'").select("event_id", "user_id", "error_id")


@query(
    """WITH s AS (SELECT event_id, user_id, ts AS a, coalesce(lead(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id), ts) AS b, event_type FROM events),
q AS (SELECT * FROM s WHERE event_type = 'purchase'), o AS (SELECT * FROM s WHERE event_type = 'signup')
SELECT o.event_id AS signup, count(*) AS purchases, min(q.event_id) AS least, max(q.event_id) AS greatest FROM q JOIN o ON q.a < o.b AND o.a < q.b GROUP BY 1"""
)
def interval_overlap(spark, sf_dir):
    """How many purchases' spans each signup's span overlaps, among all users, and the least and greatest of them."""
    events = table(spark, sf_dir, "events").select("event_id", "user_id", F.col("ts").alias("a"), "event_type")
    events = events.withColumn("b", F.coalesce(F.lead("a").over(Window.partitionBy("user_id").orderBy("a", "event_id")), F.col("a")))
    spans = lambda kind, name: events.where(F.col("event_type") == kind).select(F.col("event_id").alias(name), "a", "b")
    # Spans are hours long; a bucket of five minutes leaves few of them within one.
    found = overlap_summary(spans("signup", "signup"), spans("purchase", "purchase"), "a", "b", 300_000_000, "signup", "purchase")
    return found.withColumnRenamed("n", "purchases")
