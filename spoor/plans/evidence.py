"""Choices among candidates and their confrontation with what is known."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from spoor.functions.text import normalised_strict
from spoor.operators import scan
from spoor.operators.aggregates import confusion, first_per_group
from spoor.operators.classify import code_part
from spoor.operators.sections import overlaps
from spoor.operators.temporal import covers, with_intervals
from spoor.plans.graph import _DOWN, _EDGES, _down
from spoor.plans.prose import bills
from spoor.plans.temporal import _INTERVALS, DAY
from spoor.registry import query
from spoor.sources.tables import table


@query("SELECT l_orderkey AS id, count(*) AS formulas FROM lineitem GROUP BY 1")
def formula_index(spark, sf_dir):
    """Bills by the modifying formulas that they hold."""
    return scan.events(bills(spark, sf_dir)).where("kind = 'action'").groupBy("id").agg(F.count("*").alias("formulas"))


@query(
    """SELECT o_custkey, o_orderkey, tier FROM (SELECT o_custkey, o_orderkey, CASE o_orderstatus WHEN 'F' THEN 1 WHEN 'O' THEN 2 ELSE 3 END AS tier,
  row_number() OVER (PARTITION BY o_custkey ORDER BY CASE o_orderstatus WHEN 'F' THEN 1 WHEN 'O' THEN 2 ELSE 3 END, o_totalprice, o_orderkey) AS n FROM orders) AS x WHERE n = 1"""
)
def tiered_choice(spark, sf_dir):
    """The strongest tier first, then the smallest candidate."""
    tier = F.when(F.col("o_orderstatus") == "F", 1).when(F.col("o_orderstatus") == "O", 2).otherwise(3)
    return first_per_group(table(spark, sf_dir, "orders").withColumn("tier", tier), ["o_custkey"], ["tier", "o_totalprice", "o_orderkey"], ["o_orderkey", "tier"])


@query(
    f"""WITH {_INTERVALS}, w AS (SELECT *, lag(o_orderkey) OVER (PARTITION BY o_custkey ORDER BY start, o_orderkey) AS before FROM v),
a AS (SELECT o_custkey, arg_min(o_orderkey, (start, o_orderkey)) AS produced, arg_min(coalesce(before, -1), (start, o_orderkey)) AS preceding FROM w WHERE o_orderstatus = 'P' GROUP BY 1),
b AS (SELECT o_custkey, min(o_orderkey) AS now FROM v WHERE start <= DATE '{DAY}' AND ("end" IS NULL OR "end" > DATE '{DAY}') GROUP BY 1), c AS (SELECT o_custkey, arg_max(o_orderkey, (start, o_orderkey)) AS last FROM v GROUP BY 1)
SELECT c.o_custkey, coalesce(produced, now, last) AS shown, CASE WHEN produced IS NOT NULL THEN nullif(preceding, -1) END AS before FROM c LEFT JOIN a USING (o_custkey) LEFT JOIN b USING (o_custkey)"""
)
def states_shown(spark, sf_dir):
    """The version that a dossier produced and the one before it; else what was in force on a day; else the last."""
    orders = table(spark, sf_dir, "orders").select("o_custkey", "o_orderkey", "o_orderstatus", F.to_date("o_orderdate").alias("start"))
    w = Window.partitionBy("o_custkey").orderBy("start", "o_orderkey")
    rows = with_intervals(orders, "o_custkey", "start", ["o_orderkey"]).withColumn("before", F.lag("o_orderkey").over(w))
    order = F.struct("start", "o_orderkey")
    made = F.col("o_orderstatus") == "P"
    per = rows.groupBy("o_custkey").agg(
        F.min_by(F.struct("o_orderkey", "before"), F.when(made, order)).alias("produced"),
        F.min(F.when(covers(F.col("start"), F.col("end"), F.lit(DAY).cast("date")), F.col("o_orderkey"))).alias("now"),
        F.max_by("o_orderkey", order).alias("last"),
    )
    return per.select("o_custkey", F.coalesce("produced.o_orderkey", "now", "last").alias("shown"), F.col("produced.before").alias("before"))


@query(f"WITH {_EDGES}, {_DOWN} SELECT src, min(dst) AS origin, count(*) AS hops FROM d GROUP BY src")
def origin_one_hop(spark, sf_dir):
    return _down(spark, sf_dir).groupBy("src").agg(F.min("dst").alias("origin"), F.count("*").alias("hops"))


@query(
    """WITH t AS (SELECT event_id, user_id, ts - INTERVAL 30 MINUTE AS a, ts + INTERVAL 30 MINUTE AS b FROM events WHERE event_type = 'purchase'),
p AS (SELECT event_id, user_id, ts - INTERVAL 60 MINUTE AS a, ts + INTERVAL 60 MINUTE AS b FROM events WHERE event_type = 'view'),
f AS (SELECT t.event_id, max(p.event_id IS NOT NULL) AS found, any_value(t.user_id % 2) AS side FROM t LEFT JOIN p ON t.user_id = p.user_id AND t.a < p.b AND p.a < t.b GROUP BY 1)
SELECT side, CAST(found AS INTEGER) AS found, count(*) AS n FROM f GROUP BY ALL"""
)
def span_confrontation(spark, sf_dir):
    """Known spans against those that a rule proposes, overlapping ones found, in a cross table."""
    events = table(spark, sf_dir, "events").select("event_id", "user_id", "event_type", F.unix_micros(F.col("ts").cast("timestamp")).alias("at"))
    minute = 60_000_000
    hour = 60 * minute
    span = lambda kind, m, tag: events.where(F.col("event_type") == kind).select(F.col("event_id").alias(f"{tag}_id"), "user_id", (F.col("at") - m * minute).alias(f"{tag}_a"), (F.col("at") + m * minute).alias(f"{tag}_b"))
    truth, rule = span("purchase", 30, "t"), span("view", 60, "p")
    # Both are cut into hours, so that a user with many spans is compared within an hour only.
    cut = lambda df, tag: df.withColumn("hour", F.explode(F.sequence(F.floor(F.col(f"{tag}_a") / hour), F.floor(F.col(f"{tag}_b") / hour))))
    hits = cut(truth, "t").join(cut(rule, "p"), ["user_id", "hour"]).where(overlaps(F.col("t_a"), F.col("t_b"), F.col("p_a"), F.col("p_b"))).select("t_id").distinct()
    judged = truth.join(hits.withColumn("hit", F.lit(1)), "t_id", "left").select((F.col("user_id") % 2).alias("side"), F.coalesce("hit", F.lit(0)).alias("found"))
    return confusion(judged, "side", "found")


@query(
    """SELECT doc_id, sha256(trim(regexp_replace(translate(lower(translate(text, '‐‑‒–—−' || chr(173), '------')), '’‘ʼ«»“”"', chr(39) || chr(39) || chr(39)), '[\\s\\x{00A0}]+', ' ', 'g'))) AS sha FROM documents"""
)
def normalised_texts(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", F.sha2(normalised_strict(F.col("text"), compose=False), 256).alias("sha"))


@query("""SELECT part, count(*) AS n FROM (SELECT CASE WHEN upper(left(trim(p_type), 1)) IN ('L', 'R', 'D') THEN upper(left(trim(p_type), 1)) END AS part FROM part) AS x GROUP BY 1""")
def code_parts(spark, sf_dir):
    """Parts by the first letter of their type, as articles by the part of their code."""
    return table(spark, sf_dir, "part").groupBy(code_part(F.col("p_type")).alias("part")).agg(F.count("*").alias("n"))


@query("""SELECT conv_id, turn, CAST(length(text) AS BIGINT) AS n, page FROM (SELECT *, count(*) OVER () AS page, row_number() OVER (ORDER BY role, length(text), conv_id, turn) AS k FROM conversations WHERE role <> 'system') AS x WHERE k <= 15""")
def enum_ordered(spark, sf_dir):
    """Rows by the rank of an enumeration, then the shortest first."""
    rank = F.when(F.col("role") == "assistant", 0).otherwise(1)
    rows = table(spark, sf_dir, "conversations").where("role <> 'system'")
    return rows.orderBy(rank, F.length("text"), "conv_id", "turn").limit(15).select("conv_id", "turn", F.length("text").cast("long").alias("n")).withColumn("page", F.lit(rows.count()))
