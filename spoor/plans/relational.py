"""Joins, aggregates, windows, top lists and set operations over the star schema."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from spoor.operators.aggregates import concat_distinct, confusion, first_per_group, percentage, preferred_mode, row_counts, state_intersection, strongest_route, wilson_lower
from spoor.operators.changes import compact_changes, fold_copies, latest_verdict, replay, snapshot_diff
from spoor.operators.classify import by_pattern, outcome, reason_ladder, rejections, unread_labels, verdict
from spoor.operators.sampling import sha_sample
from spoor.registry import query
from spoor.sources.tables import table


@query("SELECT c_custkey, c_name FROM customer WHERE EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_orderpriority = '1-URGENT')")
def semi_join(spark, sf_dir):
    urgent = table(spark, sf_dir, "orders").where("o_orderpriority = '1-URGENT'").select(F.col("o_custkey").alias("c_custkey"))
    return table(spark, sf_dir, "customer").join(urgent, "c_custkey", "left_semi").select("c_custkey", "c_name")


@query("SELECT c_custkey, c_name FROM customer WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_orderpriority = '1-URGENT')")
def anti_join(spark, sf_dir):
    urgent = table(spark, sf_dir, "orders").where("o_orderpriority = '1-URGENT'").select(F.col("o_custkey").alias("c_custkey"))
    return table(spark, sf_dir, "customer").join(urgent, "c_custkey", "left_anti").select("c_custkey", "c_name")


@query("SELECT c_custkey, CAST(max(CASE WHEN o_totalprice > 450000 THEN 1 ELSE 0 END) AS BIGINT) AS large, count(o_orderkey) AS orders FROM customer LEFT JOIN orders ON o_custkey = c_custkey GROUP BY c_custkey")
def exists_flag(spark, sf_dir):
    per = table(spark, sf_dir, "orders").groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.bool_or(F.col("o_totalprice") > 450000).alias("large"), F.count("*").alias("orders"))
    found = table(spark, sf_dir, "customer").select("c_custkey").join(per, "c_custkey", "left")
    return found.select("c_custkey", F.coalesce("large", F.lit(False)).cast("long").alias("large"), F.coalesce("orders", F.lit(0)).alias("orders"))


@query("SELECT o_custkey, o_orderkey, CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS day FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS n FROM orders) AS x WHERE n = 1")
def first_order(spark, sf_dir):
    return first_per_group(table(spark, sf_dir, "orders"), ["o_custkey"], ["o_orderdate", "o_orderkey"], ["o_orderkey", "o_orderdate"]).select("o_custkey", "o_orderkey", F.to_date("o_orderdate").cast("string").alias("day"))


@query("""SELECT r_name, count(*) AS orders, round(sum(o_totalprice), 2) AS total, count(DISTINCT c_custkey) AS customers FROM orders LEFT JOIN customer ON o_custkey = c_custkey
LEFT JOIN nation ON c_nationkey = n_nationkey LEFT JOIN region ON n_regionkey = r_regionkey GROUP BY r_name""")
def left_enrich(spark, sf_dir):
    t = lambda n: table(spark, sf_dir, n)
    wide = t("orders").join(t("customer"), F.col("o_custkey") == F.col("c_custkey"), "left").join(t("nation"), F.col("c_nationkey") == F.col("n_nationkey"), "left").join(t("region"), F.col("n_regionkey") == F.col("r_regionkey"), "left")
    return wide.groupBy("r_name").agg(F.count("*").alias("orders"), F.round(F.sum("o_totalprice"), 2).alias("total"), F.countDistinct("c_custkey").alias("customers"))


@query("""WITH u AS (SELECT page_id, regexp_extract(url, '/(\\d+)', 1) AS number, regexp_extract(url, '^[a-z]+://(?:www\\.|m\\.|blog\\.)?([^/?#]+)', 1) AS host FROM pages),
k AS (SELECT host || ':' || number AS canonical, page_id FROM u WHERE number <> '')
SELECT d.doc_id, min(k.page_id) AS page_id, count(*) AS copies FROM documents d JOIN k ON split_part(k.canonical, ':', 2) = CAST(d.doc_id AS VARCHAR) GROUP BY d.doc_id""")
def id_correspondence(spark, sf_dir):
    """Document numbers parsed from urls in several forms, joined to documents; the least page wins."""
    number = F.regexp_extract("url", r"/(\d+)", 1)
    pages = table(spark, sf_dir, "pages").select("page_id", number.try_cast("long").alias("doc_id")).where("doc_id is not null")
    per = pages.groupBy("doc_id").agg(F.min("page_id").alias("page_id"), F.count("*").alias("copies"))
    return table(spark, sf_dir, "documents").select("doc_id").join(per, "doc_id")


_LADDER = [("urgent", "^[12]"), ("normal", "^3"), ("low", "^5")]


@query("SELECT CASE WHEN regexp_matches(o_orderpriority, '^[12]') THEN 'urgent' WHEN regexp_matches(o_orderpriority, '^3') THEN 'normal' WHEN regexp_matches(o_orderpriority, '^5') THEN 'low' ELSE 'unknown' END AS family, o_orderstatus, count(*) AS n FROM orders GROUP BY ALL")
def outcome_family(spark, sf_dir):
    return table(spark, sf_dir, "orders").groupBy(by_pattern(F.col("o_orderpriority"), _LADDER).alias("family"), "o_orderstatus").agg(F.count("*").alias("n"))


#: Published outcomes and procedural states as the two chambers write them, with family and ground; the last of each is not a label of any family.
_PUBLISHED = (
    ("Adopté", "adopted", None), ("Adopté - vote unique", "adopted", None), ("Rejeté", "rejected", None), ("Rejeté - vote unique", "rejected", None), ("Retiré", "withdrawn", None),
    ("Retiré avant séance", "withdrawn", None), ("Cet amendement est retiré avant séance", "withdrawn", None), ("Non soutenu", "not_moved", None), ("Tombé", "lapsed", None), ("Irrecevable", "inadmissible", None),
    ("Irrecevable art. 40 C", "inadmissible", "article 40"), ("Irrecevable art. 45, al. 1 C (cavalier)", "inadmissible", "article 45"), ("Irrecevable art. 41 C", "inadmissible", "article 41"),
    ("Irrecevable art. 44 bis, al. 5 et 6 RS (entonnoir)", "inadmissible", "article 44 bis"), ("Irrecevable LOLFSS", "inadmissible", "LOLFSS"), ("Irrecevable LOLF", "inadmissible", "LOLF"),
    ("Recevable art. 40 C / LOLF", "undecided", None), (" ", "unknown", None), (None, "unknown", None), ("Discuté", "unknown", None),
)
_STATES = (("A discuter", "undecided", None), ("À discuter", "undecided", None), ("Irrecevable 40", "inadmissible", "article 40"), ("Irrecevable 45", "inadmissible", "article 45"), (None, "unknown", None), ("En traitement", "unknown", None))


def _labelled(spark, sf_dir):
    at = lambda labels, key: F.element_at(F.array(*[F.lit(x[0]).cast("string") for x in labels]), (F.pmod(key, F.lit(len(labels))) + 1).cast("int"))
    return table(spark, sf_dir, "orders").select("o_orderkey", at(_PUBLISHED, "o_orderkey").alias("published"), at(_STATES, "o_custkey").alias("state"))


def _values(labels):
    text = lambda x: "NULL" if x is None else "'" + x + "'"
    return "(VALUES " + ", ".join(f"({k}, {', '.join(map(text, x))})" for k, x in enumerate(labels)) + ")"


_LABELS = f"""p AS (SELECT * FROM {_values(_PUBLISHED)} AS y(k, label, family, ground)), s AS (SELECT * FROM {_values(_STATES)} AS y(k, label, family, ground)),
r AS (SELECT p.label AS published, s.label AS state, p.family <> 'unknown' AS first, p.family AS pf, p.ground AS pg, s.family AS sf, s.ground AS sg FROM orders JOIN p ON p.k = o_orderkey % {len(_PUBLISHED)} JOIN s ON s.k = o_custkey % {len(_STATES)})"""


@query(f"WITH {_LABELS} SELECT CASE WHEN first THEN pf ELSE sf END AS family, CASE WHEN first THEN pg ELSE sg END AS ground, CASE WHEN first THEN 'outcome' WHEN sf <> 'unknown' THEN 'state' END AS source, count(*) AS n FROM r GROUP BY ALL")
def outcome_labels(spark, sf_dir):
    """Outcomes of proposals by family, ground and the column that told."""
    found = _labelled(spark, sf_dir).select(outcome(F.col("published"), F.col("state")).alias("x"))
    return found.groupBy("x.family", "x.ground", "x.source").agg(F.count("*").alias("n"))


@query(f"WITH {_LABELS} SELECT coalesce(nullif(trim(published), ''), state) AS label, count(*) AS n FROM r WHERE NOT first AND sf = 'unknown' AND coalesce(nullif(trim(published), ''), state) IS NOT NULL GROUP BY 1")
def outcome_contract(spark, sf_dir):
    """Labels that no family reads: only the two that were put in as such."""
    return unread_labels(_labelled(spark, sf_dir), "published", "state")


@query("""WITH f AS (SELECT c_mktsegment, c_custkey, max(o_orderstatus = 'F') AS a, max(o_totalprice > 495000) AS b, count(o_orderkey) > 12 AS c FROM customer LEFT JOIN orders ON o_custkey = c_custkey GROUP BY ALL)
SELECT c_mktsegment, CASE WHEN b THEN 'large' WHEN c THEN 'frequent' WHEN a THEN 'finished' ELSE 'silent' END AS verdict, count(*) AS n FROM f GROUP BY ALL""")
def verdict_flags(spark, sf_dir):
    per = table(spark, sf_dir, "orders").groupBy(F.col("o_custkey").alias("c_custkey")).agg(
        F.bool_or(F.col("o_orderstatus") == "F").alias("a"), F.bool_or(F.col("o_totalprice") > 495000).alias("b"), (F.count("*") > 12).alias("c")
    )
    flags = [(name, F.coalesce(c, F.lit(False))) for name, c in (("large", "b"), ("frequent", "c"), ("finished", "a"))]
    return table(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment").join(per, "c_custkey", "left").groupBy("c_mktsegment", verdict(flags, "silent").alias("verdict")).agg(F.count("*").alias("n"))


@query("""SELECT c_mktsegment, count(*) AS n, count(*) FILTER (WHERE c_acctbal < 0) AS negative, round(100.0 * count(*) FILTER (WHERE c_acctbal < 0) / count(*), 1) AS percent FROM customer GROUP BY c_mktsegment""")
def hygiene_by_part(spark, sf_dir):
    negative = F.count_if(F.col("c_acctbal") < 0)
    return table(spark, sf_dir, "customer").groupBy("c_mktsegment").agg(F.count("*").alias("n"), negative.alias("negative"), percentage(negative, F.count("*")).cast("double").alias("percent"))


@query("""WITH s AS (SELECT DISTINCT l_suppkey % 50 AS grp, l_suppkey AS state, l_partkey FROM lineitem), k AS (SELECT grp, count(DISTINCT state) AS states FROM s GROUP BY grp),
h AS (SELECT grp, l_partkey, count(*) AS held FROM s GROUP BY ALL) SELECT grp, l_partkey FROM h JOIN k USING (grp) WHERE states >= 2 AND held = states""")
def state_intersections(spark, sf_dir):
    rows = table(spark, sf_dir, "lineitem").select(F.pmod("l_suppkey", F.lit(50)).alias("grp"), F.col("l_suppkey").alias("state"), "l_partkey")
    return state_intersection(rows, "grp", "state", "l_partkey")


@query("""WITH c AS (SELECT o_custkey, o_orderpriority AS v, count(*) AS n, count(*) FILTER (WHERE o_orderstatus = 'F') AS p FROM orders GROUP BY ALL),
r AS (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY p > 0 DESC, CASE WHEN p > 0 THEN p ELSE n END DESC, v) AS k FROM c) SELECT o_custkey, v AS o_orderpriority FROM r WHERE k = 1""")
def preferred_values(spark, sf_dir):
    return preferred_mode(table(spark, sf_dir, "orders"), "o_custkey", "o_orderpriority", F.col("o_orderstatus") == "F")


@query("""SELECT l_returnflag, CAST(median(d) AS DOUBLE) AS middle, min(d) AS shortest, max(d) AS longest FROM (SELECT l_returnflag, date_diff('day', CAST(o_orderdate AS DATE), CAST(l_shipdate AS DATE)) AS d FROM lineitem JOIN orders ON l_orderkey = o_orderkey) AS x GROUP BY 1""")
def median_duration(spark, sf_dir):
    rows = table(spark, sf_dir, "lineitem").join(table(spark, sf_dir, "orders"), F.col("l_orderkey") == F.col("o_orderkey")).select("l_returnflag", F.datediff(F.to_date("l_shipdate"), F.to_date("o_orderdate")).cast("long").alias("d"))
    return rows.groupBy("l_returnflag").agg(F.median("d").alias("middle"), F.min("d").alias("shortest"), F.max("d").alias("longest"))


@query("SELECT l_suppkey, string_agg(DISTINCT l_returnflag || l_linestatus, ', ' ORDER BY l_returnflag || l_linestatus) AS kinds FROM lineitem GROUP BY l_suppkey")
def group_concat_distinct(spark, sf_dir):
    return table(spark, sf_dir, "lineitem").withColumn("kind", F.concat("l_returnflag", "l_linestatus")).groupBy("l_suppkey").agg(concat_distinct("kind").alias("kinds"))


@query("SELECT l_partkey, count(DISTINCT l_orderkey) AS citers FROM lineitem GROUP BY l_partkey ORDER BY citers DESC, l_partkey LIMIT 25")
def top_cited(spark, sf_dir):
    return table(spark, sf_dir, "lineitem").groupBy("l_partkey").agg(F.countDistinct("l_orderkey").alias("citers")).orderBy(F.desc("citers"), "l_partkey").limit(25)


@query("""WITH a AS (SELECT l_partkey, l_orderkey FROM lineitem WHERE l_returnflag = 'R' UNION SELECT l_partkey, l_orderkey FROM lineitem JOIN orders ON l_orderkey = o_orderkey WHERE o_orderstatus = 'P')
SELECT l_partkey, count(*) AS failed FROM a GROUP BY 1 ORDER BY failed DESC, l_partkey LIMIT 25""")
def top_failed(spark, sf_dir):
    items = table(spark, sf_dir, "lineitem").select("l_partkey", "l_orderkey", "l_returnflag")
    pending = table(spark, sf_dir, "orders").where("o_orderstatus = 'P'").select(F.col("o_orderkey").alias("l_orderkey"))
    both = items.where("l_returnflag = 'R'").select("l_partkey", "l_orderkey").union(items.join(pending, "l_orderkey", "left_semi").select("l_partkey", "l_orderkey")).distinct()
    return both.groupBy("l_partkey").agg(F.count("*").alias("failed")).orderBy(F.desc("failed"), "l_partkey").limit(25)


@query("""SELECT o_custkey, l_orderkey, route FROM (SELECT o_custkey, o_orderkey AS l_orderkey, min(r) AS route FROM (SELECT o_custkey, o_orderkey, 1 AS r FROM orders WHERE o_orderstatus = 'F'
UNION ALL SELECT o_custkey, o_orderkey, 2 FROM orders WHERE o_totalprice > 300000 UNION ALL SELECT o_custkey, o_orderkey, 3 FROM orders WHERE o_orderpriority = '1-URGENT') AS x GROUP BY ALL) AS y""")
def strongest_routes(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select("o_custkey", F.col("o_orderkey").alias("l_orderkey"), "o_orderstatus", "o_totalprice", "o_orderpriority")
    routes = [orders.where(c).select("o_custkey", "l_orderkey") for c in ("o_orderstatus = 'F'", "o_totalprice > 300000", "o_orderpriority = '1-URGENT'")]
    return strongest_route(list(enumerate(routes, 1)), ["o_custkey", "l_orderkey"])


@query("SELECT * FROM (SELECT p_partkey, p_name, p_size, count(*) OVER () AS total FROM part WHERE p_type = 'PROMO' AND p_size >= 10) AS x WHERE p_partkey > 500 ORDER BY p_partkey LIMIT 20")
def keyset_page(spark, sf_dir):
    found = table(spark, sf_dir, "part").where("p_type = 'PROMO' and p_size >= 10").select("p_partkey", "p_name", "p_size")
    return found.where("p_partkey > 500").orderBy("p_partkey").limit(20).withColumn("total", F.lit(found.count()))


@query("SELECT doc_id, source, sha256(CAST(doc_id AS VARCHAR) || '|' || source) AS digest FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels) ORDER BY digest, doc_id LIMIT 40")
def sha_samples(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "source")
    judged = table(spark, sf_dir, "labels").select("doc_id").distinct()
    return sha_sample(docs.join(judged, "doc_id", "left_anti"), ["doc_id", "source"], 40)


@query("""WITH c AS (SELECT source, count(*) FILTER (WHERE quality = 1) AS good, count(*) AS n FROM labels JOIN documents USING (doc_id) GROUP BY source)
SELECT source, good, n, round((good / n + 1.96 * 1.96 / (2 * n) - 1.96 * sqrt((good / n) * (1 - good / n) / n + 1.96 * 1.96 / (4 * n * n))) / (1 + 1.96 * 1.96 / n), 6) AS lower FROM c""")
def wilson(spark, sf_dir):
    rows = table(spark, sf_dir, "labels").join(table(spark, sf_dir, "documents").select("doc_id", "source"), "doc_id")
    counts = rows.groupBy("source").agg(F.count_if(F.col("quality") == 1).alias("good"), F.count("*").alias("n"))
    return counts.withColumn("lower", F.round(wilson_lower(F.col("good"), F.col("n")), 6))


@query("""WITH v AS (SELECT doc_id, quality = 1 AS good FROM labels), e AS (SELECT doc_id FROM documents WHERE n_chars >= 1500)
SELECT status, count(*) AS n FROM (SELECT CASE WHEN good AND e.doc_id IS NOT NULL THEN 'held' WHEN good THEN 'lost' WHEN e.doc_id IS NOT NULL THEN 'returned' ELSE 'absent' END AS status FROM v LEFT JOIN e USING (doc_id)) AS x GROUP BY 1""")
def replay_verdicts(spark, sf_dir):
    verdicts = latest_verdict(table(spark, sf_dir, "labels").select("doc_id", (F.col("quality") == 1).alias("good"), "toxic"), "doc_id", ["toxic", "good"])
    return replay(verdicts, table(spark, sf_dir, "documents").where("n_chars >= 1500").select("doc_id"), "doc_id").groupBy("status").agg(F.count("*").alias("n"))


@query("SELECT quality, toxic, count(*) AS n FROM labels GROUP BY ALL")
def confusion_matrix(spark, sf_dir):
    return confusion(table(spark, sf_dir, "labels"), "quality", "toxic")


@query("""SELECT user_id, event_id, event_type FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS n FROM events) AS x WHERE n = 1 AND event_type <> 'error'""")
def cdc_compact(spark, sf_dir):
    events = table(spark, sf_dir, "events").select("user_id", "event_id", "event_type", "ts")
    return compact_changes(events, "user_id", ["ts", "event_id"], F.col("event_type") == "error").select("user_id", "event_id", "event_type")


@query("""WITH a AS (SELECT o_custkey, arg_max(o_orderstatus, (o_orderdate, o_orderkey)) AS s FROM orders WHERE o_orderdate < TIMESTAMP '1996-01-01' GROUP BY 1),
b AS (SELECT o_custkey, arg_max(o_orderstatus, (o_orderdate, o_orderkey)) AS s FROM orders WHERE o_orderdate >= TIMESTAMP '2001-01-01' GROUP BY 1)
SELECT coalesce(a.o_custkey, b.o_custkey) AS o_custkey, a.s AS old, b.s AS new, CASE WHEN a.o_custkey IS NULL THEN 'entered' WHEN b.o_custkey IS NULL THEN 'left' ELSE 'flipped' END AS change
FROM a FULL JOIN b ON a.o_custkey = b.o_custkey WHERE a.s IS DISTINCT FROM b.s""")
def snapshot_diffs(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    last = lambda rows: rows.groupBy("o_custkey").agg(F.max_by("o_orderstatus", F.struct("o_orderdate", "o_orderkey")).alias("s"))
    return snapshot_diff(last(orders.where("o_orderdate < timestamp_ntz '1996-01-01'")), last(orders.where("o_orderdate >= timestamp_ntz '2001-01-01'")), "o_custkey", "s")


@query("""WITH v AS (SELECT lang, CASE WHEN count(*) FILTER (WHERE n_chars >= 1500) * 2 > count(*) THEN 'BTC' ELSE 'B' END AS winner FROM documents GROUP BY lang),
r AS (SELECT md5(text) AS body, lang, CASE WHEN doc_id % 2 = 0 THEN 'B' ELSE 'BTC' END AS stage, doc_id, source FROM documents),
g AS (SELECT body, lang, arg_max(source, doc_id) AS outcome, list(DISTINCT stage) AS stages, count(*) AS copies FROM r GROUP BY ALL)
SELECT body, lang, CASE WHEN list_contains(stages, winner) THEN winner ELSE list_min(stages) END AS stage, outcome, copies FROM g JOIN v USING (lang)""")
def dedup_copies(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    votes = docs.groupBy("lang").agg(F.when(F.count_if(F.col("n_chars") >= 1500) * 2 > F.count("*"), "BTC").otherwise("B").alias("winner"))
    rows = docs.select(F.md5("text").alias("body"), "lang", F.when(F.col("doc_id") % 2 == 0, "B").otherwise("BTC").alias("stage"), "doc_id", F.col("source").alias("outcome"))
    return fold_copies(rows, ["body", "lang"], "stage", ["doc_id"], "outcome", votes, "lang").select("body", "lang", "stage", "outcome", "copies")


@query("""SELECT CASE WHEN o_orderstatus = 'P' THEN 'not_adopted' WHEN o_totalprice < 10000 THEN 'too_small' WHEN o_orderpriority = '5-LOW' THEN 'low' ELSE 'kept' END AS reason, count(*) AS n FROM orders GROUP BY 1""")
def guard_accounting(spark, sf_dir):
    steps = [("not_adopted", F.col("o_orderstatus") == "P"), ("too_small", F.col("o_totalprice") < 10000), ("low", F.col("o_orderpriority") == "5-LOW")]
    return rejections(reason_ladder(table(spark, sf_dir, "orders"), steps))


@query("SELECT 'orders' AS \"table\", count(*) AS n FROM orders UNION ALL SELECT 'lineitem', count(*) FROM lineitem UNION ALL SELECT 'events', count(*) FROM events")
def table_sizes(spark, sf_dir):
    return row_counts({name: table(spark, sf_dir, name) for name in ("orders", "lineitem", "events")})


@query("""WITH w AS (SELECT o_custkey, o_orderkey, lead(o_orderstatus) OVER k AS next_status, o_orderstatus FROM orders WINDOW k AS (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey))
SELECT o_orderstatus AS old, next_status AS new, count(*) AS n FROM w WHERE next_status IS NOT NULL GROUP BY ALL""")
def consecutive_pairs(spark, sf_dir):
    w = Window.partitionBy("o_custkey").orderBy("o_orderdate", "o_orderkey")
    pairs = table(spark, sf_dir, "orders").select(F.col("o_orderstatus").alias("old"), F.lead("o_orderstatus").over(w).alias("new"))
    return pairs.where("new is not null").groupBy("old", "new").agg(F.count("*").alias("n"))
