"""Verbatim reuse: windows of benchmark passages in documents."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spoor.operators.closure import components
from spoor.operators.shingles import INDEX_STEP, PROBE_STEP, WIDTH, asked_for, block_windows, carried_share, prior_art, window_index_join, window_key
from spoor.registry import query
from spoor.sources.tables import spread, table, written

_WINDOWS = f"""
iw AS (SELECT item_id, pos, substr(text, CAST(pos + 1 AS BIGINT), {WIDTH}) AS w FROM (SELECT item_id, text, unnest(range(0, length(text) - {WIDTH} + 1, {PROBE_STEP})) AS pos FROM benchmark WHERE length(text) >= {WIDTH}) AS x),
dw AS (SELECT DISTINCT doc_id, source, substr(text, CAST(pos + 1 AS BIGINT), {WIDTH}) AS w FROM (SELECT doc_id, source, text, unnest(range(0, length(text) - {WIDTH} + 1)) AS pos FROM documents WHERE length(text) >= {WIDTH}) AS x
  WHERE w IN (SELECT w FROM iw))"""


def _windows(spark, sf_dir) -> tuple[DataFrame, DataFrame]:
    items = block_windows(table(spark, sf_dir, "benchmark"), "item_id", "text", WIDTH, PROBE_STEP)
    return items, block_windows(spread(table(spark, sf_dir, "documents")), ["doc_id", "source"], "text", WIDTH, INDEX_STEP, hashed=True)


@query(f"WITH {_WINDOWS} SELECT doc_id, item_id, count(*) AS hits FROM iw JOIN dw USING (w) GROUP BY doc_id, item_id")
def passage_reuse(spark, sf_dir):
    items, docs = _windows(spark, sf_dir)
    return window_index_join(items, docs.drop("source")).groupBy("doc_id", "item_id").agg(F.count("*").alias("hits"))


@query(
    f"""WITH {_WINDOWS}, c AS (SELECT item_id, count(DISTINCT w) AS candidates FROM iw GROUP BY item_id),
h AS (SELECT item_id, doc_id, count(DISTINCT iw.w) AS common, min(iw.w) AS proof FROM iw JOIN dw USING (w) GROUP BY ALL),
b AS (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY common DESC, doc_id) AS n FROM h)
SELECT item_id, doc_id, candidates, common, common / candidates AS share, proof FROM b JOIN c USING (item_id) WHERE n = 1"""
)
def passage_share(spark, sf_dir):
    items, docs = _windows(spark, sf_dir)
    return carried_share(items, docs, "item_id", "doc_id")


@query(f"WITH {_WINDOWS} SELECT item_id, pos, count(DISTINCT doc_id) AS holders FROM iw JOIN dw USING (w) GROUP BY ALL HAVING count(DISTINCT doc_id) <= 2")
def discriminant_windows(spark, sf_dir):
    items, docs = _windows(spark, sf_dir)
    found = window_index_join(items, docs.drop("source"), max_owners=2, owner_col="doc_id")
    return found.groupBy("item_id", F.col("pos").cast("long").alias("pos")).agg(F.count("*").alias("holders"))


@query(
    f"""WITH {_WINDOWS} SELECT doc_id, count(*) AS fresh FROM dw a WHERE NOT EXISTS (SELECT 1 FROM dw b WHERE b.w = a.w AND b.doc_id < a.doc_id AND b.source <> a.source) GROUP BY doc_id"""
)
def prior_art_guard(spark, sf_dir):
    items, docs = _windows(spark, sf_dir)
    known = docs.join(items.select(*window_key("w")).distinct(), ["h1", "h2"], "left_semi")
    # Read twice by the operator, and small beside the windows of all documents.
    known = written(known.select("doc_id", "source", "h1", "h2").distinct())
    return prior_art(known, "doc_id", "doc_id", "source").groupBy("doc_id").agg(F.count("*").alias("fresh"))


#: The share of a document's long lines that it has in common with the first document that holds them, from which on it is a copy.
COPIED = 0.5


@query(
    f"""WITH RECURSIVE lines AS (SELECT DISTINCT doc_id, line FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM documents) AS x WHERE length(line) >= 60),
firsts AS (SELECT line, min(doc_id) AS low FROM lines GROUP BY line), sizes AS (SELECT doc_id, count(*) AS n FROM lines GROUP BY 1),
e AS (SELECT doc_id AS a, low AS b FROM (SELECT doc_id, low, count(*) AS common FROM lines JOIN firsts USING (line) WHERE doc_id <> low GROUP BY ALL) AS x JOIN sizes USING (doc_id) WHERE common >= {COPIED} * n
  UNION SELECT doc_id, low FROM documents JOIN (SELECT text, min(doc_id) AS low FROM documents GROUP BY text) AS same USING (text) WHERE doc_id <> low),
u AS (SELECT a, b FROM e UNION SELECT b, a FROM e),
r(node, reach) AS (SELECT a, a FROM u UNION SELECT r.node, u.b FROM r JOIN u ON r.reach = u.a)
SELECT node AS doc_id, min(reach) AS component FROM r GROUP BY node"""
)
def duplicate_clusters(spark, sf_dir):
    """Documents whose text, or at least half of whose long lines, another document held first. A line that many share is a link for none
    of whom it isn't half."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    lines = docs.select("doc_id", F.explode(F.split("text", "\n")).alias("line")).where(F.length("line") >= WIDTH).select("doc_id", *window_key("line")).distinct()
    # Each line names its first holder: a star, not all pairs.
    firsts = lines.groupBy("h1", "h2").agg(F.min("doc_id").alias("low"))
    shared = lines.join(firsts, ["h1", "h2"]).groupBy("doc_id", "low").agg(F.count("*").alias("common"))
    sizes = shared.groupBy("doc_id").agg(F.sum("common").alias("n"))
    stars = shared.where("doc_id <> low").join(sizes, "doc_id").where(F.col("common") >= COPIED * F.col("n")).select("doc_id", "low")
    whole = docs.select("doc_id", F.sha2("text", 256).alias("sha"))
    stars = stars.unionByName(whole.join(whole.groupBy("sha").agg(F.min("doc_id").alias("low")), "sha").select("doc_id", "low"))
    found = components(stars, "doc_id", "low")
    members = found.select(F.col("node").alias("doc_id"), F.col("root").alias("component"))
    return members.unionByName(found.select("root", "root").distinct().toDF("doc_id", "component"))


@query(
    f"""WITH w AS (SELECT item_id, length(text) AS n, unnest(range(0, length(text) - {WIDTH} + 1)) AS pos, text FROM benchmark WHERE length(text) >= {WIDTH}),
iw AS (SELECT DISTINCT item_id, substr(text, CAST(pos + 1 AS BIGINT), {WIDTH}) AS w FROM w),
dw AS (SELECT DISTINCT substr(text, CAST(pos + 1 AS BIGINT), {WIDTH}) AS w FROM (SELECT text, unnest(range(0, length(text) - {WIDTH} + 1)) AS pos FROM documents WHERE length(text) >= {WIDTH}) AS x),
s AS (SELECT item_id, count(*) AS windows, count(*) FILTER (WHERE w IN (SELECT w FROM dw)) AS found FROM iw GROUP BY item_id)
SELECT CASE WHEN found / windows >= 0.9 THEN 'covered' WHEN found / windows >= 0.1 THEN 'partly' ELSE 'absent' END AS cover, count(*) AS items FROM s GROUP BY 1"""
)
def coverage_partition(spark, sf_dir):
    items = block_windows(table(spark, sf_dir, "benchmark"), "item_id", "text", WIDTH, 1).select("item_id", *window_key("w")).distinct()
    docs = asked_for(block_windows(spread(table(spark, sf_dir, "documents")), "doc_id", "text", WIDTH, 1, hashed=True).select("h1", "h2", F.lit(1).alias("there")), items)
    share = items.join(docs, ["h1", "h2"], "left").groupBy("item_id").agg((F.count("there") / F.count("*")).alias("share"))
    return share.groupBy(F.when(F.col("share") >= 0.9, "covered").when(F.col("share") >= 0.1, "partly").otherwise("absent").alias("cover")).agg(F.count("*").alias("items"))
