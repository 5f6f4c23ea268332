"""Streams over the events table, each run to its end, and their batch twins."""

import uuid
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spoor.operators.changes import archive_journal, deployed
from spoor.registry import query
from spoor.sources.tables import shared_dir, table, written
from spoor.streaming.events import apply_increments, archives_standing, counts_by_window, current, deploy_archives, read_increments, sessions


def _events(spark, sf_dir):
    return table(spark, sf_dir, "events").select("event_id", F.col("ts").cast("timestamp").alias("ts"), "user_id", "event_type", "value")


@query("SELECT CAST(date_trunc('hour', ts) AS VARCHAR) AS start, event_type, count(*) AS n, round(sum(value), 2) AS total FROM events GROUP BY ALL")
def event_windows(spark, sf_dir):
    return counts_by_window(_events(spark, sf_dir), "ts", "event_type").withColumn("start", F.date_format("start", "yyyy-MM-dd HH:mm:ss"))


@query(
    """WITH g AS (SELECT user_id, ts, CASE WHEN ts >= lag(ts) OVER (PARTITION BY user_id ORDER BY ts) + INTERVAL 6 HOUR OR lag(ts) OVER (PARTITION BY user_id ORDER BY ts) IS NULL THEN 1 ELSE 0 END AS s FROM events),
n AS (SELECT user_id, sum(s) OVER (PARTITION BY user_id ORDER BY ts) AS k FROM g) SELECT user_id, count(DISTINCT k) AS sessions, count(*) AS events FROM n GROUP BY user_id"""
)
def event_sessions(spark, sf_dir):
    return sessions(_events(spark, sf_dir), "ts", "user_id").groupBy("user_id").agg(F.count("*").alias("sessions"), F.sum("n").alias("events"))


@query("SELECT user_id, event_id, event_type FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS n FROM events) AS x WHERE n = 1 AND event_type <> 'error'")
def events_stream(spark, sf_dir):
    """Increments read as a stream, folded batch by batch into a snapshot, give what the whole table does."""
    folder = f"{shared_dir(spark)}/spoor-stream-{uuid.uuid4().hex}"
    source = _events(spark, sf_dir)
    source.repartition(4, "event_id").write.parquet(f"{folder}/in")
    stream = read_increments(spark, f"{folder}/in", source.schema, files_per_trigger=1)
    run = apply_increments(stream, f"{folder}/snapshots", f"{folder}/checkpoint", "user_id", ["ts", "event_id"])
    run.awaitTermination()
    batches = [p["batchId"] for p in run.recentProgress if p["numInputRows"] > 0]
    if not batches:
        return source.select("user_id", "event_id", "event_type").limit(0)
    found = current(spark, f"{folder}/snapshots", max(batches), "user_id", ["ts", "event_id"], "event_type = 'error'")
    return written(found.select("user_id", "event_id", "event_type"))


@query(
    """SELECT CAST(date_trunc('hour', ts) AS VARCHAR) AS start, event_type, count(*) AS n, round(sum(value), 2) AS total FROM events
WHERE date_trunc('hour', ts) + INTERVAL 1 HOUR <= (SELECT max(ts) FROM events) - INTERVAL 2 HOUR GROUP BY ALL"""
)
def late_events(spark, sf_dir):
    """Windows of a stream in increments by time, of which the last repeats the oldest events: they come too late and count nowhere.

    A window is given out when the watermark has passed its end, and then only.
    """
    folder = f"{shared_dir(spark)}/spoor-stream-{uuid.uuid4().hex}"
    source = _events(spark, sf_dir)
    span = source.agg(F.min("ts").alias("low"), F.max("ts").alias("high")).first()
    if span["low"] is None:
        return counts_by_window(source, "ts", "event_type").withColumn("start", F.date_format("start", "yyyy-MM-dd HH:mm:ss"))
    part = F.least(F.lit(2), F.floor(3 * (F.unix_micros("ts") - F.unix_micros(F.lit(span["low"]))) / F.greatest(F.lit(1), F.unix_micros(F.lit(span["high"])) - F.unix_micros(F.lit(span["low"])))))
    for k in (0, 1, 2, 0):
        source.where(part == k).write.mode("append").parquet(f"{folder}/in")
        stream = counts_by_window(spark.readStream.schema(source.schema).parquet(f"{folder}/in"), "ts", "event_type")
        stream.writeStream.format("parquet").outputMode("append").option("path", f"{folder}/out").option("checkpointLocation", f"{folder}/checkpoint").trigger(availableNow=True).start().awaitTermination()
    return spark.read.parquet(f"{folder}/out").withColumn("start", F.date_format("start", "yyyy-MM-dd HH:mm:ss"))


@query(
    """WITH w AS (SELECT ts, event_type, value, unnest(range(3)) AS k FROM events)
SELECT CAST(to_timestamp(floor(epoch(ts) / 7200) * 7200 - 7200 * k)::TIMESTAMP AS VARCHAR) AS start, event_type, count(*) AS n, round(sum(value), 2) AS total FROM w GROUP BY ALL"""
)
def events_sliding(spark, sf_dir):
    """Windows of six hours that begin every two."""
    return counts_by_window(_events(spark, sf_dir), "ts", "event_type", "6 hours", slide="2 hours").withColumn("start", F.date_format("start", "yyyy-MM-dd HH:mm:ss"))


#: Archives of documents as they arrive: (date, full, which documents they hold, which of those they delete, of which fonds).
_ARCHIVES = [
    (30, True, "doc_id % 5 <> 0", "false", "doc_id % 4 < 2"),
    (40, False, "doc_id % 7 = 1", "doc_id % 14 = 1", "true"),
    (10, True, "doc_id % 3 <> 0", "false", "doc_id % 4 < 3"),
    (20, False, "doc_id % 7 in (2, 5)", "doc_id % 7 = 5", "true"),
    (30, False, "doc_id % 10 = 5", "false", "true"),
    (35, False, "doc_id % 7 in (1, 3)", "doc_id % 7 = 3 and doc_id % 2 = 0", "true"),
    (5, False, "doc_id % 2 = 0", "false", "true"),
]
_MEMBERS = "m AS (" + " UNION ALL ".join(f"SELECT doc_id % 4 AS fonds, doc_id, {at} AS stamp, {'true' if full else 'false'} AS is_full, {gone} AS deleted, length(text) + {at} AS body FROM documents WHERE ({holds}) AND ({of})" for at, full, holds, gone, of in _ARCHIVES) + "), g AS (SELECT fonds, max(stamp) AS newest FROM m WHERE is_full GROUP BY 1)"
_NAMES = dict(fonds="fonds", key="doc_id", stamp="stamp", full="is_full", deleted="deleted")


def _archives(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").selectExpr("doc_id % 4 as fonds", "doc_id", "cast(length(text) as long) as body")
    for at, full, holds, gone, of in _ARCHIVES:
        yield docs.where(holds).where(of).select("fonds", "doc_id", F.lit(at).alias("stamp"), F.lit(full).alias("is_full"), F.expr(gone).alias("deleted"), (F.col("body") + at).alias("body"))


@query(
    f"""WITH {_MEMBERS}, k AS (SELECT m.*, row_number() OVER (PARTITION BY m.fonds, doc_id ORDER BY stamp DESC, deleted DESC) AS n FROM m JOIN g USING (fonds) WHERE stamp > newest OR (is_full AND stamp = newest))
SELECT fonds, doc_id, stamp, body FROM k WHERE n = 1 AND NOT deleted"""
)
def archives_deployed(spark, sf_dir):
    """Full archives and increments that arrive out of order, one a batch, folded into a state by key, give what laying them down by date does."""
    folder = f"{shared_dir(spark)}/spoor-archives-{uuid.uuid4().hex}"
    schema = None
    for rows in _archives(spark, sf_dir):
        schema = rows.schema
        rows.write.mode("append").parquet(f"{folder}/in")
        run = deploy_archives(spark.readStream.schema(schema).parquet(f"{folder}/in"), f"{folder}/state", f"{folder}/checkpoint", every=4, **_NAMES)
        run.awaitTermination()
    batches = [int(b) for b in (p["batchId"] for p in run.recentProgress)]
    return written(archives_standing(spark, f"{folder}/state", max(batches), every=4, **_NAMES).select("fonds", "doc_id", "stamp", "body"))


@query(
    f"""WITH {_MEMBERS}, k AS (SELECT m.*, row_number() OVER (PARTITION BY m.fonds, doc_id ORDER BY stamp DESC, deleted DESC) AS n FROM m JOIN g USING (fonds) WHERE stamp > newest OR (is_full AND stamp = newest))
SELECT fonds, count(*) AS members, CAST(sum(body) AS BIGINT) AS body FROM k WHERE n = 1 AND NOT deleted GROUP BY 1"""
)
def archives_by_fonds(spark, sf_dir):
    """The same from all archives at once, without a stream."""
    return deployed(reduce(DataFrame.unionByName, _archives(spark, sf_dir)), **_NAMES).groupBy("fonds").agg(F.count("*").alias("members"), F.sum("body").alias("body"))


@query(
    f"""WITH {_MEMBERS} SELECT fonds, stamp, is_full, count(*) FILTER (WHERE NOT deleted) AS members, count(*) FILTER (WHERE deleted) AS deletions, coalesce(bool_or(stamp > newest OR (is_full AND stamp = newest)), false) AS applied
FROM m LEFT JOIN g USING (fonds) GROUP BY ALL"""
)
def archives_journal(spark, sf_dir):
    """Archives with what they hold and delete, and whether they count."""
    return archive_journal(reduce(DataFrame.unionByName, _archives(spark, sf_dir)), **_NAMES).drop("hash")
