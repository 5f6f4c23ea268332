"""Streams: increments folded into a snapshot, and windowed aggregates with late data."""

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from spoor.operators.changes import archive_order, overlay, standing


def read_increments(spark: SparkSession, folder: str, schema, files_per_trigger: int = 16) -> DataFrame:
    """A stream of the files that arrive in a folder; the checkpoint is the journal of what was read already."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_trigger).parquet(folder)


#: Batches after which their changes are folded into a base.
COMPACT_EVERY = 16


def _last(changes: DataFrame, key: str, order: list[str]) -> DataFrame:
    """The last change of each key. Deleted keys stay as tombstones, so that an older change that arrives late doesn't bring them back."""
    rest = [c for c in changes.columns if c != key]
    return changes.groupBy(key).agg(F.max_by(F.struct(*rest), F.struct(*order)).alias("_last")).select(key, "_last.*").select(*changes.columns)


def _changes(spark: SparkSession, snapshots: str, version: int, every: int) -> DataFrame:
    """The last base up to a version and the changes since."""
    base = (version + 1) // every * every - 1
    folders = [f"{snapshots}/base-{base}"] * (base >= 0) + [f"{snapshots}/{n}" for n in range(base + 1, version + 1)]
    return spark.read.parquet(*folders)


def apply_increments(stream: DataFrame, snapshots: str, checkpoint: str, key: str, order: list[str], once: bool = True, every: int = COMPACT_EVERY) -> StreamingQuery:
    """Keep each batch's last change of each key, and fold them all into a base after ``every`` batches.

    Batch n writes folder n and, when its turn comes, base-n, from folders that no longer change; a batch that is run again
    gives the same. With nothing new there is no batch. Changes keep their order by ``order`` and not by arrival.
    """

    def fold(batch: DataFrame, n: int) -> None:
        _last(batch, key, order).write.mode("overwrite").parquet(f"{snapshots}/{n}")
        if (n + 1) % every == 0:
            spark = batch.sparkSession
            since = spark.read.parquet(*[f"{snapshots}/{m}" for m in range(n - every + 1, n + 1)])
            before = [spark.read.parquet(f"{snapshots}/base-{n - every}")] if n >= every else []
            _last(reduce(DataFrame.unionByName, [since, *before]), key, order).write.mode("overwrite").parquet(f"{snapshots}/base-{n}")

    writer = stream.writeStream.foreachBatch(fold).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if once else writer).start()


def current(spark: SparkSession, snapshots: str, version: int, key: str, order: list[str], is_delete: str, every: int = COMPACT_EVERY) -> DataFrame:
    """The living rows after a batch."""
    return _last(_changes(spark, snapshots, version, every), key, order).where(~F.coalesce(F.expr(is_delete), F.lit(False)))


def deploy_archives(stream: DataFrame, snapshots: str, checkpoint: str, fonds: str, key: str, stamp: str, full: str, deleted: str, once: bool = True, every: int = COMPACT_EVERY) -> StreamingQuery:
    """Fold archives that arrive in any order, full ones and increments, into a state by key; see :func:`archives_standing`.

    The state of a key is its last change, deletions too; that of a fonds is its newest full archive, kept as a row without a
    key. Both only grow with the date, so the order of arrival, and a batch that runs again, make no difference.
    """
    at = F.struct(F.col(fonds), F.col(key)).alias("_at")
    rows = stream.select(at, *[c for c in stream.columns if c not in (fonds, key)])
    # Every full archive marks its fonds, whether it says so in a row of its own or not.
    mark = F.struct(F.col(f"_at.{fonds}").alias(fonds), F.lit(None).cast(stream.schema[key].dataType).alias(key))
    own = F.when(F.col(full), F.array("_at", mark)).when(F.col(f"_at.{key}").isNotNull(), F.array("_at"))
    marked = rows.withColumn("_at", F.explode(own)).withColumn(deleted, F.when(F.col(f"_at.{key}").isNotNull(), F.coalesce(deleted, F.lit(False))).otherwise(F.lit(False)))
    return apply_increments(marked, snapshots, checkpoint, "_at", archive_order(stamp, full, deleted), once, every)


def archives_standing(spark: SparkSession, snapshots: str, version: int, fonds: str, key: str, stamp: str, full: str, deleted: str, every: int = COMPACT_EVERY) -> DataFrame:
    """The members of each fonds after a batch: of its newest full archive and the increments after it, less what those delete."""
    rows = _last(_changes(spark, snapshots, version, every), "_at", archive_order(stamp, full, deleted)).select("_at.*", "*").drop("_at")
    return standing(rows, fonds, key, stamp, full, deleted)


def counts_by_window(events: DataFrame, time: str, kind: str, width: str = "1 hour", late: str = "2 hours", slide: str | None = None) -> DataFrame:
    """(start, kind, n, total) of windows, which overlap if ``slide`` is shorter; what comes later than ``late`` is left out. Streams and tables alike."""
    rows = events.withWatermark(time, late) if events.isStreaming else events
    found = rows.groupBy(F.window(time, width, slide).alias("w"), kind).agg(F.count("*").alias("n"), F.round(F.sum("value"), 2).alias("total"))
    return found.select(F.col("w.start").alias("start"), kind, "n", "total")


def sessions(events: DataFrame, time: str, user: str, gap: str = "6 hours", late: str = "2 hours") -> DataFrame:
    """(user, start, end, n) of runs of events that lie less than ``gap`` apart."""
    rows = events.withWatermark(time, late) if events.isStreaming else events
    found = rows.groupBy(F.session_window(time, gap).alias("w"), user).agg(F.count("*").alias("n"))
    return found.select(user, F.col("w.start").alias("start"), F.col("w.end").alias("end"), "n")


def distinct_events(events: DataFrame, time: str, keys: list[str], late: str = "2 hours") -> DataFrame:
    """Events without those that repeat a key within the watermark."""
    return events.withWatermark(time, late).dropDuplicatesWithinWatermark(keys) if events.isStreaming else events.dropDuplicates(keys)


__all__ = ["apply_increments", "archives_standing", "counts_by_window", "current", "deploy_archives", "distinct_events", "overlay", "read_increments", "sessions"]
