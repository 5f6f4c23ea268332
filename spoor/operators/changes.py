"""Change data: compaction of ordered changes, snapshot differences, double publications."""

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def compact_changes(changes: DataFrame, key: str, order: list[str], is_delete: Column) -> DataFrame:
    """The last change of each key, unless it is a deletion: one aggregate with a map-side part."""
    rest = [c for c in changes.columns if c != key]
    last = changes.withColumn("_gone", is_delete).groupBy(key).agg(F.max_by(F.struct(*rest, "_gone"), F.struct(*order)).alias("_last"))
    return last.where("not _last._gone").select(key, *[F.col(f"_last.{c}").alias(c) for c in rest])


def overlay(snapshot: DataFrame, increments: DataFrame, key: str, order: list[str], is_delete: Column, newer_than: Column | None = None) -> DataFrame:
    """A snapshot with ordered increments applied; with ``newer_than`` only those increments for which it holds."""
    later = increments if newer_than is None else increments.where(newer_than)
    base = snapshot.withColumns({c: F.lit(None).cast(increments.schema[c].dataType) for c in increments.columns if c not in snapshot.columns})
    every = base.withColumn("_n", F.lit(0)).unionByName(later.withColumn("_n", F.lit(1)))
    return compact_changes(every, key, ["_n", *order], F.coalesce(is_delete, F.lit(False))).select(*snapshot.columns)


def standing(changes: DataFrame, fonds: str, key: str, stamp: str, full: str, deleted: str) -> DataFrame:
    """The living members among the last changes of each key of archives: those of a fonds' newest full archive, or newer than it.

    A row without a key is the mark of an archive, so that an empty full archive counts too. A fonds without a full archive has no
    members yet: its increments wait. An increment as old as the full archive, or older, is in it already.
    """
    newest = changes.where(F.col(full)).groupBy(fonds).agg(F.max(stamp).alias("_newest"))
    counts = (F.col(stamp) > F.col("_newest")) | (F.col(full) & (F.col(stamp) == F.col("_newest")))
    return changes.join(newest, fonds).where(counts & F.col(key).isNotNull() & ~F.coalesce(F.col(deleted), F.lit(False))).drop("_newest")


#: Of one key: the later archive, of one date the full one, within an archive its deletions, as they come after what it holds.
def archive_order(stamp: str, full: str, deleted: str) -> list[str]:
    return [stamp, full, deleted]


def deployed(archives: DataFrame, fonds: str, key: str, stamp: str, full: str, deleted: str) -> DataFrame:
    """What archives (rows with ``fonds``, ``key``, ``stamp``, ``full``, ``deleted``) leave when the newest full one is laid down and later ones over it."""
    rest = [c for c in archives.columns if c not in (fonds, key)]
    order = F.struct(*archive_order(stamp, full, deleted))
    last = archives.groupBy(fonds, key).agg(F.max_by(F.struct(*rest), order).alias("_l"), F.max(F.when(F.col(full), F.col(stamp))).alias("_full"))
    # An older full archive may hide behind a later change of the same key, so its date goes along.
    newest = last.groupBy(fonds).agg(F.max("_full").alias("_full"))
    rows = last.select(fonds, key, "_l.*").select(*archives.columns)
    mark = newest.where("_full is not null").select(F.col(fonds), *[F.lit(None).cast(archives.schema[c].dataType).alias(c) if c not in (stamp, full) else (F.col("_full").alias(stamp) if c == stamp else F.lit(True).alias(full)) for c in archives.columns if c != fonds])
    return standing(rows.where(F.col(key).isNotNull()).unionByName(mark), fonds, key, stamp, full, deleted)


def archive_journal(archives: DataFrame, fonds: str, key: str, stamp: str, full: str, deleted: str) -> DataFrame:
    """(fonds, stamp, full, members, deletions, hash, applied) of each archive; the hash is of its rows in any order."""
    flag = F.coalesce(F.col(deleted), F.lit(False))
    held = F.col(key).isNotNull()
    each = archives.groupBy(fonds, stamp, full).agg(
        F.count_if(held & ~flag).alias("members"), F.count_if(held & flag).alias("deletions"), F.sum(F.xxhash64(*[c for c in archives.columns if c not in (fonds, stamp, full)]).cast("decimal(38,0)")).cast("string").alias("hash")
    )
    newest = each.where(F.col(full)).groupBy(fonds).agg(F.max(stamp).alias("_newest"))
    applied = F.coalesce((F.col(stamp) > F.col("_newest")) | (F.col(full) & (F.col(stamp) == F.col("_newest"))), F.lit(False))
    return each.join(newest, fonds, "left").withColumn("applied", applied).drop("_newest")


def snapshot_diff(old: DataFrame, new: DataFrame, key: str, value: str) -> DataFrame:
    """(key, old, new, change): entered, left or flipped; equal rows are not returned."""
    both = old.select(F.col(key), F.col(value).alias("old"), F.lit(1).alias("_old")).join(new.select(F.col(key), F.col(value).alias("new"), F.lit(1).alias("_new")), key, "full")
    change = F.when(F.col("_old").isNull(), "entered").when(F.col("_new").isNull(), "left").when(~F.col("old").eqNullSafe(F.col("new")), "flipped")
    return both.withColumn("change", change).where("change is not null").select(key, "old", "new", "change")


def fold_copies(rows: DataFrame, same: list[str], stage: str, freshness: list[str], outcome: str, votes: DataFrame, vote_key: str) -> DataFrame:
    """Records published in several stages, one each: of the stage that the vote names, with the freshest copy's outcome.

    ``votes`` has (vote_key, winner). Where no copy is of the winning stage the least stage stays.
    """
    fresh = rows.groupBy(*same).agg(F.max_by(outcome, F.struct(*freshness)).alias("_outcome"), F.collect_set(stage).alias("_stages"), F.count("*").alias("copies"))
    voted = fresh.join(votes.select(vote_key, "winner"), vote_key, "left")
    kept = F.when(F.array_contains("_stages", F.coalesce("winner", F.lit(""))), F.col("winner")).otherwise(F.array_min("_stages"))
    return voted.select(*same, kept.alias(stage), F.col("_outcome").alias(outcome), "copies")


def latest_verdict(verdicts: DataFrame, key: str, order: list[str]) -> DataFrame:
    rest = [c for c in verdicts.columns if c != key]
    return verdicts.groupBy(key).agg(F.max_by(F.struct(*rest), F.struct(*order)).alias("_v")).select(key, "_v.*")


def replay(verdicts: DataFrame, edges: DataFrame, key: str) -> DataFrame:
    """(key, status): held, lost, returned or absent, of past verdicts (good boolean) against the edges there are now."""
    now = edges.select(key).distinct().withColumn("_now", F.lit(True))
    there = F.col("_now").isNotNull()
    status = F.when(F.col("good") & there, "held").when(F.col("good"), "lost").when(there, "returned").otherwise("absent")
    return verdicts.join(now, key, "left").select(key, status.alias("status"))


def replay_moved(verdicts: DataFrame, edges: DataFrame, by_mention: list[str] | None = None) -> DataFrame:
    """Past verdicts with ``status`` against the edges there are now, which may have moved; ``n`` counts equal verdicts.

    ``verdicts``: family, key, stable, sheet, day, good, number, lineage, route. ``edges``: family, key, stable, number, lineage, route.
    ``key`` may slide when others come in, ``stable`` is made of what doesn't; it is asked only where no edge has the key. Of edges
    that share a key the one of the judged lineage counts, else the least. Nulls: a verdict without ``good`` isn't returned, without
    ``lineage`` or ``route`` it stands for any, without keys it finds nothing.

    * ``judged_elsewhere``: a later sheet judged the same key, by day and then by name;
    * ``other_lineage``: the number is another article's now; ``other_route``: found false, and there on another ground;
    * ``returned`` and ``absent`` of false edges; ``held``, ``lost`` and ``moved`` (to another number) of good ones. Families in
      ``by_mention`` are keyed by a mention, so their number may change.
    """
    said = ["family", "key", "stable", "sheet", "day", "good", "number", "lineage", "route"]
    judged = verdicts.where("good is not null").groupBy(*said).agg(F.count("*").alias("n"))
    last = judged.groupBy("family", "key").agg(F.max(F.struct("day", "sheet")).alias("_last"))
    judged = judged.join(last.select("family", "key", F.col("_last.sheet").alias("_sheet")), ["family", "key"], "left")
    judged = judged.withColumn("_sheet", F.when(F.col("key").isNull() | F.col("family").isNull(), F.col("sheet")).otherwise(F.col("_sheet")))

    found = F.struct(F.col("lineage"), F.coalesce("route", F.lit("")).alias("route"), F.col("number"))
    names = lambda *ways: F.explode(F.array(*[F.struct(F.lit(rank).alias("rank"), F.lit(kind).alias("kind"), F.col(kind_key).alias("k"), lineage.alias("line")) for rank, kind, kind_key, lineage in ways])).alias("_at")
    whole, any_ = F.col("lineage").cast("string"), F.lit("*")
    ways = [(1, "key", "key", whole), (2, "key", "key", any_), (3, "stable", "stable", whole), (4, "stable", "stable", any_)]
    at = [F.col("_at.kind").alias("_kind"), F.col("_at.k").alias("_k"), F.col("_at.line").alias("_line")]
    index = edges.select("family", found.alias("_edge"), names(*ways)).where("_at.k is not null and _at.line is not null").groupBy("family", *at).agg(F.min("_edge").alias("_edge"))
    asked = judged.where("_sheet <=> sheet").select(*said, "n", names(*ways)).where("_at.k is not null and _at.line is not null").select(*said, "n", F.col("_at.rank").alias("_rank"), *at)
    hits = asked.join(index, ["family", "_kind", "_k", "_line"]).groupBy(*said, "n").agg(F.min_by("_edge", "_rank").alias("_edge"))
    same = [F.col(f"h.{c}").eqNullSafe(F.col(f"j.{c}")) for c in said]
    both = judged.alias("j").join(hits.select(*said, "_edge").alias("h"), reduce(Column.__and__, same), "left").select("j.*", "_edge")

    there, good = F.col("_edge").isNotNull(), F.col("good")
    status = (
        F.when(~F.col("_sheet").eqNullSafe(F.col("sheet")), "judged_elsewhere")
        .when(there & F.col("lineage").isNotNull() & ~F.col("_edge.lineage").eqNullSafe(F.col("lineage")), "other_lineage")
        .when(there & ~good & F.col("route").isNotNull() & (F.col("_edge.route") != F.col("route")), "other_route")
        .when(~good, F.when(there, "returned").otherwise("absent"))
        .when(~there, "lost")
        .when(~F.col("family").isin(by_mention or []) & ~F.col("_edge.number").eqNullSafe(F.col("number")), "moved")
        .otherwise("held")
    )
    return both.select(*said, "n", status.alias("status"), F.col("_edge.number").alias("now"))
