"""Which statute introduced each paragraph of an article, by the ancestry of its segments, and what became of it on the way."""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from spoor.operators.closure import closure


def highlighted(shown: DataFrame, segments: DataFrame, versions: DataFrame, carried: DataFrame, produced: DataFrame, statutes: DataFrame, results: DataFrame, palette: int = 10) -> DataFrame:
    """(version, segment, rank, ancestors, since, introduced_by, colour, touched, amendments), one row a segment of a version shown.

    ``shown``: version. ``segments``: segment, version, rank. ``versions``: version, start. ``carried``: segment, source, share.
    ``produced``: version, statute, link. ``statutes``: statute, date. ``results``: segment, amendment.

    Of a segment and all that it was carried from, the one of the earliest version introduced it, the least segment of several, a
    version without a date last; ``introduced_by`` (array of rank, statute) are the statutes that produced this version without repealing it, by date
    and then name. ``rank`` there counts a version's introducing statutes in time, from 1, and ``colour`` is that of the
    segment's first one, from 0 and over again after ``palette``; null where none is known. ``touched`` says whether a share on the
    way was below 1, and ``amendments`` (sorted array) are those that any of these segments results from.

    Equal rows count once, cycles end, rows with null keys are ignored, empty tables give no row or nothing but the segments. An
    ancestor is met by an equi-join and a segment's ancestors are folded into one row; the window goes over an article's statutes.
    """
    own = segments.join(shown.select("version").distinct(), "version", "left_semi").where("segment is not null").select("version", "segment", "rank").distinct()
    edges = carried.where("segment is not null and source is not null")
    chain = closure(edges, "segment", "source", own.select("segment")).select("seed", F.col("node").alias("segment"))
    dated = segments.join(versions, "version").groupBy("segment", "version").agg(F.min("start").alias("start"))
    changed = edges.groupBy("segment").agg(F.max(F.coalesce(F.col("share") < 1, F.lit(False))).alias("changed"))
    first = F.min(F.struct(F.col("start").isNull(), F.col("start"), F.col("segment"), F.col("version")))
    each = chain.join(dated, "segment").join(changed, "segment", "left")
    told = each.groupBy("seed").agg((F.count_distinct("segment") - 1).alias("ancestors"), first.alias("f"), F.coalesce(F.max("changed"), F.lit(False)).alias("touched"))
    told = told.select(F.col("seed").alias("segment"), "ancestors", F.col("f.start").alias("since"), F.col("f.version").alias("_from"), "touched")
    made = produced.where("link is null or link <> 'repeal'").join(statutes, "statute").groupBy(F.col("version").alias("_from"), "statute").agg(F.min("date").alias("date"))
    origin = own.select("version", "segment").join(told, "segment").join(made, "_from").select("version", "segment", "statute", "date")
    in_time = Window.partitionBy("version").orderBy(F.col("date").asc_nulls_last(), "statute")
    ranked = origin.withColumn("rank", F.dense_rank().over(in_time))
    by = ranked.groupBy("version", "segment").agg(F.array_sort(F.collect_set(F.struct("rank", "statute"))).alias("introduced_by"))
    marks = chain.join(results.where("amendment is not null"), "segment").groupBy(F.col("seed").alias("segment")).agg(F.array_sort(F.collect_set("amendment")).alias("amendments"))
    out = own.join(told, "segment", "left").join(by, ["version", "segment"], "left").join(marks, "segment", "left")
    none = lambda c: F.coalesce(F.col(c), F.array().cast(out.schema[c].dataType)).alias(c)
    return out.select(
        "version", "segment", "rank", F.coalesce("ancestors", F.lit(0)).alias("ancestors"), "since", none("introduced_by"), colour(F.get("introduced_by", F.lit(0))["rank"], palette).alias("colour"),
        F.coalesce("touched", F.lit(False)).alias("touched"), none("amendments"),
    )


def colour(rank: Column, palette: int) -> Column:
    return F.pmod(rank - 1, F.lit(palette))


def legend(rows: DataFrame, palette: int = 10) -> DataFrame:
    """(version, statute, colour, paragraphs): the statutes that introduced a highlighted version's segments, and how many each.

    Segments without a known origin stand under a null statute and colour.
    """
    each = rows.select("version", F.explode_outer("introduced_by").alias("x")).select("version", "x.statute", "x.rank")
    return each.groupBy("version", "statute", colour(F.col("rank"), palette).alias("colour")).agg(F.count("*").alias("paragraphs"))
