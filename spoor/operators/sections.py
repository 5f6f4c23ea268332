"""Positional operators over a text's headers and segments."""

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def sections(headers: DataFrame, key: str, start: str, total: str, name: str, min_len: int = 800, merge_equal: bool = False) -> DataFrame:
    """(key, n, name, start, end): a section runs from its header to the next; shorter ones are dropped, then numbered.

    With ``merge_equal`` a header that repeats the one before it, as on every page, opens no section.
    """
    rows = headers.select(key, F.col(start).alias("start"), F.col(total).alias("_total"), F.col(name).alias("name"))
    w = Window.partitionBy(key).orderBy("start", "name")
    if merge_equal:
        rows = rows.withColumn("_before", F.lag("name").over(w)).where("_before is null or _before <> name").drop("_before")
    rows = rows.withColumn("end", F.coalesce(F.lead("start").over(w), F.col("_total"))).where(F.col("end") - F.col("start") >= min_len)
    return rows.select(key, F.row_number().over(w).alias("n"), "name", "start", "end")


def segments(rows: DataFrame, id_col: str, text_col: str, least: int = 15, separator: int = 1) -> DataFrame:
    """(id, ordinal, segment, start, end): lines of ``least`` characters or more, with offsets into the lines joined again."""
    kept = F.filter(F.transform(F.split(text_col, "\n"), lambda x: F.trim(x)), lambda x: F.length(x) >= least)
    each = rows.select(id_col, F.posexplode(kept).alias("ordinal", "segment"))
    before = Window.partitionBy(id_col).orderBy("ordinal").rowsBetween(Window.unboundedPreceding, -1)
    start = F.coalesce(F.sum(F.length("segment") + separator).over(before), F.lit(0))
    return each.withColumn("start", start).withColumn("end", F.col("start") + F.length("segment"))


def consecutive(rows: DataFrame, key: str, order: str, number: str) -> DataFrame:
    """Rows while a key's numbers go 1, 2, 3 and on; none after the first break."""
    w = Window.partitionBy(key).orderBy(order)
    rows = rows.withColumn("_ok", (F.row_number().over(w) == F.col(number)).cast("int"))
    return rows.withColumn("_all", F.min("_ok").over(w.rowsBetween(Window.unboundedPreceding, 0))).where("_all = 1").drop("_ok", "_all")


def first_of(rows: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The first row of each key."""
    return rows.withColumn("_n", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).where("_n = 1").drop("_n")


def overlaps(a_start: Column, a_end: Column, b_start: Column, b_end: Column) -> Column:
    """Whether two half-open spans share a position."""
    return (a_start < b_end) & (b_start < a_end)


def overlap_join(left: DataFrame, right: DataFrame, start: str, end: str, bucket: int, keys: list[str] | None = None) -> DataFrame:
    """Pairs of left and right spans that share a moment, each once; other columns of both sides come back, those of right spans' ends don't.

    Spans are half-open timestamps and are dealt to buckets of so many microseconds. A pair meets in the bucket where the later
    of the two begins and nowhere else: each side's beginnings meet the other side's buckets. A span is so copied to each
    bucket that it reaches, and buckets are to be about as long as a usual span. A span with a null start or end overlaps none.
    """
    keys = keys or []
    at = lambda c: F.floor(F.unix_micros(c.cast("timestamp")) / bucket)
    rest = [c for c in right.columns if c not in (start, end, *keys)]
    r = right.select(*keys, F.col(start).alias("_from"), F.col(end).alias("_to"), *rest)
    reach = lambda rows, a, b: rows.withColumn("_bucket", F.explode(F.sequence(at(F.col(a)), at(F.col(b)))))
    begun = lambda rows, a: rows.withColumn("_bucket", at(F.col(a)))
    hit = overlaps(F.col(start), F.col(end), F.col("_from"), F.col("_to"))
    on = [*keys, "_bucket"]
    later_right = reach(left, start, end).join(begun(r, "_from"), on).where(hit & (F.col("_from") >= F.col(start)))
    later_left = begun(left, start).join(reach(r, "_from", "_to"), on).where(hit & (F.col("_from") < F.col(start)))
    return later_right.unionByName(later_left).drop("_bucket", "_from", "_to")


def overlap_summary(left: DataFrame, right: DataFrame, start: str, end: str, bucket: int, left_id: str, right_id: str) -> DataFrame:
    """(left id, n, least, greatest): how many right spans each left span overlaps, and the least and greatest id of them; none, no row.

    The pairs of :func:`overlap_join` without being rows: most are told by totals. Spans are half-open timestamps that don't end before
    they start, and are dealt to buckets of so many microseconds. Right spans that begin within a left one are, of the buckets
    in which it starts and ends, running totals; of those between, totals over buckets by powers of two. Right spans that are open where a left one starts are told alike,
    with left starts for points and the right spans' own buckets between. Only spans that start and end in one bucket are paired
    with what else starts in it, so buckets are to be short beside a usual span.
    """
    micros = lambda c: F.unix_micros(F.col(c).cast("timestamp"))
    at = lambda c: F.floor(F.col(c) / bucket).cast("long")
    dealt = lambda rows, key, name: rows.where(F.col(start) <= F.col(end)).select(F.col(key).alias(name), micros(start).alias("a"), micros(end).alias("b")).withColumns({"ba": at("a"), "bb": at("b")})
    o, q = dealt(left, left_id, "_o"), dealt(right, right_id, "_q")
    totals = lambda rows, *keys: rows.groupBy(*keys).agg(F.count("_q").alias("n"), F.min("_q").alias("least"), F.max("_q").alias("greatest"))
    cols = ["_o", "n", "least", "greatest"]

    def passed(asked: DataFrame, held: DataFrame, back: bool = False) -> DataFrame:
        """Totals of what is held in a point's bucket before it in order of (t, tie), or of both backwards."""
        order = [F.col(c).desc() if back else F.col(c) for c in ("t", "tie")]
        w = Window.partitionBy("bucket").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
        both = asked.unionByName(held, allowMissingColumns=True)
        both = both.withColumns({"n": F.count("_q").over(w), "least": F.min("_q").over(w), "greatest": F.max("_q").over(w)})
        return both.where("_o is not null and n > 0").select(*cols)

    def nodes(rows: DataFrame, key: str) -> DataFrame:
        """(key, k, node): the buckets between a span's first and last as the fewest runs of 2**k of them, each from a multiple of 2**k on."""
        inner = rows.where("bb - ba > 1").select(key, F.expr("ba + 1").alias("low"), F.col("bb").alias("high"))
        each = inner.select(key, "low", "high", F.explode(F.sequence(F.lit(0), F.floor(F.log2(F.col("high") - F.col("low"))).cast("int") + 1)).alias("k"))
        each = each.select(key, "k", F.expr("-shiftright(-low, k)").alias("low"), F.expr("shiftright(high, k)").alias("high")).where("low < high")
        ends = F.array_compact(F.array(F.when(F.pmod("low", F.lit(2)) == 1, F.col("low")), F.when(F.pmod("high", F.lit(2)) == 1, F.col("high") - 1)))
        return each.select(key, "k", F.explode(ends).alias("node"))

    def over(rows: DataFrame, levels: DataFrame) -> DataFrame:
        """Rows once for each level in use, with the node there that their bucket ba belongs to."""
        return rows.crossJoin(F.broadcast(levels.select("k").distinct())).withColumn("node", F.expr("shiftright(ba, k)"))

    point = lambda rows, key, t, b, tie: rows.select(key, F.col(t).alias("t"), F.col(b).alias("bucket"), tie.alias("tie"))
    long_o, long_q = o.where("ba < bb"), q.where("ba < bb")
    # Right spans that begin at or after a left one's start and before its end; an empty one at the start itself is none.
    begun = passed(point(long_o, "_o", "a", "ba", F.lit(1)), point(q, "_q", "a", "ba", F.when(F.col("a") < F.col("b"), 2).otherwise(0)), back=True)
    until = passed(point(long_o, "_o", "b", "bb", F.lit(0)), point(q, "_q", "a", "ba", F.lit(1)))
    asked = nodes(long_o, "_o")
    tree = over(totals(q, "ba"), asked).groupBy("k", "node").agg(F.sum("n").alias("n"), F.min("least").alias("least"), F.max("greatest").alias("greatest"))
    between = asked.join(tree, ["k", "node"]).select(*cols)
    # Right spans that begin before a left one's start and end after it.
    opened = passed(point(o, "_o", "a", "ba", F.lit(0)), point(long_q, "_q", "a", "ba", F.lit(1)))
    ending = passed(point(o, "_o", "a", "ba", F.lit(1)), point(long_q, "_q", "b", "bb", F.lit(0)), back=True)
    held = totals(nodes(long_q, "_q"), "k", "node")
    across = over(o.select("_o", "ba"), held).join(held, ["k", "node"]).select(*cols)
    theirs = lambda rows: rows.select("_q", F.col("a").alias("qa"), F.col("b").alias("qb"), "ba")
    short_o = totals(o.where("ba = bb").join(theirs(q), "ba").where("a <= qa and qa < b and a < qb"), "_o")
    short_q = totals(o.join(theirs(q.where("ba = bb")), "ba").where("qa < a and a < qb"), "_o")
    parts = reduce(DataFrame.unionByName, [begun, until, between, opened, ending, across, short_o.select(*cols), short_q.select(*cols)])
    return parts.groupBy(F.col("_o").alias(left_id)).agg(F.sum("n").alias("n"), F.min("least").alias("least"), F.max("greatest").alias("greatest"))


def in_bands(anchors: DataFrame, cells: DataFrame, page: list[str], y: str, tolerance: float = 8.0) -> DataFrame:
    """Cells with the anchor whose band [y, next y), moved up by a tolerance, holds them: a backward as-of by page.

    ``anchors`` and ``cells`` share the page columns and ``y``; every column of the anchor comes back with prefix ``anchor_``.
    """
    own = [c for c in anchors.columns if c not in page]
    rest = [c for c in cells.columns if c not in page]
    left = anchors.select(*page, (F.col(y) - tolerance).alias("_y"), F.lit(0).alias("_s"), F.struct(*own).alias("_a"))
    left = left.withColumn("_c", F.lit(None).cast(cells.select(F.struct(*rest).alias("x")).schema["x"].dataType))
    right = cells.select(*page, F.col(y).cast("double").alias("_y"), F.lit(1).alias("_s"), F.lit(None).cast(left.schema["_a"].dataType).alias("_a"), F.struct(*rest).alias("_c"))
    w = Window.partitionBy(*page).orderBy("_y", "_s").rowsBetween(Window.unboundedPreceding, 0)
    found = left.unionByName(right).withColumn("_a", F.last("_a", ignorenulls=True).over(w)).where("_s = 1 and _a is not null")
    return found.select(*page, *[F.col(f"_c.{c}").alias(c) for c in rest], *[F.col(f"_a.{c}").alias(f"anchor_{c}") for c in own])
