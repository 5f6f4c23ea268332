"""Mixing sources to target weights by a low-discrepancy schedule.

Slots of BLOCK words are laid out; slot s has the golden-ratio point s * 2654435769 mod 2**32, and the cumulative weight
interval that the point falls in names its source. A source's documents, shuffled by hash and laid end to end, are a tape
that begins anew at its end; its k-th slot takes the tape's k-th block of BLOCK words. A source has as many slots as its
target calls for: those that its points name beyond are cut, those that they lack stand at the schedule's end. Running totals
are taken over hash-ordered runs of bounded size and their sums, never over a whole source in one task.
"""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from spoor.llm.common import WORD, null_safe, written

#: Weights of the sources in order, repeating; the most often that a word may be taken.
WEIGHTS, MOST = (5, 2, 1), 3
#: Words in a block and its slot.
BLOCK = 64
#: 2**32 over the golden ratio, odd: no point comes twice within 2**31 slots, after which the schedule repeats.
GOLDEN, POINTS = 2654435769, 1 << 32
#: Rows in a run whose total is taken in one window partition, runs in a stretch, and strips that the points are cut into.
RUN, STRETCH, STRIPS = 256, 256, 1024


def targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST) -> DataFrame:
    """(key, source, source_size, n, weight, target) from (key, source, source_size, n): one row a source, by code point, null last.

    Shares of the total by weight; no target is above ``most`` times its source, and what is cut off is shared again by
    weight. The level at which that ends is found in one pass: sources reach their limit in the order of limit over weight.
    """
    place = F.row_number().over(Window.partitionBy(F.lit(1)).orderBy(F.col("source").asc_nulls_last())) - 1
    own = F.element_at(F.array(*map(F.lit, weights)), (F.pmod("place", F.lit(len(weights))) + 1).cast("int"))
    found = sizes.withColumn("place", place).withColumn("weight", own).withColumn("most", F.col("source_size") * most)
    everything = Window.partitionBy(F.lit(1))
    filling = everything.orderBy(F.col("most") / F.col("weight"), "place")
    before = filling.rowsBetween(Window.unboundedPreceding, -1)
    found = found.withColumns(
        {
            "left": F.sum("source_size").over(everything) - F.coalesce(F.sum("most").over(before), F.lit(0)),
            "open": F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), F.lit(0)),
        }
    )
    # Before the first source that its share doesn't fill, all are at their limit.
    found = found.withColumn("level", F.when(F.col("most") * F.col("open") >= F.col("left") * F.col("weight"), F.col("left") / F.col("open")))
    found = found.withColumn("level", F.first("level", ignorenulls=True).over(filling.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)))
    reach = F.col("level") * F.col("weight")
    target = F.when(F.col("most") <= reach, F.col("most").cast("double")).otherwise(reach)
    return found.select("key", "source", "source_size", "n", "weight", F.coalesce(target, F.lit(0.0)).alias("target"))


def _running(rows: DataFrame, key: str, run: Column, order: list, value: str, out: str) -> DataFrame:
    """``rows`` plus the total of ``value`` over the rows of its key that stand before it.

    ``run`` numbers bounded runs of rows in the sense of ``order``, which is total but for rows that are equal throughout.
    """
    rows = rows.withColumn("_run", run).withColumn("_stretch", F.floor(F.col("_run") / STRETCH))
    runs = rows.groupBy(key, "_stretch", "_run").agg(F.sum(value).alias("_sum"))
    stretches = runs.groupBy(key, "_stretch").agg(F.sum("_sum").alias("_total"))
    ahead = lambda part, by: Window.partitionBy(*part).orderBy(*by).rowsBetween(Window.unboundedPreceding, -1)
    total = lambda c, w: F.coalesce(F.sum(c).over(w), F.lit(0))
    stretches = stretches.select(key, "_stretch", total("_total", ahead([key], ["_stretch"])).alias("_far"))
    runs = runs.join(stretches, [key, "_stretch"]).select(key, "_run", (F.col("_far") + total("_sum", ahead([key, "_stretch"], ["_run"]))).alias("_near"))
    own = rows.withColumn("_own", total(value, ahead([key, "_run"], order)))
    return own.join(runs, [key, "_run"]).withColumn(out, F.col("_near") + F.col("_own")).drop("_run", "_stretch", "_near", "_own")


def schedule(spark, wanted: DataFrame, total: int, block: int = BLOCK) -> DataFrame:
    """(key, k, amount): the slots of each source of ``wanted`` (key, source, target), in schedule order from 0, and their words.

    The words of a source's slots sum up to its target, to the nearest whole number. Points fall so evenly that a source lacks
    at most a few dozen slots, however many it has.
    """
    edges = Window.partitionBy(F.lit(1)).orderBy(F.col("source").asc_nulls_last())
    upto = F.round(F.sum("target").over(edges) / total * POINTS).cast("long")
    spans = wanted.withColumn("high", upto).withColumn("low", F.coalesce(F.lag("high").over(edges), F.lit(0))).where("high > low")
    strip = POINTS // STRIPS
    spans = spans.select("key", "target", "low", "high", F.explode(F.sequence(F.floor(F.col("low") / strip), F.floor((F.col("high") - 1) / strip))).alias("strip"))
    slots = spark.range(-(-total // block)).select(F.col("id").alias("s"), F.pmod(F.pmod("id", F.lit(POINTS // 2)) * GOLDEN, F.lit(POINTS)).alias("point")).withColumn("strip", F.floor(F.col("point") / strip))
    slots = slots.join(spans, "strip").where("point >= low and point < high").select("key", "target", "s", F.lit(1).alias("one"))
    # Slots of a source with share p lie 1/p apart, so runs of one length in s would be uneven: the run grows with 1/p.
    apart = F.greatest(F.lit(1.0), F.lit(float(total)) / F.col("target"))
    named = _running(slots, "key", F.floor(F.col("s") / (F.lit(RUN) * apart)), ["s"], "one", "k").select("key", "target", "k")
    had = slots.groupBy("key").agg(F.count("*").alias("had"))
    calls_for = F.ceil(F.round("target") / block)
    lacking = wanted.join(had, "key", "left").withColumn("had", F.coalesce("had", F.lit(0))).where(F.col("had") < calls_for)
    lacking = lacking.select("key", "target", F.explode(F.sequence("had", calls_for - 1)).alias("k"))
    amount = F.least(F.lit(block), F.round("target").cast("long") - F.col("k") * block)
    return named.unionByName(lacking).select("key", "k", amount.cast("long").alias("amount")).where("amount > 0")


def mix(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", block: int = BLOCK) -> DataFrame:
    """doc_id, size, source_size, target and taken (words that the mix takes of the document, repeats counted) of every row.

    What is taken of a source's documents sums up to its target, to the nearest whole number, however small the source.

    A null text has size 0 and is never taken. A null source is a source of its own, the last. Rows that repeat are
    shuffled apart only if id or text differ; equal ones share what falls to them in no particular order. Other columns
    are not read; an empty table gives none.
    """
    spark = docs.sparkSession
    shuffled = F.md5(F.concat_ws(":", F.coalesce(F.col(id_col).cast("string"), F.lit("")), F.lit("mix")))
    sized = docs.select(
        F.col(id_col).alias("doc_id"),
        F.col(source_col).cast("string").alias("source"),
        null_safe(source_col).alias("key"),
        F.coalesce(F.regexp_count(F.col(text_col), F.lit(WORD)), F.lit(0)).cast("long").alias("size"),
        F.conv(F.substring(shuffled, 1, 12), 16, 10).cast("long").alias("h"),
    )
    sized = written(sized)
    sizes = sized.groupBy("key").agg(F.first("source").alias("source"), F.sum("size").alias("source_size"), F.count("*").alias("n"))
    wanted = written(targets(sizes, weights))
    total = wanted.agg(F.sum("source_size")).first()[0] or 0
    laid = sized.join(wanted.select("key", "source_size", "target", "n"), "key")
    if not total:
        return laid.select("doc_id", "size", "source_size", "target", F.lit(0).cast("long").alias("taken"))
    run = F.floor(F.col("h") / F.lit(1 << 48) * F.ceil(F.col("n") / RUN))
    laid = written(_running(laid, "key", run, ["h", "doc_id", "size"], "size", "start"))
    # What each document has in each block of the tape: once for each time that the tape has passed it before it ends.
    ends = F.round("target").cast("long")
    passes = F.sequence(F.lit(0).cast("long"), F.floor((ends - 1 - F.col("start")) / F.col("source_size")))
    pieces = laid.where((F.col("size") > 0) & (F.col("start") < ends)).select("key", "start", "size", "source_size", ends.alias("stop"), F.explode(passes).alias("times"))
    pieces = pieces.withColumn("begin", F.col("start") + F.col("times") * F.col("source_size")).withColumn("end", F.least(F.col("begin") + F.col("size"), "stop"))
    pieces = pieces.select("key", "start", "size", "begin", "end", F.explode(F.sequence(F.floor(F.col("begin") / block), F.floor((F.col("end") - 1) / block))).alias("k"))
    slots = schedule(spark, wanted.select("key", "source", "target"), total, block)
    words = F.least(F.col("end"), F.col("k") * block + F.col("amount")) - F.greatest(F.col("begin"), F.col("k") * block)
    taken = pieces.join(slots, ["key", "k"]).withColumn("words", words).groupBy("key", "start", "size").agg(F.sum("words").alias("taken"))
    out = laid.join(taken, ["key", "start", "size"], "left")
    return out.select("doc_id", "size", "source_size", "target", F.coalesce("taken", F.lit(0)).cast("long").alias("taken"))


def repeated(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", block: int = BLOCK) -> DataFrame:
    """``docs`` with every row as often as the mix takes it, to the nearest whole number. Columns stay as they are.

    Rows that repeat an id are taken as one document would be: by the mean of what the mix takes of them.
    """
    times = mix(docs, weights, id_col, text_col, source_col, block).groupBy("doc_id").agg(F.round(F.sum("taken") / F.greatest(F.sum("size"), F.lit(1))).cast("int").alias("_times"))
    times = written(times.where("_times > 0"))
    rows = docs.select(F.struct("*").alias("row"), F.col(id_col).alias("id"))
    # Counts are the smaller side at every size: hashed by partition, so that no text is sorted.
    joined = rows.join(times.hint("shuffle_hash"), rows["id"].eqNullSafe(times["doc_id"]))
    return joined.select("row", F.explode(F.sequence(F.lit(1), F.col("_times")))).select("row.*")


def oracle(weights: tuple[int, ...] = WEIGHTS) -> str:
    """DuckDB SQL of :func:`mix`, without slots: a source's words in shuffled order, over and over, up to its target."""
    return f"""
WITH d AS (SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) AS BIGINT) AS size,
  CAST(('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), '') || ':mix'), 1, 12)) AS BIGINT) AS h FROM documents),
s AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS place FROM d GROUP BY source),
w AS (SELECT *, {list(weights)}[place % {len(weights)} + 1] AS weight, source_size * {MOST} AS most FROM s),
l AS (SELECT *, sum(source_size) OVER () - coalesce(sum(most) OVER f, 0) AS rest, sum(weight) OVER () - coalesce(sum(weight) OVER f, 0) AS open FROM w
  WINDOW f AS (ORDER BY most / weight, place ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
v AS (SELECT CAST(arg_min(CAST(rest AS DOUBLE) / CAST(open AS DOUBLE), (CAST(most AS DOUBLE) / weight, place)) AS DOUBLE) AS level FROM l WHERE most * open >= rest * weight),
t AS (SELECT source, place, source_size, CASE WHEN most <= level * weight THEN CAST(most AS DOUBLE) ELSE level * weight END AS target FROM w, v),
laid AS (SELECT d.*, t.source_size, t.target, CAST(round(t.target) AS BIGINT) AS words,
  coalesce(sum(size) OVER (PARTITION BY t.place ORDER BY h, doc_id, size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS start FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size, source_size, target,
  CAST(CASE WHEN size > 0 THEN words // source_size * size + greatest(0, least(size, words % source_size - start)) ELSE 0 END AS BIGINT) AS taken FROM laid"""
