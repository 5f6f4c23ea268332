"""Rarity-weighted ranking of passages: corpus-wide inverse document frequency, windows, and disjoint best ones."""

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from spoor.functions.text import terms
from spoor.sources.tables import written

#: Width of a ranking window and passages shown; least shared terms; weight of a rare term; slack around sentence ends.
WINDOW, SHOWN, MIN_TERMS, RARE, SLACK = 400, 3, 2, math.log(200), 140


def _score(weight: Column) -> Column:
    """The sum of weights, the same in whatever order: they are added as whole numbers of the tenth decimal."""
    return F.round(F.sum(F.round(weight * 1e10).cast("long")) / 1e10, 6).alias("score")


def idf(docs: DataFrame, id_col: str, text_col: str, stopwords: tuple[str, ...] = ()) -> DataFrame:
    """(term, df, weight) with weight ln(N / df) over all documents."""
    each = docs.select(id_col, F.explode(F.array_distinct(terms(F.col(text_col), stopwords))).alias("term"))
    n = F.lit(docs.count())
    return each.groupBy("term").agg(F.count("*").alias("df")).select("term", "df", F.log(n / F.col("df")).alias("weight"))


def rank_units(
    queries: DataFrame, units: DataFrame, weights: DataFrame, query_id: str, unit_id: str, text_col: str, k: int = SHOWN, min_terms: int = MIN_TERMS, min_rare: int = 0, rare: float = RARE, stopwords: tuple[str, ...] = ()
) -> DataFrame:
    """(query, unit, score, shared, rank): a query's k units of the greatest summed weight of shared terms, ties to the least id."""
    own = queries.select(F.col(query_id), F.explode(F.array_distinct(terms(F.col(text_col), stopwords))).alias("term")).join(weights, "term")
    held = units.select(F.col(unit_id), F.explode(F.array_distinct(terms(F.col(text_col), stopwords))).alias("term"))
    scored = own.join(held, "term").groupBy(query_id, unit_id).agg(
        _score(F.col("weight")), F.count("*").alias("shared"), F.count_if(F.col("weight") >= rare).alias("rare")
    )
    order = Window.partitionBy(query_id).orderBy(F.col("score").desc(), F.col(unit_id))
    kept = scored.where((F.col("shared") >= min_terms) & (F.col("rare") >= min_rare)).withColumn("rank", F.row_number().over(order))
    return kept.where(F.col("rank") <= k).select(query_id, unit_id, "score", "shared", "rank")


def windows(docs: DataFrame, id_col: str, text_col: str, size: int = WINDOW) -> DataFrame:
    """(id, start, w): half-overlapping windows of ``size`` characters; a shorter text is one window."""
    last = F.greatest(F.lit(0), F.length(text_col) - F.lit(size // 2) - 1)
    starts = F.sequence(F.lit(0), last, F.lit(size // 2))
    return docs.where(F.length(text_col) > 0).select(id_col, F.col(text_col).alias("_t"), F.explode(starts).alias("start")).select(id_col, "start", F.substring("_t", F.col("start") + 1, F.lit(size)).alias("w"))


#: A sentence or clause ends with one of these and white space; characters in which a word begins, if no sentence does.
STOP, WORD_REACH = r"[.;:!?]\s", 40


def reframed(docs: DataFrame, hits: DataFrame, id_col: str, text_col: str, size: int = WINDOW, slack: int = SLACK) -> DataFrame:
    """``hits`` (id, start) plus begin, end, clean_begin, clean_end and passage: the window moved to where sentences begin and end.

    A window begins after the last sentence end of the ``slack`` before it, else after the first within as much behind its start,
    else at the next word. It is as long as before at most and ends with the last sentence end in its last ``slack`` characters,
    else before its last word. The text's own ends are clean, as are sentences'; an ellipsis stands where one isn't.
    """
    # What a window can reach is cut out of its text once; a long text is not gone through for every place in it.
    base = F.greatest(F.lit(0), F.col("start") - slack)
    near = F.substring("_t", base + 1, F.lit(size + 2 * slack))
    joined = hits.join(docs.select(id_col, F.col(text_col).alias("_t"), F.length(text_col).alias("_total")), id_col).withColumns({"_near": near, "_base": base}).drop("_t")
    part = lambda start, stop: F.substring("_near", start - F.col("_base") + 1, F.greatest(stop - start, F.lit(0)))
    extent = lambda text, pattern, group=0: F.length(F.regexp_extract(text, pattern, group))
    start, total = F.col("start"), F.col("_total")
    low, stop = F.greatest(F.lit(0), start - slack), F.least(start + size, total)
    back, ahead = extent(part(low, start), f"(?s)^.*{STOP}"), extent(part(start, F.least(start + slack, stop)), f"(?s)^.*?{STOP}")
    word = F.instr(part(start, F.least(start + WORD_REACH, stop)), F.lit(" "))
    begin = F.when(start == 0, 0).when(back > 0, low + back).when(ahead > 0, start + ahead).otherwise(start + word)
    framed = joined.withColumns({"begin": begin.cast("int"), "clean_begin": (start == 0) | (back > 0) | (ahead > 0)})
    whole = F.least(F.col("begin") + size, total)
    late = F.greatest(F.col("begin"), whole - slack)
    last, gap = extent(part(late, whole), f"(?s)^(.*{STOP[:-2]})\\s", 1), extent(part(F.col("begin"), whole), "(?s)^(.*) ", 1)
    end = F.when(whole == total, whole).when(last > 0, late + last).when(gap > 0, F.col("begin") + gap).otherwise(whole)
    framed = framed.withColumns({"end": end.cast("int"), "clean_end": (whole == total) | (last > 0)})
    dots = lambda clean: F.when(F.col(clean), "").otherwise("…")
    body = F.trim(F.regexp_replace(part(F.col("begin"), F.col("end")), r"\s+", " "))
    return framed.withColumn("passage", F.concat(dots("clean_begin"), body, dots("clean_end"))).drop("_near", "_base", "_total")


def disjoint_top(scored: DataFrame, keys: list[str], size: int = WINDOW, k: int = SHOWN) -> DataFrame:
    """Greedily the best windows of each key by score, then start, of which no two overlap, with their ``rank``.

    ``k`` rounds of an aggregate and a filter, so that a key's windows need not meet in one task's memory. The scores are written
    once, as each round reads what the ones before left.
    """
    left, out = written(scored), None
    for rank in range(1, k + 1):
        best = left.groupBy(*keys).agg(F.max(F.struct("score", (-F.col("start")).alias("s"))).alias("_b")).select(*keys, F.col("_b.score").alias("score"), (-F.col("_b.s")).alias("start"))
        out = best.withColumn("rank", F.lit(rank)) if out is None else out.unionByName(best.withColumn("rank", F.lit(rank)))
        taken = best.select(*keys, F.col("start").alias("_taken"))
        left = left.join(taken, keys).where(F.abs(F.col("start") - F.col("_taken")) >= size).drop("_taken")
    return out


def rank_windows(
    queries: DataFrame, docs: DataFrame, weights: DataFrame, query_id: str, doc_id: str, text_col: str, size: int = WINDOW, k: int = SHOWN, min_terms: int = MIN_TERMS, stopwords: tuple[str, ...] = ()
) -> DataFrame:
    """(query, doc, start, score, rank): the k best disjoint windows of a query in each document.

    The queries' weighted terms are written first, so that Spark knows their size: if they are few, windows meet them where they
    are read, and no term of a window that nobody asks for is shuffled.
    """
    own = written(queries.select(query_id, F.explode(F.array_distinct(terms(F.col(text_col), stopwords))).alias("term")).join(weights, "term"))
    held = windows(docs, doc_id, text_col, size).select(doc_id, "start", F.explode(F.array_distinct(terms(F.col("w"), stopwords))).alias("term"))
    scored = own.join(held, "term").groupBy(query_id, doc_id, "start").agg(_score(F.col("weight")), F.count("*").alias("shared"))
    return disjoint_top(scored.where(F.col("shared") >= min_terms).drop("shared"), [query_id, doc_id], size, k)
