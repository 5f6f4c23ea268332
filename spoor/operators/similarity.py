"""Set similarity of texts, and the best match within blocks."""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from spoor.functions.text import word_trigrams, words


def jaccard(a: Column, b: Column) -> Column:
    """Shared over all members of two arrays; two empty ones are equal."""
    union = F.size(F.array_union(a, b))
    return F.when(union == 0, 1.0).otherwise(F.size(F.array_intersect(a, b)) / union)


def long_words(text: Column, min_len: int = 4) -> Column:
    """Lower-case words of ``min_len`` letters, digits and underscores or more, repeats included."""
    return F.regexp_extract_all(F.lower(text), F.lit(r"(?U)\w{%d,}" % min_len), F.lit(0))


def word_jaccard(a: Column, b: Column, min_len: int = 4) -> Column:
    return jaccard(long_words(a, min_len), long_words(b, min_len))


def similarity_join(left: DataFrame, right: DataFrame, left_id: str, right_id: str, members: str, least: float) -> DataFrame:
    """(left, right, score): every pair whose sets ``members`` (array<string>) have a Jaccard similarity of ``least`` or more.

    Of two such sets each has one of the other's members among its rarest, so only these are joined: of n members, taken from
    the rarest in the right table on, all but ceil(least * n) and one more. That is exact, as what shares none of them lies
    below ``least``. Empty and null sets are in no pair.
    """
    sets = lambda rows, key: rows.where(F.size(members) > 0).select(key, F.array_distinct(members).alias("_set"))
    left, right = sets(left, left_id), sets(right, right_id)
    held = right.select(F.explode("_set").alias("_m")).groupBy("_m").agg(F.count("*").alias("_df"))

    def rarest(rows: DataFrame, key: str) -> DataFrame:
        each = rows.select(key, F.size("_set").alias("_n"), F.explode("_set").alias("_m")).join(held, "_m", "left")
        order = Window.partitionBy(key).orderBy(F.coalesce("_df", F.lit(0)), "_m")
        kept = F.col("_n") - F.ceil(F.lit(least) * F.col("_n") - F.lit(1e-9)) + 1
        return each.withColumn("_k", F.row_number().over(order)).where(F.col("_k") <= kept).select(key, "_m", "_n")

    a, b = rarest(left, left_id), rarest(right, right_id).withColumnRenamed("_n", "_of")
    fits = F.least("_n", "_of") >= least * F.greatest("_n", "_of") - 1e-9
    pairs = a.join(b, "_m").where(fits).select(left_id, right_id).distinct()
    both = pairs.join(left, left_id).join(right.withColumnRenamed("_set", "_other"), right_id)
    return both.select(left_id, right_id, jaccard(F.col("_set"), F.col("_other")).alias("score")).where(F.col("score") >= least)


def best_of(scored: DataFrame, left_id: str, right_id: str, least: float) -> DataFrame:
    """(left, right, score, runner_up) of each left row's best pair at ``least`` or above; ties go to the greater right id."""
    order = Window.partitionBy(left_id).orderBy(F.col("score").desc(), F.col(right_id).desc())
    two = scored.withColumn("_n", F.row_number().over(order)).where("_n <= 2")
    best = two.groupBy(left_id).agg(
        *[F.max(F.when(F.col("_n") == 1, F.col(c))).alias(c) for c in (right_id, "score")], F.max(F.when(F.col("_n") == 2, F.col("score"))).alias("runner_up")
    )
    return best.where(F.col("score") >= least)


def trigram_containment(part: Column, whole: Column, min_words: int = 8) -> Column:
    """The share of a text's word trigrams that another holds; null below ``min_words`` words or without the other."""
    own = word_trigrams(part)
    share = F.size(F.array_intersect(own, word_trigrams(whole))) / F.size(own)
    return F.when((F.size(words(part)) >= min_words) & whole.isNotNull() & (F.size(own) > 0), share)


def best_in_block(left: DataFrame, right: DataFrame, block: str, left_id: str, right_id: str, score: Column, least: float) -> DataFrame:
    """(left, right, score, runner_up) of the best pair of each left row, among rows of the same block that reach ``least``.

    Ties go to the greater right id. Blocks are to be narrow: every pair of one is scored.
    """
    scored = left.join(right, block).withColumn("score", score)
    order = Window.partitionBy(left_id).orderBy(F.col("score").desc(), F.col(right_id).desc())
    ranked = scored.withColumns({"_n": F.row_number().over(order), "runner_up": F.lead("score").over(order)})
    return ranked.where((F.col("_n") == 1) & (F.col("score") >= least)).select(left_id, right_id, "score", "runner_up")


def unique_winner(best: DataFrame, least: float = 0.6, runner_up: float = 0.5) -> DataFrame:
    """Best pairs at ``least`` or above whose runner-up stays below ``runner_up``."""
    return best.where((F.col("score") >= least) & (F.coalesce("runner_up", F.lit(0.0)) < runner_up))
