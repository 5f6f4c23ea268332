"""Aggregates that are compositions of built-in ones."""

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def percentage(part: Column, whole: Column, digits: int = 1) -> Column:
    return F.when(whole > 0, F.round(100.0 * part / whole, digits))


def wilson_lower(k: Column, n: Column, z: float = 1.96) -> Column:
    """The lower end of Wilson's interval for k successes in n; 0 for none."""
    p = k / n
    centre, spread = p + z * z / (2 * n), z * F.sqrt(p * (1 - p) / n + z * z / (4 * n * n))
    return F.when(n > 0, (centre - spread) / (1 + z * z / n)).otherwise(F.lit(0.0))


def first_per_group(rows: DataFrame, key: list[str], order: list[str], columns: list[str]) -> DataFrame:
    """The first row of each key by ``order``, as one aggregate with a map-side part and no sort."""
    first = rows.groupBy(*key).agg(F.min_by(F.struct(*columns), F.struct(*order)).alias("_first"))
    return first.select(*key, "_first.*")


def preferred_mode(rows: DataFrame, key: str, value: str, preferred: Column) -> DataFrame:
    """The key's most frequent value among preferred rows, if it has any, else among all; ties go to the least value."""
    counts = rows.where(F.col(value).isNotNull()).groupBy(key, value).agg(F.count("*").alias("n"), F.count_if(preferred).alias("p"))
    order = F.struct((F.col("p") > 0).alias("a"), F.when(F.col("p") > 0, F.col("p")).otherwise(F.col("n")).alias("b"))
    top = counts.groupBy(key).agg(F.max(order).alias("_top"))
    return counts.join(top, key).where(order == F.col("_top")).groupBy(key).agg(F.min(value).alias(value))


def state_intersection(rows: DataFrame, group: str, state: str, value: str, min_states: int = 2) -> DataFrame:
    """(group, value): values that every state of a group with ``min_states`` or more has; a contradiction gives no row."""
    seen = rows.select(group, state, value).distinct()
    states = seen.select(group, state).distinct().groupBy(group).agg(F.count("*").alias("_states"))
    held = seen.groupBy(group, value).agg(F.count("*").alias("_held"))
    return held.join(states, group).where((F.col("_states") >= min_states) & (F.col("_held") == F.col("_states"))).select(group, value)


def concat_distinct(column: str, separator: str = ", ") -> Column:
    return F.array_join(F.array_sort(F.collect_set(column)), separator)


def row_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """(table, n): how many rows each table has."""
    return reduce(DataFrame.unionByName, [df.agg(F.count("*").alias("n")).select(F.lit(name).alias("table"), "n") for name, df in tables.items()])


def confusion(rows: DataFrame, truth: str, found: str) -> DataFrame:
    """(truth, found, n) of every pair of values that occurs."""
    return rows.groupBy(truth, found).agg(F.count("*").alias("n"))


def strongest_route(routes: list[tuple[int, DataFrame]], key: list[str]) -> DataFrame:
    """Rows of several routes, one a key: that of the least priority number."""
    every = reduce(DataFrame.unionByName, [df.withColumn("route", F.lit(k)) for k, df in routes])
    rest = [c for c in every.columns if c not in key and c != "route"]
    best = every.groupBy(*key).agg(F.min(F.struct("route", *rest)).alias("_best"))
    return best.select(*key, "_best.*")
