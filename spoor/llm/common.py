"""What the operators of this subpackage share."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spoor.sources.tables import shared_dir, table, written

__all__ = ["BLANKS", "WORD", "dealt_anew", "null_safe", "shared_dir", "table", "written"]

#: ASCII white space between words, and a word, as regular expressions of the JVM.
BLANKS = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]+"


def dealt_anew(df: DataFrame) -> DataFrame:
    """Even out partitions and forget their key, so that a following join may split what is skewed."""
    return df.hint("rebalance")


def null_safe(column: str) -> Column:
    """A join key that is never null: equal for equal values, and for nulls."""
    return F.concat(F.when(F.col(column).isNull(), F.lit("n")).otherwise(F.lit("v")), F.coalesce(F.col(column).cast("string"), F.lit("")))
