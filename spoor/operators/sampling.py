"""Reproducible samples: order by the digest of a key."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def digest(*columns: str) -> Column:
    return F.sha2(F.concat_ws("|", *[F.col(c).cast("string") for c in columns]), 256)


def sha_sample(rows: DataFrame, key_cols: list[str], n: int, exclude: DataFrame | None = None) -> DataFrame:
    """The first ``n`` rows by the SHA-256 of their key, of those not yet in ``exclude``; top-n, not a full sort."""
    left = rows if exclude is None else rows.join(exclude, key_cols, "left_anti")
    return left.withColumn("digest", digest(*key_cols)).orderBy("digest", *key_cols).limit(n)
