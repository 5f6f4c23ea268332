"""Sinks: flat exports with a manifest, redaction, and idempotent rebuilds."""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def flattened(rows: DataFrame, columns: list[str]) -> DataFrame:
    """Tabs and line breaks within the columns as spaces, so that a row is a line."""
    return rows.withColumns({c: F.translate(c, "\t\n\r", "   ") for c in columns})


def export_tsv(rows: DataFrame, path: str) -> None:
    """Tab-separated text with a header; nulls are empty, tabs and line breaks in texts are spaces."""
    texts = [c for c, kind in rows.dtypes if kind == "string"]
    flattened(rows, texts).write.mode("overwrite").csv(path, sep="\t", header=True, nullValue="", emptyValue="", quote="")


def withheld(rows: DataFrame, which: Column, column: str, notice: Column) -> DataFrame:
    """A notice in place of the texts that may not be passed on."""
    return rows.withColumn(column, F.when(which, notice).otherwise(F.col(column)))


def shortened_proofs(proofs: DataFrame, column: str = "window", most: int = 60) -> DataFrame:
    return proofs.withColumn(column, F.substring(column, 1, most))


def without_withheld_edges(edges: DataFrame, documents: DataFrame, key: str) -> DataFrame:
    """Strict mode: edges that rest on withheld documents go, and verdicts are to be made anew from what is left."""
    return edges.join(documents.select(key), key, "left_anti")


def manifest(spark: SparkSession, folder: str, pattern: str = "*") -> DataFrame:
    """(file, bytes, sha256) of every file beneath a folder."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", pattern).load(folder)
    return files.select(F.regexp_extract("path", r"[^/]+$", 0).alias("file"), F.col("length").alias("bytes"), F.sha2("content", 256).alias("sha256"))


def replace_partition(rows: DataFrame, path: str, producer: str) -> None:
    """Write a stage's edges over those that it wrote before, and leave other stages' alone."""
    rows.withColumn("producer", F.lit(producer)).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("producer").parquet(path)


def compact(spark: SparkSession, source: str, target: str, files: int) -> None:
    """The same rows in so many files."""
    spark.read.parquet(source).repartition(files).write.mode("overwrite").parquet(target)


def as_json(rows: DataFrame, column: str = "json") -> DataFrame:
    return rows.select(F.to_json(F.struct(*rows.columns)).alias(column))


def journal(spark: SparkSession, path: str, run: str, step: str, status: str, seconds: float, detail: str = "") -> None:
    """Append a step to the journal of a run; line breaks and home folders are taken out of the detail."""
    row = spark.createDataFrame([(run, step, status, float(seconds), detail)], "run string, step string, status string, seconds double, detail string")
    row.withColumn("detail", F.regexp_replace(F.translate("detail", "\t\n\r", "   "), r"/(?:home|root)/[^\s:]*", "~")).coalesce(1).write.mode("append").parquet(path)
