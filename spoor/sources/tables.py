"""Reading tables, and cutting lineage by a table in the folder that all executors share."""

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder named in ``spark.checkpoint.dir``; where that is unset a new one on this machine, if Spark runs on it alone."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not folder:
        if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
            raise ValueError("spark.checkpoint.dir is not set: it must name a folder that driver and executors share")
        folder = tempfile.mkdtemp(prefix="spoor-checkpoint-")
        spark.sparkContext.setCheckpointDir(folder)
    return folder


def written(df: DataFrame) -> DataFrame:
    """Write a table to the shared folder and read it back: lineage ends here, and a lost executor costs nothing.

    Unlike ``checkpoint()`` the rows are compressed and columnar, and joins on the result are free to deal both sides anew,
    so that adaptive execution can split a hot key.
    """
    path = f"{shared_dir(df.sparkSession)}/spoor-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def spread(df: DataFrame) -> DataFrame:
    """Deal rows anew where a scan has fewer partitions than there are cores, as one small file has; else leave them as read."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df
