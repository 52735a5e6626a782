"""The shared work folder, where lineage is cut by written tables."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def work_folder(spark: SparkSession) -> str:
    """The folder that driver and executors share: `spark.checkpoint.dir`, or for a local master without it a new temporary one."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        folder = tempfile.mkdtemp(prefix="spark-", dir="/tmp")
        spark.conf.set("spark.checkpoint.dir", folder)
    return folder


def store(df: DataFrame, name: str) -> DataFrame:
    """`df`, written once to the shared work folder and read back: later stages don't repeat its work, and a lost executor costs only the tasks it ran."""
    spark = df.sparkSession
    path = f"{work_folder(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def spread(rows: DataFrame, parallelism: int | None = None) -> DataFrame:
    """`rows` dealt evenly to `parallelism` tasks, by default as many as shuffles have: where a row takes long however few bytes it has, a small file's rows mustn't share a task."""
    spark = rows.sparkSession
    return rows.repartition(parallelism or max(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism))


def range_parts(df: DataFrame, name: str, *order: Column | str, n: int | None = None) -> tuple[DataFrame, int]:
    """`df`, written in ranges of `order` with the number of each row's range in `part`, and how many ranges there may be. Rows with equal keys share a range."""
    n = n or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return store(df.repartitionByRange(n, *order).withColumn("part", F.spark_partition_id()), name), n
