"""What several operators share: reading tables, the shared folder, the split into training rows."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A given table, by Spark's own reader."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_folder(spark: SparkSession) -> str:
    """Folder that driver and executors share: ``spark.checkpoint.dir``, or the warehouse where that is unset."""
    context = spark.sparkContext
    configured = context.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    root = configured or context.getCheckpointDir() or f"{spark.conf.get('spark.sql.warehouse.dir')}/_shared"
    return f"{root}/llm/{context.applicationId}"


def written(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: lineage is cut and survives lost executors."""
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex[:12]}"
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def held_out(column: str, modulus: int, remainder: int) -> Column:
    """Whether crc32 of the id's text leaves ``remainder``; a null id is never held out."""
    digest = F.crc32(F.col(column).cast("string").cast("binary"))
    return F.coalesce(digest % modulus == remainder, F.lit(False))
