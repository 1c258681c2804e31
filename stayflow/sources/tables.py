"""Lake tables: dated partitions for daily facts, batch partitions for what is only added to."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def path_exists(spark: SparkSession, path: str) -> bool:
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()).exists(where)


def scan_core_reservations(df: DataFrame, snapshot_date: date, horizon_days: int = 730) -> DataFrame:
    """Reservations still touching the stay horizon; null dates drop out here."""
    from stayflow.operators.filters import horizon

    return horizon(df, snapshot_date, horizon_days)


def read_daily_snapshot(spark: SparkSession, path: str, dates: list[date]) -> DataFrame:
    """Only the partitions of the given snapshot dates."""
    from stayflow.schemas import DAILY_SNAPSHOT

    return spark.read.schema(DAILY_SNAPSHOT).parquet(path).where(F.col("snapshot_date").isin(list(dates)))


def write_dated(df: DataFrame, path: str) -> None:
    """Replace exactly the ``snapshot_date`` partitions present in ``df``."""
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("snapshot_date").parquet(path)


def write_changes(df: DataFrame, path: str, batch_id: int) -> None:
    """Write the rows a batch changed as partition ``batch_id``; a replay overwrites it.

    Writing costs what the batch has, not what the table has.
    """
    (
        df.withColumn("batch_id", F.lit(batch_id).cast("bigint"))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("batch_id")
        .parquet(path)
    )
