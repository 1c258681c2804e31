"""Session settings and the shared scratch folder."""

from __future__ import annotations

import itertools
import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    # The JVM never compiles a method of more bytes, and the parse would run interpreted; Spark then projects in small methods.
    "spark.sql.codegen.hugeMethodLimit": "8000",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings every operator relies on."""
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def build_session(master: str = "local[*]", shuffle_partitions: int | None = None) -> SparkSession:
    builder = SparkSession.builder.master(master).appName("stayflow").config("spark.driver.memory", "8g").config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false")
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    return builder.getOrCreate()


def checkpoint_root(spark: SparkSession) -> str:
    """The cluster's shared checkpoint folder.

    A machine-local folder is only ever chosen in local mode, where the one
    machine is the whole cluster; elsewhere the setting has to exist.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        context = spark.sparkContext
        root = context.getCheckpointDir()
        if not root:
            if not context.master.startswith("local"):
                raise ValueError("set spark.checkpoint.dir to a folder every executor can reach")
            root = tempfile.mkdtemp(prefix="stayflow-")
            context.setCheckpointDir(root)
    return root


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path under the shared folder."""
    return f"{checkpoint_root(spark).rstrip('/')}/{label}-{uuid.uuid4().hex[:12]}"


def materialize(df: DataFrame, label: str = "cut", path: str | None = None) -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    The written files outlive any executor, so later stages never recompute
    the lineage behind them.
    """
    spark = df.sparkSession
    path = path or scratch_path(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def spread(df: DataFrame) -> DataFrame:
    """Deal rows out over the cores: however few files they came in, work on every row (JSON above all) runs on all of them."""
    return df.repartition(df.sparkSession.sparkContext.defaultParallelism)


@contextmanager
def scratch(spark: SparkSession) -> Iterator[Callable[..., DataFrame]]:
    """``materialize`` for the length of a batch: what it wrote is removed at the end."""
    root = scratch_path(spark, "batch")
    count = itertools.count()

    def cut(df: DataFrame, label: str = "cut") -> DataFrame:
        return materialize(df, path=f"{root}/{next(count)}-{label}")

    try:
        yield cut
    finally:
        where = spark._jvm.org.apache.hadoop.fs.Path(root)
        where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)
