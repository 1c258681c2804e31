"""Helpers shared by the text operators."""

from __future__ import annotations

import os
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Words of the whitespace kind: everything between space, tab, LF, VT, FF and CR.
BLANKS = " \t\n\x0b\x0c\r"
SPACED_WORD = r"[^\x20\x09-\x0D]+"


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def word_count(text: Column) -> Column:
    """Number of words between blanks; null and empty texts have none."""
    return F.coalesce(F.regexp_count(text, F.lit(SPACED_WORD)).cast("bigint"), F.lit(0).cast("bigint"))


def content_key(text: Column) -> Column:
    """SHA-256 of the UTF-8 bytes as binary; null texts count as empty."""
    return F.unhex(F.sha2(F.coalesce(text, F.lit("")).cast("binary"), 256))


def total_order(*columns: Column) -> list[Column]:
    """Sort keys that put nulls first and leave ties only between equal rows."""
    return [c.asc_nulls_first() for c in columns]


def share_of(key: Column, share: Column) -> Column:
    """Whether a row is in a share of all rows, by a hash of its key: the same rows on every run."""
    return F.pmod(F.xxhash64(F.lit("share"), key), F.lit(1 << 30)) < share * F.lit(float(1 << 30))


def fresh(columns: list[str], name: str) -> str:
    """``name``, or it with underscores in front until no column is called so."""
    taken = {c.lower() for c in columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def importable(spark: SparkSession) -> None:
    """Let workers look for this package where the driver has it; where it is installed on the workers, that changes nothing."""
    here = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    environment = spark.sparkContext.environment
    paths = [p for p in environment.get("PYTHONPATH", "").split(os.pathsep) if p]
    if here not in paths:
        environment["PYTHONPATH"] = os.pathsep.join([*paths, here])


def sliced(batches: Iterator[pa.RecordBatch], rows: int = 256) -> Iterator[pa.RecordBatch]:
    """The same rows, that many at a time: what a task makes of long texts stays small.

    Spark itself bounds the batches by bytes; no setting of the session is touched.
    """
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)
