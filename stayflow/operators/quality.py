"""Checks for the constraints the tables declare; each returns the offending rows."""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stayflow.schemas import EVENT_STATUSES


def check_unique(df: DataFrame, keys: list[str], where: Column | None = None) -> DataFrame:
    """Keys that occur more than once, among the rows ``where`` applies to."""
    rows = df if where is None else df.where(where)
    return rows.groupBy(*keys).agg(F.count("*").alias("copies")).where("copies > 1")


def check_not_null(df: DataFrame, columns: list[str]) -> DataFrame:
    return df.where(reduce(or_, [F.col(c).isNull() for c in columns]))


def check_status_domain(df: DataFrame, column: str = "status", allowed: list[str] | None = None) -> DataFrame:
    """Rows with a status outside the list; a null passes, as in a CHECK."""
    return df.where(~F.col(column).isin(EVENT_STATUSES if allowed is None else allowed))


def check_foreign_key(child: DataFrame, parent: DataFrame, column: str) -> DataFrame:
    """Child rows whose non-null reference has no parent."""
    return child.where(F.col(column).isNotNull()).join(parent.select(column), column, "left_anti")


def apply_defaults(df: DataFrame, defaults: dict[str, object]) -> DataFrame:
    """Fill nulls; a default may be a literal or a column."""
    filled = {
        name: F.coalesce(F.col(name), value if isinstance(value, Column) else F.lit(value)).cast(df.schema[name].dataType)
        for name, value in defaults.items()
        if name in df.columns
    }
    return df.withColumns(filled)


def reconcile_counts(counts: DataFrame) -> DataFrame:
    """Compare every count of ``storage_counts`` with the completed events."""
    expected = counts.where("name = 'events_completed'").select("rows").scalar()
    return counts.where("name <> 'daily_snapshot_rows'").select(
        "name", "rows", (F.col("rows") - expected).alias("difference"), (F.col("rows") == expected).alias("matches")
    )
