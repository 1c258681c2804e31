"""Row filters over core reservations, stay-night snapshots and last status."""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stayflow.schemas import OFF_BOOKS


def is_active(status: Column | None = None, deleted_at: Column | None = None) -> Column:
    """Not deleted, and not cancelled or no-show; an unknown status counts as active."""
    status = F.col("reservation_status") if status is None else status
    deleted_at = F.col("deleted_at") if deleted_at is None else deleted_at
    return deleted_at.isNull() & ~F.coalesce(status.isin(OFF_BOOKS), F.lit(False))


def active_only(df: DataFrame) -> DataFrame:
    return df.where(is_active())


def active_only_strict(df: DataFrame) -> DataFrame:
    """The analysts' form: an unknown status drops out and deletion is not looked at."""
    return df.where(~F.col("reservation_status").isin(OFF_BOOKS))


def in_status(df: DataFrame, statuses: list[str], column: str = "last_status") -> DataFrame:
    return df.where(F.col(column).isin(list(statuses)))


def arrivals_on(df: DataFrame, day: date) -> DataFrame:
    return df.where(F.col("arrival_date") == F.lit(day))


def stay_between(df: DataFrame, first: date, last: date) -> DataFrame:
    return df.where(F.col("stay_date").between(F.lit(first), F.lit(last)))


def as_of(df: DataFrame, day: date) -> DataFrame:
    return df.where(F.col("snapshot_date") == F.lit(day))


def horizon(df: DataFrame, day: date, days: int = 730) -> DataFrame:
    return df.where((F.col("departure_date") >= F.lit(day)) & (F.col("arrival_date") <= F.lit(day + timedelta(days=days))))


def hotel_filter(df: DataFrame, hotel_id: str) -> DataFrame:
    return df.where(F.col("hotel_id") == hotel_id)
