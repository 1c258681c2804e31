"""The analysts' reports over last status."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stayflow.operators.filters import arrivals_on, as_of, hotel_filter, in_status
from stayflow.operators.snapshot import coalesce_segments
from stayflow.schemas import OFF_BOOKS

DETAIL_COLUMNS = [
    "snapshot_date",
    "hotel_id",
    "reservation_id",
    "confirmation_no",
    "arrival_date",
    "departure_date",
    "last_status",
    "last_status_event_at",
    "room_type",
    "rate_code",
    "market_code",
    "source_code",
    "channel_code",
]


def order_report(df: DataFrame, *by: str) -> DataFrame:
    """Order a finished report; ``-name`` sorts descending."""
    return df.orderBy(*[F.desc(c[1:]) if c.startswith("-") else F.asc(c) for c in by])


def _counted(df: DataFrame, name: str = "reservations") -> DataFrame:
    return df.groupBy("hotel_id", "last_status").agg(F.count("*").alias(name))


def status_by_hotel(status: DataFrame, day: date) -> DataFrame:
    return order_report(_counted(as_of(status, day)), "hotel_id", "-reservations")


def cancelled_noshow_by_hotel(status: DataFrame, day: date) -> DataFrame:
    return order_report(_counted(in_status(as_of(status, day), OFF_BOOKS)), "hotel_id", "last_status")


def arrivals_by_status(status: DataFrame, day: date) -> DataFrame:
    return order_report(_counted(arrivals_on(as_of(status, day), day), "arrivals"), "hotel_id", "-arrivals")


def inhouse_checkedout(status: DataFrame, day: date) -> DataFrame:
    return order_report(_counted(in_status(as_of(status, day), ["CHECKED_IN", "CHECKED_OUT"])), "hotel_id", "last_status")


def status_by_segment(status: DataFrame, day: date) -> DataFrame:
    segments = ["market_code", "channel_code", "source_code"]
    mapped = coalesce_segments(as_of(status, day), segments)
    counted = mapped.groupBy("hotel_id", *segments, "last_status").agg(F.count("*").alias("reservations"))
    return order_report(counted, "-reservations")


def hotel_detail(status: DataFrame, day: date, hotel_id: str) -> DataFrame:
    rows = hotel_filter(as_of(status, day), hotel_id).select(*DETAIL_COLUMNS)
    return order_report(rows, "arrival_date", "reservation_id")


def status_as_of(status: DataFrame, day: date) -> DataFrame:
    """The report as it stood on a past date."""
    rows = as_of(status, day).select(
        "hotel_id", "reservation_id", "confirmation_no", "arrival_date", "departure_date", "last_status", "last_status_event_at"
    )
    return order_report(rows, "hotel_id", "arrival_date", "reservation_id")
