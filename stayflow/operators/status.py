"""Last status: one row per reservation and snapshot date."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stayflow.schemas import LAST_STATUS_KEY

_CARRIED = [
    "confirmation_no",
    "reservation_status",
    "last_event_id",
    "room_type",
    "rate_code",
    "market_code",
    "source_code",
    "channel_code",
    "payload",
    "deleted_at",
]
CURRENT_COLUMNS = [
    "snapshot_date",
    "snapshot_taken_at",
    "hotel_id",
    "reservation_id",
    "confirmation_no",
    "arrival_date",
    "departure_date",
    "last_status",
    "last_status_event_at",
    "last_event_id",
    "room_type",
    "rate_code",
    "market_code",
    "source_code",
    "channel_code",
    "source_updated_at",
]


def last_status_label(status: Column, deleted_at: Column) -> Column:
    return F.when(deleted_at.isNotNull(), F.lit("DELETED")).otherwise(status)


def last_status(snapshot: DataFrame, snapshot_date: date | None = None, taken_at: Column | None = None) -> DataFrame:
    """Fold a reservation's nights into one row; no status is filtered out.

    The carried columns come from the night with the latest event, earliest
    night first among equals, unknown event times last. One aggregate gives
    bounds and carried row together; nights of a stay lie side by side, so most
    of the folding happens before the shuffle.
    """
    nights = snapshot if snapshot_date is None else snapshot.where(F.col("snapshot_date") == F.lit(snapshot_date))
    # Structs order nulls first, so in a descending pick unknown times come last.
    order = F.struct(F.col("last_event_at"), (-F.unix_date("stay_date")).alias("early"))
    folded = nights.groupBy(*LAST_STATUS_KEY).agg(
        F.min("stay_date").alias("arrival_date"),
        F.date_add(F.max("stay_date"), 1).alias("departure_date"),
        F.max("last_event_at").alias("last_status_event_at"),
        F.max("source_updated_at").alias("source_updated_at"),
        F.max_by(F.struct(*_CARRIED), order).alias("_row"),
    )
    return folded.select(
        "snapshot_date",
        (F.current_timestamp() if taken_at is None else taken_at).alias("snapshot_taken_at"),
        "hotel_id",
        "reservation_id",
        F.col("_row.confirmation_no").alias("confirmation_no"),
        "arrival_date",
        "departure_date",
        last_status_label(F.col("_row.reservation_status"), F.col("_row.deleted_at")).alias("last_status"),
        "last_status_event_at",
        *[F.col(f"_row.{c}").alias(c) for c in ("last_event_id", "room_type", "rate_code", "market_code", "source_code", "channel_code")],
        "source_updated_at",
        F.col("_row.payload").alias("payload"),
        F.col("_row.deleted_at").alias("deleted_at"),
    )


def current_status_view(df: DataFrame, as_of: date | Column) -> DataFrame:
    """The report columns of one snapshot date (no payload, no deletion time)."""
    day = as_of if isinstance(as_of, Column) else F.lit(as_of)
    return df.where(F.col("snapshot_date") == day).select(*CURRENT_COLUMNS)
