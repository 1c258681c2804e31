"""Booking pickup: what changed on the books between observation dates.

All comparisons are left-anchored on today's rows: a night that is gone today
adds no negative pickup (``cancellations_since`` and ``changed_between`` report
those). Earlier observations are first folded to one row per reservation night
with a column set per horizon, so today's rows are shuffled once and joined
once however many horizons are asked for, and the horizons only become rows
after aggregation.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stayflow.functions import scalars as S
from stayflow.operators.filters import active_only, active_only_strict, in_status, stay_between
from stayflow.operators.snapshot import coalesce_segments, observation_dates
from stayflow.schemas import OFF_BOOKS, SEGMENTS

NIGHT = ["hotel_id", "reservation_id", "stay_date"]
MEASURES = ["rooms", "room_revenue", "total_revenue"]


def _on(snapshot: DataFrame, day: date) -> DataFrame:
    return snapshot.where(F.col("snapshot_date") == F.lit(day))


def previous_by_horizon(snapshot: DataFrame, day: date, horizons: Sequence[int], measures: Sequence[str], active: bool) -> DataFrame:
    """Earlier observations per reservation night: ``<measure>_<days>`` for each horizon.

    A night occurs once per observation date, so the sums only move values into
    columns.
    """
    lags = {n: day - timedelta(days=n) for n in horizons}
    old = snapshot.where(F.col("snapshot_date").isin(sorted(set(lags.values()))))
    if active:
        old = active_only(old)
    cells = [
        F.sum(F.when(F.col("snapshot_date") == F.lit(seen), F.col(m))).alias(f"{m}_{n}")
        for n, seen in lags.items()
        for m in measures
    ]
    return old.groupBy(*NIGHT).agg(*cells)


def previous_by_date(snapshot: DataFrame, dates: Sequence[date], measures: Sequence[str]) -> DataFrame:
    """Active earlier observations per reservation night as a list ``_past``, one entry per date it was seen on.

    The list is as long as the dates asked for at most.
    """
    old = active_only(snapshot.where(F.col("snapshot_date").isin(sorted(set(dates)))))
    per_date = old.groupBy(*NIGHT, "snapshot_date").agg(*[F.sum(m).alias(m) for m in measures])
    return per_date.groupBy(*NIGHT).agg(F.collect_list(F.struct("snapshot_date", *measures)).alias("_past"))


def pickup_join(today: DataFrame, previous: DataFrame) -> DataFrame:
    """Today's nights with what earlier observations held for them; unmatched stay null."""
    return today.join(previous, NIGHT, "left")


def _was(measure: str, days: int) -> Column:
    return F.coalesce(F.col(f"{measure}_{days}"), F.lit(0))


def pickup_self_join(snapshot: DataFrame, day: date, days: int) -> DataFrame:
    """Active nights of ``day`` beside their active state ``days`` earlier (zero where there is none)."""
    today = active_only(_on(snapshot, day))
    joined = pickup_join(today, previous_by_horizon(snapshot, day, [days], MEASURES, active=True))
    return joined.select(
        *today.columns,
        *[_was(m, days).cast(today.schema[m].dataType).alias(f"{m}_previous") for m in MEASURES],
    )


def pickup_metric(
    snapshot: DataFrame, snapshot_date: date | Sequence[date], days: Sequence[int], calculated_at: Column | None = None
) -> DataFrame:
    """The pickup table: on books, previous and pickup per segment for every horizon, of one date or of several at once."""
    horizons = list(dict.fromkeys(days))
    keys = ["snapshot_date", "hotel_id", "stay_date", *SEGMENTS]
    dates = observation_dates(snapshot_date)
    if len(dates) == 1:
        today = active_only(_on(snapshot, dates[0])).select(*keys, "reservation_id", *MEASURES)
        joined = pickup_join(today, previous_by_horizon(snapshot, dates[0], horizons, MEASURES, active=True))
    else:
        today = active_only(snapshot.where(F.col("snapshot_date").isin(dates))).select(*keys, "reservation_id", *MEASURES)
        seen = [d - timedelta(days=n) for d in dates for n in horizons]
        past = pickup_join(today, previous_by_date(snapshot, seen, MEASURES))
        for n in horizons:
            past = past.withColumn(f"_at_{n}", F.expr(f"get(filter(_past, p -> p.snapshot_date = date_sub(snapshot_date, {n})), 0)"))
        joined = past.select(*today.columns, *[F.col(f"_at_{n}.{m}").alias(f"{m}_{n}") for n in horizons for m in MEASURES])
    sums = [F.sum(m).alias(f"_now_{m}") for m in MEASURES]
    sums += [F.sum(_was(m, n)).alias(f"_was_{m}_{n}") for n in horizons for m in MEASURES]
    # Codes are unified before grouping: an absent code and a literal UNMAPPED are one segment.
    summed = coalesce_segments(joined).groupBy(*keys).agg(*sums)
    sets = [
        F.struct(F.lit(n).alias("comparison_days"), *[F.col(f"_was_{m}_{n}").alias(m) for m in MEASURES])
        for n in horizons
    ]
    rows = summed.withColumn("_old", F.explode(F.array(*sets)))

    def now(m: str) -> Column:
        return F.col(f"_now_{m}")

    def was(m: str) -> Column:
        return F.col(f"_old.{m}")

    def money(value: Column, name: str) -> Column:
        return value.cast(S.MONEY).alias(name)

    return rows.select(
        "snapshot_date",
        F.col("_old.comparison_days").alias("comparison_days"),
        (F.current_timestamp() if calculated_at is None else calculated_at).alias("calculated_at"),
        "hotel_id",
        "stay_date",
        *SEGMENTS,
        money(now("rooms"), "rooms_on_books"),
        money(was("rooms"), "rooms_on_books_previous"),
        money(now("rooms") - was("rooms"), "pickup_rooms"),
        money(now("room_revenue"), "room_revenue_on_books"),
        money(was("room_revenue"), "room_revenue_previous"),
        money(now("room_revenue") - was("room_revenue"), "pickup_room_revenue"),
        money(now("total_revenue"), "total_revenue_on_books"),
        money(was("total_revenue"), "total_revenue_previous"),
        money(now("total_revenue") - was("total_revenue"), "pickup_total_revenue"),
        money(S.adr(now("room_revenue"), now("rooms")), "adr_on_books"),
        money(S.adr(now("room_revenue") - was("room_revenue"), now("rooms") - was("rooms")), "pickup_adr"),
    )


def pickup_rooms_by_segment(snapshot: DataFrame, day: date, days: Sequence[int] = (1, 3, 7, 15)) -> DataFrame:
    """Rooms picked up over several horizons side by side, by night, market and channel."""
    today = active_only_strict(_on(snapshot, day))
    joined = pickup_join(today, previous_by_horizon(snapshot, day, days, ["rooms"], active=False))
    return joined.groupBy("hotel_id", "stay_date", "market_code", "channel_code").agg(
        *[F.sum(F.col("rooms") - _was("rooms", n)).alias(f"pickup_rooms_{n}d") for n in days]
    )


def pickup_revenue_adr(snapshot: DataFrame, day: date, days: int = 7) -> DataFrame:
    """Revenue, rooms and rate picked up, by night and market; no status is filtered out."""
    joined = pickup_join(_on(snapshot, day), previous_by_horizon(snapshot, day, [days], ["rooms", "room_revenue"], active=False))
    summed = joined.groupBy("hotel_id", "stay_date", "market_code").agg(
        F.sum(F.col("room_revenue") - _was("room_revenue", days)).alias(f"pickup_room_revenue_{days}d"),
        F.sum(F.col("rooms") - _was("rooms", days)).alias(f"pickup_rooms_{days}d"),
    )
    rate = S.adr(F.col(f"pickup_room_revenue_{days}d"), F.col(f"pickup_rooms_{days}d")).cast(S.MONEY)
    return summed.withColumn(f"pickup_adr_{days}d", rate)


def rooms_on_books(snapshot: DataFrame, day: date) -> DataFrame:
    booked = active_only_strict(_on(snapshot, day))
    summed = booked.groupBy("hotel_id", "stay_date").agg(
        F.sum("rooms").alias("rooms_on_books"), F.sum("room_revenue").alias("room_revenue_on_books")
    )
    rate = S.adr(F.col("room_revenue_on_books"), F.col("rooms_on_books")).cast(S.MONEY)
    return summed.withColumn("adr_on_books", rate)


def pickup_by_channel(snapshot: DataFrame, day: date, days: int = 15, window: int = 90) -> DataFrame:
    """Rooms and total revenue picked up for stays in the next ``window`` days, by channel, market and source."""
    today = stay_between(_on(snapshot, day), day, day + timedelta(days=window))
    joined = pickup_join(today, previous_by_horizon(snapshot, day, [days], ["rooms", "total_revenue"], active=False))
    return joined.groupBy("hotel_id", "channel_code", "market_code", "source_code").agg(
        F.sum(F.col("rooms") - _was("rooms", days)).alias(f"pickup_rooms_{days}d"),
        F.sum(F.col("total_revenue") - _was("total_revenue", days)).alias(f"pickup_total_revenue_{days}d"),
    )


def top_segments(snapshot: DataFrame, day: date, n: int, days: int = 15, window: int = 90) -> DataFrame:
    """The ``n`` segments with most revenue picked up; equal revenue is ordered by segment."""
    segments = pickup_by_channel(snapshot, day, days, window)
    ties = [F.asc_nulls_last(c) for c in ("hotel_id", "channel_code", "market_code", "source_code")]
    return segments.orderBy(F.desc(f"pickup_total_revenue_{days}d"), *ties).limit(n)


def cancellations_since(snapshot: DataFrame, day: date, days: int = 7) -> DataFrame:
    """Nights cancelled or no-show today that were on the books ``days`` earlier, with the old revenue."""
    gone = in_status(_on(snapshot, day), OFF_BOOKS, "reservation_status")
    before = active_only_strict(_on(snapshot, day - timedelta(days=days)))
    return gone.join(before.select(*NIGHT, F.col("room_revenue").alias("old_room_revenue")), NIGHT, "inner")


def cancellations(snapshot: DataFrame, day: date, days: int = 7) -> DataFrame:
    lost = F.sum(F.coalesce("old_room_revenue", F.lit(0)))
    return cancellations_since(snapshot, day, days).groupBy("hotel_id", "stay_date", "market_code").agg(
        F.count("*").alias(f"cancellations_since_{days}d"),
        lost.alias(f"cancelled_room_revenue_since_{days}d"),
    )


def changed_between(snapshot: DataFrame, first: date, second: date) -> DataFrame:
    """Nights that are new, removed or modified between two observations.

    One grouping over both dates instead of a full outer join.
    """
    compared = ["reservation_status", "rooms", "room_revenue", "total_revenue"]
    both = snapshot.where(F.col("snapshot_date").isin([first, second]))

    def side(day: date, name: str) -> Column:
        state = F.when(F.col("snapshot_date") == F.lit(day), F.struct(*compared))
        return F.max(state).alias(name)

    paired = both.groupBy(*NIGHT).agg(side(first, "before"), side(second, "after"))
    kind = (
        F.when(F.col("before").isNull(), "new")
        .when(F.col("after").isNull(), "removed")
        .when(~F.col("before").eqNullSafe(F.col("after")), "modified")
    )
    return paired.withColumn("change", kind).where(F.col("change").isNotNull()).select(
        *NIGHT,
        "change",
        F.col("before.reservation_status").alias("status_before"),
        F.col("after.reservation_status").alias("status_after"),
        F.col("before.room_revenue").alias("revenue_before"),
        F.col("after.room_revenue").alias("revenue_after"),
    )


