"""Stay-night snapshots: one row per reservation and remaining night."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stayflow.functions import jsontree as J
from stayflow.functions import scalars as S
from stayflow.operators.filters import horizon
from stayflow.schemas import SEGMENTS

# Payload members read by name, and the lists that hold dated entries.
PAYLOAD_NAMES = [
    "rooms",
    "numberOfRooms",
    "roomRevenue",
    "rateAmount",
    "totalRevenue",
    "confirmationNo",
    "roomType",
    "rateCode",
    "marketCode",
    "sourceCode",
    "channelCode",
    "reservationStatus",
    "createdDate",
    "createDate",
    "cancelledDate",
    "arrivalDate",
    "departureDate",
]
DATED_LISTS = ["dailyRates", "roomRates", "rateDetails", "stayDetails"]
DATE_NAMES = ["stayDate", "businessDate", "date"]

CORE_COLUMNS = [
    "hotel_id",
    "reservation_id",
    "confirmation_no",
    "arrival_date",
    "departure_date",
    "reservation_status",
    "source_updated_at",
    "last_event_id",
    "last_event_at",
    "deleted_at",
]


def latest_payload_per_reservation(raw: DataFrame) -> DataFrame:
    """Newest reservation payload per resource, by fetch time then arrival.

    An aggregate keeps one candidate per task before the shuffle, so a
    resource fetched millions of times costs no more than any other.
    """
    mine = raw.where(F.col("resource_type") == "reservation")
    newest = F.max_by("payload", F.struct("fetched_at", "seq"))
    return mine.groupBy("hotel_id", F.col("resource_id").alias("reservation_id")).agg(newest.alias("raw_payload"))


def latest_raw(raw: DataFrame, keys: list[str]) -> DataFrame:
    """Newest row per key by fetch time then arrival."""
    rest = [c for c in raw.columns if c not in keys]
    top = raw.groupBy(*keys).agg(F.max_by(F.struct(*rest), F.struct("fetched_at", "seq")).alias("_row"))
    return top.select(*keys, "_row.*")


def attach_latest_payload(core: DataFrame, raw: DataFrame) -> DataFrame:
    """Core reservations with ``raw_payload``, null where nothing was fetched."""
    return core.join(latest_payload_per_reservation(raw), ["hotel_id", "reservation_id"], "left")


def _dated_entries(text: str, name: str) -> str:
    """Dated entries of one JSON list that carry ``name``, in list order."""
    day = S.iso_date(J.truthy_at("x", *[f"$.{n}" for n in DATE_NAMES]))
    found = J.value_at("x", f"$.{name}")
    objects = f"filter({J.items(J.parse(text))}, x -> {J.is_object('x')})"
    entries = f"transform({objects}, x -> named_struct('day', {day}, 'found', {found}))"
    return f"filter({entries}, e -> e.day is not null and e.found is not null)"


def with_payload_fields(df: DataFrame) -> DataFrame:
    """Parse ``raw_payload`` once: found values ``_p_<name>`` and dated revenue entries ``_rates``."""
    doc = df.selectExpr("*", f"{J.parse('raw_payload')} as _doc")
    doc = doc.selectExpr("*", "case when _doc is not null then raw_payload end as _text")
    # The usual places of the dated list, taken when it is the only such list anywhere.
    usual = ", ".join(J.text_at("_doc", f"$.{p}{n}") for p in ("", "reservation.") for n in DATED_LISTS)
    doc = doc.selectExpr("*", f"{J.mentions('_text', DATED_LISTS)} as _lists")
    doc = doc.selectExpr("*", f"case when _lists = 1 then coalesce({usual}) end as _usual")
    fields = {f"_p_{n}": [n] for n in PAYLOAD_NAMES}
    found = J.search_fields(doc, "_doc", "_text", fields)
    walk = f"case when _lists > 0 and _usual is null then {J.tree_hits('_doc', '_text', DATED_LISTS)} end"
    found = found.selectExpr("*", f"{walk} as _places")
    # Search order: outer objects first, then the fixed order of the four lists.
    rank = "array_position(array(" + ", ".join(J.quoted(n) for n in DATED_LISTS) + "), h.name)"
    lists = "filter(_places, h -> startswith(h.text, '['))"
    ordered = f"array_sort(transform({lists}, h -> named_struct('parent', h.parent, 'rank', {rank}, 'text', h.text)))"
    walked = f"flatten(transform({ordered}, h -> {_dated_entries('h.text', 'roomRevenue')}))"
    rates = f"coalesce({_dated_entries('_usual', 'roomRevenue')}, {walked}, array()) as _rates"
    return found.selectExpr(*[f"`{c}`" for c in df.columns], *fields, rates)


def find_for_date(rates: str, night: str) -> str:
    """First dated entry of the night, as a found value."""
    return f"get(filter({rates}, e -> e.day = {night}), 0).found"


def remaining_nights(arrival: Column, departure: Column, snapshot_date: Column) -> Column:
    """Nights from arrival (or the snapshot date if later) up to the night before departure."""
    first = F.greatest(arrival, snapshot_date)
    return F.when(departure > first, F.sequence(first, F.date_sub(departure, 1)))


def expand_stay_nights(df: DataFrame, snapshot_date: date) -> DataFrame:
    """One row per remaining night; nothing without both dates or with departure not after arrival."""
    nights = remaining_nights(F.col("arrival_date"), F.col("departure_date"), F.lit(snapshot_date))
    valid = df.where(F.col("departure_date") > F.col("arrival_date"))
    return valid.select("*", F.explode(nights).alias("stay_date")).withColumn("snapshot_date", F.lit(snapshot_date))


def observation_dates(snapshot_date: date | Sequence[date]) -> list[date]:
    return [snapshot_date] if isinstance(snapshot_date, date) else sorted(set(snapshot_date))


def project_snapshot(df: DataFrame, snapshot_date: date | Sequence[date], taken_at: Column | None = None, observed: Column | None = None) -> DataFrame:
    """Core rows with ``raw_payload`` to the daily snapshot, one row per remaining night and observation date.

    Reservation-level values are worked out once per reservation and nightly
    revenue once per night, however many dates are asked for; rows multiply
    last. ``observed`` may narrow the dates of a reservation (an array).
    Unreadable numbers set ``reject_reason`` instead of stopping the job.
    """
    dates = observation_dates(snapshot_date)
    if observed is None:
        observed = F.array(*[F.lit(d) for d in dates])
    parsed = with_payload_fields(df).withColumn("_observed", observed)

    def find(*names: str) -> Column:
        return F.expr("coalesce(" + ", ".join(J.truthy(f"_p_{n}") for n in names) + ")")

    def text(name: str) -> Column:
        return F.col(f"_p_{name}")["text"]

    def day(found: str) -> Column:
        return F.expr(S.iso_date(found))

    parsed = parsed.withColumns(
        {
            "_arrival": F.coalesce("arrival_date", day("_p_arrivalDate.text")),
            "_departure": F.coalesce("departure_date", day("_p_departureDate.text")),
        }
    )
    left = remaining_nights(F.col("_arrival"), F.col("_departure"), F.lit(dates[0]))
    parsed = parsed.withColumn("_left", F.when(F.col("_departure") > F.col("_arrival"), left))
    priced_night = f"named_struct('stay_date', n, 'night_revenue', {J.truthy(find_for_date('_rates', 'n'))})"
    seen = "named_struct('snapshot_date', d, 'stay_date', p.stay_date, 'night_revenue', p.night_revenue)"
    nights = F.expr(
        f"flatten(transform(transform(_left, n -> {priced_night}), p -> transform(filter(_observed, d -> d <= p.stay_date), d -> {seen})))"
    )
    per_reservation = parsed.select(
        (F.current_timestamp() if taken_at is None else taken_at).alias("snapshot_taken_at"),
        "hotel_id",
        "reservation_id",
        F.coalesce(S.to_text(F.col("confirmation_no")), text("confirmationNo")).alias("confirmation_no"),
        text("roomType").alias("room_type"),
        text("rateCode").alias("rate_code"),
        text("marketCode").alias("market_code"),
        text("sourceCode").alias("source_code"),
        text("channelCode").alias("channel_code"),
        F.coalesce(S.to_text(F.col("reservation_status")), text("reservationStatus")).alias("reservation_status"),
        F.coalesce(find("rooms", "numberOfRooms"), F.lit("1")).alias("_rooms_text"),
        find("roomRevenue", "rateAmount").alias("_any_revenue"),
        find("totalRevenue").alias("_total"),
        day(f"coalesce({J.truthy('_p_createdDate')}, {J.truthy('_p_createDate')})").alias("created_date"),
        day("_p_cancelledDate.text").alias("cancelled_date"),
        "source_updated_at",
        "last_event_id",
        "last_event_at",
        "deleted_at",
        F.coalesce(F.col("raw_payload"), F.lit("{}")).alias("payload"),
        nights.alias("_nights"),
    )
    nightly = J.fence(per_reservation).select(
        *[c for c in per_reservation.columns if c != "_nights"], F.explode("_nights").alias("_night")
    )
    nightly = nightly.withColumn("_revenue_text", F.coalesce("_night.night_revenue", "_any_revenue", F.lit("0")))
    priced = nightly.withColumns(
        {"_rooms": F.expr(S.to_decimal("_rooms_text")), "_revenue": F.expr(S.to_decimal("_revenue_text"))}
    ).withColumn(
        "_total_revenue", F.when(F.col("_total").isNotNull(), F.expr(S.to_decimal("_total"))).otherwise(F.col("_revenue"))
    )
    unreadable = F.col("_rooms").isNull() | F.col("_revenue").isNull() | F.col("_total_revenue").isNull()
    return priced.select(
        F.col("_night.snapshot_date").alias("snapshot_date"),
        "snapshot_taken_at",
        "hotel_id",
        F.col("_night.stay_date").alias("stay_date"),
        "reservation_id",
        "confirmation_no",
        "room_type",
        "rate_code",
        "market_code",
        "source_code",
        "channel_code",
        "reservation_status",
        F.col("_rooms").cast("decimal(12,4)").alias("rooms"),
        F.col("_revenue").cast(S.MONEY).alias("room_revenue"),
        F.col("_total_revenue").cast(S.MONEY).alias("total_revenue"),
        S.adr(F.col("_revenue"), F.col("_rooms")).cast(S.MONEY).alias("adr"),
        "created_date",
        "cancelled_date",
        "source_updated_at",
        "last_event_id",
        "last_event_at",
        "payload",
        "deleted_at",
        F.when(unreadable, F.lit("unreadable number")).alias("reject_reason"),
    )


def build_daily_snapshot(
    core: DataFrame, raw: DataFrame, snapshot_date: date | Sequence[date], horizon_days: int = 730, taken_at: Column | None = None
) -> DataFrame:
    """Horizon scan, newest payload, night expansion; includes rejected rows with their reason.

    Several dates take one scan of core and raw: a reservation in the horizon of
    any of them is parsed once and observed on each date whose horizon it is in.
    """
    dates = observation_dates(snapshot_date)
    in_scope = horizon(core, dates[0], horizon_days + (dates[-1] - dates[0]).days)
    observed = F.filter(
        F.array(*[F.lit(d) for d in dates]),
        lambda d: (F.col("departure_date") >= d) & (F.col("arrival_date") <= F.date_add(d, horizon_days)),
    )
    return project_snapshot(attach_latest_payload(in_scope.select(*CORE_COLUMNS), raw), dates, taken_at, observed)


def coalesce_segments(df: DataFrame, segments: list[str] | None = None) -> DataFrame:
    """Segments without a code report as ``UNMAPPED``."""
    return df.fillna("UNMAPPED", subset=SEGMENTS if segments is None else segments)
