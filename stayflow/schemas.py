"""Table schemas and keys."""

from __future__ import annotations

from pyspark.sql.types import (
    ArrayType,
    DataType,
    DateType,
    DecimalType,
    IntegerType,
    LongType,
    MapType,
    StringType,
    StructType,
    TimestampType,
)

_TYPES: dict[str, DataType] = {
    "string": StringType(),
    "timestamp": TimestampType(),
    "date": DateType(),
    "int": IntegerType(),
    "bigint": LongType(),
    "money": DecimalType(18, 4),
    "rooms": DecimalType(12, 4),
}


def _table(columns: str) -> StructType:
    """``"name type, name type"`` to a schema, without needing a session."""
    schema = StructType()
    for column in columns.split(","):
        name, kind = column.split()
        schema.add(name, _TYPES[kind])
    return schema


DETAIL = _table(
    "elementName string, name string, oldValue string, newValue string, value string,"
    " elementType string, elementRole string, elementSequence int, scopeFrom string, scopeTo string"
)

EVENT_V1 = _table(
    "unique_event_id string, hotel_id string, module string, action_type string, occurred_at timestamp,"
    " received_at timestamp, raw_key string, stream_offset string, payload string"
)
BUSINESS_EVENT = (
    _table(
        "unique_event_id string, offset string, primary_key string, module_name string, event_name string,"
        " hotel_id string, chain_code string, occurred_at timestamp"
    )
    .add("details", ArrayType(DETAIL))
    .add("metadata", MapType(StringType(), StringType()))
    .add("payload", StringType())
)
EVENT_LOG = _table(
    "unique_event_id string, chain_code string, hotel_id string, stream_offset string, primary_key string,"
    " module_name string, event_name string, occurred_at timestamp, received_at timestamp,"
    " completed_at timestamp, failed_at timestamp, status string, retry_count int, error_message string,"
    " payload string"
)
#: Which event holds a position of a chain.
EVENT_POSITIONS = _table("slot string, unique_event_id string")
RESOURCE_SNAPSHOT = _table(
    "unique_event_id string, hotel_id string, resource_type string, resource_id string,"
    " operation_id string, fetched_at timestamp, payload string"
)

MESSAGE = _table("message_id string, body string, seq bigint, receive_count int")

_TAIL = (
    " source_updated_at timestamp, last_event_id string, last_event_at timestamp,"
    " created_at timestamp, updated_at timestamp, deleted_at timestamp"
)
RESERVATION = _table(
    "hotel_id string, reservation_id string, confirmation_no string, arrival_date date,"
    " departure_date date, reservation_status string," + _TAIL
)
PROFILE = _table(
    "profile_id string, profile_type string, first_name string, last_name string, email string," + _TAIL
)
FOLIO = _table(
    "hotel_id string, reservation_id string, folio_id string, folio_no string,"
    " balance_amount money, currency_code string," + _TAIL
)
FOLIO_TRANSACTION = _table(
    "hotel_id string, transaction_no string, reservation_id string, folio_id string,"
    " amount money, currency_code string, transaction_code string," + _TAIL
)

DAILY_SNAPSHOT = _table(
    "snapshot_date date, snapshot_taken_at timestamp, hotel_id string, stay_date date,"
    " reservation_id string, confirmation_no string, room_type string, rate_code string,"
    " market_code string, source_code string, channel_code string, reservation_status string,"
    " rooms rooms, room_revenue money, total_revenue money, adr money,"
    " created_date date, cancelled_date date, source_updated_at timestamp, last_event_id string,"
    " last_event_at timestamp, payload string, deleted_at timestamp"
)
LAST_STATUS = _table(
    "snapshot_date date, snapshot_taken_at timestamp, hotel_id string, reservation_id string,"
    " confirmation_no string, arrival_date date, departure_date date, last_status string,"
    " last_status_event_at timestamp, last_event_id string, room_type string, rate_code string,"
    " market_code string, source_code string, channel_code string, source_updated_at timestamp,"
    " payload string, deleted_at timestamp"
)
PICKUP_METRIC = _table(
    "snapshot_date date, comparison_days int, calculated_at timestamp, hotel_id string, stay_date date,"
    " market_code string, channel_code string, source_code string, room_type string, rate_code string,"
    " rooms_on_books money, rooms_on_books_previous money, pickup_rooms money,"
    " room_revenue_on_books money, room_revenue_previous money,"
    " pickup_room_revenue money, total_revenue_on_books money,"
    " total_revenue_previous money, pickup_total_revenue money,"
    " adr_on_books money, pickup_adr money"
)

# Primary keys of the core tables, by resource type.
CORE_KEYS = {
    "reservation": ["hotel_id", "reservation_id"],
    "profile": ["profile_id"],
    "folio": ["hotel_id", "reservation_id", "folio_id"],
    "folio_transaction": ["hotel_id", "transaction_no"],
}
CORE_SCHEMAS = {
    "reservation": RESERVATION,
    "profile": PROFILE,
    "folio": FOLIO,
    "folio_transaction": FOLIO_TRANSACTION,
}
_SYSTEM = {"last_event_id", "last_event_at", "created_at", "updated_at", "deleted_at"}
CORE_ATTRIBUTES = {
    kind: [f for f in schema.fieldNames() if f not in CORE_KEYS[kind] and f not in _SYSTEM]
    for kind, schema in CORE_SCHEMAS.items()
}
EVENT_LOG_KEY = ["unique_event_id"]
RESOURCE_SNAPSHOT_KEY = ["unique_event_id", "resource_type", "resource_id"]
DAILY_SNAPSHOT_KEY = ["snapshot_date", "hotel_id", "stay_date", "reservation_id"]
LAST_STATUS_KEY = ["snapshot_date", "hotel_id", "reservation_id"]
SEGMENTS = ["market_code", "channel_code", "source_code", "room_type", "rate_code"]
PICKUP_KEY = ["snapshot_date", "comparison_days", "hotel_id", "stay_date", *SEGMENTS]

# Allowed event states and statuses that do not count as booked.
EVENT_STATUSES = ["RECEIVED", "COMPLETED", "FAILED", "RETRYABLE", "DELETED"]
OFF_BOOKS = ["CANCELLED", "NO_SHOW"]

#: What a batch of the queue did; ``batch_id`` is added when it is stored.
QUEUE_COUNTERS = _table(
    "received bigint, processed bigint, failed bigint, enriched bigint, deduplicated bigint,"
    " retried bigint, dead_lettered bigint, unresolvable bigint, last_event_at timestamp"
)
