"""Column-level helpers: times, dates, decimals, ids, hashes."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from stayflow.functions.jsontree import bind, quoted

MONEY = "decimal(18,4)"
# Wide enough to hold an unrounded amount before it is stored at four decimals.
WIDE = "decimal(28,10)"

_ISO = r"^\d{4}-\d{2}-\d{2}([T ]\d{2}(:\d{2}(:\d{2}([.,]\d+)?)?)?(Z|[+-]\d{2}:?\d{2})?)?$"
# The form that needs no rewriting.
_TIDIED = r"^.{10}[T ]\d{2}:\d{2}:\d{2}(\.\d+)?(Z|[+-]\d{2}:\d{2})$"
# Rewrites towards the one form the cast reads the same in every session time zone:
# a time of day, minutes, a colon in the offset, an explicit zone.
_TIDY = [
    (r"^(.{10})$", "$1T00:00:00"),
    (r"^(.{10}[T ]\d{2})(Z|[+-].*)?$", "$1:00$2"),
    (r"^(.{10}[T ]\d{2}:\d{2})(Z|[+-].*)?$", "$1:00$2"),
    (r"([T ].*[+-]\d{2})(\d{2})$", "$1:$2"),
    (r"^(.{10}[T ][0-9:.]+)$", "$1Z"),
]


def iso_timestamp(text: str) -> str:
    """ISO-8601 text to an instant; a text without zone is UTC; anything else is null.

    Takes and returns SQL expression text, like ``functions.jsontree``.
    """
    tidy = f"translate({text}, ',', '.')"
    for pattern, replacement in _TIDY:
        tidy = f"regexp_replace({tidy}, {quoted(pattern)}, {quoted(replacement)})"
    tidy = f"case when {text} rlike {quoted(_TIDIED)} then {text} else {tidy} end"
    return f"case when {text} rlike {quoted(_ISO)} then try_cast({tidy} as timestamp) end"


def iso_date(text: str) -> str:
    """Calendar date written in an ISO date or datetime (its offset is not applied)."""
    return bind(text, lambda t: f"if({iso_timestamp(t)} is not null, try_cast(substr({t}, 1, 10) as date), null)")


def event_time(found: str, default: str) -> str:
    """Event time from a found JSON value: number = epoch seconds, text = ISO, else default."""
    epoch = f"case when {found}.literal then nullif(try_cast({found}.text as double), 0.0) end"
    as_text = f"case when not {found}.literal then {iso_timestamp(found + '.text')} end"
    return f"coalesce(timestamp_seconds({epoch}), {as_text}, {default})"


def to_decimal(text: str, kind: str = WIDE) -> str:
    """Decimal of a text; missing or empty is 0; unreadable is null (callers reject it)."""
    return f"case when {text} is null or {text} = '' then cast(0 as {kind}) else try_cast(trim({text}) as {kind}) end"


def to_text(value: Column) -> Column:
    return F.nullif(value.cast("string"), F.lit(""))


def adr(revenue: Column, rooms: Column) -> Column:
    """Average daily rate; null when there are no rooms."""
    return revenue / F.nullif(rooms, F.lit(0).cast("decimal(1,0)"))


def sha256_hex(value: Column) -> Column:
    return F.sha2(value, 256)


def raw_key(hotel_id: Column, occurred_at: Column, event_id: Column) -> Column:
    """Archive key ``hotel_id=X/YYYY/MM/DD/<id>-<12 hex>.json``."""
    day = F.date_format(occurred_at, "yyyy/MM/dd")
    digest = F.substring(sha256_hex(event_id), 1, 12)
    return F.concat(F.lit("hotel_id="), hotel_id, F.lit("/"), day, F.lit("/"), event_id, F.lit("-"), digest, F.lit(".json"))


def archive_key(hotel_id: Column, occurred_at: Column, event_id: Column, prefix: str = "raw") -> Column:
    """Where the archive keeps an event's record: ``raw_key`` under ``prefix``."""
    return F.concat(F.lit(prefix.rstrip("/") + "/"), raw_key(hotel_id, occurred_at, event_id))


def message_group(prefix: str, partitions: int, hotel_id: Column, key: Column) -> Column:
    """Group name from the 256-bit hash of ``hotel:key`` modulo the number of groups.

    The 64 hex digits are read eight at a time, carrying the remainder along.
    """
    n = max(1, partitions)
    digest = sha256_hex(F.concat(hotel_id, F.lit(":"), F.coalesce(key, F.lit(""))))
    words = [F.conv(F.substring(digest, 1 + 8 * i, 8), 16, 10).cast("bigint") for i in range(8)]
    carry = (1 << 32) % n
    slot = reduce(lambda acc, word: (acc * F.lit(carry) + word) % F.lit(n), words, F.lit(0).cast("bigint"))
    number = slot.cast("string")
    # Two digits at least, more where the number needs them.
    padded = F.when(F.length(number) < 2, F.lpad(number, 2, "0")).otherwise(number)
    return F.concat(F.lit(f"{prefix}-"), padded)


def truncate_error(message: Column, n: int = 2000) -> Column:
    return F.substring(message, 1, n)


def retry_after(header: Column) -> Column:
    """Seconds from a Retry-After header; never negative; unreadable is null."""
    seconds = F.when(header.rlike(r"^\s*[+-]?\d+\s*$"), F.trim(header).try_cast("int"))
    return F.when(seconds.isNotNull(), F.greatest(seconds, F.lit(0)))


def retry_visibility(seconds: Column, default: int = 120, ceiling: int = 43200) -> Column:
    """Delay before a message shows again; zero or missing means the default."""
    return F.least(F.coalesce(F.nullif(seconds, F.lit(0)), F.lit(default)), F.lit(ceiling))


def split_csv_ints(text: str | list[int]) -> list[int]:
    """``'1, 3,7'`` to ``[1, 3, 7]`` (a driver-side argument, never data)."""
    if not isinstance(text, str):
        return [int(part) for part in text]
    return [int(part) for part in text.split(",") if part.strip()]


def expand_path(template: Column, hotel_id: Column, resource_id: Column) -> Column:
    """Fill a route's path template."""
    path = F.replace(template, F.lit("{hotelId}"), hotel_id)
    for slot in ("{reservationId}", "{profileId}", "{transactionNo}"):
        path = F.replace(path, F.lit(slot), resource_id)
    return path
