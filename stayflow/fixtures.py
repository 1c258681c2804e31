"""Hotel tables derived row by row from the given parquet tables.

Used by the registered queries, the tests and the bench. Every table grows with
its base table; nothing is sampled or limited.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stayflow.schemas import RESERVATION
from stayflow.session import spread

DAY = date(1998, 6, 15)
OBSERVED = [date(1998, 6, 15), date(1998, 6, 14), date(1998, 6, 12), date(1998, 6, 8), date(1998, 5, 31)]
FETCHED = "timestamp'2024-02-01 00:00:00'"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def reservations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Core reservations; zero-night, null-status and deleted ones included."""
    return table(spark, sf_dir, "orders").selectExpr(
        "concat('H', lpad(cast(o_custkey % 7 as string), 2, '0')) as hotel_id",
        "concat('resv-', cast(o_orderkey as string)) as reservation_id",
        "concat('CNF', cast(o_orderkey as string)) as confirmation_no",
        "cast(o_orderdate as date) as booked_date",
        "date_add(cast(o_orderdate as date), cast(o_orderkey % 60 as int)) as arrival_date",
        "date_add(cast(o_orderdate as date), cast(o_orderkey % 60 + o_orderkey % 5 as int)) as departure_date",
        "case when o_orderkey % 13 = 0 then null when o_orderstatus = 'F' then 'CHECKED_IN'"
        " when o_orderstatus = 'O' then 'RESERVED' when o_custkey % 2 = 0 then 'CANCELLED'"
        " else 'NO_SHOW' end as reservation_status",
        "concat('evt-', cast(o_orderkey as string)) as last_event_id",
        "cast(o_orderdate as timestamp) as last_event_at",
        "case when o_orderkey % 29 = 0 then cast(o_orderdate as timestamp) end as deleted_at",
        "case when o_orderkey % 11 = 0 then null else o_orderpriority end as market_code",
        "concat('CH', cast(o_custkey % 4 as string)) as channel_code",
        "case when o_orderkey % 9 = 0 then null else 'WEB' end as source_code",
        "concat('RT', cast(o_orderkey % 3 as string)) as room_type",
        "concat('RC', cast(o_orderkey % 2 as string)) as rate_code",
        "cast(1 + o_orderkey % 2 as decimal(12,4)) as rooms",
        "cast(o_totalprice as decimal(18,4)) as room_revenue",
    )


def core_reservations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same reservations in the core table's shape."""
    r = spread(reservations(spark, sf_dir))
    made = {"source_updated_at": F.col("last_event_at"), "created_at": F.col("last_event_at"), "updated_at": F.col("last_event_at")}
    return r.withColumns(made).select(*RESERVATION.fieldNames())


def snapshots(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stay-night snapshots for five observation dates (0, 1, 3, 7 and 15 days back)."""
    days = F.explode(F.array(*[F.lit(d) for d in OBSERVED])).alias("snapshot_date")
    seen = reservations(spark, sf_dir).select("*", days).where(
        "booked_date <= snapshot_date and departure_date > arrival_date and departure_date > snapshot_date"
        " and arrival_date <= date_add(snapshot_date, 730)"
    )
    nights = seen.withColumn(
        "stay_date",
        F.explode(F.sequence(F.greatest("arrival_date", "snapshot_date"), F.date_sub("departure_date", 1))),
    )
    return nights.selectExpr(
        "snapshot_date",
        "cast(snapshot_date as timestamp) as snapshot_taken_at",
        "hotel_id",
        "stay_date",
        "reservation_id",
        "confirmation_no",
        "room_type",
        "rate_code",
        "market_code",
        "source_code",
        "channel_code",
        "case when date_add(booked_date, 20) <= snapshot_date then reservation_status else 'RESERVED' end as reservation_status",
        "rooms",
        "room_revenue",
        "room_revenue as total_revenue",
        "last_event_at as source_updated_at",
        "last_event_id",
        "last_event_at",
        "'{}' as payload",
        "case when date_add(booked_date, 20) <= snapshot_date then deleted_at end as deleted_at",
    )


def raw_payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Landed reservation payloads; some resources were fetched twice (``seq`` tells the newer)."""
    versions = F.explode(F.when(F.col("reservation_id").like("%7"), F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1))))
    body = (
        "concat('{\"reservation\":{\"roomStay\":{\"roomType\":\"', room_type, '\"},\"rateCode\":\"', rate_code,"
        " '\",\"channelCode\":\"', channel_code, '\",\"dailyRates\":[{\"stayDate\":\"', cast(arrival_date as string),"
        " '\",\"roomRevenue\":\"', cast(room_revenue as string), '\"}],\"rooms\":\"', cast(rooms as string),"
        " '\",\"v\":', cast(k as string), '}}') as payload"
    )
    return reservations(spark, sf_dir).withColumn("k", versions).selectExpr(
        "last_event_id as unique_event_id",
        "hotel_id",
        "'reservation' as resource_type",
        "reservation_id as resource_id",
        "'getReservation' as operation_id",
        f"{FETCHED} as fetched_at",
        "cast(k as bigint) as seq",
        body,
    )


_TS_TEXT = "date_format(ts, \"yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'\")"


def event_bodies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Business-event JSON; ids repeat from 9,000 events on, every 50th event has no route."""
    body = (
        "concat('{\"metadata\":{\"offset\":\"', cast(event_id as string), '\",\"uniqueEventId\":\"evt-',"
        " cast(event_id % 9000 as string), '\"},\"chainCode\":\"CHAIN\",\"hotelId\":\"H', cast(user_id % 7 as string),"
        " '\",\"moduleName\":\"', case when event_id % 50 = 0 then 'Housekeeping' when event_type = 'view' then 'RSV'"
        " when event_type = 'error' then 'Reservation' when event_type = 'signup' then 'PROFILE'"
        " when event_type = 'click' then 'Cashiering' else 'CSH' end,"
        " '\",\"eventName\":\"', case event_type when 'view' then 'UpdateReservation' when 'error' then 'CancelReservation'"
        " when 'signup' then 'NewProfile' when 'click' then 'Folio' else 'FolioTransaction' end,"
        " '\",\"primaryKey\":\"', case event_type when 'click' then concat('folio-', cast(event_id as string))"
        " when 'purchase' then cast(event_id as string) else concat('key-', cast(user_id as string)) end,"
        f" '\",\"timestamp\":\"', {_TS_TEXT},"
        " '\",\"detail\":[{\"elementName\":\"reservationId\",\"oldValue\":\"',"
        " case when event_id % 4 = 0 then cast(user_id as string) else '' end, '\",\"newValue\":\"',"
        " case when event_id % 31 = 0 then '' else concat('resv-', cast(user_id as string)) end, '\"}]}') as body"
    )
    return spread(table(spark, sf_dir, "events")).selectExpr(
        "event_id", "event_id as seq", "cast(ts as timestamp) as ts", "user_id", "event_type", body
    )


#: A route whose identifier kind is not among the built-in ones.
BLOCK_ROUTE = {
    "moduleName": "Blocks",
    "eventName": "*",
    "resource_type": "block",
    "operation_id": "getBlock",
    "path": "/blocks",
    "identifier_type": "blockId",
    "fetch": "block",
}


def awkward_bodies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as they should not be written: envelopes that disagree with their payload, repeated and nested names,
    escaped keys, leading blanks, numbers for text, keys that do not fit, configured kinds, no object at all."""
    n, u = "cast(event_id as string)", "cast(user_id as string)"
    body = (
        "case event_id % 9"
        f" when 0 then concat('{{\"module\":\"X\",\"action_type\":\"A\",\"hotelId\":\"OUT\",\"payload\":{{\"moduleName\":\"RSV\",\"eventName\":\"NewReservation\",\"hotelId\":\"IN\",\"eventId\":\"p-', {n}, '\",\"primaryKey\":\"k', {u}, '\"}}}}')"
        f" when 1 then concat('{{\"a\":{{\"eventId\":\"deep\",\"offset\":1.50}},\"b\":[{{\"eventId\":\"deeper\",\"offset\":2}}],\"eventId\":\"t-', {n}, '\"}}')"
        f" when 2 then concat('{{\"z\":{{\"hotelId\":\"Z\"}},\"b\":{{\"c\":[{{}},{{\"resort\":\"B', {u}, '\"}}]}},\"eventId\":\"n-', {n}, '\"}}')"
        f" when 3 then concat('{{\"hotel\\\\u0049d\":\"E', {u}, '\",\"eventId\":\"e-', {n}, '\"}}')"
        f" when 4 then concat('\\n\\t {{\"eventId\":\"l-', {n}, '\"}}')"
        f" when 5 then concat('{{\"eventId\":\"b-', {n}, '\",\"moduleName\":\"Blocks\",\"primaryKey\":\"unused\",\"info\":{{\"blockId\":\"blk-', {u}, '\"}}}}')"
        f" when 6 then concat('{{\"eventId\":\"d-', {n}, '\",\"moduleName\":\"CSH\",\"eventName\":\"FolioTransaction\",\"primaryKey\":\"none\",\"deep\":{{\"x\":[{{\"trxNo\":', {n}, '}}]}}}}')"
        f" when 7 then concat('{{\"payload\":{{\"b\": \"', {u}, '\", \"a\": [', {n}, ']}},\"c\":1}}')"
        f" else concat('[', {n}, ']') end as body"
    )
    return table(spark, sf_dir, "events").selectExpr("event_id", body)


def frames(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Subscription frames in all the shapes a frame may take."""
    shaped = (
        "case event_id % 5 when 0 then concat('{\"data\":{\"newEvent\":', body, '}}')"
        " when 1 then concat('{\"data\":{\"businessEvents\":[', body, ',7,', body, ']}}')"
        " when 2 then concat('{\"data\":{\"businessEvents\":', body, '}}')"
        " when 3 then body else '{\"data\":{\"businessEvents\":\"none\"}}' end as frame"
    )
    return event_bodies(spark, sf_dir).selectExpr("event_id", "ts", shaped)


def flat_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flat (v1) events: other key names, numeric times, some without id or hotel."""
    body = (
        "concat('{', case when event_id % 6 = 0 then '' else concat('\"businessEventId\":\"b-', cast(event_id as string), '\",') end,"
        " case when event_id % 9 = 0 then '' else concat('\"resort\":\"R', cast(user_id % 5 as string), '\",') end,"
        " '\"eventType\":\"', event_type, '\",\"info\":{\"action\":\"', case when event_id % 8 = 0 then '' else 'ACT' end,"
        " '\",\"sequence\":', cast(event_id as string), '},\"eventTime\":',"
        " case when event_id % 2 = 0 then cast(unix_seconds(ts) as string)"
        " else concat('\"', date_format(ts, \"yyyy-MM-dd'T'HH:mm:ss'+00:00'\"), '\"') end, '}') as body"
    )
    return spread(table(spark, sf_dir, "events")).withColumn("ts", F.col("ts").cast("timestamp")).selectExpr(
        "event_id", "event_id as seq", "ts", "user_id", "event_type", body
    )


def responses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """HTTP status per event, all classifier branches."""
    return table(spark, sf_dir, "events").selectExpr(
        "event_id",
        "cast(case event_id % 20 when 1 then 404 when 2 then 429 when 3 then 503 when 4 then 401"
        " when 5 then 400 when 6 then 418 else 200 end as int) as status_code",
        "case event_id % 3 when 0 then '30' when 1 then '-5' else 'soon' end as retry_after",
    )


def operations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Upserts and deletes arriving out of time order."""
    return table(spark, sf_dir, "events").selectExpr(
        "user_id % 500 as k",
        "(event_id * 48271) % 2147483647 as seq",
        "cast(ts as timestamp) as event_at",
        "cast(ts as timestamp) as applied_at",
        "case when event_type = 'error' then 'delete' else 'upsert' end as op",
        "cast(event_id as string) as event_id",
        "value",
    )


_RESPONSE_BODIES = {
    "reservation": (
        "concat(case when event_id % 4 = 1 then '{\"reservations\":[' else '{\"reservation\":' end, '{',"
        " case when event_id % 7 = 0 then '' else concat('\"reservationIdList\":[{\"type\":\"Reservation\",\"id\":\"resv-',"
        " cast(user_id as string), '\"}],') end,"
        " case when event_id % 3 = 0 then '\"confirmationNumber\"' else '\"confirmationNo\"' end, ':\"CNF-', cast(event_id as string),"
        " '\",\"arrivalDate\":\"', cast(cast(ts as date) as string), '\",\"departureDate\":\"',"
        " case when event_id % 17 = 0 then 'soon' else cast(date_add(cast(ts as date), 3) as string) end,"
        " case when event_id % 5 = 0 then '\",\"status\":\"' else '\",\"reservationStatus\":\"' end, event_type,"
        f" '\",\"lastModifyDateTime\":\"', {_TS_TEXT}, '\"}}',"
        " case when event_id % 4 = 1 then ',{\"confirmationNo\":\"second\"}]}' else '}' end)"
    ),
    "profile": (
        "concat('{\"profile\":{', case when event_id % 6 = 0 then '' when event_id % 6 = 1 then concat('\"id\":\"p-', cast(user_id as string), '\",')"
        " else concat('\"profileId\":\"p-', cast(user_id as string), '\",') end, '\"type\":\"', event_type, '\",',"
        " case when event_id % 2 = 0 then '\"customer\":{\"personName\":[{\"givenName\":\"Ann\",\"surname\":\"Lee\"}]}'"
        " else '\"firstName\":\"Bob\",\"lastName\":\"Ray\"' end,"
        " case event_id % 3 when 0 then concat(',\"emails\":[{\"email\":\"e', cast(user_id as string), '@x.invalid\"}]')"
        " when 1 then concat(',\"emailInfo\":[{\"emailAddress\":\"i', cast(user_id as string), '@x.invalid\"}]')"
        " else concat(',\"email\":\"d', cast(user_id as string), '@x.invalid\"') end,"
        f" ',\"updateDate\":\"', {_TS_TEXT}, '\"}}}}')"
    ),
    "folio": (
        "case when event_id % 11 = 0 then '{\"items\":[]}' when event_id % 5 = 0 then concat('{\"folio\":{\"id\":\"f-',"
        " cast(event_id as string), '\",\"folioNo\":\"1\",\"balance\":\"', cast(value as string), '\",\"currency\":\"USD\"}}')"
        " else concat('{\"folios\":[{\"folioId\":\"f-', cast(event_id as string), '\",\"folioNo\":\"1\",\"balance\":\"',"
        " cast(value as string), '\",\"currencyCode\":\"EUR\"},5,{\"folioNumber\":\"2\",\"balance\":0,\"balanceAmount\":7.25,\"currency\":\"EUR\"}]}') end"
    ),
    "folio_transaction": (
        "concat('{\"transaction\":{', case when event_id % 6 = 0 then '' else concat('\"transactionNo\":\"T-', cast(event_id as string), '\",') end,"
        " case when event_id % 4 = 0 then concat('\"amount\":0,\"grossAmount\":\"', cast(value as string), '\",')"
        " else concat('\"amount\":\"', cast(value as string), '\",') end, '\"resvNameId\":\"resv-', cast(user_id as string),"
        " '\",\"folioId\":\"f-', cast(user_id % 9 as string), '\",\"currency\":\"EUR\",\"trxCode\":\"', event_type,"
        f" '\",\"updateDate\":\"', {_TS_TEXT}, '\"}}}}')"
    ),
}


def resource_payloads(spark: SparkSession, sf_dir: str, kind: str) -> DataFrame:
    """One response of the given resource type per event."""
    events = spread(table(spark, sf_dir, "events")).withColumn("ts", F.col("ts").cast("timestamp"))
    return events.selectExpr(
        "event_id",
        "concat('H', cast(user_id % 7 as string)) as hotel_id",
        "concat('routed-', cast(event_id as string)) as resource_id",
        f"{_RESPONSE_BODIES[kind]} as payload",
    )


def landed_responses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Landed API responses for the resources the events of ``event_bodies`` lead to.

    One per resource a route asks for, newest fetch last; the status follows the
    fetching event, so all outcomes occur.
    """
    events = table(spark, sf_dir, "events").withColumn("ts", F.col("ts").cast("timestamp"))
    kind = (
        "case when event_type in ('view', 'error') then 'reservation' when event_type = 'signup' then 'profile'"
        " when event_type = 'click' then 'folio' else 'folio_transaction' end"
    )
    bodies = " ".join(f"when '{k}' then {v}" for k, v in _RESPONSE_BODIES.items())
    return events.selectExpr("*", f"{kind} as kind").selectExpr(
        "event_id as fetch_seq",
        "case kind when 'reservation' then 'getReservation' when 'profile' then 'getProfile'"
        " when 'folio' then 'getFolio' else 'getFolioTransactionDetails' end as operation_id",
        "concat('H', cast(user_id % 7 as string)) as hotel_id",
        "case kind when 'folio' then concat('resv-', cast(user_id as string))"
        " when 'folio_transaction' then cast(event_id as string) else concat('key-', cast(user_id as string)) end as resource_id",
        "cast(case event_id % 20 when 1 then 404 when 2 then 429 when 3 then 503 when 4 then 401"
        " when 5 then 400 when 6 then 418 else 200 end as int) as status_code",
        "case event_id % 3 when 0 then '30' when 1 then '-5' else 'soon' end as retry_after",
        f"case kind {bodies} end as payload",
    )
