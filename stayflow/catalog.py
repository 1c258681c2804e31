"""The registered queries: every operator over whole tables.

Results are flattened for comparison with other engines: times as epoch
microseconds, dates as text, decimals as doubles, counts as 64-bit.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import date, timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stayflow import fixtures as X
from stayflow.functions import scalars as S
from stayflow.operators import enrich, filters, merge, messaging, metrics, parse, pickup, quality, routing, snapshot, status, transform
from stayflow.plans import daily, enrichment, reports
from stayflow.schemas import DAILY_SNAPSHOT_KEY, EVENT_LOG, EVENT_V1
from stayflow.session import configure, scratch_path
from stayflow.sources import events as sources
from stayflow.sources.routes import load_routes
from stayflow.sources.state import StateTable
from stayflow.sources.tables import scan_core_reservations
from stayflow.streaming import jobs

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
DAY = X.DAY
LATE = "timestamp'2030-01-01 00:00:00'"


def plain(df: DataFrame) -> DataFrame:
    """Column types every engine writes the same way."""

    def flat(f: T.StructField) -> Column:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, T.TimestampType):
            return F.unix_micros(c).alias(f.name)
        if isinstance(f.dataType, T.DateType):
            return F.date_format(c, "yyyy-MM-dd").alias(f.name)
        if isinstance(f.dataType, T.DecimalType):
            return c.cast("double").alias(f.name)
        if isinstance(f.dataType, (T.IntegerType, T.BooleanType)):
            return c.cast("bigint").alias(f.name)
        return c.alias(f.name)

    return df.select(*[flat(f) for f in df.schema.fields])


def query(fn: Query) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return plain(fn(configure(spark), sf_dir))

    run.__doc__ = fn.__doc__
    QUERIES[fn.__name__] = run
    return fn


def _late() -> Column:
    return F.expr(LATE)


def _parsed(spark: SparkSession, sf: str) -> DataFrame:
    return parse.parse_business_event(X.event_bodies(spark, sf), "body", _late())


def _routed(spark: SparkSession, sf: str) -> DataFrame:
    return routing.route_events(_parsed(spark, sf))


# ---- stay-night snapshot -------------------------------------------------------------


@query
def stay_nights(spark, sf):
    core = scan_core_reservations(X.reservations(spark, sf), DAY)
    return snapshot.expand_stay_nights(core, DAY).select("hotel_id", "reservation_id", "stay_date")


@query
def scan_horizon(spark, sf):
    return scan_core_reservations(X.reservations(spark, sf), DAY).select("reservation_id", "arrival_date", "departure_date")


@query
def latest_raw_payload(spark, sf):
    newest = snapshot.latest_payload_per_reservation(X.raw_payloads(spark, sf))
    return newest.select("hotel_id", "reservation_id", F.expr("cast(get_json_object(raw_payload, '$.reservation.v') as bigint)").alias("version"))


@query
def daily_snapshot(spark, sf):
    built = snapshot.build_daily_snapshot(X.core_reservations(spark, sf), X.raw_payloads(spark, sf), DAY)
    return snapshot.coalesce_segments(built.drop("snapshot_taken_at", "payload", "source_updated_at", "last_event_at"))


def _published(spark: SparkSession, root: str) -> DataFrame:
    """Rows and totals of the published tables by date."""
    snap = daily.read_daily(spark, root, daily.SNAPSHOT).select(F.lit("snapshot").alias("name"), "snapshot_date", F.col("room_revenue").alias("amount"))
    stat = daily.read_daily(spark, root, daily.STATUS).select(F.lit("status").alias("name"), "snapshot_date", F.lit(1).alias("amount"))
    pick = daily.read_daily(spark, root, daily.PICKUP).select(F.lit("pickup").alias("name"), "snapshot_date", F.col("pickup_rooms").alias("amount"))
    both = snap.unionByName(stat).unionByName(pick)
    return both.groupBy("name", "snapshot_date").agg(F.count("*").alias("rows"), F.sum("amount").alias("total"))


@query
def daily_tables(spark, sf):
    """The whole daily job into tables, read back: rows and totals per table."""
    root = scratch_path(spark, "daily")
    core, raw = X.core_reservations(spark, sf), X.raw_payloads(spark, sf)
    daily.run_daily(spark, core, raw, root, DAY - timedelta(days=7), days="7")
    daily.run_daily(spark, core, raw, root, DAY, days="1,7")
    return _published(spark, root)


@query
def daily_backfill(spark, sf):
    """Two dates given in the wrong order, built in one pass."""
    root = scratch_path(spark, "backfill")
    daily.backfill(spark, X.core_reservations(spark, sf), X.raw_payloads(spark, sf), root, [DAY, DAY - timedelta(days=7)], days="7")
    return _published(spark, root)


@query
def daily_emptied(spark, sf):
    """A date built and then rebuilt from nothing: only the other date is left."""
    root = scratch_path(spark, "emptied")
    core, raw = X.core_reservations(spark, sf), X.raw_payloads(spark, sf)
    daily.backfill(spark, core, raw, root, [DAY - timedelta(days=7), DAY], days="7")
    daily.run_daily(spark, core.where("false"), raw, root, DAY, days="7")
    return _published(spark, root)


# ---- pickup --------------------------------------------------------------------------


@query
def rooms_on_books(spark, sf):
    return pickup.rooms_on_books(X.snapshots(spark, sf), DAY)


@query
def active_rows(spark, sf):
    return filters.active_only(X.snapshots(spark, sf)).select(*DAILY_SNAPSHOT_KEY, "reservation_status")


@query
def pickup_metric(spark, sf):
    return pickup.pickup_metric(X.snapshots(spark, sf), DAY, [1, 3, 7, 15]).drop("calculated_at")


@query
def pickup_self_join(spark, sf):
    rows = pickup.pickup_self_join(X.snapshots(spark, sf), DAY, 7)
    return rows.select(*pickup.NIGHT, *pickup.MEASURES, *[f"{m}_previous" for m in pickup.MEASURES])


@query
def pickup_rooms_multi(spark, sf):
    return pickup.pickup_rooms_by_segment(X.snapshots(spark, sf), DAY)


@query
def pickup_revenue_adr_7d(spark, sf):
    return pickup.pickup_revenue_adr(X.snapshots(spark, sf), DAY)


@query
def pickup_by_channel_15d(spark, sf):
    return pickup.pickup_by_channel(X.snapshots(spark, sf), DAY)


@query
def top_segments(spark, sf):
    return pickup.top_segments(X.snapshots(spark, sf), DAY, 10)


@query
def cancellations_7d(spark, sf):
    return pickup.cancellations(X.snapshots(spark, sf), DAY)


@query
def snapshot_changes(spark, sf):
    return pickup.changed_between(X.snapshots(spark, sf), DAY - timedelta(days=7), DAY)


# ---- last status ---------------------------------------------------------------------


def _status(spark: SparkSession, sf: str) -> DataFrame:
    return status.last_status(X.snapshots(spark, sf), taken_at=F.lit(DAY).cast("timestamp"))


@query
def last_status(spark, sf):
    return _status(spark, sf).drop("snapshot_taken_at", "payload")


@query
def current_status(spark, sf):
    return status.current_status_view(_status(spark, sf), DAY)


@query
def status_by_hotel(spark, sf):
    return reports.status_by_hotel(_status(spark, sf), DAY)


@query
def cancelled_noshow(spark, sf):
    return reports.cancelled_noshow_by_hotel(_status(spark, sf), DAY)


@query
def arrivals_by_status(spark, sf):
    return reports.arrivals_by_status(_status(spark, sf), DAY)


@query
def inhouse(spark, sf):
    return reports.inhouse_checkedout(_status(spark, sf), DAY)


@query
def status_by_segment(spark, sf):
    return reports.status_by_segment(_status(spark, sf), DAY)


@query
def hotel_detail(spark, sf):
    return reports.hotel_detail(_status(spark, sf), DAY, "H03")


@query
def status_as_of(spark, sf):
    return reports.status_as_of(_status(spark, sf), date(1998, 6, 8))


# ---- events --------------------------------------------------------------------------


@query
def extract_payloads(spark, sf):
    rows = sources.extract_payloads(X.frames(spark, sf), "frame")
    return rows.select("event_id", F.expr("get_json_object(body, '$.metadata.uniqueEventId')").alias("unique_event_id"))


@query
def parse_event(spark, sf):
    return _parsed(spark, sf).select(
        "event_id", "unique_event_id", "offset", "primary_key", "module_name", "event_name", "hotel_id", "chain_code", "occurred_at"
    )


@query
def parse_event_flat(spark, sf):
    rows = parse.parse_event_v1(X.flat_events(spark, sf), "body", _late())
    return rows.select("event_id", F.col("unique_event_id").alias("id"), "hotel_id", "module", "action_type", "occurred_at", "stream_offset")


@query
def parse_awkward(spark, sf):
    """Disagreeing envelopes, repeated, nested and escaped names, hashed ids and configured kinds, up to the resource."""
    routes = [*load_routes()[0], X.BLOCK_ROUTE]
    events = routing.route_events(parse.parse_business_event(X.awkward_bodies(spark, sf), "body", _late()), routes)
    rows = routing.resolve_identifier(events, routes)
    return rows.select("event_id", "unique_event_id", "hotel_id", "module_name", "event_name", "offset", "operation_id", "resource_id")


@query
def malformed_events(spark, sf):
    return parse.malformed(X.awkward_bodies(spark, sf), "body")


@query
def event_metadata(spark, sf):
    names = ["chainCode", "hotelId", "moduleName", "eventName", "primaryKey", "timestamp"]
    rows = _parsed(spark, sf)
    return rows.select(
        "event_id", F.size("metadata").alias("members"), *[F.try_element_at("metadata", F.lit(n)).alias(n) for n in names]
    )


@query
def event_changes(spark, sf):
    return parse.element_name_changes(_parsed(spark, sf)).drop("element_sequence")


@query
def delete_flag(spark, sf):
    return parse.with_delete_flag(_parsed(spark, sf)).select("event_id", "is_delete_or_cancel")


@query
def route_events(spark, sf):
    return _routed(spark, sf).select("event_id", "module_norm", "event_norm", "resource_type", "operation_id", "identifier_type")


@query
def resolve_identifier(spark, sf):
    rows = routing.with_request_path(routing.resolve_identifier(_routed(spark, sf)))
    return rows.select("event_id", "resource_id", "request_path")


@query
def queue_messages_read(spark, sf):
    flat = parse.parse_event_v1(X.flat_events(spark, sf), "body", _late()).drop("body")
    messages = messaging.to_queue_message(flat).select("body")
    return sources.read_queue_messages(messages).select("unique_event_id", "hotel_id", "module", "action_type", "offset", "occurred_at")


# ---- responses -----------------------------------------------------------------------


def _classified(spark: SparkSession, sf: str) -> DataFrame:
    flagged = parse.with_delete_flag(routing.resolve_identifier(_routed(spark, sf)))
    withdrawn = flagged.join(X.responses(spark, sf).withColumn("response", F.lit(None).cast("string")), "event_id")
    return enrich.process_outcome(withdrawn)


@query
def classify_responses(spark, sf):
    return _classified(spark, sf).select("event_id", "decision", "reason", "outcome", "visible_in")


@query
def attach_responses(spark, sf):
    rows = enrich.attach_responses(routing.resolve_identifier(_routed(spark, sf)), X.landed_responses(spark, sf))
    return rows.select("event_id", "operation_id", "status_code", "retry_after")


@query
def event_outcomes(spark, sf):
    rows = _classified(spark, sf).where("outcome <> 'RETRY'")
    outcomes = rows.select("unique_event_id", "seq", "outcome", "error", F.col("ts").alias("at"))
    first = merge.first_arrivals(_parsed(spark, sf).select("unique_event_id", "seq", "ts"), ["unique_event_id"], "seq")
    made = {"received_at": F.col("ts"), "status": F.lit("RECEIVED"), "retry_count": F.lit(0)}
    log = first.select(
        *[made.get(f.name, F.col(f.name) if f.name in first.columns else F.lit(None)).cast(f.dataType).alias(f.name) for f in EVENT_LOG.fields]
    )
    done = merge.event_outcomes(log, outcomes)
    return done.select("unique_event_id", "status", "retry_count", "completed_at", "failed_at", F.col("error_message").isNotNull().alias("has_error"))


@query
def transform_reservation(spark, sf):
    return transform.transform_reservation(X.resource_payloads(spark, sf, "reservation")).drop("payload")


@query
def transform_profile(spark, sf):
    return transform.transform_profile(X.resource_payloads(spark, sf, "profile")).drop("payload")


@query
def transform_folios(spark, sf):
    return transform.transform_folios(X.resource_payloads(spark, sf, "folio")).drop("payload")


@query
def transform_transaction(spark, sf):
    return transform.transform_transaction(X.resource_payloads(spark, sf, "folio_transaction")).drop("payload")


@query
def deleted_marker(spark, sf):
    rows = transform.deleted_marker(X.resource_payloads(spark, sf, "reservation"))
    return rows.select("event_id", "operation_id", "payload")


# ---- state ---------------------------------------------------------------------------


def _target(spark: SparkSession, sf: str) -> DataFrame:
    """A core table that already holds some of the keys, and some others."""
    return X.table(spark, sf, "customer").selectExpr(
        "c_custkey % 700 as k",
        "timestamp'2024-01-15 00:00:00' as last_event_at",
        "cast(c_custkey % 700 as string) as last_event_id",
        "cast(c_custkey % 700 as double) as value",
        "timestamp'2023-12-01 00:00:00' as created_at",
        "timestamp'2024-01-15 00:00:00' as updated_at",
        "case when c_custkey % 700 % 3 = 0 then timestamp'2024-01-10 00:00:00' end as deleted_at",
    ).distinct()


@query
def merge_core(spark, sf):
    return merge.merge_core(None, X.operations(spark, sf), ["k"], ["value"])


@query
def merge_core_target(spark, sf):
    return merge.merge_core(_target(spark, sf), X.operations(spark, sf), ["k"], ["value"])


@query
def soft_delete(spark, sf):
    deletes = X.operations(spark, sf).where("op = 'delete'").withColumnRenamed("k", "profile_id")
    target = _target(spark, sf).withColumnRenamed("k", "profile_id")
    return merge.soft_delete(target, deletes, "profile", ["profile_id"], ["value"])


@query
def accepted_ops(spark, sf):
    return merge.accepted_ops(X.operations(spark, sf), ["k"]).select("k", "seq", "event_id")


def _ids(spark: SparkSession, sf: str) -> DataFrame:
    return X.table(spark, sf, "events").selectExpr(
        "concat('evt-', cast(event_id % 9000 as string)) as unique_event_id", "event_id as seq", "event_type"
    )


def _known(spark: SparkSession, sf: str) -> DataFrame:
    return X.table(spark, sf, "events").selectExpr("concat('evt-', cast(event_id * 3 as string)) as unique_event_id")


@query
def insert_if_absent(spark, sf):
    return merge.insert_if_absent(_known(spark, sf), _ids(spark, sf), ["unique_event_id"])


@query
def insert_flags(spark, sf):
    return merge.insert_flags(_known(spark, sf), _ids(spark, sf), ["unique_event_id"]).select("unique_event_id", "seq", "inserted")


@query
def register_events(spark, sf):
    batch = _ids(spark, sf).selectExpr("*", "'CHAIN' as chain_code", "cast(seq as string) as stream_offset")
    log = X.table(spark, sf, "events").selectExpr(
        "concat('evt-', cast(event_id * 3 as string)) as unique_event_id",
        "'CHAIN' as chain_code",
        "cast(event_id * 5 as string) as stream_offset",
        "case event_id % 3 when 0 then 'COMPLETED' when 1 then 'FAILED' else 'DELETED' end as status",
    )
    entered = merge.new_events(log, batch)
    return merge.register_events(log, batch, entered).select("unique_event_id", "seq", "status")


@query
def upsert_resource_snapshot(spark, sf):
    events = X.table(spark, sf, "events").selectExpr(
        "concat('evt-', cast(event_id % 9000 as string)) as unique_event_id",
        "concat('H', cast(user_id % 7 as string)) as hotel_id",
        "'reservation' as resource_type",
        "cast(user_id as string) as resource_id",
        "event_type as operation_id",
        "cast(ts as timestamp) as fetched_at",
        "cast(value as string) as payload",
        "event_id as seq",
    )
    return merge.upsert_resource_snapshot(events.where("operation_id = 'view'").drop("seq"), events.where("operation_id <> 'view'"))


# ---- queue ---------------------------------------------------------------------------


@query
def fifo_prefix(spark, sf):
    rows = X.table(spark, sf, "events").selectExpr("event_id", "user_id as group_id", "event_id as seq", "event_type <> 'error' as ok")
    return messaging.fifo_prefix(rows).select("event_id")


def _deliveries(spark: SparkSession, sf: str) -> DataFrame:
    rows = X.responses(spark, sf).join(X.event_bodies(spark, sf), "event_id").withColumn("is_delete_or_cancel", F.col("event_type") == "error")
    named = rows.withColumn("message_id", F.col("event_id").cast("string")).withColumn("receive_count", F.col("user_id") % 8)
    return enrich.retry_classify(named)


@query
def dead_letter(spark, sf):
    return messaging.dead_letter(_deliveries(spark, sf)).drop("body")


@query
def left_for_retry(spark, sf):
    return messaging.left_for_retry(_deliveries(spark, sf)).select("event_id", "receive_count")


@query
def message_group(spark, sf):
    rows = X.table(spark, sf, "events")
    hotel = F.concat(F.lit("H"), F.col("user_id") % 7)
    key = F.when(F.col("event_id") % 10 != 0, F.col("event_id").cast("string"))
    return rows.select("event_id", S.message_group("events", 32, hotel, key).alias("group_id"))


@query
def queue_message(spark, sf):
    flat = parse.parse_event_v1(X.flat_events(spark, sf), "body", _late())
    named = flat.withColumn("hotel_id", F.when(F.col("hotel_id") != "UNKNOWN", F.col("hotel_id")).otherwise(F.lit("")))
    rows = messaging.to_queue_message(named)
    return rows.select(
        "group_id", "dedup_id", F.expr("get_json_object(body, '$.payload.info.sequence')").alias("sequence"), F.expr("attributes['hotel_id']").alias("hotel_attribute")
    )


@query
def raw_record(spark, sf):
    flat = parse.parse_event_v1(X.flat_events(spark, sf), "body", _late())
    rows = messaging.to_raw_record(flat, _late())
    return rows.select("raw_key", F.expr("get_json_object(body, '$.ingested_at')").alias("ingested_at"))


def _positions(spark: SparkSession, sf: str) -> DataFrame:
    return X.table(spark, sf, "events").selectExpr(
        "event_type as chain_code", "cast(event_id as string) as offset", "concat('evt-', cast(event_id % 9000 as string)) as unique_event_id", "event_id as seq", "ts"
    )


@query
def commit_offset(spark, sf):
    return messaging.commit_offset(_positions(spark, sf)).drop("updated_at")


@query
def raw_archive(spark, sf):
    """The raw archive written and read back, folders included."""
    path = scratch_path(spark, "archive")
    flat = parse.parse_event_v1(X.flat_events(spark, sf), "body", _late())
    messaging.write_raw_events(messaging.to_raw_record(flat, _late()), path)
    rows = spark.read.text(path)
    return rows.select(
        "hotel_id", *[F.col(c).cast("bigint").alias(c) for c in "ymd"], F.expr("cast(get_json_object(value, '$.payload.info.sequence') as bigint)").alias("sequence")
    )


@query
def event_files(spark, sf):
    """Event bodies landed as text lines, read back and parsed."""
    path = scratch_path(spark, "files")
    X.event_bodies(spark, sf).select(F.col("body").alias("value")).write.text(path)
    rows = parse.parse_business_event(sources.read_event_files(spark, path, lines=True), "body", _late())
    return rows.select("unique_event_id", "offset", "hotel_id", "event_name")


@query
def resource_responses(spark, sf):
    """Responses landed as JSON lines, read back."""
    path = scratch_path(spark, "responses")
    X.landed_responses(spark, sf).write.json(path)
    rows = sources.read_resource_responses(spark, path)
    return rows.select("operation_id", "hotel_id", "resource_id", "status_code", "retry_after")


@query
def error_texts(spark, sf):
    """Errors cut to the limits of the log and of the dead letters."""
    long = F.expr("repeat(concat(event_type, '\u00e9-'), cast(event_id % 500 as int))")
    rows = X.table(spark, sf, "events").withColumn("error", long)
    return rows.select("event_id", F.sha2(S.truncate_error(F.col("error")), 256).alias("logged"), S.truncate_error(F.col("error"), 256).alias("failure_reason"))


@query
def replay_from(spark, sf):
    rows = _positions(spark, sf)
    saved = messaging.commit_offset(rows.where("ts < timestamp_ntz'2024-01-15 00:00:00'"))
    return sources.replay_from(rows, "view", saved).select("chain_code", "offset")


# ---- operations ----------------------------------------------------------------------


@query
def stage_latency(spark, sf):
    return metrics.stage_latency(X.table(spark, sf, "events"), "event_type", "value")


@query
def usage_summary(spark, sf):
    return metrics.usage_summary(X.table(spark, sf, "lineitem"), "l_returnflag", "l_quantity")


@query
def processing_counters(spark, sf):
    rows = _classified(spark, sf)
    flags = rows.withColumn("deduplicated", (F.col("outcome") == "COMPLETED") & (F.col("seq") >= 9000)).withColumn(
        "dead_lettered", (F.col("decision") == "poison") & (F.col("user_id") % 8 >= 5)
    )
    return metrics.processing_counters(flags)


@query
def errors_by_code(spark, sf):
    return metrics.errors_by_code(X.responses(spark, sf))


@query
def batch_summary(spark, sf):
    return metrics.batch_summary(X.table(spark, sf, "events"), "user_id")


@query
def new_event_ids(spark, sf):
    return metrics.count_new_ids(_known(spark, sf), _ids(spark, sf))


def _counts(spark: SparkSession, sf: str) -> DataFrame:
    log = X.responses(spark, sf).withColumn("status", F.when(F.col("status_code") == 200, "COMPLETED").otherwise("FAILED"))
    return metrics.storage_counts(log, X.raw_payloads(spark, sf), X.core_reservations(spark, sf), X.snapshots(spark, sf), _status(spark, sf))


@query
def storage_counts(spark, sf):
    return _counts(spark, sf)


@query
def reconcile_counts(spark, sf):
    return quality.reconcile_counts(_counts(spark, sf))


# ---- checks --------------------------------------------------------------------------


@query
def check_unique(spark, sf):
    return quality.check_unique(_ids(spark, sf), ["unique_event_id"])


@query
def check_unique_partial(spark, sf):
    rows = X.table(spark, sf, "events").selectExpr("event_type as chain_code", "case when user_id % 2 = 0 then user_id end as stream_offset")
    return quality.check_unique(rows, ["chain_code", "stream_offset"], F.col("stream_offset").isNotNull())


@query
def check_not_null(spark, sf):
    return quality.check_not_null(X.snapshots(spark, sf), ["reservation_status", "market_code"]).select(*DAILY_SNAPSHOT_KEY)


@query
def check_status_domain(spark, sf):
    rows = X.responses(spark, sf).selectExpr("event_id", "case status_code when 200 then 'COMPLETED' when 404 then 'GONE' when 429 then null else 'FAILED' end as status")
    return quality.check_status_domain(rows)


@query
def check_fk(spark, sf):
    return quality.check_foreign_key(_ids(spark, sf), _known(spark, sf), "unique_event_id").select("unique_event_id", "seq")


@query
def apply_defaults(spark, sf):
    rows = X.snapshots(spark, sf).select(*DAILY_SNAPSHOT_KEY, "market_code", "source_code", "reservation_status")
    return quality.apply_defaults(rows, {"market_code": "UNMAPPED", "source_code": "UNMAPPED", "reservation_status": "RECEIVED"})


# ---- streaming -----------------------------------------------------------------------


FILE_ROWS = 25_000


def _landed(df: DataFrame, label: str, parts: int = 4) -> tuple[str, DataFrame]:
    """Land the input in arrival order, one write after the other, and open it as a stream.

    Each write makes as many files as each micro-batch takes, so the batches are
    the writes. The number of files grows with the input.
    """
    spark = df.sparkSession
    path = scratch_path(spark, label)
    rows = df.count()
    files = max(2, -(-rows // (parts * FILE_ROWS)))
    last = df.select(F.max("seq")).scalar()
    dealt = df.withColumn("_part", F.floor(F.col("seq") * parts / (last + 1)))
    for part in range(parts):
        dealt.where(F.col("_part") == part).drop("_part").repartition(files).write.mode("append").parquet(f"{path}/in")
    return path, spark.readStream.schema(df.schema).option("maxFilesPerTrigger", files).parquet(f"{path}/in")


@query
def stream_dedup(spark, sf):
    path, stream = _landed(_ids(spark, sf), "dedup")
    schema = stream.schema
    jobs.stream_dedup(stream, ["unique_event_id"], f"{path}/out", f"{path}/cp").awaitTermination()
    return StateTable(spark, f"{path}/out", ["unique_event_id"], schema).read().select("unique_event_id")


@query
def stream_latest_state(spark, sf):
    """Micro-batches in arrival order end in the same state as one merge of everything."""
    path, stream = _landed(X.operations(spark, sf), "state")
    schema = merge.merge_core(None, X.operations(spark, sf), ["k"], ["value"]).schema
    jobs.stream_latest_state(stream, ["k"], ["value"], schema, f"{path}/out", f"{path}/cp").awaitTermination()
    return StateTable(spark, f"{path}/out", ["k"], schema).read().select("k", "value", "last_event_id", "last_event_at", "deleted_at")


@query
def stream_events(spark, sf):
    path, stream = _landed(X.frames(spark, sf).selectExpr("frame as body", "event_id as seq"), "events", 2)
    jobs.stream_events(stream, path, f"{path}/cp", received_at=_late()).awaitTermination()
    rows = StateTable(spark, f"{path}/events", ["unique_event_id"], EVENT_V1).read()
    return rows.select("unique_event_id", "hotel_id", "module", "action_type", "occurred_at", "raw_key")


def _enriched(spark: SparkSession, sf: str) -> str:
    """All messages through the whole enrichment, at their first to last delivery; where the tables are.

    Two batches ten minutes apart, in which waiting messages are delivered again
    as they come due, and a drain that lets the rest of time pass.
    """
    messages = X.event_bodies(spark, sf).selectExpr("cast(event_id as string) as message_id", "if(event_id % 100 = 99, concat('[', body), body) as body", "seq", "cast(1 + event_id % 5 as int) as receive_count")
    path, stream = _landed(messages, "enrich", 2)
    landed = X.landed_responses(spark, sf)
    jobs.stream_enrich(stream, landed, f"{path}/out", f"{path}/cp", lambda n: _late() + F.expr(f"interval {10 * n} minutes")).awaitTermination()
    enrichment.drain_queue(spark, landed, f"{path}/out", _late() + F.expr("interval 1 hour"))
    return f"{path}/out"


@query
def stream_enrich(spark, sf):
    """The event log by state and route with the failed deliveries, and the dead letters."""
    root = _enriched(spark, sf)
    log = enrichment.read_event_log(spark, root)
    logged = log.groupBy("module_name", "status").agg(F.count("*").alias("events"), F.sum("retry_count").cast("bigint").alias("failures"))
    dead = spark.read.parquet(f"{root}/dead_letters").agg(F.count("*").alias("events"))
    return logged.unionByName(dead.select(F.lit("dead letters").alias("module_name"), F.lit("DEAD").alias("status"), "events", F.lit(0).cast("bigint").alias("failures")))


@query
def stream_counters(spark, sf):
    """What the batches of the same run counted while they wrote, added up."""
    return metrics.add_counters(enrichment.read_counters(spark, _enriched(spark, sf)))


@query
def queue_schedule(spark, sf):
    """When each message has its turn within an hour: hotels in order, each failure held back by its own delay."""
    events = X.event_bodies(spark, sf)
    bad, tries = F.col("event_id") % 6 == 0, F.lit(5) - F.col("event_id") % 5
    rows = events.select(
        "event_id",
        "seq",
        F.concat(F.lit("H"), (F.col("user_id") % 7).cast("string")).alias("group_id"),
        F.when(bad, tries).otherwise(1).cast("bigint").alias("tries"),
        (F.when(F.col("event_type") == "error", 30).otherwise(120) * 1_000_000).cast("bigint").alias("delay"),
    )
    # the first events of a hotel wait from before; the others arrive now
    waiting = rows.withColumn("waiting", F.col("event_id") < 40).withColumn("since", F.when(F.col("waiting"), 0).otherwise(600 * 1_000_000).cast("bigint"))
    timed = messaging.schedule(waiting, 3600 * 1_000_000)
    return timed.select("event_id", "tried", "done", F.when(~F.col("done"), F.col("due")).alias("due"))
