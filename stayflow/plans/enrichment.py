"""Enrichment of one batch of messages: from JSON bodies to the operational tables.

State lives in log-structured tables (``sources.state``): a batch reads the
state left by the batches before it, in the buckets of its own keys, and writes
the rows it changed under its own number. Running a batch again therefore gives
the same tables.

The queue is FIFO per hotel and has a clock. A message that is not done is
delivered again after its own delay and holds up its hotel until it is handled
or out of attempts; what waits lies in a table by due time, of which a batch
opens only what came due since the batch before. A batch stands for the time
since then: all redeliveries that fall into it are worked off in one pass,
however many there are. Within a batch, events of different hotels that share
an id take their turn by arrival. An attempt is a delivery that was tried;
waiting behind another message costs none.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, LongType, StringType, StructField, StructType

from stayflow.functions import scalars as S
from stayflow.operators import merge as M
from stayflow.operators import transform as T
from stayflow.operators.enrich import attach_responses, process_outcome
from stayflow.operators.messaging import DEAD_LETTER_GROUP, schedule
from stayflow.operators.metrics import queue_counters
from stayflow.operators.parse import malformed, parse_business_event, with_delete_flag
from stayflow.operators.routing import resolve_identifier, route_events
from stayflow.operators.running import earlier
from stayflow.schemas import (
    BUSINESS_EVENT,
    CORE_ATTRIBUTES,
    CORE_KEYS,
    CORE_SCHEMAS,
    EVENT_LOG,
    EVENT_LOG_KEY,
    EVENT_POSITIONS,
    MESSAGE,
    QUEUE_COUNTERS,
    RESOURCE_SNAPSHOT,
    RESOURCE_SNAPSHOT_KEY,
)
from stayflow.session import scratch, spread
from stayflow.sources import manifest
from stayflow.sources.state import StateTable
from stayflow.sources.tables import write_changes

MESSAGE_COLUMNS = MESSAGE.fieldNames()
MAX_ATTEMPTS = 5
#: What a decision does not need. These are most of a message: they stay where they are written once and are picked out of there.
TEXTS = ["body", "payload", "details", "metadata"]
_TRANSFORMS = {
    "reservation": T.transform_reservation,
    "profile": T.transform_profile,
    "folio": T.transform_folios,
    "folio_transaction": T.transform_transaction,
}


def read_messages(messages: DataFrame) -> DataFrame:
    """Messages with the event they carry; ``parsed`` is false for a body that is not a JSON object.

    The time is null where the event tells none: what stands in for it is the
    time of a delivery, and a message is read once for all of its deliveries.
    """
    events = parse_business_event(messages, "body", F.lit(None).cast("timestamp")).withColumn("parsed", F.lit(True))
    return events.unionByName(malformed(messages, "body").withColumn("parsed", F.lit(False)), allowMissingColumns=True)


def resolve(read: DataFrame, received_at: Column) -> DataFrame:
    """Read messages with their routes and the resources they refer to."""
    events = with_delete_flag(read.where("parsed")).withColumn("timed", F.col("occurred_at").isNotNull()).withColumn("occurred_at", F.coalesce("occurred_at", received_at.cast("timestamp")))
    return resolve_identifier(route_events(events)).unionByName(read.where("not parsed"), allowMissingColumns=True)


def decide(messages: DataFrame, responses: DataFrame, received_at: Column, max_attempts: int = MAX_ATTEMPTS) -> DataFrame:
    """Messages to decided events: parsed, routed, resolved, matched, classified."""
    return judge(resolve(read_messages(messages), received_at), responses, max_attempts)


def judge(resolved: DataFrame, responses: DataFrame, max_attempts: int = MAX_ATTEMPTS) -> DataFrame:
    """Resolved messages to decided events: matched, classified.

    ``tries`` is how often the message is delivered until it leaves the queue:
    once if it is handled, else until it is out of attempts, whatever keeps it
    there; ``receive_count`` is how often it was tried before. ``delay`` is the
    wait before the next delivery, in microseconds. A body that is not a JSON
    object fails like any other poison; it has no event id and enters no table
    but the dead letters.
    """
    decided = process_outcome(attach_responses(resolved.where("parsed"), responses))
    handled = F.col("outcome").isin("COMPLETED", "DELETED")
    broken = resolved.where("not parsed").withColumn("outcome", F.lit("FAILED")).withColumn("error", F.lit("message body is not a JSON object"))
    tries = F.when(handled, 1).otherwise(F.greatest(F.lit(max_attempts) - F.col("receive_count"), F.lit(1))).cast("bigint")
    delay = F.coalesce("visible_in", S.retry_visibility(F.lit(None).cast("int"))).cast("bigint") * 1_000_000
    return decided.unionByName(broken, allowMissingColumns=True).withColumn("tries", tries).withColumn("delay", delay)


def mark_duplicates(events: DataFrame) -> DataFrame:
    """Add ``deduplicated``: the log row of the event was already completed when its turn came.

    Only a completed row is skipped. A failure reopens it and a deletion does
    not close it, so what counts is the last completion or failure before, in
    this batch or, failing that, in the log (``status``). The row may belong to
    another id at the same position (``log_id``); only events of the row's own
    id move it.
    """
    own = F.col("unique_event_id") == F.col("log_id")
    settling = F.when(own & F.col("outcome").isin("COMPLETED", "FAILED"), F.col("outcome"))
    seen = earlier(events, ["log_id"], "seq", settling, "_before", "last")
    state = F.coalesce("_before", "status")
    skipped = F.col("outcome").isin("COMPLETED", "DELETED") & F.coalesce(state == "COMPLETED", F.lit(False))
    return seen.withColumn("deduplicated", skipped).drop("_before")


def core_operations(events: DataFrame, kind: str, applied_at: Column) -> DataFrame:
    """Upserts and deletes of one resource type, ready for ``merge_core``."""
    keys, attributes = CORE_KEYS[kind], CORE_ATTRIBUTES[kind]
    types = {f.name: f.dataType for f in CORE_SCHEMAS[kind].fields}
    mine = events.where(F.col("resource_type") == kind)
    tail = ["event_id", "event_at", "applied_at", "seq"]
    base = mine.select(
        "outcome",
        "hotel_id",
        "resource_id",
        F.col("response").alias("payload"),
        F.col("unique_event_id").alias("event_id"),
        F.col("occurred_at").alias("event_at"),
        applied_at.alias("applied_at"),
        "seq",
    )
    rows = _TRANSFORMS[kind](base.where("outcome = 'COMPLETED'"))
    ops = rows.withColumn("op", F.lit("upsert")).select(*keys, *[F.col(a).cast(types[a]) for a in attributes], "op", *tail)
    if kind not in M.DELETABLE:
        return ops
    gone = base.where("outcome = 'DELETED'").withColumn(keys[-1], F.col("resource_id"))
    deletes = gone.select(
        *keys, *[F.lit(None).cast(types[a]).alias(a) for a in attributes], F.lit("delete").alias("op"), *tail
    )
    return ops.unionByName(deletes)


def _log_rows(events: DataFrame, received_at: Column) -> DataFrame:
    fresh = {
        "stream_offset": F.col("offset"),
        "received_at": received_at,
        "completed_at": F.lit(None),
        "failed_at": F.lit(None),
        "status": F.lit("RECEIVED"),
        "retry_count": F.lit(0),
        "error_message": F.lit(None),
    }
    return events.select(
        *[fresh.get(f.name, F.col(f.name)).cast(f.dataType).alias(f.name) for f in EVENT_LOG.fields], "seq"
    )


#: Messages that wait: how often they were tried (``receive_count``), their event as it was read (``payload`` is null if it
#: is the body), their group, and when it is due. ``parsed`` is null if the message was not read when it was left.
READ = [*BUSINESS_EVENT.fields, StructField("parsed", BooleanType())]
PENDING = StructType([*MESSAGE.fields, *READ, StructField("group_id", StringType()), StructField("due", LongType()), StructField("due_slot", LongType()), StructField("batch_id", LongType())])
#: Microseconds of due time in a folder of waiting messages.
SLOT = 300 * 1_000_000


def pending_before(spark: SparkSession, root: str, batch_id: int, after: int, upto: int | None = None) -> DataFrame:
    """Waiting messages that batches before ``batch_id`` left, due after the time ``after`` and up to ``upto``."""
    path = f"{root}/pending"
    if not manifest.exists(spark, path):
        return spark.createDataFrame([], PENDING)
    stored = spark.read.schema(PENDING).parquet(path).where((F.col("batch_id") < batch_id) & (F.col("due_slot") >= after // SLOT) & (F.col("due") > after))
    return stored if upto is None else stored.where((F.col("due_slot") <= upto // SLOT) & (F.col("due") <= upto))


def _clock(spark: SparkSession, root: str, batch_id: int, at: Column, all_of_time: bool) -> tuple[int, int]:
    """The time the batch before ended and the time this one does, in microseconds.

    Time never runs back, a replay gets the time of the first run, and a drain
    ends when the last message it finds is due.
    """
    before = (manifest.read_version(spark, f"{root}/_clock", batch_id)[1] or {"at": 0})["at"]
    same = manifest.read_version(spark, f"{root}/_clock", batch_id + 1)
    if same[0] == batch_id:
        return before, same[1]["at"]
    now = spark.range(1).select(F.unix_micros(at.cast("timestamp"))).first()[0]
    if all_of_time:
        now = max(now, pending_before(spark, root, batch_id, before).agg(F.max("due")).first()[0] or 0)
    manifest.write_version(spark, f"{root}/_clock", batch_id, {"at": max(now, before)})
    return before, max(now, before)


def enrich_batch(
    messages: DataFrame,
    responses: DataFrame,
    root: str,
    batch_id: int,
    applied_at: Column,
    max_attempts: int = MAX_ATTEMPTS,
    drain: bool = False,
) -> None:
    """Process one batch of messages against the tables under ``root``, at the time ``applied_at``.

    ``seq`` is the arrival number: messages of a later batch have higher ones.
    A drain also delivers everything that would only come due later, and leaves
    nothing waiting.
    """
    spark = messages.sparkSession
    done, commit = manifest.read_version(spark, f"{root}/_batches", batch_id)
    with scratch(spark) as cut:
        _enrich(messages, responses, root, batch_id, applied_at, max_attempts, drain, cut)
    drained = commit["drains"] if done is not None else 0
    manifest.write_version(spark, f"{root}/_batches", batch_id, {"drains": drained + drain})


def drains(spark: SparkSession, root: str) -> int:
    """How often the queue under ``root`` was drained; each drain is a batch of its own."""
    return (manifest.read_version(spark, f"{root}/_batches")[1] or {"drains": 0})["drains"]


def drain_queue(spark: SparkSession, responses: DataFrame, root: str, applied_at: Column, max_attempts: int = MAX_ATTEMPTS) -> None:
    """Let all of time pass: what waits is delivered until it is handled or has used all its attempts, then it is a dead letter.

    For the end of a run that no batch follows. Later batches are numbered
    after the drain; run it only when the stream has stopped.
    """
    last, _ = manifest.read_version(spark, f"{root}/_batches")
    if last is not None:
        enrich_batch(spark.createDataFrame([], MESSAGE), responses, root, last + 1, applied_at, max_attempts, drain=True)


def _queue(messages: DataFrame, root: str, batch_id: int, before: int, now: int, drain: bool) -> DataFrame:
    """What is there to deliver, read: new messages, and waiting ones that are due. ``receive_count`` is how often each was tried.

    Only what was not read before is parsed.
    """
    spark = messages.sparkSession
    new = messages.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in MESSAGE.fields])
    new = new.withColumn("receive_count", F.greatest(F.coalesce("receive_count", F.lit(1)), F.lit(1)) - 1)
    due = pending_before(spark, root, batch_id, before, None if drain else now)
    read = [f.name for f in READ]
    waiting = due.select(*MESSAGE_COLUMNS, *read, F.lit(True).alias("waiting"), F.col("due").alias("since"))
    waiting = waiting.withColumn("payload", F.when(F.col("parsed"), F.coalesce("payload", "body")))
    new = new.select(*MESSAGE_COLUMNS, F.lit(False).alias("waiting"), F.lit(now).cast("bigint").alias("since"))
    unread = waiting.where("parsed is null").drop(*read).unionByName(new)
    return waiting.where("parsed is not null").unionByName(read_messages(spread(unread)))


def group_ends(turns: DataFrame) -> DataFrame:
    """How far each group gets: its first message that is not done, by whether it waited before, with its tries so far, and when it is due.

    Messages are done in order, those that waited first, so this is all there is to tell about those that are not.
    """
    old = F.col("waiting")
    return turns.where("not done").groupBy("group_id").agg(
        F.min(F.when(old, F.col("seq"))).alias("_old_end"), F.min(F.when(~old, F.col("seq"))).alias("_new_end"), F.max("tried").alias("_head_tried"), F.min("due").alias("due")
    )


def at_turn(rows: DataFrame, ends: DataFrame) -> DataFrame:
    """Add ``done``, ``due`` and ``tried`` (times so far, of a message that is not done) to rows with unique ``seq``.

    As told by the few rows of ``group_ends``, so the messages themselves need not be shuffled.
    """
    end = F.when(F.col("waiting"), F.col("_old_end")).otherwise(F.col("_new_end"))
    head = F.coalesce((F.col("seq") == end) & (F.col("waiting") | F.col("_old_end").isNull()), F.lit(False))
    placed = rows.join(ends, "group_id", "left").withColumn("done", F.coalesce(F.col("seq") < end, F.lit(True)))
    return placed.withColumn("tried", F.when(head, F.col("_head_tried")).otherwise(0)).drop("_old_end", "_new_end", "_head_tried")


def _enrich(messages, responses, root, batch_id, applied_at, max_attempts, drain, cut) -> None:
    spark = messages.sparkSession
    before, now = _clock(spark, root, batch_id, applied_at, drain)
    queue = _queue(messages, root, batch_id, before, now, drain)
    # Matching needs the events twice, so they are written before it; a payload that is the body is written once.
    resolved = resolve(queue, applied_at).withColumn("group_id", F.coalesce(S.to_text(F.col("hotel_id")), F.lit("default")))
    resolved = cut(resolved.withColumn("payload", F.nullif("payload", F.col("body"))), "resolved")
    decided = judge(resolved.drop(*TEXTS), responses, max_attempts)
    # A hotel that still waits keeps its new messages waiting, too.
    later = pending_before(spark, root, batch_id, now).select("group_id", F.col("due").alias("_until")).distinct()
    if not drain:
        decided = decided.join(later, "group_id", "left").withColumn("since", F.greatest("since", "_until")).drop("_until")
    # Read by every sink below, so it is written once to the shared folder; turns are found on a few columns.
    counters = queue_counters()
    seen = {name: Observation() for name in counters}

    def counted(df: DataFrame, name: str) -> DataFrame:
        return df.observe(seen[name], *counters[name])

    decided = cut(counted(decided, "decided"), "decided")
    scheduled = schedule(decided.select("seq", "group_id", "waiting", "since", "tries", "delay"), None if drain else now)
    turns = cut(counted(scheduled.select("seq", "group_id", "waiting", "tried", "done", "due"), "turns"), "turns")
    repeated = not turns.groupBy("seq").count().where("count > 1 or seq is null").isEmpty()
    ends = None if repeated else cut(group_ends(turns), "ends")

    def timed(rows: DataFrame) -> DataFrame:
        """Add ``tried`` (times so far, for a message that is not done), ``done`` and ``due``."""
        return rows.join(turns.select("seq", "tried", "done", "due"), "seq") if repeated else at_turn(rows, ends)

    prefix = timed(decided).withColumn("tried", F.when(F.col("done"), F.col("tries")).otherwise(F.col("tried"))).where("tried > 0")

    registering = prefix.where("outcome <> 'RETRY' and unique_event_id is not null").withColumn("stream_offset", F.col("offset")).drop("response")
    log_table = StateTable(spark, f"{root}/event_log", EVENT_LOG_KEY, EVENT_LOG)
    slot_table = StateTable(spark, f"{root}/event_positions", ["slot"], EVENT_POSITIONS)
    # An event keeps its id and position for good; the log is by id, and positions lead to ids.
    positions = M.with_slot(registering).where("slot is not null").select("slot")
    ids = registering.select("unique_event_id").unionByName(slot_table.read(batch_id, positions).select("unique_event_id"))
    log = cut(log_table.read(batch_id, ids), "log")
    # Who enters is found on ids and positions; whole rows are only picked out, one per id.
    first = M.new_events(log, registering.select("unique_event_id", "chain_code", "stream_offset", "seq"), cut=cut)
    fresh = resolved.join(first.select("unique_event_id", "seq"), ["unique_event_id", "seq"], "left_semi")
    fresh = fresh.withColumn("payload", F.coalesce("payload", "body"))
    entered = cut(M.first_arrivals(_log_rows(fresh, applied_at), ["unique_event_id"], "seq"), "entered")
    known = M.register_events(log, registering, entered)
    flagged = cut(counted(mark_duplicates(known), "flagged"), "flagged")
    handled = flagged.where("not deduplicated")

    # Whatever another id's row stood in for leaves no mark on a row that enters later.
    outcomes = handled.where("unique_event_id = log_id").select("unique_event_id", "seq", "outcome", "error", "tried", applied_at.alias("at"))
    mine = log.join(handled.select(*EVENT_LOG_KEY).distinct(), EVENT_LOG_KEY, "left_semi")
    rows = mine.unionByName(entered.select(*EVENT_LOG.fieldNames()))
    log_table.write(M.event_outcomes(rows, outcomes.withColumnRenamed("tried", "tries")), batch_id)
    slot_table.write(M.with_slot(entered).where("slot is not null").select("slot", "unique_event_id"), batch_id)

    fetched = handled.where("outcome in ('COMPLETED', 'DELETED')")
    fetched = cut(decided.where("outcome in ('COMPLETED', 'DELETED')").select("seq", "response").join(fetched, "seq"), "fetched")
    marker = T.deleted_marker(fetched)
    gone = F.col("outcome") == "DELETED"
    snapshots = marker.select(
        "unique_event_id",
        "hotel_id",
        "resource_type",
        "resource_id",
        F.when(gone, F.col("operation_id")).otherwise(_operation(F.col("resource_type"))).alias("operation_id"),
        applied_at.alias("fetched_at"),
        F.when(gone, F.col("payload")).otherwise(F.col("response")).alias("payload"),
        "seq",
    )
    raw_table = StateTable(spark, f"{root}/resource_snapshot", RESOURCE_SNAPSHOT_KEY, RESOURCE_SNAPSHOT)
    raw_table.write(M.upsert_resource_snapshot(raw_table.read(batch_id, snapshots.select(*RESOURCE_SNAPSHOT_KEY)), snapshots), batch_id)

    for kind, schema in CORE_SCHEMAS.items():
        keys = CORE_KEYS[kind]
        table = StateTable(spark, f"{root}/core_{kind}", keys, schema)
        ops = cut(core_operations(fetched, kind, applied_at), f"ops-{kind}")
        state = M.merge_core(table.read(batch_id, ops.select(*keys)), ops, keys, CORE_ATTRIBUTES[kind])
        table.write(state.select(*schema.fieldNames()), batch_id)

    logged = (F.col("outcome") == "FAILED") & F.col("unique_event_id").isNotNull()
    spent = prefix.where(F.col("done") & (logged | F.expr("outcome = 'RETRY' or unique_event_id is null")))
    reason = F.when(logged, F.col("error")).otherwise(F.coalesce("error", "reason", F.lit("no response landed")))
    bodies = resolved.dropDuplicates(["seq"]) if repeated else timed(resolved).where("done")
    dead = spent.select("seq", "message_id", S.truncate_error(reason, 256).alias("failure_reason")).join(bodies.select("seq", "body"), "seq").select(
        "message_id",
        "body",
        F.lit(DEAD_LETTER_GROUP).alias("group_id"),
        F.concat(F.lit("poison-"), F.coalesce("message_id", F.lit(""))).alias("dedup_id"),
        "failure_reason",
    )
    write_changes(counted(dead, "dead"), f"{root}/dead_letters", batch_id)
    _write_counters(spark, root, batch_id, {k: v for observed in seen.values() for k, v in observed.get.items()})
    # Left in the queue: whatever is not done, and everything behind it in its group.
    left = timed(resolved).where("not done").withColumn("receive_count", (F.col("receive_count") + F.col("tried")).cast("int"))
    left = left.withColumn("occurred_at", F.when(F.col("timed"), F.col("occurred_at")))
    left = left.select(*MESSAGE_COLUMNS, *[f.name for f in READ], "group_id", "due", F.floor(F.col("due") / SLOT).alias("due_slot"))
    left.withColumn("batch_id", F.lit(batch_id).cast("bigint")).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("due_slot", "batch_id").parquet(f"{root}/pending")
    _forget(spark, root)


def _write_counters(spark: SparkSession, root: str, batch_id: int, of: dict) -> None:
    """One row per batch; a batch that runs again replaces its own."""
    values = {**of, "failed": of["finished"] - of["processed"], "retried": of["deliveries"] - of["finished"]}
    row = spark.createDataFrame([tuple(values[n] for n in QUEUE_COUNTERS.fieldNames())], QUEUE_COUNTERS)
    write_changes(row.coalesce(1), f"{root}/counters", batch_id)


def read_counters(spark: SparkSession, root: str) -> DataFrame:
    """What each batch did; ``metrics.add_counters`` sums them up."""
    return spark.read.schema(StructType([*QUEUE_COUNTERS.fields, StructField("batch_id", LongType())])).parquet(f"{root}/counters")


def _forget(spark: SparkSession, root: str) -> None:
    """Remove folders of waiting messages that were due before any batch that can still run again."""
    kept = manifest.versions(spark, f"{root}/_clock")
    oldest = manifest.read_json(spark, f"{root}/_clock/{kept[0]:012d}.json")["at"] // SLOT if len(kept) == manifest.KEPT else 0
    for name in manifest.names(spark, f"{root}/pending"):
        if name.startswith("due_slot=") and int(name.removeprefix("due_slot=")) < oldest:
            manifest.remove(spark, f"{root}/pending/{name}")


def _operation(resource_type: Column) -> Column:
    return (
        F.when(resource_type == "reservation", "getReservation")
        .when(resource_type == "profile", "getProfile")
        .when(resource_type == "folio", "getFolio")
        .otherwise("getFolioTransactionDetails")
    )


def read_core(spark: SparkSession, root: str, kind: str) -> DataFrame:
    return StateTable(spark, f"{root}/core_{kind}", CORE_KEYS[kind], CORE_SCHEMAS[kind]).read()


def read_event_log(spark: SparkSession, root: str) -> DataFrame:
    return StateTable(spark, f"{root}/event_log", EVENT_LOG_KEY, EVENT_LOG).read()


def read_raw(spark: SparkSession, root: str) -> DataFrame:
    return StateTable(spark, f"{root}/resource_snapshot", RESOURCE_SNAPSHOT_KEY, RESOURCE_SNAPSHOT).read()
