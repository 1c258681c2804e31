"""Structured Streaming jobs: the batch operators inside ``foreachBatch``.

No event is ever dropped for being late: deduplication looks at everything
stored, and out-of-order events are told apart by the age guard of the merge.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.query import StreamingQuery
from pyspark.sql.types import StructType

from stayflow.functions import scalars as S
from stayflow.operators import merge as M
from stayflow.operators.messaging import commit_offset, to_raw_record, write_raw_events
from stayflow.operators.parse import parse_event_v1
from stayflow.plans.enrichment import drains, enrich_batch
from stayflow.session import scratch, spread
from stayflow.sources.events import extract_payloads
from stayflow.sources.state import StateTable
from stayflow.sources.tables import write_changes


def start(stream: DataFrame, each: Callable[[DataFrame, int], None], checkpoint: str, every: str | None = None) -> StreamingQuery:
    """Run ``each`` per micro-batch: until the input is used up, or on a clock (``every``, e.g. '1 second')."""
    writer = stream.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint)
    trigger = {"processingTime": every} if every else {"availableNow": True}
    return writer.trigger(**trigger).start()


def stream_dedup(stream: DataFrame, key: list[str], root: str, checkpoint: str, seq: str = "seq", every: str | None = None) -> StreamingQuery:
    """Keep the first arrival of each key ever seen, against the stored keys."""
    schema = stream.schema

    def each(batch: DataFrame, batch_id: int) -> None:
        table = StateTable(batch.sparkSession, root, key, schema)
        stored = table.read(batch_id, batch.select(*key))
        table.write(M.insert_if_absent(stored, batch, key, seq), batch_id)

    return start(stream, each, checkpoint, every)


def dedup_within(stream: DataFrame, key: list[str], at: str, window: str = "5 minutes") -> DataFrame:
    """Queue-style deduplication inside a time window.

    Rows later than the window are dropped, so this is not for the event log.
    """
    return stream.withColumn(at, F.col(at).cast("timestamp")).withWatermark(at, window).dropDuplicatesWithinWatermark(key)


def stream_latest_state(
    stream: DataFrame, keys: list[str], attributes: list[str], schema: StructType, root: str, checkpoint: str, every: str | None = None
) -> StreamingQuery:
    """Latest state per key under the age guard; each batch rewrites only the keys it touches."""

    def each(batch: DataFrame, batch_id: int) -> None:
        table = StateTable(batch.sparkSession, root, keys, schema)
        state = M.merge_core(table.read(batch_id, batch.select(*keys)), batch, keys, attributes)
        table.write(state.select(*schema.fieldNames()), batch_id)

    return start(stream, each, checkpoint, every)


def stream_enrich(
    stream: DataFrame,
    responses: DataFrame,
    root: str,
    checkpoint: str,
    applied_at: Callable[[int], Column] | None = None,
    every: str | None = None,
) -> StreamingQuery:
    """Enrich message batches; tables are written before the batch counts as consumed.

    What a batch leaves in the queue is delivered again by the first batch after
    its delay. ``applied_at`` gives the time of a batch, now if not given.
    ``plans.enrichment.drain_queue`` ends a run that no batch follows.
    """
    drained = drains(stream.sparkSession, root)

    def each(batch: DataFrame, batch_id: int) -> None:
        at = F.current_timestamp() if applied_at is None else applied_at(batch_id)
        enrich_batch(batch, responses, root, batch_id + drained, at)

    return start(stream, each, checkpoint, every)


def stream_events(
    stream: DataFrame, root: str, checkpoint: str, frame: str = "body", received_at: Column | None = None, every: str | None = None
) -> StreamingQuery:
    """Ingest subscription frames: unwrap, parse, archive, log new events, commit the position.

    ``stream`` carries the frame text and an arrival number ``seq``.
    """

    def each(batch: DataFrame, batch_id: int) -> None:
        at = F.current_timestamp() if received_at is None else received_at
        events = parse_event_v1(extract_payloads(spread(batch), frame, "event"), "event", at)
        with scratch(batch.sparkSession) as cut:
            store(cut(events.drop("event"), "events"), batch_id, at)

    def store(parsed: DataFrame, batch_id: int, at: Column) -> None:
        records = to_raw_record(parsed, at)
        # A replayed batch replaces its own archive folder.
        write_raw_events(records, f"{root}/raw/batch_id={batch_id}", mode="overwrite")
        key_of = S.archive_key(F.col("hotel_id"), F.col("occurred_at"), F.col("unique_event_id"))
        rows = parsed.select(
            "unique_event_id", "hotel_id", "module", "action_type", "occurred_at", at.alias("received_at"), key_of.alias("raw_key"), "stream_offset", "payload", "seq"
        )
        key = ["unique_event_id"]
        table = StateTable(parsed.sparkSession, f"{root}/events", key, rows.schema)
        table.write(M.insert_if_absent(table.read(batch_id, rows.select(*key)), rows, key), batch_id)
        position = parsed.withColumn("subscription", F.lit("events")).withColumn("offset", F.col("stream_offset"))
        write_changes(commit_offset(position, "subscription", at=at), f"{root}/offsets", batch_id)

    return start(stream, each, checkpoint, every)
