"""Queue-shaped views of events: messages, archive records, FIFO order, dead letters, offsets."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stayflow.functions import scalars as S
from stayflow.operators.running import earlier

DEAD_LETTER_GROUP = "event-enricher-poison"


def _iso(ts: Column) -> Column:
    """UTC ISO text, with a fraction only where there is one."""
    seconds = F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss")
    micros = F.date_format(ts, ".SSSSSS")
    return F.concat(seconds, F.when(micros != ".000000", micros).otherwise(F.lit("")), F.lit("+00:00"))


def _body(*extra: Column) -> Column:
    """Canonical JSON of an event envelope: keys sorted, nulls written, payload nested."""
    parts = [
        F.col("action_type"),
        F.col("hotel_id"),
        *extra,
        F.col("module"),
        _iso(F.col("occurred_at")).alias("occurred_at"),
        F.col("stream_offset").alias("offset"),
        F.try_parse_json("payload").alias("payload"),
        F.col("unique_event_id"),
    ]
    return F.to_json(F.struct(*parts), {"ignoreNullFields": "false"})


def to_queue_message(df: DataFrame, default_group: str = "event-stream") -> DataFrame:
    """Message body, FIFO group (hotel, or the default when empty), deduplication id and attributes."""
    return df.select(
        _body().alias("body"),
        F.coalesce(S.to_text(F.col("hotel_id")), F.lit(default_group)).alias("group_id"),
        F.col("unique_event_id").alias("dedup_id"),
        F.create_map(F.lit("hotel_id"), F.col("hotel_id"), F.lit("unique_event_id"), F.col("unique_event_id")).alias("attributes"),
    )


def to_raw_record(df: DataFrame, ingested_at: Column, prefix: str = "raw") -> DataFrame:
    """Archive record: object key under ``prefix`` and canonical body with its ingest time."""
    return df.select(
        S.archive_key(F.col("hotel_id"), F.col("occurred_at"), F.col("unique_event_id"), prefix).alias("raw_key"),
        "unique_event_id",
        "hotel_id",
        "occurred_at",
        _body(_iso(ingested_at).alias("ingested_at")).alias("body"),
    )


def write_raw_events(records: DataFrame, path: str, mode: str = "append") -> None:
    """Archive records as text files partitioned by hotel and day.

    Rows are rebalanced by hotel and day: adaptive execution splits a busy
    hotel's day over as many writers as its size asks for, and a small folder
    does not get a file from every task.
    """
    dated = records.select(
        "hotel_id",
        F.date_format("occurred_at", "yyyy").alias("y"),
        F.date_format("occurred_at", "MM").alias("m"),
        F.date_format("occurred_at", "dd").alias("d"),
        F.col("body").alias("value"),
    )
    days = ["hotel_id", "y", "m", "d"]
    dated.hint("rebalance", *days).write.mode(mode).partitionBy(*days).text(path)


def fifo_prefix(df: DataFrame, group: str = "group_id", seq: str = "seq", ok: str = "ok") -> DataFrame:
    """Per group, the messages up to and including the first that failed.

    The first failure is an aggregate joined back, so a group holding a third
    of all messages is never sorted or held in one task.
    """
    first = df.where(~F.col(ok)).groupBy(group).agg(F.min(seq).alias("_stop"))
    return df.join(first, group, "left").where(F.col("_stop").isNull() | (F.col(seq) <= F.col("_stop"))).select(*df.columns)


def dead_letter(df: DataFrame, max_attempts: int = 5) -> DataFrame:
    """Poison messages out of attempts, as dead-letter rows."""
    spent = df.where((F.col("decision") == "poison") & (F.col("receive_count") >= max_attempts))
    return spent.select(
        "message_id",
        "body",
        F.lit(DEAD_LETTER_GROUP).alias("group_id"),
        F.concat(F.lit("poison-"), F.coalesce("message_id", F.lit(""))).alias("dedup_id"),
        S.truncate_error(F.col("reason"), 256).alias("failure_reason"),
    )


def left_for_retry(df: DataFrame, max_attempts: int = 5) -> DataFrame:
    """Poison messages with attempts left."""
    return df.where((F.col("decision") == "poison") & (F.col("receive_count") < max_attempts))


def commit_offset(df: DataFrame, subscription: str = "chain_code", seq: str = "seq", at: Column | None = None) -> DataFrame:
    """Latest position per subscription, by arrival."""
    last = df.groupBy(F.col(subscription).alias("subscription_name")).agg(
        F.max_by(F.struct("offset", "unique_event_id"), seq).alias("_last")
    )
    return last.select(
        "subscription_name",
        F.col("_last.offset").alias("offset"),
        F.col("_last.unique_event_id").alias("last_unique_event_id"),
        (F.current_timestamp() if at is None else at).alias("updated_at"),
    )


def schedule(df: DataFrame, now: int | None, group: str = "group_id", seq: str = "seq") -> DataFrame:
    """When each message of a FIFO group has its turn up to the time ``now``: ``tried`` (times), ``done`` and ``due``.

    Times are in microseconds; without ``now`` all of time passes. A message has
    ``tries`` (how often it is delivered until it leaves the queue) and
    ``delay`` (the wait between two of them), and holds up those behind it. It is
    there from ``since`` on: the time a waiting message is due (``waiting``), the
    time it arrives for a new one, or later if its group waits for another. The
    waits of a group are a running sum, so any number of redeliveries takes one
    pass. ``due`` is when the group's next delivery comes, if it has one.
    """
    waited = (F.col("tries") - 1) * F.col("delay")
    rows = earlier(df.withColumn("_waited", waited), [group, "waiting"], seq, F.col("_waited"), "_before", "sum")
    # New messages come after all that wait.
    old = F.when(F.col("waiting"), 1)
    ends = rows.groupBy(group).agg((F.max(old * F.col("since")) + F.sum(old * F.col("_waited"))).alias("_free"))
    timed = rows.join(ends, group).withColumn("_start", F.when(F.col("waiting"), F.col("since")).otherwise(F.greatest("since", "_free")) + F.col("_before"))
    if now is None:
        tried, time = F.col("tries").cast("bigint"), None
    else:
        time = F.lit(now)
        often = F.floor((time - F.col("_start")) / F.greatest("delay", F.lit(1))) + 1
        tried = F.when(F.col("_start") > time, 0).when(F.col("tries") == 1, 1).otherwise(F.least(F.col("tries"), often)).cast("bigint")
    told = timed.withColumn("tried", tried).withColumn("done", F.col("tried") == F.col("tries"))
    due = told.where(~F.col("done")).groupBy(group).agg(F.min(F.col("_start") + F.col("tried") * F.col("delay")).alias("due"))
    return told.join(due, group, "left").select(*df.columns, "tried", "done", "due")
