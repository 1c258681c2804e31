"""Row counts, latency statistics and processing counters."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stayflow.schemas import QUEUE_COUNTERS

# Digits of the search below: 2^16 candidates per step, 2^64 overall.
_STEP_BITS = 16


def storage_counts(events: DataFrame, raw: DataFrame, core: DataFrame, snapshot: DataFrame, status: DataFrame) -> DataFrame:
    """Row counts of the five tables; events count when completed."""
    tables = {
        "events_completed": events.where("status = 'COMPLETED'"),
        "raw_snapshots": raw,
        "core_reservations": core,
        "daily_snapshot_rows": snapshot,
        "last_status_rows": status,
    }
    parts = [df.agg(F.count("*").alias("rows")).select(F.lit(n).alias("name"), "rows") for n, df in tables.items()]
    return reduce(DataFrame.unionByName, parts)


def exact_percentiles(df: DataFrame, group: str, value: str, percents: list[float]) -> DataFrame:
    """Exact order statistics at rank ``floor((n - 1) * p)`` of a non-negative BIGINT, per group.

    Counts per distinct value are taken first. The rank is then located digit
    by digit, most significant first: each step sums counts per candidate
    digit, so no task ever holds more than 2^16 rows of a group however many
    measurements or distinct values it has.
    """
    counts = df.groupBy(group, F.col(value).alias("_v")).agg(F.count("*").alias("_n"))
    totals = counts.groupBy(group).agg(F.sum("_n").alias("_total"))
    asked = F.explode(F.array(*[F.lit(float(p)) for p in percents])).alias("percent")
    state = totals.select(group, "_total", asked).select(
        group, "percent", F.floor((F.col("_total") - 1) * F.col("percent")).cast("bigint").alias("_rank"), F.lit(0).cast("bigint").alias("_prefix")
    )
    shift = 64 - _STEP_BITS
    while shift >= 0:
        # Values still in play share the digits found so far.
        head = F.lit(0).cast("bigint") if shift + _STEP_BITS >= 64 else F.shiftright("_v", shift + _STEP_BITS)
        candidates = counts.select(group, "_n", head.alias("_prefix"), F.shiftright("_v", shift).alias("_digit"))
        live = candidates.join(state.select(group, "_prefix").distinct(), [group, "_prefix"], "left_semi")
        bins = live.groupBy(group, "_prefix", "_digit").agg(F.sum("_n").alias("_n"))
        order = Window.partitionBy(group, "_prefix").orderBy("_digit").rowsBetween(Window.unboundedPreceding, -1)
        bins = bins.withColumn("_below", F.coalesce(F.sum("_n").over(order), F.lit(0)))
        hit = (F.col("_rank") >= F.col("_below")) & (F.col("_rank") < F.col("_below") + F.col("_n"))
        state = (
            state.join(bins, [group, "_prefix"])
            .where(hit)
            .select(group, "percent", (F.col("_rank") - F.col("_below")).alias("_rank"), F.col("_digit").alias("_prefix"))
        )
        shift -= _STEP_BITS
    return state.select(group, "percent", F.col("_prefix").alias("value"))


def stage_latency(df: DataFrame, stage: str = "stage", millis: str = "ms") -> DataFrame:
    """Count, total, mean, p50, p95, p99 and max per stage, milliseconds.

    Percentiles are exact at the precision reported (a millionth of a
    millisecond), taken on whole nanoseconds.
    """
    timed = df.select(F.col(stage).alias("stage"), F.col(millis).alias("ms"))
    nanos = timed.withColumn("ns", F.round(F.col("ms") * 1_000_000).cast("bigint"))
    ranks = exact_percentiles(nanos, "stage", "ns", [0.5, 0.95, 0.99])

    def at(p: float, name: str) -> Column:
        return (F.max(F.when(F.col("percent") == p, F.col("value"))) / F.lit(1_000_000.0)).alias(name)

    wide = ranks.groupBy("stage").agg(at(0.5, "p50_ms"), at(0.95, "p95_ms"), at(0.99, "p99_ms"))
    basics = timed.groupBy("stage").agg(
        F.count("*").alias("count"),
        F.round(F.sum("ms"), 3).alias("total_ms"),
        F.round(F.avg("ms"), 6).alias("avg_ms"),
        F.round(F.max("ms"), 6).alias("max_ms"),
    )
    return basics.join(wide, "stage")


def usage_summary(df: DataFrame, metric: str = "metric", value: str = "value") -> DataFrame:
    return df.groupBy(F.col(metric).alias("metric")).agg(
        F.round(F.avg(value), 2).alias("avg"), F.round(F.max(value), 2).alias("max")
    )


def count_new_ids(seen: DataFrame, batch: DataFrame, key: str = "unique_event_id") -> DataFrame:
    """How many distinct ids of the batch were not seen before."""
    fresh = batch.select(key).distinct().join(seen.select(key), key, "left_anti")
    return fresh.agg(F.count("*").alias("new_ids"))


def processing_counters(df: DataFrame) -> DataFrame:
    """Counters over processed events: one row, from a single pass.

    Expects ``outcome``, ``status_code``, ``resource_id``, ``operation_id``,
    ``occurred_at`` and the flags ``deduplicated`` and ``dead_lettered``.
    """
    outcome = F.col("outcome")
    done = outcome.isin("COMPLETED", "DELETED")
    return df.agg(
        F.count("*").alias("received"),
        F.count_if(done).alias("processed"),
        F.count_if(~done).alias("failed"),
        F.count_if((outcome == "COMPLETED") & ~F.col("deduplicated")).alias("enriched"),
        F.count_if(F.col("deduplicated")).alias("deduplicated"),
        F.count_if(outcome == "RETRY").alias("retried"),
        F.count_if(F.col("dead_lettered")).alias("dead_lettered"),
        F.count_if(F.col("operation_id").isNotNull() & F.col("resource_id").isNull()).alias("unresolvable"),
        F.max("occurred_at").alias("last_event_at"),
    )


def queue_counters() -> dict[str, list[Column]]:
    """Counters of a queue batch by the table they are taken from, for ``DataFrame.observe`` on a write that happens anyway.

    ``decided``: every message looked at. ``turns``: deliveries made. ``flagged``:
    delivered events that are logged. ``dead``: dead letters. Each message counts
    once, in the batch that takes it in or in the one that is done with it;
    deliveries that were not the last are ``retried``. So they add up over batches.
    """
    handled = F.col("outcome").isin("COMPLETED", "DELETED")
    lost = F.col("done") & F.col("operation_id").isNotNull() & F.col("resource_id").isNull()
    return {
        "decided": [F.count_if(~F.col("waiting")).alias("received")],
        "turns": [F.count_if("done").alias("finished"), F.coalesce(F.sum("tried"), F.lit(0)).alias("deliveries")],
        "flagged": [
            F.count_if(handled).alias("processed"),
            F.count_if((F.col("outcome") == "COMPLETED") & ~F.col("deduplicated")).alias("enriched"),
            F.count_if("deduplicated").alias("deduplicated"),
            F.count_if(lost).alias("unresolvable"),
            F.max("occurred_at").alias("last_event_at"),
        ],
        "dead": [F.count(F.lit(1)).alias("dead_lettered")],
    }


def add_counters(counters: DataFrame) -> DataFrame:
    """Counters of several batches as one row."""
    sums = [F.coalesce(F.sum(n), F.lit(0)).alias(n) for n in QUEUE_COUNTERS.fieldNames() if n != "last_event_at"]
    return counters.agg(*sums, F.max("last_event_at").alias("last_event_at"))


def errors_by_code(df: DataFrame) -> DataFrame:
    return df.where("status_code >= 400").groupBy("status_code").agg(F.count("*").alias("errors"))


def batch_summary(df: DataFrame, batch: str = "batch_id") -> DataFrame:
    """Number of batches and their sizes."""
    sizes = df.groupBy(batch).agg(F.count("*").alias("n"))
    return sizes.agg(
        F.count("*").alias("count"),
        F.coalesce(F.min("n"), F.lit(0)).alias("min_size"),
        F.coalesce(F.max("n"), F.lit(0)).alias("max_size"),
        F.coalesce(F.round(F.avg("n"), 2), F.lit(0.0)).alias("avg_size"),
    )
