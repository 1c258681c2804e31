"""Attaching responses to routed events and deciding what becomes of each event."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stayflow.functions import scalars as S
from stayflow.functions.jsontree import fence

OPERATIONS = ["getReservation", "getProfile", "getFolio", "getFolioTransactionDetails"]


def attach_responses(events: DataFrame, responses: DataFrame) -> DataFrame:
    """Left join of routed events with landed responses.

    A profile is fetched by id alone, the others within a hotel. The newest
    response (``fetch_seq``) of a resource is taken, and only resources that some
    event asks for are reduced: the landed table grows without end, a batch does
    not. Events without identifier get a key of their own, so they do not pile up
    in one partition.
    """
    result = ["status_code", "retry_after", "response"]

    def scope(operation: Column, hotel: Column) -> Column:
        return F.when(operation == "getProfile", F.lit("")).otherwise(hotel)

    landed = responses.select(
        "operation_id",
        scope(F.col("operation_id"), F.col("hotel_id")).alias("_scope"),
        F.col("resource_id").alias("_resource"),
        F.struct("status_code", "retry_after", F.col("payload").alias("response")).alias("_r"),
        "fetch_seq",
    )
    own = F.concat(F.lit("\u0002"), F.col("unique_event_id"))
    keyed = events.withColumn("_scope", scope(F.col("operation_id"), F.col("hotel_id"))).withColumn(
        "_resource", F.coalesce("resource_id", own)
    )
    keys = ["operation_id", "_scope", "_resource"]
    asked = keyed.where("resource_id is not null").select(*keys).distinct()
    newest = landed.join(asked, keys, "left_semi").groupBy(*keys).agg(F.max_by("_r", "fetch_seq").alias("_r"))
    return keyed.join(newest, keys, "left").select(
        *events.columns, *[F.col(f"_r.{c}").alias(c) for c in result]
    )


def retry_decision(status_code: Column, is_delete: Column) -> Column:
    """success, deleted, retry or poison for an HTTP status."""
    return (
        F.when(status_code < 400, "success")
        .when((status_code == 404) & is_delete, "deleted")
        .when((status_code == 429) | status_code.between(500, 599) | (status_code == 401), "retry")
        .otherwise("poison")
    )


def retry_reason(status_code: Column, is_delete: Column) -> Column:
    return (
        F.when(status_code < 400, F.lit(None).cast("string"))
        .when((status_code == 404) & is_delete, "resource deleted or cancelled")
        .when(status_code == 429, "rate limited")
        .when(status_code.between(500, 599), "server error")
        .when(status_code.isin(400, 404), "non-retryable API error")
        .when(status_code == 401, "unauthorized after token refresh")
        .otherwise("unexpected API error")
    )


def retry_classify(df: DataFrame) -> DataFrame:
    """Add ``decision``, ``reason`` and, for retries, ``visible_in`` seconds.

    Only a rate limit carries its own delay; other retries use the default.
    """
    code, gone = F.col("status_code"), F.col("is_delete_or_cancel")
    delay = F.when(code == 429, S.retry_after(F.col("retry_after")))
    return (
        df.withColumn("decision", retry_decision(code, gone))
        .withColumn("reason", retry_reason(code, gone))
        .withColumn("visible_in", F.when(F.col("decision") == "retry", S.retry_visibility(delay)))
    )


def process_outcome(df: DataFrame) -> DataFrame:
    """Add ``outcome`` and ``error`` for each routed event with its response.

    COMPLETED, DELETED or FAILED go to the event log; RETRY leaves the event as
    received and visible again later. A resource nothing was landed for yet is
    a retry too.
    """
    no_route = F.col("operation_id").isNull()
    unknown = ~F.col("operation_id").isin(OPERATIONS)
    no_id = F.col("resource_id").isNull()
    waiting = F.col("status_code").isNull()
    decided = retry_classify(df)
    outcome = (
        F.when(no_route | no_id | unknown, "FAILED")
        .when(waiting, "RETRY")
        .otherwise(
            F.when(F.col("decision") == "success", "COMPLETED")
            .when(F.col("decision") == "deleted", "DELETED")
            .when(F.col("decision") == "retry", "RETRY")
            .otherwise("FAILED")
        )
    )
    nothing = F.lit("null")
    error = (
        F.when(
            no_route,
            F.concat(
                F.lit("No route for moduleName="),
                F.coalesce("module_name", nothing),
                F.lit(" eventName="),
                F.coalesce("event_name", nothing),
            ),
        )
        .when(no_id, F.concat(F.lit("Could not resolve "), F.col("identifier_type"), F.lit(" for event "), F.col("unique_event_id")))
        .when(unknown, F.concat(F.lit("Unsupported operation_id="), F.col("operation_id")))
        .when(F.col("decision") == "poison", F.coalesce("response", "reason"))
    )
    shown = decided.withColumn("outcome", outcome).withColumn("error", error)
    delay = F.when(F.col("outcome") == "RETRY", F.coalesce("visible_in", S.retry_visibility(F.lit(None).cast("int"))))
    return fence(shown.withColumn("visible_in", delay), *df.columns)
