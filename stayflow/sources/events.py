"""Reading landed events, queue messages and resource responses."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stayflow.functions import jsontree as J
from stayflow.functions import scalars as S


def read_event_files(spark: SparkSession, path: str, streaming: bool = False, lines: bool = False, max_files: int | None = None) -> DataFrame:
    """Landed event bodies as column ``body``: one document per file, or one per line."""
    reader = spark.readStream if streaming else spark.read
    if max_files and streaming:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.option("wholetext", not lines).format("text").load(path).withColumnRenamed("value", "body")


def extract_payloads(df: DataFrame, col: str, out: str = "body") -> DataFrame:
    """Unwrap subscription frames to one row per event.

    ``data.newEvent`` object, else ``data.businessEvents``, else the frame
    itself; a list gives a row per object in it, anything else gives none.
    """
    doc = J.fence(df.selectExpr("*", f"{J.parse(col)} as _frame"), *df.columns).where(J.is_object("_frame"))
    single = J.member("_frame", "$.data.newEvent")
    many = J.member("_frame", "$.data.businessEvents")
    # JSON null is as good as absent here.
    absent = f"coalesce(schema_of_variant({many}), 'VOID') = 'VOID'"
    other = J.bind(
        f"if({absent}, _frame, {many})",
        lambda b: f"coalesce(filter({J.items(b)}, x -> {J.is_object('x')}), case when {J.is_object(b)} then array({b}) end)",
    )
    rows = f"if({J.is_object(single)}, array({single}), {other})"
    kept = [f"`{c}`" for c in df.columns if c != out]
    return doc.selectExpr(*kept, f"explode({rows}) as _event").selectExpr(*kept, f"to_json(_event) as {out}")


_ENVELOPE = ["unique_event_id", "hotel_id", "module", "action_type", "offset"]
_REQUIRED = ["unique_event_id", "hotel_id", "occurred_at", "payload"]


def _envelope(df: DataFrame, col: str) -> DataFrame:
    doc = df.selectExpr("*", f"{J.parse(col)} as _doc").selectExpr("*", f"{J.entries('_doc')} as _members")
    moment = J.bind(J.text_at("_doc", "$.occurred_at"), S.iso_timestamp)
    present = " and ".join(f"map_contains_key(_members, '{n}')" for n in _REQUIRED)
    read = doc.selectExpr(
        *[f"`{c}`" for c in df.columns],
        *[f"{J.text_at('_doc', '$.' + n)} as {n}" for n in _ENVELOPE],
        f"{moment} as occurred_at",
        f"to_json({J.member('_doc', '$.payload')}) as payload",
        f"{present} as _present",
    )
    complete = F.expr("coalesce(_present and occurred_at is not null, false)")
    return J.fence(read.withColumn("_complete", complete).drop("_present"), *df.columns)


def read_queue_messages(df: DataFrame, col: str = "body") -> DataFrame:
    """Envelope columns of queue messages; id, hotel, time and payload are required."""
    return _envelope(df, col).where("_complete").drop("_complete")


def rejected_queue_messages(df: DataFrame, col: str = "body") -> DataFrame:
    """Messages without a required envelope field, untouched."""
    return _envelope(df, col).where("not _complete").select(*df.columns)


def read_resource_responses(spark: SparkSession, path: str, schema: str | None = None, streaming: bool = False) -> DataFrame:
    """Landed API responses: operation, resource, hotel, status code, payload, optional retry header."""
    fields = schema or (
        "operation_id string, hotel_id string, resource_id string, status_code int,"
        " retry_after string, payload string"
    )
    reader = spark.readStream if streaming else spark.read
    return reader.schema(fields).json(path)


def replay_from(df: DataFrame, chain_code: str, committed: DataFrame | None = None, offset: str | None = None) -> DataFrame:
    """Events of a chain past the saved position.

    The position is either given or taken from a committed-offsets table as a
    scalar subquery, so nothing is collected.
    """
    mine = df.where(F.col("chain_code") == chain_code)
    if offset is not None:
        return mine.where(F.col("offset").try_cast("bigint") > int(offset))
    if committed is None:
        return mine
    saved = committed.where(F.col("subscription_name") == chain_code).select(
        F.coalesce(F.max(F.col("offset").try_cast("bigint")), F.lit(-1))
    )
    return mine.where(F.col("offset").try_cast("bigint") > saved.scalar())
