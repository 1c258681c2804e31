"""Routing events to resources and resolving which resource they refer to."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stayflow.functions import jsontree as J
from stayflow.functions import scalars as S
from stayflow.operators.parse import detail_lookup
from stayflow.sources.routes import ALIASES, ROUTES

ROUTE_COLUMNS = ["resource_type", "operation_id", "method", "path", "identifier_type", "fetch"]

# Names an identifier may go by.
IDENTIFIER_NAMES = {
    "reservationId": ["reservationId", "reservationID", "resvId", "resvNameId", "confirmationNo"],
    "transactionNo": ["transactionNo", "transactionNumber", "transactionId", "trxNo"],
    "profileId": ["profileId", "profileID", "profileNo", "nameId"],
    "primaryKey": ["primaryKey", "primary_key"],
}


def _alias(value: Column, table: dict[str, str]) -> Column:
    if not table:
        return value
    lookup = F.create_map(*[F.lit(x) for pair in table.items() for x in pair])
    return F.coalesce(F.try_element_at(lookup, value), F.try_element_at(lookup, F.upper(value)), value)


def normalize_aliases(df: DataFrame, aliases: dict[str, dict[str, str]] | None = None) -> DataFrame:
    """Add ``module_norm`` and ``event_norm``: alias as written, then upper-cased, else unchanged."""
    aliases = ALIASES if aliases is None else aliases
    return df.withColumn("module_norm", _alias(F.col("module_name"), aliases.get("moduleName", {}))).withColumn(
        "event_norm", _alias(F.col("event_name"), aliases.get("eventName", {}))
    )


def route_events(
    df: DataFrame, routes: list[dict] | None = None, aliases: dict[str, dict[str, str]] | None = None
) -> DataFrame:
    """Attach the route of each event: exact (module, event), else (module, ``*``), else nulls.

    The route table is a handful of configured rows, never data: it is a map
    literal in the plan, and routing needs no join. The first listed route wins.
    """
    first: dict[tuple[str, str], dict] = {}
    for route in ROUTES if routes is None else routes:
        first.setdefault((route["moduleName"], route["eventName"]), {"method": "GET", **route})
    module, event = F.col("module_norm"), F.col("event_norm")

    def at(of: Column | str, name: Column | str) -> Column:
        """A key that tells every pair apart, null when either is."""
        parts = [F.lit(x) if isinstance(x, str) else x for x in (of, name)]
        return F.concat(F.length(parts[0]).cast("string"), F.lit(":"), *parts)

    route = F.lit(None).cast("struct<" + ",".join(f"{c}:string" for c in ROUTE_COLUMNS) + ">")
    if first:
        rows = [(at(*pair), F.struct(*[F.lit(r[c]).alias(c) for c in ROUTE_COLUMNS])) for pair, r in first.items()]
        table = F.create_map(*[x for row in rows for x in row])
        route = F.coalesce(F.try_element_at(table, at(module, event)), F.try_element_at(table, at(module, "*")))
    routed = normalize_aliases(df, aliases).withColumn("_route", route)
    return routed.select(
        *df.columns, "module_norm", "event_norm", *[F.col(f"_route.{c}").alias(c) for c in ROUTE_COLUMNS]
    )


def has_digit(value: Column) -> Column:
    return value.rlike(r"\d")


def resolve_identifier(df: DataFrame, routes: list[dict] | None = None) -> DataFrame:
    """Add ``resource_id``, the identifier the event's route asks for; null when unresolvable.

    Tried in order: a fitting primary key (never for folios, which are looked
    up by reservation), top-level metadata, the change list, anywhere in the
    payload. The payload is parsed only for events still open by then. A kind
    that only ``routes`` know is looked up by its own name, never by primary key.
    """
    known = {r["identifier_type"]: [r["identifier_type"]] for r in (ROUTES if routes is None else routes)}
    names_of = {**known, **IDENTIFIER_NAMES}
    place = {name: f"_p_{i}" for i, name in enumerate(names_of)}
    kind, key = F.col("identifier_type"), F.nullif(F.col("primary_key"), F.lit(""))
    by_reservation = (F.col("resource_type") == "folio") & (kind == "reservationId")
    fitting = F.when(kind.isin(list(IDENTIFIER_NAMES)) & ~by_reservation, key)
    direct = F.when((kind != "transactionNo") | has_digit(key), fitting)

    def per_kind(make) -> Column:
        out = F.lit(None).cast("string")
        for name, names in names_of.items():
            out = F.when(kind == name, make(names)).otherwise(out)
        return out

    meta = per_kind(
        lambda names: F.coalesce(*[S.to_text(F.try_element_at(F.col("metadata"), F.lit(n))) for n in sorted(names)])
    )
    detail = per_kind(lambda names: F.expr(detail_lookup("details", names, skip_empty=True)))
    step = df.withColumn("_direct", F.coalesce(direct, meta, detail))
    still = "_direct is null and identifier_type is not null"
    opened = step.selectExpr("*", f"case when {still} then {J.parse('payload')} end as _open")
    opened = opened.selectExpr("*", "case when _open is not null then payload end as _open_text")
    found = J.search_fields(opened, "_open", "_open_text", {place[k]: v for k, v in names_of.items()})
    deep = F.lit(None).cast("string")
    for name in names_of:
        deep = F.when(kind == name, F.col(place[name])["text"]).otherwise(deep)
    resolved = found.withColumn("resource_id", F.coalesce("_direct", deep, F.when(kind == "primaryKey", key)))
    return J.fence(resolved.select(*df.columns, "resource_id"), *df.columns)


def with_request_path(df: DataFrame) -> DataFrame:
    """Add ``request_path``, the route's template filled in."""
    return df.withColumn("request_path", S.expand_path(F.col("path"), F.col("hotel_id"), F.col("resource_id")))
