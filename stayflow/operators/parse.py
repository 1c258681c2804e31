"""Business-event JSON to typed rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stayflow.functions import jsontree as J
from stayflow.functions import scalars as S

# Key names per field, flat (v1) events.
V1_NAMES = {
    "id": ["uniqueEventId", "unique_event_id", "businessEventId", "eventId"],
    "hotel": ["hotelId", "hotelID", "resort", "propertyCode", "hotelCode"],
    "module": ["moduleName", "module", "eventType"],
    "action": ["actionType", "action", "eventName"],
    "offset": ["offset", "cursor", "sequence", "sequenceNumber"],
    "time": ["timestamp", "createdDateTime", "creationDate", "eventTime"],
}
# Key names per field, enveloped (v2) events.
V2_NAMES = {
    "id": ["uniqueEventId", "unique_event_id", "businessEventId", "eventId"],
    "offset": ["offset", "stream_offset", "sequence"],
    "key": ["primaryKey", "primary_key", "primaryKeyValue"],
    "module": ["moduleName", "module", "module_name"],
    "event": ["eventName", "actionType", "action_type", "action"],
    "hotel": ["hotelId", "hotelID", "hotel_id", "resort"],
    "chain": ["chainCode", "chain_code"],
    "time": ["timestamp", "createdDateTime", "creationDate", "eventTime"],
}
_DETAIL_TEXT = [
    "elementName",
    "name",
    "oldValue",
    "newValue",
    "value",
    "elementType",
    "elementRole",
    "elementSequence",
    "scopeFrom",
    "scopeTo",
]
_NOT_METADATA = ["payload", "detail", "details"]


def _opens_object(text: str) -> str:
    return f"startswith(trim(leading ' \\t\\r\\n' from {text}), '{{')"


def malformed(df: DataFrame, json_col: str) -> DataFrame:
    """Rows whose text is not a JSON object; no parser takes them."""
    return df.where(f"not coalesce({_opens_object(json_col)} and {J.parse(json_col)} is not null, false)")


def _parsed(df: DataFrame, json_col: str, out: str) -> DataFrame:
    doc = df.where(_opens_object(json_col)).selectExpr("*", f"{J.parse(json_col)} as {out}")
    return J.fence(doc, *df.columns).where(f"{out} is not null")


def _with_doc(df: DataFrame, json_col: str) -> DataFrame:
    """Add ``_doc`` (search space) and ``_payload`` (the event proper, as JSON text).

    An envelope with an object under ``payload`` is searched as the payload's
    members overlaid with its own; those under the payload's names (``_lead``)
    come before the rest. An event without envelope is its own payload and keeps
    its text as landed.
    """
    outer = f"case when {J.mentions(json_col, ['payload'])} > 0 then {J.entries('_body')} end as _outer"
    wrapped = _parsed(df, json_col, "_body").selectExpr("*", outer)
    inner = "try_element_at(_outer, 'payload')"
    has = "coalesce(map_contains_key(_outer, 'payload'), false)"
    opened = wrapped.selectExpr(
        "*", f"{has} as _has", f"case when {has} then {J.entries(inner)} end as _inner"
    )
    overlay = (
        "to_variant_object(map_concat(map_filter(_inner, (k, v) -> not map_contains_key(_outer, k)), _outer))"
    )
    lead = "to_variant_object(map_from_entries(transform(map_entries(_inner), e -> struct(e.key, coalesce(try_element_at(_outer, e.key), e.value)))))"
    alone = "to_variant_object(map_filter(_outer, (k, v) -> k = 'payload'))"
    return opened.selectExpr(
        *[f"`{c}`" for c in df.columns],
        f"case when _inner is not null then {overlay} else _body end as _doc",
        f"case when _inner is not null then {lead} end as _lead",
        "case when _inner is not null then to_json(to_variant_object(_inner))"
        f" when _has then to_json({alone}) else {json_col} end as _payload",
    )


def _payload_id(payload: str) -> str:
    """Stand-in id: the hash of the canonical payload, whatever its key order or spacing."""
    return f"sha2({J.canonical_json(payload)}, 256)"


def parse_event_v1(df: DataFrame, json_col: str, received_at: Column) -> DataFrame:
    """Identity fields of a flat event, found by name anywhere in it."""
    doc = _parsed(df.withColumn("_received", received_at), json_col, "_doc")
    found = J.search_fields(doc, "_doc", json_col, {f"_{k}": v for k, v in V1_NAMES.items()})
    parsed = found.selectExpr(
        *[f"`{c}`" for c in df.columns],
        f"coalesce({J.truthy('_id')}, {_payload_id(json_col)}) as unique_event_id",
        f"coalesce({J.truthy('_hotel')}, 'UNKNOWN') as hotel_id",
        f"{J.truthy('_module')} as module",
        f"{J.truthy('_action')} as action_type",
        f"{S.event_time('_time', '_received')} as occurred_at",
        f"{J.truthy('_offset')} as stream_offset",
        f"{json_col} as payload",
    )
    return J.fence(parsed, *df.columns)


def event_details(doc: str, text: str) -> str:
    """Change list of an event: ``detail``, else ``details``, else the first one found deeper."""

    def top(name: str) -> str:
        some = f"coalesce(size({J.items('c')}) > 0, false) or {J.truthy(J.found_value('c'))} is not null"
        return f"get(filter(array({J.member(doc, '$.' + name)}), c -> {some}), 0)"

    names = ["detail", "details"]
    deeper = f"case when {J.mentions(text, names)} > 0 then {J.parse(J.find_first(doc, text, names))} end"
    chosen = f"coalesce({top('detail')}, {top('details')}, {deeper})"
    listed = J.bind(chosen, lambda b: f"coalesce({J.items(b)}, array({b}))")
    changes = f"filter(transform({listed}, d -> {J.texts_at('d', _DETAIL_TEXT)}), c -> c is not null)"
    parts = [f"'{n}', " + (f"try_cast(c.{n} as int)" if n == "elementSequence" else f"c.{n}") for n in _DETAIL_TEXT]
    return f"transform(coalesce({changes}, array()), c -> named_struct({', '.join(parts)}))"


def event_metadata(doc: str) -> str:
    """Top-level scalar members of an event as text."""
    plain = "coalesce(substr(schema_of_variant(v), 1, 5) not in ('OBJEC', 'ARRAY'), true)"
    scalar = f"map_filter({J.entries(doc)}, (k, v) -> k not in ({J.name_list(_NOT_METADATA)}) and {plain})"
    return f"transform_values({scalar}, (k, v) -> {J.text_at('v')})"


def detail_lookup(details: str, names: list[str], skip_empty: bool = False) -> str:
    """Value of the first change whose element name is one of ``names`` (case ignored).

    New value, else old value, else plain value. The first match decides even
    when it is empty, unless ``skip_empty``.
    """
    value = "coalesce(nullif({0}.newValue, ''), nullif({0}.oldValue, ''), {0}.value)"
    element = "lower(coalesce(nullif(d.elementName, ''), d.name, ''))"
    test = f"{element} in ({J.name_list([n.lower() for n in names])})"
    if skip_empty:
        test += f" and coalesce({value.format('d')}, '') <> ''"
    first = f"get(filter({details}, d -> {test}), 0)"
    return f"nullif({J.bind(first, value.format)}, '')"


def parse_business_event(df: DataFrame, json_col: str, received_at: Column) -> DataFrame:
    """Enveloped event to typed columns (``schemas.BUSINESS_EVENT``); other columns pass through."""
    doc = _with_doc(df.withColumn("_received", received_at), json_col)
    found = J.search_fields(doc, "_doc", json_col, {f"_{k}": v for k, v in V2_NAMES.items()}, leading="_lead")
    found = found.selectExpr("*", f"{event_details('_doc', json_col)} as _details")

    def field(key: str, only_truthy: bool = False) -> str:
        text = J.truthy(f"_{key}") if only_truthy else f"_{key}.text"
        return f"if(_{key} is not null, {text}, {detail_lookup('_details', V2_NAMES[key])})"

    late = J.bind(detail_lookup("_details", V2_NAMES["time"]), S.iso_timestamp)
    parsed = found.selectExpr(
        *[f"`{c}`" for c in df.columns],
        f"coalesce({field('id', True)}, {_payload_id('_payload')}) as unique_event_id",
        f"{field('offset')} as offset",
        f"{field('key')} as primary_key",
        f"{field('module')} as module_name",
        f"{field('event')} as event_name",
        f"coalesce({field('hotel', True)}, 'UNKNOWN') as hotel_id",
        f"{field('chain')} as chain_code",
        f"if(_time is not null, {S.event_time('_time', '_received')}, coalesce({late}, _received)) as occurred_at",
        "_details as details",
        f"{event_metadata('_doc')} as metadata",
        "_payload as payload",
    )
    return J.fence(parsed, *df.columns)


def with_delete_flag(df: DataFrame) -> DataFrame:
    """Add ``is_delete_or_cancel``: by event name, by all-empty new values, or by a status change."""
    by_name = F.coalesce(F.upper("event_name").rlike("DELETE|CANCEL"), F.lit(False))
    emptied = (F.size("details") > 0) & F.forall(
        "details", lambda d: F.coalesce(d["newValue"], F.lit("")) == ""
    )
    off = F.exists(
        "details",
        lambda d: F.lower(F.coalesce(d["elementName"], F.lit(""))).contains("status")
        & F.translate(F.upper(F.coalesce(d["newValue"], F.lit(""))), " ", "_").isin("CANCELLED", "CANCELED", "NO_SHOW"),
    )
    return df.withColumn("is_delete_or_cancel", by_name | F.coalesce(emptied | off, F.lit(False)))


def element_name_changes(df: DataFrame) -> DataFrame:
    """One row per changed element of each event."""
    change = df.select("unique_event_id", "hotel_id", "occurred_at", F.explode("details").alias("d"))
    return change.select(
        "unique_event_id",
        "hotel_id",
        "occurred_at",
        F.col("d.elementName").alias("element_name"),
        F.col("d.oldValue").alias("old_value"),
        F.col("d.newValue").alias("new_value"),
        F.col("d.elementSequence").alias("element_sequence"),
    )
