"""Resource responses to core-table rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stayflow.functions import jsontree as J
from stayflow.functions import scalars as S


def _first_filled(doc: str, names: list[str], *fallback: str) -> str:
    return "coalesce(" + ", ".join([*[J.filled(J.member(doc, f"$.{n}")) for n in names], *fallback]) + ")"


def _rooted(df: DataFrame, payload: str, *names: str) -> DataFrame:
    """Add ``_root``: the first filled member of ``names``, else the document; a list stands for its first element."""
    doc = df.selectExpr("*", f"{J.parse(payload)} as _doc")
    chosen = _first_filled("_doc", list(names), "_doc")
    return doc.selectExpr("*", J.bind(chosen, lambda b: f"if({J.is_list(b)}, get({J.items(b)}, 0), {b})") + " as _root")


def _pick(root: str, *names: str) -> str:
    """First truthy member; the last one is taken as it is, as a chain of alternatives would."""
    *early, last = [f"$.{n}" for n in names]
    tail = J.text_at(root, last)
    return f"coalesce({', '.join([J.truthy(J.value_at(root, p)) for p in early])}, {tail})" if early else tail


def _date(root: str, name: str) -> str:
    return S.iso_date(_pick(root, name))


def _updated(root: str) -> str:
    return J.bind(_pick(root, "lastModifyDateTime", "updateDate"), S.iso_timestamp) + " as source_updated_at"


def _kept(df: DataFrame) -> list[str]:
    return [f"`{c}`" for c in df.columns]


def _fenced(df: DataFrame, *columns: str) -> DataFrame:
    return J.fence(df.selectExpr(*columns), *df.columns)


def transform_reservation(df: DataFrame, payload: str = "payload") -> DataFrame:
    """Reservation response to a core row; ``resource_id`` is the routed identifier."""
    rooted = _rooted(df, payload, "reservation", "reservations")
    ids = J.items(J.member("_root", "$.reservationIdList"))
    listed = f"coalesce({J.truthy_at('_root', '$.reservationId')}, {J.text_at(f'get({ids}, 0)', '$.id')}, resource_id)"
    return _fenced(
        rooted,
        *_kept(df),
        f"if({ids} is not null, {listed}, resource_id) as reservation_id",
        f"{_pick('_root', 'confirmationNo', 'confirmationNumber')} as confirmation_no",
        f"{_date('_root', 'arrivalDate')} as arrival_date",
        f"{_date('_root', 'departureDate')} as departure_date",
        f"{_pick('_root', 'reservationStatus', 'status')} as reservation_status",
        _updated("_root"),
    )


def transform_profile(df: DataFrame, payload: str = "payload") -> DataFrame:
    rooted = _rooted(df, payload, "profile", "profiles")
    mails = _first_filled("_root", ["emails", "emailInfo"])
    people = J.items(J.member("_root", "$.customer.personName"))
    parts = rooted.selectExpr("*", f"get({J.items(mails)}, 0) as _mail", f"get({people}, 0) as _person")
    return _fenced(
        parts,
        *_kept(df),
        f"coalesce({J.truthy_at('_root', '$.profileId', '$.id')}, resource_id) as profile_id",
        f"{_pick('_root', 'profileType', 'type')} as profile_type",
        f"coalesce({J.truthy_at('_person', '$.givenName')}, {J.text_at('_root', '$.firstName')}) as first_name",
        f"coalesce({J.truthy_at('_person', '$.surname')}, {J.text_at('_root', '$.lastName')}) as last_name",
        f"if({J.is_object('_mail')}, {_pick('_mail', 'email', 'emailAddress')}, {_pick('_root', 'email')}) as email",
        _updated("_root"),
    )


def transform_folios(df: DataFrame, payload: str = "payload") -> DataFrame:
    """Folio response to one row per folio; a folio without id is named by its 1-based place."""
    doc = df.selectExpr("*", f"{J.parse(payload)} as _doc")
    chosen = _first_filled("_doc", ["folios", "folio", "items"])
    listed = J.bind(chosen, lambda b: f"coalesce({J.items(b)}, case when {J.is_object(b)} then array({b}) end)")
    each = doc.selectExpr(*_kept(df), f"posexplode({listed}) as (_pos, _folio)").where(J.is_object("_folio"))
    return _fenced(
        each,
        *_kept(df),
        "resource_id as reservation_id",
        f"coalesce({J.truthy_at('_folio', '$.folioId', '$.id')}, cast(_pos + 1 as string)) as folio_id",
        f"{_pick('_folio', 'folioNo', 'folioNumber')} as folio_no",
        f"try_cast({_pick('_folio', 'balance', 'balanceAmount')} as {S.MONEY}) as balance_amount",
        f"{_pick('_folio', 'currencyCode', 'currency')} as currency_code",
        _updated("_folio"),
    )


def transform_transaction(df: DataFrame, payload: str = "payload") -> DataFrame:
    rooted = _rooted(df, payload, "transaction", "transactionDetails")
    return _fenced(
        rooted,
        *_kept(df),
        f"coalesce({J.truthy_at('_root', '$.transactionNo')}, resource_id) as transaction_no",
        f"{_pick('_root', 'reservationId', 'resvNameId')} as reservation_id",
        f"{_pick('_root', 'folioId')} as folio_id",
        f"try_cast({_pick('_root', 'amount', 'grossAmount')} as {S.MONEY}) as amount",
        f"{_pick('_root', 'currencyCode', 'currency')} as currency_code",
        f"{_pick('_root', 'transactionCode', 'trxCode')} as transaction_code",
        _updated("_root"),
    )


def deleted_marker(df: DataFrame) -> DataFrame:
    """Replace the response by the marker stored for a resource that no longer exists."""
    body = F.to_json(F.struct(F.lit(True).alias("deleted"), F.col("resource_id").alias("resource_id")))
    return df.withColumn("operation_id", F.lit("deleted_marker")).withColumn("payload", body)
