"""The route table: which resource an event leads to and how it is fetched."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

# Routes in order of precedence.
ROUTES = [
    {
        "moduleName": "Reservation",
        "eventName": "*",
        "resource_type": "reservation",
        "operation_id": "getReservation",
        "method": "GET",
        "path": "/rsv/v1/hotels/{hotelId}/reservations/{reservationId}",
        "identifier_type": "reservationId",
        "fetch": "reservation",
    },
    {
        "moduleName": "Profile",
        "eventName": "*",
        "resource_type": "profile",
        "operation_id": "getProfile",
        "method": "GET",
        "path": "/crm/v1/profiles/{profileId}",
        "identifier_type": "profileId",
        "fetch": "profile",
    },
    {
        "moduleName": "Cashiering",
        "eventName": "Folio",
        "resource_type": "folio",
        "operation_id": "getFolio",
        "method": "GET",
        "path": "/csh/v1/hotels/{hotelId}/reservations/{reservationId}/folios",
        "identifier_type": "reservationId",
        "fetch": "folios",
    },
    {
        "moduleName": "Cashiering",
        "eventName": "Transaction",
        "resource_type": "folio_transaction",
        "operation_id": "getFolioTransactionDetails",
        "method": "GET",
        "path": "/csh/v1/hotels/{hotelId}/transactionDetails?transactionNo={transactionNo}",
        "identifier_type": "transactionNo",
        "fetch": "transaction_details",
    },
]
# Other spellings of module and event names.
ALIASES = {
    "moduleName": {
        "RSV": "Reservation",
        "RESERVATION": "Reservation",
        "CRM": "Profile",
        "PROFILE": "Profile",
        "CSH": "Cashiering",
        "CASHIERING": "Cashiering",
    },
    "eventName": {"FolioTransaction": "Transaction", "TransactionDetails": "Transaction"},
}
ROUTE_SCHEMA = (
    "position int, route_module string, route_event string, resource_type string, operation_id string,"
    " method string, path string, identifier_type string, fetch string"
)


def load_routes(config: str | dict | None = None) -> tuple[list[dict], dict[str, dict[str, str]]]:
    """Routes and aliases from a YAML path, a parsed mapping, or the built-in table.

    Without a YAML reader the mapping form still works. ``method`` defaults to GET.
    """
    if config is None:
        return ROUTES, ALIASES
    if isinstance(config, str):
        try:
            import yaml
        except ImportError as missing:
            raise RuntimeError("reading a YAML route file needs PyYAML; pass a mapping instead") from missing
        with open(config, encoding="utf-8") as handle:
            config = yaml.safe_load(handle) or {}
    routes = [{"method": "GET", **route} for route in config.get("routes", [])]
    return routes, config.get("aliases", {})


def routes_frame(spark: SparkSession, routes: list[dict] | None = None) -> DataFrame:
    """The route table as a DataFrame, with its list position."""
    rows = [
        (
            i,
            r["moduleName"],
            r["eventName"],
            r["resource_type"],
            r["operation_id"],
            r.get("method", "GET"),
            r["path"],
            r["identifier_type"],
            r["fetch"],
        )
        for i, r in enumerate(ROUTES if routes is None else routes)
    ]
    return spark.createDataFrame(rows, ROUTE_SCHEMA)
