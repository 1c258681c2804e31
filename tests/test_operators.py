"""Literal cases and brute-force comparisons for the operators."""


import hashlib
import json
import random
from datetime import date, datetime, timedelta, timezone
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from stayflow.functions import scalars as S
from stayflow.operators import enrich, merge, messaging, metrics, parse, routing, running, snapshot, status, transform
from stayflow.schemas import EVENT_LOG
from stayflow.session import materialize
from stayflow.sources import events as sources
from stayflow.sources.routes import load_routes

UTC = timezone.utc


def late():
    return F.lit("2030-01-01 00:00:00").cast("timestamp")


def frame(spark, *docs):
    return spark.createDataFrame([(i, json.dumps(d) if not isinstance(d, str) else d) for i, d in enumerate(docs)], "n int, body string")


def parsed(spark, *docs):
    return parse.parse_business_event(frame(spark, *docs), "body", late()).orderBy("n")


# ---- parsing -------------------------------------------------------------------------


def test_flat_event_identity_fields(spark):
    docs = [
        {"seen": [{"cursor": 88, "action": "\u00c4nderung"}], "resort": "K\u00d6LN", "businessEventId": 5, "eventType": "Blocks", "eventTime": 951782400.5},
        {"moduleName": "", "module": "second name", "hotelCode": "by code", "eventId": None, "inner": {"eventId": "deep"}},
        {"sequenceNumber": 0, "propertyCode": ["a", "list"]},
    ]
    rows = parse.parse_event_v1(frame(spark, *docs), "body", late()).orderBy("n").collect()
    assert [(r.unique_event_id, r.hotel_id, r.module, r.action_type, r.stream_offset) for r in rows[:2]] == [
        ("5", "K\u00d6LN", "Blocks", "\u00c4nderung", "88"),
        ("deep", "by code", "second name", None, None),
    ]
    assert rows[0].occurred_at == datetime(2000, 2, 29, 0, 0, 0, 500000)
    assert (len(rows[2].unique_event_id), rows[2].hotel_id, rows[2].stream_offset) == (64, '["a","list"]', None)


def test_id_falls_back_to_a_hash_that_ignores_key_order(spark):
    docs = ('{ "z" : [1, {"y": true, "x": null}],\n "resort": "\u00dc" }', '{"resort":"\u00dc","z":[1,{"x":null,"y":true}]}')
    want = hashlib.sha256('{"resort":"\u00dc","z":[1,{"x":null,"y":true}]}'.encode()).hexdigest()
    for rows in (parse.parse_event_v1(frame(spark, *docs), "body", late()), parsed(spark, *docs)):
        assert {r.unique_event_id for r in rows.collect()} == {want}
    # Of an enveloped event only the payload counts.
    rows = parsed(spark, {"payload": {"k": 1}, "trace": "a"}, {"trace": "b", "payload": {"k": 1}}).collect()
    assert {r.unique_event_id for r in rows} == {hashlib.sha256(b'{"k":1}').hexdigest()}


def test_envelope_is_searched_over_its_payload(spark):
    inner = {"metadata": {"offset": "9", "uniqueEventId": "in"}, "hotelId": "IN", "eventName": "X", "detail": {"elementName": "primaryKey", "newValue": "pk"}}
    outer = {"unique_event_id": "out", "hotel_id": "OUT", "payload": inner}
    row = parsed(spark, outer).first()
    assert row.unique_event_id == "out"
    # Own keys in alphabetical order: hotelId, from the payload, before hotel_id.
    assert row.hotel_id == "IN"
    assert (row.offset, row.primary_key, row.event_name) == ("9", "pk", "X")
    assert json.loads(row.payload) == inner
    assert "payload" not in row.metadata and row.metadata["hotel_id"] == "OUT"


def test_payload_names_come_before_envelope_names(spark):
    outer = {
        "module": "outside", "action": "outside", "resort": "OUT",
        "payload": {"moduleName": "inside", "eventName": "inside", "resort": "IN", "more": {"chainCode": "c-in"}},
        "a": {"chain_code": "c-out"},
    }
    only_below = {"a": {"hotelId": "envelope"}, "payload": {"z": {"hotel_id": "payload"}}}
    first, second = parsed(spark, outer, only_below).collect()
    # A name both have keeps the envelope's value; below own keys, the payload is walked first.
    assert (first.module_name, first.event_name, first.hotel_id, first.chain_code) == ("inside", "inside", "OUT", "c-in")
    assert second.hotel_id == "payload"


def test_numbers_read_alike_however_often_they_occur(spark):
    rows = parsed(spark, '{"in":{"offset":1.50}}', '{"in":{"offset":1.50},"x":{"offset":2}}', '{"offset":1.50}').collect()
    assert [r.offset for r in rows] == ["1.5"] * 3


def test_times_are_utc_numbers_are_seconds(spark):
    values = ["2031-12-31T23:30:00-01:30", "2031-12-31", 1000000000, 0, "1000000000", "soon", "2031-12-31T07:05"]
    rows = parsed(spark, *[{"eventId": "x", "timestamp": v} for v in values]).collect()
    assert [r.occurred_at for r in rows] == [
        datetime(2032, 1, 1, 1, 0),
        datetime(2031, 12, 31),
        datetime(2001, 9, 9, 1, 46, 40),
        datetime(2030, 1, 1),
        datetime(2030, 1, 1),
        datetime(2030, 1, 1),
        datetime(2031, 12, 31, 7, 5),
    ]


def test_not_an_object_is_malformed(spark):
    rows = frame(spark, '{"eventId":"a"}', "[1]", "x{", "3", "{bad", ' \r\n\t{"eventId":"b"}')
    assert {r.unique_event_id for r in parse.parse_business_event(rows, "body", late()).collect()} == {"a", "b"}
    assert parse.malformed(rows, "body").count() == 4


@pytest.mark.parametrize(
    "name, details, expected",
    [
        # One telling change among others is enough; the element's name only has to contain the word.
        ("Moved", [{"elementName": "floor", "newValue": "3"}, {"elementName": "roomSTATUSflag", "newValue": "Canceled"}], True),
        ("Moved", [{"elementName": "bookingStatus", "newValue": "No_Show"}, {"newValue": "kept"}], True),
        # A status under ``name`` or as an old value does not tell.
        ("Moved", [{"name": "status", "newValue": "CANCELLED"}], False),
        ("Moved", [{"elementName": "status", "oldValue": "CANCELLED", "newValue": "BOOKED"}], False),
        # All emptied: missing, null and empty alike; one filled value keeps the event alive.
        ("Moved", [{"elementName": "a"}, {"elementName": "b", "newValue": None}, {"newValue": ""}], True),
        ("Moved", [{"elementName": "a"}, {"newValue": " "}], False),
        ("preCancellation", [{"newValue": "kept"}], True),
        ("", [], False),
        (None, "no list", False),
    ],
)
def test_delete_flag(spark, name, details, expected):
    rows = parse.with_delete_flag(parsed(spark, {"eventId": "e", "eventName": name, "detail": details}))
    assert rows.first().is_delete_or_cancel is expected


def test_frames_unwrap(spark):
    event = {"eventId": "a"}
    shapes = [{"data": {"newEvent": event}}, {"data": {"businessEvents": [event, 3, event]}}, {"data": {"businessEvents": event}}, event, {"data": {"businessEvents": "x"}}]
    rows = sources.extract_payloads(frame(spark, *shapes), "body", "event").groupBy("n").count().collect()
    assert {r.n: r["count"] for r in rows} == {0: 1, 1: 2, 2: 1, 3: 1}


def test_queue_messages_need_their_envelope(spark):
    good = {"unique_event_id": "e", "hotel_id": "H", "occurred_at": "2026-08-03T00:00:00+00:00", "payload": {"a": 1}, "offset": None}
    bad = {k: v for k, v in good.items() if k != "payload"}
    rows = frame(spark, good, bad)
    assert [r.payload for r in sources.read_queue_messages(rows).collect()] == ['{"a":1}']
    assert [r.n for r in sources.rejected_queue_messages(rows).collect()] == [1]


# ---- routing -------------------------------------------------------------------------


def test_routes_and_identifiers(spark):
    docs = [
        {"eventId": "a", "moduleName": "RESERVATION", "eventName": "UpdateReservation", "hotel_id": "Q", "primary_key": "no digits needed"},
        {"eventId": "b", "moduleName": "CSH", "eventName": "TransactionDetails", "primaryKey": "without", "rows": [{"n": 1}, {"transactionId": "tx"}]},
        {"eventId": "c", "moduleName": "Cashiering", "eventName": "Folio", "primaryKey": "unused", "confirmationNo": "from metadata", "detail": {"elementName": "RESVID", "newValue": "from change"}},
        {"eventId": "d", "moduleName": "Cashiering", "eventName": "Folio", "details": [{"name": "RESVID", "newValue": "", "value": "from change"}]},
        {"eventId": "e", "moduleName": "profile", "eventName": "NewProfile", "more": {"nameId": 4.0}},
        {"eventId": "f", "moduleName": "Spa", "eventName": "UpdateReservation"},
    ]
    rows = routing.resolve_identifier(routing.route_events(parsed(spark, *docs))).orderBy("n").collect()
    assert [(r.operation_id, r.resource_id) for r in rows] == [
        ("getReservation", "no digits needed"),
        ("getFolioTransactionDetails", "tx"),
        ("getFolio", "from metadata"),
        ("getFolio", "from change"),
        ("getProfile", "4"),
        (None, None),
    ]


def test_identifier_kinds_from_the_configuration(spark):
    base = {"moduleName": "Blocks", "eventName": "*", "resource_type": "block", "operation_id": "getBlock", "path": "/b", "identifier_type": "blockId", "fetch": "f"}
    docs = [
        {"eventId": "a", "moduleName": "Blocks", "primaryKey": "unused", "deep": [{"blockId": "below"}]},
        {"eventId": "b", "moduleName": "Blocks", "blockId": 12, "deep": {"blockId": "below"}},
        {"eventId": "c", "moduleName": "Blocks", "detail": [{"elementName": "BLOCKID", "newValue": "changed"}]},
        {"eventId": "d", "moduleName": "Blocks", "primaryKey": "unused"},
    ]
    routed = routing.route_events(parsed(spark, *docs), [base])
    rows = routing.resolve_identifier(routed, [base]).orderBy("n").collect()
    assert [r.resource_id for r in rows] == ["below", "12", "changed", None]


def test_first_listed_route_wins_and_method_defaults(spark):
    base = {"moduleName": "M", "eventName": "*", "resource_type": "a", "path": "/p", "identifier_type": "primaryKey", "fetch": "f"}
    routes, aliases = load_routes({"routes": [{**base, "operation_id": "one"}, {**base, "operation_id": "two"}]})
    row = routing.route_events(parsed(spark, {"eventId": "e", "moduleName": "M"}), routes, aliases).first()
    assert (row.operation_id, row.method) == ("one", "GET")


# ---- responses -----------------------------------------------------------------------


def answers(spark, doc, resource_id="routed"):
    return spark.createDataFrame([("MAD01", resource_id, json.dumps(doc))], "hotel_id string, resource_id string, payload string")


def test_reservation_response(spark):
    doc = {
        "reservations": [
            {"reservationIdList": [{"type": "Alias", "id": "\u017d-7"}, {"type": "Reservation", "id": "not the first"}], "confirmationNumber": 31, "arrivalDate": "2031-02-28", "departureDate": "later", "status": "DUE OUT"},
            {"confirmationNo": "of the second"},
        ]
    }
    row = transform.transform_reservation(answers(spark, doc)).first()
    assert (row.reservation_id, row.confirmation_no, row.arrival_date, row.departure_date, row.reservation_status, row.source_updated_at) == (
        "\u017d-7", "31", date(2031, 2, 28), None, "DUE OUT", None,
    )
    # Without the id list even a member reservationId does not count.
    assert transform.transform_reservation(answers(spark, {"reservationId": "x"})).first().reservation_id == "routed"


def test_profile_folio_transaction_responses(spark):
    profile = {"profile": {"id": 6, "type": "AGENT", "firstName": "\u00c9va", "lastName": "Nagy", "emailInfo": [{"emailAddress": "eva@desk.invalid"}]}}
    row = transform.transform_profile(answers(spark, profile)).first()
    assert (row.profile_id, row.profile_type, row.first_name, row.last_name, row.email) == ("6", "AGENT", "\u00c9va", "Nagy", "eva@desk.invalid")
    folios = {"folios": [7, {"folioNumber": "second", "balance": 0, "balanceAmount": -3.125}, {"folioId": "F", "balance": "no number", "currency": "JPY"}]}
    rows = transform.transform_folios(answers(spark, folios)).collect()
    assert [r.balance_amount for r in rows] == [Decimal("-3.1250"), None]
    assert rows[1].folio_id == "F"
    deal = {"transaction": {"amount": 0, "grossAmount": "-1.00005", "resvNameId": "R"}}
    row = transform.transform_transaction(answers(spark, deal)).first()
    assert (row.transaction_no, row.reservation_id, row.transaction_code) == ("routed", "R", None)


def test_retry_rules(spark):
    cases = [(200, False, "success"), (404, True, "deleted"), (404, False, "poison"), (429, False, "retry"), (503, True, "retry"), (401, False, "retry"), (400, True, "poison"), (418, False, "poison")]
    rows = spark.createDataFrame(cases, "status_code int, is_delete_or_cancel boolean, want string").withColumn("retry_after", F.lit("7"))
    for r in enrich.retry_classify(rows).collect():
        assert r.decision == r.want
        assert r.visible_in == (None if r.decision != "retry" else 7 if r.status_code == 429 else 120)


# ---- snapshot ------------------------------------------------------------------------

CORE = "hotel_id string, reservation_id string, confirmation_no string, arrival_date date, departure_date date, reservation_status string, source_updated_at timestamp, last_event_id string, last_event_at timestamp, deleted_at timestamp, raw_payload string"


def nights(spark, arrival, departure, payload, day, deleted=None):
    row = ("H77", "stay-9", None, arrival, departure, "RESERVED", None, "e", None, deleted, payload if isinstance(payload, (str, type(None))) else json.dumps(payload))
    return snapshot.project_snapshot(spark.createDataFrame([row], CORE), day).orderBy("stay_date").collect()


def test_snapshot_nights_over_a_month_end(spark):
    """Lists of two names, a date listed twice, nights without an entry, and a stay that began before the day."""
    payload = {
        "roomType": "SUP", "rateCode": "NET42", "sourceCode": "WEB",
        "stayDetails": [{"date": "2031-03-01", "roomRevenue": 61}],
        "roomRates": [{"date": "2031-02-27", "roomRevenue": "55.5"}, {"date": "2031-02-27", "roomRevenue": "99"}],
    }
    rows = nights(spark, date(2031, 2, 26), date(2031, 3, 3), payload, date(2031, 2, 27))
    # a night without an entry takes the first amount found anywhere
    assert [(r.stay_date.month, r.stay_date.day, float(r.room_revenue)) for r in rows] == [(2, 27, 55.5), (2, 28, 55.5), (3, 1, 61), (3, 2, 55.5)]
    assert {(r.room_type, r.rate_code, r.market_code, r.source_code) for r in rows} == {("SUP", "NET42", None, "WEB")}


def test_snapshot_skips_past_nights_and_defaults(spark):
    rows = nights(spark, date(2026, 8, 1), date(2026, 8, 4), "{}", date(2026, 8, 3), datetime(2026, 8, 2))
    assert [(r.stay_date, r.rooms, r.room_revenue, r.adr, r.deleted_at) for r in rows] == [(date(2026, 8, 3), 1, 0, 0, datetime(2026, 8, 2))]
    assert nights(spark, date(2026, 8, 4), date(2026, 8, 4), None, date(2026, 8, 3)) == []


def test_snapshot_falsy_zero_and_nested_lists(spark):
    payload = {
        "rooms": 0, "numberOfRooms": "2", "totalRevenue": "500",
        "b": {"stayDetails": [{"date": "2026-08-10", "roomRevenue": 70}], "roomRates": [{"businessDate": "2026-08-10T00:00:00Z", "roomRevenue": 80}]},
        "a": [{"rateDetails": [{"stayDate": "2026-08-11", "roomRevenue": 0}, {"stayDate": "2026-08-12", "roomRevenue": "x"}]}],
    }
    rows = nights(spark, date(2026, 8, 10), date(2026, 8, 13), payload, date(2026, 8, 9))
    # Night 10: roomRates comes before stayDetails. Night 11: zero falls to the first non-empty
    # roomRevenue of the payload, the text zero itself being found first and falsy too, then to 0.
    assert [(r.rooms, r.room_revenue, r.total_revenue, r.reject_reason) for r in rows] == [
        (2, 80, 500, None),
        (2, 0, 500, None),
        (2, None, 500, "unreadable number"),
    ]
    assert rows[0].adr == 40


def test_last_status_takes_the_latest_night_row(spark):
    cols = "snapshot_date date, hotel_id string, reservation_id string, stay_date date, confirmation_no string, reservation_status string, last_event_id string, last_event_at timestamp, source_updated_at timestamp, room_type string, rate_code string, market_code string, source_code string, channel_code string, payload string, deleted_at timestamp"
    d = date(2026, 8, 11)

    def row(night, state, at, gone=None):
        return (d, "H", "r", night, None, state, state, at, None, None, None, None, None, None, "{}", gone)

    t1, t2 = datetime(2026, 8, 1), datetime(2026, 8, 2)
    df = spark.createDataFrame([row(date(2026, 8, 13), "A", t2), row(date(2026, 8, 12), "B", t2), row(d, "C", None), row(date(2026, 8, 14), "D", t1)], cols)
    got = status.last_status(df).first()
    assert (got.last_status, got.arrival_date, got.departure_date, got.last_status_event_at) == ("B", d, date(2026, 8, 15), t2)
    gone = status.last_status(spark.createDataFrame([row(d, "A", t1, t2)], cols)).first()
    assert gone.last_status == "DELETED"


# ---- order-dependent operators against sequential replay ------------------------------


def replay(ops, target=None):
    row = dict(target) if target else None
    for seq, at, op, eid, value in sorted(ops):
        if row is None:
            row = {"value": None, "last_event_id": eid, "last_event_at": at, "deleted_at": None, "created_at": seq, "updated_at": seq}
        elif row["last_event_at"] is not None and row["last_event_at"] > at:
            continue
        row.update(last_event_id=eid, last_event_at=at, updated_at=seq)
        if op == "upsert":
            row["value"] = value
        else:
            row["deleted_at"] = seq
    return row


@pytest.mark.parametrize("span", [1, 3, 1 << 20])
def test_merge_equals_sequential_replay(spark, span):
    rng = random.Random(span)
    t0 = datetime(2024, 1, 1)
    at = lambda n: t0 + timedelta(hours=n)
    by_key, rows, seqs = {}, [], iter(rng.sample(range(10_000), 2000))
    for key in range(60):
        for _ in range(rng.choice([0, 1, 3, 12, 40])):
            seq, hour = next(seqs), rng.randint(0, 12)
            op = (seq, at(hour), rng.choice(["upsert", "delete"]), f"e{seq}", rng.choice([None, float(seq)]))
            by_key.setdefault(key, []).append(op)
            rows.append((key, op[0], op[1], op[2], op[3], op[4], t0 + timedelta(seconds=seq)))
    targets = {k: {"value": 1.0, "last_event_id": "old", "last_event_at": at(6), "deleted_at": -5 if k % 4 == 0 else None, "created_at": -9, "updated_at": -9} for k in range(0, 70, 2)}
    moment = lambda s: None if s is None else t0 + timedelta(seconds=s)
    ops = spark.createDataFrame(rows, "k int, seq long, event_at timestamp, op string, event_id string, value double, applied_at timestamp")
    target = spark.createDataFrame(
        [(k, r["value"], r["last_event_id"], r["last_event_at"], moment(-9), moment(-9), moment(r["deleted_at"])) for k, r in targets.items()],
        "k int, value double, last_event_id string, last_event_at timestamp, created_at timestamp, updated_at timestamp, deleted_at timestamp",
    )
    got = {r.k: r for r in merge.merge_core(target, ops, ["k"], ["value"], span=span).collect()}
    assert set(got) == set(by_key) | set(targets)
    for key, row in got.items():
        want = replay(by_key.get(key, []), targets.get(key))
        assert (row.value, row.last_event_id, row.last_event_at) == (want["value"], want["last_event_id"], want["last_event_at"])
        assert (row.deleted_at, row.created_at, row.updated_at) == tuple(moment(want[c]) for c in ("deleted_at", "created_at", "updated_at"))


@pytest.mark.parametrize("how", ["max", "last"])
def test_running_values_over_spans(spark, how):
    rng = random.Random(1)
    rows = [(rng.choice([0, 0, 0, 1]), s, rng.choice([None, rng.randint(0, 50)])) for s in rng.sample(range(500), 300)]
    df = spark.createDataFrame(rows, "k int, seq long, v int")
    got = {(r.k, r.seq): r.seen for r in running.earlier(df, ["k"], "seq", F.col("v"), "seen", how, span=37).collect()}
    for k, s, _ in rows:
        before = [v for kk, ss, v in sorted(rows, key=lambda r: r[1]) if kk == k and ss < s and v is not None]
        assert got[(k, s)] == ((max(before) if how == "max" else before[-1]) if before else None)


def test_new_events_equal_one_by_one_inserts(spark):
    rng = random.Random(3)
    log = [("x1", "C", "1"), ("x2", "C", None)]
    batch = [(f"x{rng.randint(1, 14)}", rng.choice(["C", "C", None]), rng.choice([None, str(rng.randint(1, 14))]), s) for s in rng.sample(range(1000), 60)]
    ids = {i for i, _, _ in log}
    slots = {(c, o) for _, c, o in log if c and o}
    want = []
    for i, c, o, s in sorted(batch, key=lambda r: r[3]):
        if i in ids or (c and o and (c, o) in slots):
            continue
        ids.add(i)
        if c and o:
            slots.add((c, o))
        want.append(s)
    log_df = spark.createDataFrame(log, "unique_event_id string, chain_code string, stream_offset string").withColumn("status", F.lit("COMPLETED"))
    df = spark.createDataFrame(batch, "unique_event_id string, chain_code string, stream_offset string, seq long")
    entered = merge.new_events(log_df, df)
    assert sorted(r.seq for r in entered.collect()) == want
    found = merge.register_events(log_df, df, entered)
    assert found.count() == 60 and found.where("status is null").count() == 0


EVENT_ROW = "unique_event_id string, chain_code string, stream_offset string, seq long"


def one_by_one(batch):
    ids, slots, entered = set(), set(), []
    for event, chain, offset, seq in sorted(batch, key=lambda r: r[3]):
        if event not in ids and (chain, offset) not in slots:
            ids.add(event)
            slots.add((chain, offset))
            entered.append(seq)
    return entered


@pytest.mark.parametrize("order", ["rising", "falling", "random", "pairs", "mesh"])
def test_chains_of_conflicts_take_few_steps(spark, order):
    """A thousand rows, each in conflict with its neighbours; a mesh has groups of many rows, too."""
    rng = random.Random(5)
    place = list(range(1000))
    if order == "falling":
        place.reverse()
    elif order == "random":
        rng.shuffle(place)
    elif order == "pairs":
        place = [p ^ 1 for p in place]
    batch = [(f"e{k // 2}", "C", str((k + 1) // 2), place[k]) for k in range(1000)]
    if order == "mesh":
        batch = [(f"e{rng.randint(0, 150)}", "C", str(rng.randint(0, 150)), k) for k in range(1000)]
    cuts = []
    log = spark.createDataFrame([], EVENT_ROW).drop("seq")
    entered = merge.new_events(log, spark.createDataFrame(batch, EVENT_ROW), cut=lambda df, label: cuts.append(label) or materialize(df, label))
    assert sorted(r.seq for r in entered.collect()) == one_by_one(batch)
    assert cuts.count("entered") <= 5 and cuts.count("chains") <= 12 + cuts.count("entered")


def test_outcomes_fold_in_order(spark):
    at = datetime(2024, 1, 1)
    log = spark.createDataFrame([("e1", "RECEIVED", 1), ("e2", "COMPLETED", 0), ("e3", "RECEIVED", 0)], "unique_event_id string, status string, retry_count int")
    log = log.select(*[F.col(f.name).cast(f.dataType) if f.name in log.columns else F.lit(None).cast(f.dataType).alias(f.name) for f in EVENT_LOG.fields])
    rows = [("e1", 1, "FAILED", "x" * 3000, at), ("e1", 2, "COMPLETED", None, at), ("e2", 3, "FAILED", "y" * 3000, at)]
    done = {r.unique_event_id: r for r in merge.event_outcomes(log, spark.createDataFrame(rows, "unique_event_id string, seq long, outcome string, error string, at timestamp")).collect()}
    assert (done["e1"].status, done["e1"].retry_count, done["e1"].error_message) == ("COMPLETED", 2, None)
    assert (done["e2"].status, done["e2"].retry_count, len(done["e2"].error_message)) == ("FAILED", 1, 2000)
    assert (done["e3"].status, done["e3"].retry_count) == ("RECEIVED", 0)


def test_fifo_stops_a_group_at_its_first_failure(spark):
    rows = [("MAD", 1, True), ("MAD", 2, False), ("MAD", 3, True), ("BCN", 4, True)]
    df = spark.createDataFrame(rows, "group_id string, seq long, ok boolean")
    assert sorted(r.seq for r in messaging.fifo_prefix(df).collect()) == [1, 2, 4]


# ---- small functions -----------------------------------------------------------------


def test_message_group_is_the_hash_modulo(spark):
    import hashlib

    rows = [(f"H{i}", None if i % 5 == 0 else f"k{i}") for i in range(50)]
    df = spark.createDataFrame(rows, "h string, k string")
    for n in (1, 7, 32, 1000):
        for r in df.select("h", "k", S.message_group("p", n, F.col("h"), F.col("k")).alias("g")).collect():
            slot = int(hashlib.sha256(f"{r.h}:{r.k or ''}".encode()).hexdigest(), 16) % n
            assert r.g == f"p-{slot:02d}"


def test_delays_and_paths(spark):
    df = spark.createDataFrame([("30",), ("-5",), ("soon",), (None,), ("99999",)], "h string")
    got = [r[0] for r in df.select(S.retry_visibility(S.retry_after(F.col("h")))).collect()]
    assert got == [30, 120, 120, 120, 43200]
    assert S.split_csv_ints("1, 3,7,") == [1, 3, 7]


def test_queue_message_body_is_canonical(spark):
    doc = {"uniqueEventId": "evt-1", "hotelId": "", "creationDate": "2026-08-03T00:00:00Z", "b": 1, "a": "é"}
    flat = parse.parse_event_v1(frame(spark, doc), "body", late()).withColumn("hotel_id", F.lit(""))
    row = messaging.to_queue_message(flat, "fallback").first()
    assert (row.group_id, row.dedup_id) == ("fallback", "evt-1")
    body = {"unique_event_id": "evt-1", "hotel_id": "", "module": None, "action_type": None, "occurred_at": "2026-08-03T00:00:00+00:00", "offset": None, "payload": doc}
    assert row.body == json.dumps(body, sort_keys=True, separators=(",", ":"), ensure_ascii=False)


def test_exact_percentiles(spark):
    rng = random.Random(2)
    groups = {"a": [rng.random() * 1e4 for _ in range(777)], "b": [5.0] * 40, "c": [0.0], "d": [rng.choice([0.25, 1e7]) for _ in range(31)]}
    df = spark.createDataFrame([(g, v) for g, vs in groups.items() for v in vs], "stage string, ms double")
    for r in metrics.stage_latency(df).collect():
        ordered = sorted(groups[r.stage])
        for p, got in ((0.5, r.p50_ms), (0.95, r.p95_ms), (0.99, r.p99_ms)):
            assert got == pytest.approx(round(ordered[int((len(ordered) - 1) * p)], 6), abs=1e-9)
        assert r["count"] == len(ordered) and r.max_ms == round(ordered[-1], 6)


def test_event_files_batch_and_stream(spark, tmp_path):
    docs = [{"eventId": f"e{i}", "hotelId": "H"} for i in range(5)]
    for i, d in enumerate(docs):
        (tmp_path / f"{i}.json").write_text(json.dumps(d, indent=2))
    rows = sources.read_event_files(spark, str(tmp_path))
    assert parse.parse_event_v1(rows, "body", late()).count() == 5
    stream = sources.read_event_files(spark, str(tmp_path), streaming=True, max_files=2)
    query = parse.parse_event_v1(stream, "body", late()).writeStream.format("memory").queryName("landed").trigger(availableNow=True).start()
    query.awaitTermination()
    assert {r.unique_event_id for r in spark.table("landed").collect()} == {d["eventId"] for d in docs}
    (tmp_path / "answers").mkdir()
    (tmp_path / "answers" / "a.json").write_text(json.dumps({"operation_id": "getProfile", "resource_id": "p", "status_code": 200, "payload": "{}"}))
    assert sources.read_resource_responses(spark, str(tmp_path / "answers")).first().status_code == 200


def test_queue_window_dedup_runs_as_a_stream(spark, tmp_path):
    from stayflow.streaming.jobs import dedup_within

    spark.createDataFrame([("a", "2024-01-01 00:00:00"), ("a", "2024-01-01 00:01:00"), ("b", "2024-01-01 00:02:00")], "id string, at string").write.json(str(tmp_path / "in"))
    stream = spark.readStream.schema("id string, at string").json(str(tmp_path / "in"))
    query = dedup_within(stream, ["id"], "at").writeStream.format("memory").queryName("window").trigger(availableNow=True).start()
    query.awaitTermination()
    assert sorted(r.id for r in spark.table("window").collect()) == ["a", "b"]
