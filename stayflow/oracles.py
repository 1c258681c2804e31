"""The registered queries once more, as plain SQL over the given tables.

Written independently of the operators: fixtures are common table expressions
and each query computes its answer from the base columns. Times are epoch
microseconds, dates text, decimals doubles, counts 64-bit.
"""

from __future__ import annotations

RESV = """
resv as (select concat('H', lpad(cast(o_custkey % 7 as varchar), 2, '0')) as hotel_id,
 concat('resv-', o_orderkey) as reservation_id, concat('CNF', o_orderkey) as confirmation_no,
 cast(o_orderdate as date) as booked_date,
 cast(o_orderdate as date) + cast(o_orderkey % 60 as int) as arrival_date,
 cast(o_orderdate as date) + cast(o_orderkey % 60 + o_orderkey % 5 as int) as departure_date,
 case when o_orderkey % 13 = 0 then null when o_orderstatus = 'F' then 'CHECKED_IN' when o_orderstatus = 'O' then 'RESERVED'
  when o_custkey % 2 = 0 then 'CANCELLED' else 'NO_SHOW' end as reservation_status,
 concat('evt-', o_orderkey) as last_event_id, o_orderdate as last_event_at,
 case when o_orderkey % 29 = 0 then o_orderdate end as deleted_at,
 case when o_orderkey % 11 = 0 then null else o_orderpriority end as market_code,
 concat('CH', o_custkey % 4) as channel_code, case when o_orderkey % 9 = 0 then null else 'WEB' end as source_code,
 concat('RT', o_orderkey % 3) as room_type, concat('RC', o_orderkey % 2) as rate_code,
 cast(1 + o_orderkey % 2 as decimal(12,4)) as rooms, cast(o_totalprice as decimal(18,4)) as room_revenue,
 o_orderkey as k from orders)"""
NIGHTS = """
nights as (select r.*, cast(r.arrival_date + n.n as date) as stay_date from resv r, (select unnest([0,1,2,3]) as n) n
 where r.arrival_date + n.n < r.departure_date)"""
SNAP = """
snap as (select d.snapshot_date, n.hotel_id, n.stay_date, n.reservation_id, n.confirmation_no, n.room_type, n.rate_code,
 n.market_code, n.source_code, n.channel_code,
 case when n.booked_date + 20 <= d.snapshot_date then n.reservation_status else 'RESERVED' end as reservation_status,
 n.rooms, n.room_revenue, n.room_revenue as total_revenue, n.last_event_id, n.last_event_at,
 case when n.booked_date + 20 <= d.snapshot_date then n.deleted_at end as deleted_at
 from nights n, (select unnest([date '1998-06-15', date '1998-06-14', date '1998-06-12', date '1998-06-08', date '1998-05-31']) as snapshot_date) d
 where n.booked_date <= d.snapshot_date and n.arrival_date <= d.snapshot_date + 730 and n.stay_date >= d.snapshot_date)"""
BASE = f"with {RESV}, {NIGHTS}, {SNAP}"
TODAY = "t.snapshot_date = date '1998-06-15'"
LIVE = "({0}.deleted_at is null and ({0}.reservation_status is null or {0}.reservation_status not in ('CANCELLED','NO_SHOW')))"
STRICT = "{0}.reservation_status not in ('CANCELLED','NO_SHOW')"
SAME = "o.hotel_id = t.hotel_id and o.reservation_id = t.reservation_id and o.stay_date = t.stay_date"
DAY = "strftime({0}, '%Y-%m-%d')"

PARSED = """
ev as (select event_id, event_id as seq, ts, user_id, event_type, value,
 concat('evt-', event_id % 9000) as unique_event_id, concat('H', user_id % 7) as hotel_id,
 case when event_id % 50 = 0 then 'Housekeeping' when event_type = 'view' then 'RSV' when event_type = 'error' then 'Reservation'
  when event_type = 'signup' then 'PROFILE' when event_type = 'click' then 'Cashiering' else 'CSH' end as module_name,
 case event_type when 'view' then 'UpdateReservation' when 'error' then 'CancelReservation' when 'signup' then 'NewProfile'
  when 'click' then 'Folio' else 'FolioTransaction' end as event_name,
 case event_type when 'click' then concat('folio-', event_id) when 'purchase' then cast(event_id as varchar) else concat('key-', user_id) end as primary_key,
 case when event_id % 4 = 0 then cast(user_id as varchar) else '' end as old_value,
 case when event_id % 31 = 0 then '' else concat('resv-', user_id) end as new_value from events)"""
ROUTED = """
routed as (select *, case when event_id % 50 = 0 then null when event_type in ('view','error') then 'reservation' when event_type = 'signup' then 'profile'
  when event_type = 'click' then 'folio' else 'folio_transaction' end as resource_type,
 case when event_id % 50 = 0 then null when event_type in ('view','error') then 'getReservation' when event_type = 'signup' then 'getProfile'
  when event_type = 'click' then 'getFolio' else 'getFolioTransactionDetails' end as operation_id,
 case when event_id % 50 = 0 then null when event_type = 'click' then coalesce(nullif(new_value, ''), nullif(old_value, '')) else primary_key end as resource_id,
 event_type = 'error' or new_value = '' as gone from ev)"""
STATUS = """
resp as (select event_id, case event_id % 20 when 1 then 404 when 2 then 429 when 3 then 503 when 4 then 401 when 5 then 400 when 6 then 418 else 200 end as status_code from events)"""
DECIDED = f"""{PARSED}, {ROUTED}, {STATUS},
dec0 as (select r.*, p.status_code, case when status_code < 400 then 'success' when status_code = 404 and gone then 'deleted'
  when status_code in (429, 503, 401) then 'retry' else 'poison' end as decision from routed r join resp p using (event_id)),
decided as (select *, case when operation_id is null or resource_id is null then 'FAILED' when decision = 'success' then 'COMPLETED'
  when decision = 'deleted' then 'DELETED' when decision = 'retry' then 'RETRY' else 'FAILED' end as outcome from dec0)"""
LAST = """
lasts as (select *, min(stay_date) over w as arr, max(stay_date) over w as lst, max(last_event_at) over w as seen_at,
 row_number() over (partition by snapshot_date, hotel_id, reservation_id order by last_event_at desc nulls last, stay_date) as rn,
 case when deleted_at is not null then 'DELETED' else reservation_status end as last_status
 from snap window w as (partition by snapshot_date, hotel_id, reservation_id))"""
LASTB = f"{BASE}, {LAST}"
TODAYL = "rn = 1 and snapshot_date = date '1998-06-15'"


def _rate(revenue: str, rooms: str) -> str:
    """Revenue per room rounded half away from zero to four places, in whole numbers."""
    n, d = f"cast(({revenue}) * 10000 as hugeint)", f"cast(({rooms}) * 10000 as hugeint)"
    rounded = f"sign({n}) * sign({d}) * ((2 * abs({n}) * 10000 + abs({d})) // nullif(2 * abs({d}), 0))"
    return f"cast(cast({rounded} as decimal(38,0)) / 10000 as double)"


def _double(sql: str, name: str) -> str:
    return f"cast({sql} as double) as {name}"


_PICK = {
    "r": ("rooms", "rooms_on_books", "rooms_on_books_previous", "pickup_rooms"),
    "v": ("room_revenue", "room_revenue_on_books", "room_revenue_previous", "pickup_room_revenue"),
    "t": ("total_revenue", "total_revenue_on_books", "total_revenue_previous", "pickup_total_revenue"),
}


def _pickup_metric() -> str:
    cols = []
    for m, now, was, diff in _PICK.values():
        cols += [
            _double(f"sum(t.{m})", now),
            _double(f"sum(coalesce(o.{m}, 0))", was),
            _double(f"sum(t.{m} - coalesce(o.{m}, 0))", diff),
        ]
    seg = ["market_code", "channel_code", "source_code", "room_type", "rate_code"]
    return f"""{BASE} select {DAY.format('t.snapshot_date')} as snapshot_date, cast(h.days as bigint) as comparison_days, t.hotel_id,
 {DAY.format('t.stay_date')} as stay_date, {', '.join(f"coalesce(t.{s}, 'UNMAPPED') as {s}" for s in seg)}, {', '.join(cols)},
 {_rate('sum(t.room_revenue)', 'sum(t.rooms)')} as adr_on_books,
 {_rate('sum(t.room_revenue - coalesce(o.room_revenue, 0))', 'sum(t.rooms - coalesce(o.rooms, 0))')} as pickup_adr
 from snap t cross join (select unnest([1,3,7,15]) as days) h left join snap o on {SAME} and t.snapshot_date - o.snapshot_date = h.days and {LIVE.format('o')}
 where {TODAY} and {LIVE.format('t')} group by t.snapshot_date, h.days, t.hotel_id, t.stay_date, {', '.join(f"coalesce(t.{s}, 'UNMAPPED')" for s in seg)}"""


def _old(alias: str, days: int) -> str:
    return f"left join snap {alias} on {SAME.replace('o.', alias + '.')} and {alias}.snapshot_date = date '1998-06-15' - {days}"


def _stage_latency() -> str:
    ranks = ", ".join(
        f"max(case when rn = cast(floor((n - 1) * {p}) as bigint) + 1 then v end) / 1000000.0 as {name}"
        for p, name in ((0.5, "p50_ms"), (0.95, "p95_ms"), (0.99, "p99_ms"))
    )
    return f"""with x as (select event_type as stage, value as ms, cast(round(value * 1000000) as bigint) as v,
 row_number() over (partition by event_type order by value) as rn, count(*) over (partition by event_type) as n from events)
 select stage, count(*) as "count", round(sum(ms), 3) as total_ms, round(avg(ms), 6) as avg_ms, round(max(ms), 6) as max_ms, {ranks} from x group by stage"""


_MERGE = """a as (select *, max(ts) over (partition by k order by seq rows between unbounded preceding and 1 preceding) as mx from ops),
 ok as (select * from a where mx is null or ts >= mx)"""
_OPS = """ops as (select user_id % 500 as k, (event_id * 48271) % 2147483647 as seq, ts, case when event_type = 'error' then 'delete' else 'upsert' end as op,
 cast(event_id as varchar) as eid, value from events)"""
_TARGET = """target as (select distinct c_custkey % 700 as k from customer)"""
_SEEDED = f"""with {_OPS}, {_TARGET}, both_ops as (select k, seq, ts, op, eid, value, ts as applied from ops {{where}} union all
 select k, -1, timestamp '2024-01-15', 'upsert', cast(k as varchar), cast(k as double), timestamp '2024-01-15' from target),
 a as (select *, max(ts) over (partition by k order by seq rows between unbounded preceding and 1 preceding) as mx from both_ops),
 ok as (select * from a where mx is null or ts >= mx),
 l as (select *, row_number() over (partition by k order by seq desc) as rn, row_number() over (partition by k, op order by seq desc) as rop,
  min(seq) over (partition by k) as s0 from ok),
 g as (select k, max(case when rop = 1 and op = 'upsert' then value end) as value, max(case when rn = 1 then eid end) as last_event_id,
  max(case when rn = 1 then epoch_us(ts) end) as last_event_at, min(case when seq = s0 then epoch_us(ts) end) as first_at,
  max(case when rn = 1 then epoch_us(applied) end) as updated_at, max(case when rop = 1 and op = 'delete' then epoch_us(ts) end) as gone_at, min(s0) as s0 from l group by k)
 select k as {{key}}, value, last_event_id, last_event_at, case when s0 = -1 then epoch_us(timestamp '2023-12-01') else first_at end as created_at, updated_at,
  coalesce(gone_at, case when s0 = -1 and k % 3 = 0 then epoch_us(timestamp '2024-01-10') end) as deleted_at from g"""

_FLAT = """flat as (select event_id, event_type, user_id, ts, case when event_id % 6 = 0 then sha256(concat('{"eventTime":', epoch_us(ts) // 1000000, ',"eventType":"', event_type,
 '","info":{"action":"', case when event_id % 8 = 0 then '' else 'ACT' end, '","sequence":', event_id, '}', case when event_id % 9 = 0 then '' else concat(',"resort":"R', user_id % 5, '"') end, '}')) else concat('b-', event_id) end as id,
 case when event_id % 9 = 0 then 'UNKNOWN' else concat('R', user_id % 5) end as hotel_id, event_type as module,
 case when event_id % 8 = 0 then null else 'ACT' end as action_type, epoch_us(date_trunc('second', ts)) as occurred_at,
 case when event_id = 0 then null else cast(event_id as varchar) end as stream_offset from events)"""
_TSUS = "epoch_us(ts)"
_IDS = "ids as (select concat('evt-', event_id % 9000) as unique_event_id, event_id as seq, event_type from events)"
_KNOWN = "known as (select concat('evt-', event_id * 3) as unique_event_id from events)"
_LASTCOLS = """snapshot_date, hotel_id, reservation_id, confirmation_no, arr, lst"""


def _status_count(where: str, name: str = "reservations") -> str:
    return f"{LASTB} select hotel_id, last_status, count(*) as {name} from lasts where {TODAYL} {where} group by 1, 2"


_LANDED = """landed as (select event_id as n, case when event_type in ('view','error') then 'getReservation' when event_type = 'signup' then 'getProfile'
  when event_type = 'click' then 'getFolio' else 'getFolioTransactionDetails' end as operation_id, case when event_type = 'signup' then '' else concat('H', user_id % 7) end as place,
  case event_type when 'click' then concat('resv-', user_id) when 'purchase' then cast(event_id as varchar) else concat('key-', user_id) end as resource_id from events),
 newest as (select operation_id, place, resource_id, max(n) as n from landed group by all)"""

ORACLES: dict[str, str] = {
    "stream_enrich": f"""with {PARSED}, {ROUTED}, {_LANDED},
 a as (select r.*, case when n.n is null then null when r.seq % 100 = 99 then null else case n.n % 20 when 1 then 404 when 2 then 429 when 3 then 503 when 4 then 401 when 5 then 400 when 6 then 418 else 200 end end as status_code
  from routed r left join newest n on n.operation_id = r.operation_id and n.place = case when r.operation_id = 'getProfile' then '' else r.hotel_id end and n.resource_id = r.resource_id),
 d as (select *, case when seq % 100 = 99 then 'BROKEN' when operation_id is null or resource_id is null then 'FAILED' when status_code is null then 'RETRY' when status_code < 400 then 'COMPLETED'
  when status_code = 404 and gone then 'DELETED' when status_code in (429, 503, 401) then 'RETRY' else 'FAILED' end as outcome from a),
 k as (select *, last_value(case when outcome in ('COMPLETED', 'FAILED') then outcome end ignore nulls) over (partition by unique_event_id order by seq rows between unbounded preceding and 1 preceding) as state
  from d where outcome not in ('RETRY', 'BROKEN')),
 h as (select * from k where not (outcome in ('COMPLETED', 'DELETED') and coalesce(state = 'COMPLETED', false))),
 l as (select unique_event_id, arg_min(module_name, seq) as module_name from k group by 1),
 s as (select unique_event_id, arg_max(outcome, seq) as status, coalesce(sum(5 - event_id % 5) filter (where outcome = 'FAILED'), 0) as failures from h group by 1)
 select module_name, status, count(*) as events, cast(sum(failures) as bigint) as failures from l join s using (unique_event_id) group by 1, 2
 union all select 'dead letters', 'DEAD', count(*), 0 from d where outcome in ('FAILED', 'RETRY', 'BROKEN')""",
    "queue_schedule": """with r as (select event_id, concat('H', user_id % 7) as g, event_id < 40 as old, case when event_id < 40 then 0 else 600000000 end as since,
  case when event_id % 6 = 0 then 5 - event_id % 5 else 1 end as tries, case when event_type = 'error' then 30000000 else 120000000 end as delay from events),
 w as (select *, (tries - 1) * delay as wait, coalesce(sum((tries - 1) * delay) over (partition by g, old order by event_id rows between unbounded preceding and 1 preceding), 0) as before from r),
 f as (select g, max(since) filter (old) + sum(wait) filter (old) as free from w group by g),
 s as (select w.*, case when old then since else greatest(since, coalesce(free, since)) end + before as start from w join f using (g)),
 t as (select *, case when start > 3600000000 then 0 when tries = 1 then 1 else least(tries, (3600000000 - start) // delay + 1) end::bigint as tried from s),
 d as (select g, min(start + tried * delay)::bigint as due from t where tried <> tries group by g)
 select event_id, tried, (tried = tries)::bigint as done, case when tried <> tries then due end as due from t left join d using (g)""",
    "stay_nights": f"with {RESV}, {NIGHTS} select hotel_id, reservation_id, {DAY.format('stay_date')} as stay_date from nights where departure_date >= date '1998-06-15' and arrival_date <= date '1998-06-15' + 730 and stay_date >= date '1998-06-15'",
    "scan_horizon": f"with {RESV} select reservation_id, {DAY.format('arrival_date')} as arrival_date, {DAY.format('departure_date')} as departure_date from resv where departure_date >= date '1998-06-15' and arrival_date <= date '1998-06-15' + 730",
    "latest_raw_payload": f"with {RESV} select hotel_id, reservation_id, cast(case when reservation_id like '%7' then 2 else 1 end as bigint) as version from resv",
    "daily_snapshot": f"""with {RESV}, {NIGHTS} select '1998-06-15' as snapshot_date, hotel_id, {DAY.format('stay_date')} as stay_date, reservation_id, confirmation_no,
 room_type, rate_code, 'UNMAPPED' as market_code, 'UNMAPPED' as source_code, channel_code, reservation_status, {_double('rooms', 'rooms')},
 {_double('room_revenue', 'room_revenue')}, {_double('room_revenue', 'total_revenue')}, {_rate('room_revenue', 'rooms')} as adr,
 cast(null as varchar) as created_date, cast(null as varchar) as cancelled_date, last_event_id, epoch_us(deleted_at) as deleted_at, cast(null as varchar) as reject_reason
 from nights where departure_date >= date '1998-06-15' and arrival_date <= date '1998-06-15' + 730 and stay_date >= date '1998-06-15'""",
    "daily_tables": f"""with {RESV}, {NIGHTS}, d as (select unnest([date '1998-06-08', date '1998-06-15']) as day),
 s as (select d.day, n.* from nights n, d where departure_date >= day and arrival_date <= day + 730 and stay_date >= day),
 live as (select * from s where {LIVE.format('s')}),
 p as (select d2.day, h.n, t.*, o.rooms as old_rooms from (select day as day0, * exclude (day) from live) t join d d2 on t.day0 = d2.day
  join (select date '1998-06-08' as hd, 7 as n union all select date '1998-06-15', 1 union all select date '1998-06-15', 7) h on h.hd = d2.day
  left join live o on o.hotel_id = t.hotel_id and o.reservation_id = t.reservation_id and o.stay_date = t.stay_date and o.day = d2.day - h.n),
 g as (select day, n, hotel_id, stay_date, channel_code, room_type, rate_code, sum(rooms - coalesce(old_rooms, 0)) as pickup from p group by all)
 select 'snapshot' as name, {DAY.format('day')} as snapshot_date, count(*) as rows, cast(sum(room_revenue) as double) as total from s group by day
 union all select 'status', {DAY.format('day')}, count(distinct reservation_id), cast(count(distinct reservation_id) as double) from s group by day
 union all select 'pickup', {DAY.format('day')}, count(*), cast(sum(pickup) as double) from g group by day""",
    "rooms_on_books": f"""{BASE} select hotel_id, {DAY.format('stay_date')} as stay_date, {_double('sum(rooms)', 'rooms_on_books')}, {_double('sum(room_revenue)', 'room_revenue_on_books')},
 {_rate('sum(room_revenue)', 'sum(rooms)')} as adr_on_books from snap t where {TODAY} and {STRICT.format('t')} group by hotel_id, t.stay_date""",
    "active_rows": f"{BASE} select {DAY.format('snapshot_date')} as snapshot_date, hotel_id, {DAY.format('stay_date')} as stay_date, reservation_id, reservation_status from snap t where {LIVE.format('t')}",
    "pickup_metric": _pickup_metric(),
    "pickup_self_join": f"""{BASE} select t.hotel_id, t.reservation_id, {DAY.format('t.stay_date')} as stay_date, {_double('t.rooms', 'rooms')}, {_double('t.room_revenue', 'room_revenue')},
 {_double('t.total_revenue', 'total_revenue')}, {_double('coalesce(o.rooms, 0)', 'rooms_previous')}, {_double('coalesce(o.room_revenue, 0)', 'room_revenue_previous')},
 {_double('coalesce(o.total_revenue, 0)', 'total_revenue_previous')} from snap t {_old('o', 7)} and {LIVE.format('o')} where {TODAY} and {LIVE.format('t')}""",
    "pickup_rooms_multi": f"""{BASE} select t.hotel_id, {DAY.format('t.stay_date')} as stay_date, t.market_code, t.channel_code,
 {', '.join(_double(f'sum(t.rooms - coalesce(d{n}.rooms, 0))', f'pickup_rooms_{n}d') for n in (1, 3, 7, 15))}
 from snap t {' '.join(_old(f'd{n}', n) for n in (1, 3, 7, 15))} where {TODAY} and {STRICT.format('t')} group by t.hotel_id, t.stay_date, t.market_code, t.channel_code""",
    "pickup_revenue_adr_7d": f"""{BASE} select t.hotel_id, {DAY.format('t.stay_date')} as stay_date, t.market_code,
 {_double('sum(t.room_revenue - coalesce(o.room_revenue, 0))', 'pickup_room_revenue_7d')}, {_double('sum(t.rooms - coalesce(o.rooms, 0))', 'pickup_rooms_7d')},
 {_rate('sum(t.room_revenue - coalesce(o.room_revenue, 0))', 'sum(t.rooms - coalesce(o.rooms, 0))')} as pickup_adr_7d
 from snap t {_old('o', 7)} where {TODAY} group by t.hotel_id, t.stay_date, t.market_code""",
    "pickup_by_channel_15d": f"""{BASE} select t.hotel_id, t.channel_code, t.market_code, t.source_code, {_double('sum(t.rooms - coalesce(o.rooms, 0))', 'pickup_rooms_15d')},
 {_double('sum(t.total_revenue - coalesce(o.total_revenue, 0))', 'pickup_total_revenue_15d')} from snap t {_old('o', 15)}
 where {TODAY} and t.stay_date between date '1998-06-15' and date '1998-06-15' + 90 group by all""",
    "top_segments": f"""{BASE} select t.hotel_id, t.channel_code, t.market_code, t.source_code, {_double('sum(t.rooms - coalesce(o.rooms, 0))', 'pickup_rooms_15d')},
 {_double('sum(t.total_revenue - coalesce(o.total_revenue, 0))', 'pickup_total_revenue_15d')} from snap t {_old('o', 15)}
 where {TODAY} and t.stay_date between date '1998-06-15' and date '1998-06-15' + 90 group by all
 order by pickup_total_revenue_15d desc, hotel_id, channel_code, market_code nulls last, source_code nulls last limit 10""",
    "cancellations_7d": f"""{BASE} select t.hotel_id, {DAY.format('t.stay_date')} as stay_date, t.market_code, count(*) as cancellations_since_7d,
 {_double('sum(coalesce(o.room_revenue, 0))', 'cancelled_room_revenue_since_7d')} from snap t join snap o on {SAME} and o.snapshot_date = date '1998-06-15' - 7
 where {TODAY} and t.reservation_status in ('CANCELLED','NO_SHOW') and {STRICT.format('o')} group by t.hotel_id, t.stay_date, t.market_code""",
    "snapshot_changes": f"""{BASE}, x as (select * from snap where snapshot_date = date '1998-06-08'), y as (select * from snap where snapshot_date = date '1998-06-15')
 select coalesce(x.hotel_id, y.hotel_id) as hotel_id, coalesce(x.reservation_id, y.reservation_id) as reservation_id, {DAY.format('coalesce(x.stay_date, y.stay_date)')} as stay_date,
 case when x.hotel_id is null then 'new' when y.hotel_id is null then 'removed' else 'modified' end as change, x.reservation_status as status_before, y.reservation_status as status_after,
 cast(x.room_revenue as double) as revenue_before, cast(y.room_revenue as double) as revenue_after
 from x full outer join y on x.hotel_id = y.hotel_id and x.reservation_id = y.reservation_id and x.stay_date = y.stay_date
 where x.hotel_id is null or y.hotel_id is null or x.reservation_status is distinct from y.reservation_status or x.rooms <> y.rooms or x.room_revenue <> y.room_revenue""",
    "last_status": f"""{LASTB} select {DAY.format('snapshot_date')} as snapshot_date, hotel_id, reservation_id, confirmation_no, {DAY.format('arr')} as arrival_date,
 {DAY.format('(lst + 1)')} as departure_date, last_status, epoch_us(seen_at) as last_status_event_at, last_event_id, room_type, rate_code, market_code, source_code, channel_code,
 epoch_us(seen_at) as source_updated_at, epoch_us(deleted_at) as deleted_at from lasts where rn = 1""",
    "current_status": f"""{LASTB} select {DAY.format('snapshot_date')} as snapshot_date, epoch_us(timestamp '1998-06-15') as snapshot_taken_at, hotel_id, reservation_id, confirmation_no,
 {DAY.format('arr')} as arrival_date, {DAY.format('(lst + 1)')} as departure_date, last_status, epoch_us(seen_at) as last_status_event_at, last_event_id, room_type, rate_code,
 market_code, source_code, channel_code, epoch_us(seen_at) as source_updated_at from lasts where {TODAYL}""",
    "status_by_hotel": _status_count(""),
    "cancelled_noshow": _status_count("and last_status in ('CANCELLED','NO_SHOW')"),
    "arrivals_by_status": _status_count("and arr = date '1998-06-15'", "arrivals"),
    "inhouse": _status_count("and last_status in ('CHECKED_IN','CHECKED_OUT')"),
    "status_by_segment": f"""{LASTB} select hotel_id, coalesce(market_code, 'UNMAPPED') as market_code, coalesce(channel_code, 'UNMAPPED') as channel_code,
 coalesce(source_code, 'UNMAPPED') as source_code, last_status, count(*) as reservations from lasts where {TODAYL} group by all""",
    "hotel_detail": f"""{LASTB} select {DAY.format('snapshot_date')} as snapshot_date, hotel_id, reservation_id, confirmation_no, {DAY.format('arr')} as arrival_date,
 {DAY.format('(lst + 1)')} as departure_date, last_status, epoch_us(seen_at) as last_status_event_at, room_type, rate_code, market_code, source_code, channel_code
 from lasts where {TODAYL} and hotel_id = 'H03'""",
    "status_as_of": f"""{LASTB} select hotel_id, reservation_id, confirmation_no, {DAY.format('arr')} as arrival_date, {DAY.format('(lst + 1)')} as departure_date, last_status,
 epoch_us(seen_at) as last_status_event_at from lasts where rn = 1 and snapshot_date = date '1998-06-08'""",
    "extract_payloads": f"""with {PARSED} select event_id, unique_event_id from ev where event_id % 5 in (0, 2, 3)
 union all select event_id, unique_event_id from ev, (select unnest([1, 2]) as copy) where event_id % 5 = 1""",
    "parse_event": f"with {PARSED} select event_id, unique_event_id, cast(event_id as varchar) as \"offset\", primary_key, module_name, event_name, hotel_id, 'CHAIN' as chain_code, {_TSUS} as occurred_at from ev",
    "parse_event_flat": f"with {_FLAT} select event_id, id, hotel_id, module, action_type, occurred_at, stream_offset from flat",
    "event_metadata": f"""with {PARSED} select event_id, cast(6 as bigint) as members, 'CHAIN' as "chainCode", hotel_id as "hotelId", module_name as "moduleName", event_name as "eventName",
 primary_key as "primaryKey", strftime(ts, '%Y-%m-%dT%H:%M:%S.%fZ') as "timestamp" from ev""",
    "event_changes": f"with {PARSED} select unique_event_id, hotel_id, {_TSUS} as occurred_at, 'reservationId' as element_name, old_value, new_value from ev",
    "delete_flag": f"with {PARSED} select event_id, cast(event_type = 'error' or new_value = '' as bigint) as is_delete_or_cancel from ev",
    "route_events": f"""with {PARSED}, {ROUTED} select event_id, case when event_id % 50 = 0 then 'Housekeeping' when event_type in ('view','error') then 'Reservation' when event_type = 'signup' then 'Profile' else 'Cashiering' end as module_norm,
 case when event_type = 'purchase' then 'Transaction' else event_name end as event_norm, resource_type, operation_id,
 case resource_type when 'reservation' then 'reservationId' when 'profile' then 'profileId' when 'folio' then 'reservationId' when 'folio_transaction' then 'transactionNo' end as identifier_type from routed""",
    "resolve_identifier": f"""with {PARSED}, {ROUTED} select event_id, resource_id, case when resource_id is null then null
 when resource_type = 'reservation' then '/rsv/v1/hotels/' || hotel_id || '/reservations/' || resource_id when resource_type = 'profile' then '/crm/v1/profiles/' || resource_id
 when resource_type = 'folio' then '/csh/v1/hotels/' || hotel_id || '/reservations/' || resource_id || '/folios'
 when resource_type = 'folio_transaction' then '/csh/v1/hotels/' || hotel_id || '/transactionDetails?transactionNo=' || resource_id end as request_path from routed""",
    "queue_messages_read": f"with {_FLAT} select id as unique_event_id, hotel_id, module, action_type, stream_offset as \"offset\", occurred_at from flat",
    "classify_responses": f"""with {DECIDED} select event_id, decision, case when status_code < 400 then null when status_code = 404 and gone then 'resource deleted or cancelled'
 when status_code = 429 then 'rate limited' when status_code = 503 then 'server error' when status_code in (400, 404) then 'non-retryable API error'
 when status_code = 401 then 'unauthorized after token refresh' else 'unexpected API error' end as reason, outcome,
 cast(case when outcome = 'RETRY' then case when status_code = 429 and event_id % 3 = 0 then 30 else 120 end end as bigint) as visible_in from decided""",
    "attach_responses": f"""with {PARSED}, {ROUTED}, landed as (select event_id as n, case when event_type in ('view','error') then 'getReservation' when event_type = 'signup' then 'getProfile'
  when event_type = 'click' then 'getFolio' else 'getFolioTransactionDetails' end as operation_id, case when event_type = 'signup' then '' else concat('H', user_id % 7) end as place,
  case event_type when 'click' then concat('resv-', user_id) when 'purchase' then cast(event_id as varchar) else concat('key-', user_id) end as resource_id from events),
 newest as (select operation_id, place, resource_id, max(n) as n from landed group by all)
 select r.event_id, r.operation_id, cast(case n.n % 20 when 1 then 404 when 2 then 429 when 3 then 503 when 4 then 401 when 5 then 400 when 6 then 418 else 200 end as bigint) * case when n.n is null then null else 1 end as status_code,
 case when n.n is null then null else case n.n % 3 when 0 then '30' when 1 then '-5' else 'soon' end end as retry_after
 from routed r left join newest n on n.operation_id = r.operation_id and n.place = case when r.operation_id = 'getProfile' then '' else r.hotel_id end and n.resource_id = r.resource_id""",
    "event_outcomes": f"""with {DECIDED}, o as (select *, row_number() over (partition by unique_event_id order by seq desc) as rn from decided where outcome <> 'RETRY'),
 e as (select distinct unique_event_id from ev)
 select e.unique_event_id, coalesce(max(case when rn = 1 then outcome end), 'RECEIVED') as status, cast(count(*) filter (outcome = 'FAILED') as bigint) as retry_count,
 epoch_us(arg_max(ts, seq) filter (outcome in ('COMPLETED','DELETED'))) as completed_at, epoch_us(arg_max(ts, seq) filter (outcome = 'FAILED')) as failed_at,
 cast(coalesce(max(case when rn = 1 then outcome end) = 'FAILED', false) as bigint) as has_error from e left join o using (unique_event_id) group by e.unique_event_id""",
    "transform_reservation": f"""select event_id, concat('H', user_id % 7) as hotel_id, concat('routed-', event_id) as resource_id,
 case when event_id % 7 = 0 then concat('routed-', event_id) else concat('resv-', user_id) end as reservation_id, concat('CNF-', event_id) as confirmation_no,
 {DAY.format('ts')} as arrival_date, case when event_id % 17 = 0 then null else {DAY.format('(cast(ts as date) + 3)')} end as departure_date, event_type as reservation_status, {_TSUS} as source_updated_at from events""",
    "transform_profile": f"""select event_id, concat('H', user_id % 7) as hotel_id, concat('routed-', event_id) as resource_id, case when event_id % 6 = 0 then concat('routed-', event_id) else concat('p-', user_id) end as profile_id,
 event_type as profile_type, case when event_id % 2 = 0 then 'Ann' else 'Bob' end as first_name, case when event_id % 2 = 0 then 'Lee' else 'Ray' end as last_name,
 concat(case event_id % 3 when 0 then 'e' when 1 then 'i' else 'd' end, user_id, '@x.invalid') as email, {_TSUS} as source_updated_at from events""",
    "transform_folios": """with f as (select event_id, user_id, value, unnest(case when event_id % 11 = 0 then [] when event_id % 5 = 0 then [1] else [1, 3] end) as place from events)
 select event_id, concat('H', user_id % 7) as hotel_id, concat('routed-', event_id) as resource_id, concat('routed-', event_id) as reservation_id,
 case when place = 1 then concat('f-', event_id) else '3' end as folio_id, case when place = 1 then '1' else '2' end as folio_no,
 cast(case when place = 1 then cast(cast(value as varchar) as decimal(18,4)) else 7.25 end as double) as balance_amount,
 case when event_id % 5 = 0 then 'USD' else 'EUR' end as currency_code, cast(null as bigint) as source_updated_at from f""",
    "transform_transaction": f"""select event_id, concat('H', user_id % 7) as hotel_id, concat('routed-', event_id) as resource_id, case when event_id % 6 = 0 then concat('routed-', event_id) else concat('T-', event_id) end as transaction_no,
 concat('resv-', user_id) as reservation_id, concat('f-', user_id % 9) as folio_id, cast(cast(cast(value as varchar) as decimal(18,4)) as double) as amount, 'EUR' as currency_code, event_type as transaction_code, {_TSUS} as source_updated_at from events""",
    "deleted_marker": "select event_id, 'deleted_marker' as operation_id, concat('{\"deleted\":true,\"resource_id\":\"routed-', event_id, '\"}') as payload from events",
    "merge_core": f"""with {_OPS}, {_MERGE}, l as (select *, row_number() over (partition by k order by seq desc) as rn, row_number() over (partition by k, op order by seq desc) as rop,
  row_number() over (partition by k order by seq) as ra from ok)
 select k, max(case when rop = 1 and op = 'upsert' then value end) as value, max(case when rn = 1 then eid end) as last_event_id, max(case when rn = 1 then epoch_us(ts) end) as last_event_at,
 max(case when ra = 1 then epoch_us(ts) end) as created_at, max(case when rn = 1 then epoch_us(ts) end) as updated_at, max(case when rop = 1 and op = 'delete' then epoch_us(ts) end) as deleted_at from l group by k""",
    "merge_core_target": _SEEDED.format(where="", key="k"),
    "soft_delete": _SEEDED.format(where="where op = 'delete'", key="profile_id"),
    "accepted_ops": f"with {_OPS}, {_MERGE} select k, seq, eid as event_id from ok",
    "insert_if_absent": f"with {_IDS}, {_KNOWN}, f as (select *, row_number() over (partition by unique_event_id order by seq) as rn from ids) select unique_event_id, seq, event_type from f where rn = 1 and unique_event_id not in (select unique_event_id from known)",
    "insert_flags": f"with {_IDS}, {_KNOWN}, f as (select *, row_number() over (partition by unique_event_id order by seq) as rn from ids) select f.unique_event_id, seq, cast(rn = 1 and k.unique_event_id is null as bigint) as inserted from f left join (select distinct unique_event_id from known) k on k.unique_event_id = f.unique_event_id",
    "register_events": f"""with {_IDS}, log as (select concat('evt-', event_id * 3) as unique_event_id, cast(event_id * 5 as varchar) as pos, case event_id % 3 when 0 then 'COMPLETED' when 1 then 'FAILED' else 'DELETED' end as status from events),
 b as (select ids.unique_event_id, seq, a.status as s1, p.status as s2, row_number() over (partition by ids.unique_event_id order by case when a.status is null and p.status is null then 0 else 1 end, seq) as rn
  from ids left join log a on a.unique_event_id = ids.unique_event_id left join log p on p.pos = cast(ids.seq as varchar)),
 n as (select unique_event_id from b where s1 is null and s2 is null and rn = 1)
 select b.unique_event_id, seq, coalesce(s1, case when n.unique_event_id is not null then 'RECEIVED' end, s2) as status from b left join n on n.unique_event_id = b.unique_event_id""",
    "upsert_resource_snapshot": """with e as (select concat('evt-', event_id % 9000) as unique_event_id, concat('H', user_id % 7) as hotel_id, cast(user_id as varchar) as resource_id, event_type, ts, cast(value as varchar) as payload,
  case when event_type = 'view' then -1 else event_id end as seq from events)
 select unique_event_id, arg_min(hotel_id, epoch_us(ts)) as hotel_id, 'reservation' as resource_type, resource_id, arg_max(event_type, epoch_us(ts)) as operation_id, max(epoch_us(ts)) as fetched_at, arg_max(payload, epoch_us(ts)) as payload
 from e group by unique_event_id, resource_id""",
    "fifo_prefix": "with f as (select user_id, min(event_id) as stop from events where event_type = 'error' group by user_id) select event_id from events left join f using (user_id) where stop is null or event_id <= stop",
    "dead_letter": f"""with {DECIDED} select cast(event_id as varchar) as message_id, 'event-enricher-poison' as group_id, concat('poison-', event_id) as dedup_id,
 case when status_code in (400, 404) then 'non-retryable API error' else 'unexpected API error' end as failure_reason
 from dec0 where status_code in (400, 404, 418) and not (status_code = 404 and event_type = 'error') and user_id % 8 >= 5""",
    "left_for_retry": f"with {DECIDED} select event_id, user_id % 8 as receive_count from dec0 where status_code in (400, 404, 418) and not (status_code = 404 and event_type = 'error') and user_id % 8 < 5",
    "message_group": """with h as (select event_id, sha256(concat('H', user_id % 7, ':', case when event_id % 10 <> 0 then cast(event_id as varchar) else '' end)) as d from events)
 select event_id, concat('events-', lpad(cast(cast(concat('0x', substr(d, 57, 8)) as bigint) % 32 as varchar), 2, '0')) as group_id from h""",
    "queue_message": f"with {_FLAT} select case when hotel_id = 'UNKNOWN' then 'event-stream' else hotel_id end as group_id, id as dedup_id, cast(event_id as varchar) as sequence, case when hotel_id = 'UNKNOWN' then '' else hotel_id end as hotel_attribute from flat",
    "raw_record": f"with {_FLAT} select concat('raw/hotel_id=', hotel_id, '/', strftime(ts, '%Y/%m/%d'), '/', id, '-', substr(sha256(id), 1, 12), '.json') as raw_key, '2030-01-01T00:00:00+00:00' as ingested_at from flat",
    "commit_offset": "select event_type as subscription_name, cast(max(event_id) as varchar) as \"offset\", concat('evt-', max(event_id) % 9000) as last_unique_event_id from events group by event_type",
    "replay_from": "select event_type as chain_code, cast(event_id as varchar) as \"offset\" from events where event_type = 'view' and event_id > (select coalesce(max(event_id), -1) from events where event_type = 'view' and ts < timestamp '2024-01-15')",
    "stage_latency": _stage_latency(),
    "usage_summary": "select l_returnflag as metric, round(avg(l_quantity), 2) as avg, round(max(l_quantity), 2) as max from lineitem group by 1",
    "processing_counters": f"""with {DECIDED}, x as (select *, outcome = 'COMPLETED' and seq >= 9000 as dup, decision = 'poison' and user_id % 8 >= 5 as dead from decided)
 select count(*) as received, count(*) filter (outcome in ('COMPLETED','DELETED')) as processed, count(*) filter (outcome not in ('COMPLETED','DELETED')) as failed,
 count(*) filter (outcome = 'COMPLETED' and not dup) as enriched, count(*) filter (dup) as deduplicated, count(*) filter (outcome = 'RETRY') as retried,
 count(*) filter (dead) as dead_lettered, count(*) filter (operation_id is not null and resource_id is null) as unresolvable, epoch_us(max(ts)) as last_event_at from x""",
    "errors_by_code": f"with {STATUS} select cast(status_code as bigint) as status_code, count(*) as errors from resp where status_code >= 400 group by 1",
    "batch_summary": "select count(*) as count, min(n) as min_size, max(n) as max_size, round(avg(n), 2) as avg_size from (select count(*) as n from events group by user_id)",
    "new_event_ids": f"with {_IDS}, {_KNOWN} select count(distinct unique_event_id) as new_ids from ids where unique_event_id not in (select unique_event_id from known)",
    "storage_counts": f"""{BASE}, {STATUS} select 'events_completed' as name, count(*) as rows from resp where status_code = 200 union all select 'raw_snapshots', count(*) + count(*) filter (reservation_id like '%7') from resv
 union all select 'core_reservations', count(*) from resv union all select 'daily_snapshot_rows', count(*) from snap union all select 'last_status_rows', count(distinct (snapshot_date, reservation_id)) from snap""",
    "check_unique": f"with {_IDS} select unique_event_id, count(*) as copies from ids group by 1 having count(*) > 1",
    "check_unique_partial": "select event_type as chain_code, user_id as stream_offset, count(*) as copies from events where user_id % 2 = 0 group by 1, 2 having count(*) > 1",
    "check_not_null": f"{BASE} select {DAY.format('snapshot_date')} as snapshot_date, hotel_id, {DAY.format('stay_date')} as stay_date, reservation_id from snap where reservation_status is null or market_code is null",
    "check_status_domain": f"with {STATUS} select event_id, 'GONE' as status from resp where status_code = 404",
    "check_fk": f"with {_IDS}, {_KNOWN} select unique_event_id, seq from ids where unique_event_id not in (select unique_event_id from known)",
    "apply_defaults": f"""{BASE} select {DAY.format('snapshot_date')} as snapshot_date, hotel_id, {DAY.format('stay_date')} as stay_date, reservation_id, coalesce(market_code, 'UNMAPPED') as market_code,
 coalesce(source_code, 'UNMAPPED') as source_code, coalesce(reservation_status, 'RECEIVED') as reservation_status from snap""",
    "stream_dedup": f"with {_IDS} select distinct unique_event_id from ids",
    "stream_events": f"""with {PARSED}, d as (select * from ev where event_id % 5 <> 4),
 f as (select *, row_number() over (partition by unique_event_id order by seq) as rn from d)
 select unique_event_id, hotel_id, module_name as module, event_name as action_type, {_TSUS} as occurred_at,
 concat('raw/hotel_id=', hotel_id, '/', strftime(ts, '%Y/%m/%d'), '/', unique_event_id, '-', substr(sha256(unique_event_id), 1, 12), '.json') as raw_key from f where rn = 1""",
}
ORACLES["reconcile_counts"] = (
    f"with c as ({ORACLES['storage_counts']}) select name, rows, rows - (select rows from c where name = 'events_completed') as difference,"
    " cast(rows = (select rows from c where name = 'events_completed') as bigint) as matches from c where name <> 'daily_snapshot_rows'"
)
ORACLES["stream_latest_state"] = (
    f"with m as ({ORACLES['merge_core']}) select k, value, last_event_id, last_event_at, deleted_at from m"
)
_BACKFILL = ORACLES["daily_tables"].replace("union all select date '1998-06-15', 1 ", "")
ORACLES["daily_backfill"] = _BACKFILL
ORACLES["daily_emptied"] = f"select * from ({_BACKFILL}) where snapshot_date = {DAY.format("date '1998-06-08'")}"

_RAWHOTEL = "case when event_id % 9 = 0 then 'UNKNOWN' else concat('R', user_id % 5) end"
_NEWQ = "event_id % 9"
ORACLES["parse_awkward"] = f"""select event_id,
  case {_NEWQ} when 7 then sha256(concat('{{"a":[', event_id, '],"b":"', user_id, '"}}')) else concat(['p', 't', 'n', 'e', 'l', 'b', 'd'][cast({_NEWQ} + 1 as int)], '-', event_id) end as unique_event_id,
  case {_NEWQ} when 0 then 'OUT' when 2 then concat('B', user_id) when 3 then concat('E', user_id) else 'UNKNOWN' end as hotel_id,
  case {_NEWQ} when 0 then 'RSV' when 5 then 'Blocks' when 6 then 'CSH' end as module_name,
  case {_NEWQ} when 0 then 'NewReservation' when 6 then 'FolioTransaction' end as event_name,
  case {_NEWQ} when 1 then '1.5' end as "offset",
  case {_NEWQ} when 0 then 'getReservation' when 5 then 'getBlock' when 6 then 'getFolioTransactionDetails' end as operation_id,
  case {_NEWQ} when 0 then concat('k', user_id) when 5 then concat('blk-', user_id) when 6 then cast(event_id as varchar) end as resource_id
  from events where {_NEWQ} <> 8"""
ORACLES["malformed_events"] = f"select event_id, concat('[', event_id, ']') as body from events where {_NEWQ} = 8"
ORACLES["raw_archive"] = f"select {_RAWHOTEL} as hotel_id, year(ts) as y, month(ts) as m, day(ts) as d, event_id as sequence from events"
ORACLES["event_files"] = f"with {PARSED} select unique_event_id, cast(event_id as varchar) as \"offset\", hotel_id, event_name from ev"
ORACLES["error_texts"] = """select event_id, sha256(substr(error, 1, 2000)) as logged, substr(error, 1, 256) as failure_reason
  from (select event_id, repeat(concat(event_type, 'é-'), cast(event_id % 500 as bigint)) as error from events)"""
ORACLES["resource_responses"] = """select case when event_type in ('view','error') then 'getReservation' when event_type = 'signup' then 'getProfile'
  when event_type = 'click' then 'getFolio' else 'getFolioTransactionDetails' end as operation_id, concat('H', user_id % 7) as hotel_id,
  case event_type when 'click' then concat('resv-', user_id) when 'purchase' then cast(event_id as varchar) else concat('key-', user_id) end as resource_id,
  cast(case event_id % 20 when 1 then 404 when 2 then 429 when 3 then 503 when 4 then 401 when 5 then 400 when 6 then 418 else 200 end as bigint) as status_code,
  case event_id % 3 when 0 then '30' when 1 then '-5' else 'soon' end as retry_after from events"""
_ENRICHED = ORACLES["stream_enrich"].split(",\n h as")[0]
ORACLES["stream_counters"] = f"""{_ENRICHED},
 o as (select outcome in ('COMPLETED', 'DELETED') as handled, outcome = 'COMPLETED' as completed, coalesce(state = 'COMPLETED', false) as again, operation_id is not null and resource_id is null as lost, ts from k)
 select (select count(*) from d) as received, count(*) filter (handled) as processed, (select count(*) from d where outcome not in ('COMPLETED', 'DELETED')) as failed,
  count(*) filter (completed and not again) as enriched, count(*) filter (handled and again) as deduplicated,
  (select cast(sum(4 - event_id % 5) as bigint) from d where outcome not in ('COMPLETED', 'DELETED')) as retried,
  (select count(*) from d where outcome not in ('COMPLETED', 'DELETED')) as dead_lettered, count(*) filter (lost) as unresolvable, epoch_us(max(ts)) as last_event_at from o"""
