"""Idempotent inserts, event outcomes and the guarded latest-wins merge."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stayflow.functions import scalars as S
from stayflow.operators.running import SPAN, earlier, span_of
from stayflow.session import materialize


def first_arrivals(batch: DataFrame, key: list[str], seq: str) -> DataFrame:
    """The earliest row of each key (map-side reduced, so copies never travel)."""
    rest = [c for c in batch.columns if c not in key]
    firsts = batch.groupBy(*key).agg(F.min_by(F.struct(*rest), seq).alias("_row"))
    return firsts.select(*key, "_row.*").select(*batch.columns)


def insert_if_absent(target: DataFrame, batch: DataFrame, key: list[str], seq: str = "seq") -> DataFrame:
    """Rows to insert: first arrival of each key the target does not have yet."""
    return first_arrivals(batch, key, seq).join(target.select(*key), key, "left_anti")


def insert_flags(target: DataFrame, batch: DataFrame, key: list[str], seq: str = "seq") -> DataFrame:
    """The batch with ``inserted``: whether that very row would have been inserted."""
    new = insert_if_absent(target, batch, key, seq).select(*key, F.col(seq).alias("_first"))
    return batch.join(new, key, "left").withColumn(
        "inserted", F.coalesce(F.col("_first") == F.col(seq), F.lit(False))
    ).select(*batch.columns, "inserted")


def _slot(id_col: Column) -> Column:
    """Join key for (chain, offset); a row without one gets a key nothing else has.

    Left as null, all such rows would meet in one partition.
    """
    complete = F.col("chain_code").isNotNull() & F.col("stream_offset").isNotNull()
    return F.when(complete, F.concat(F.col("chain_code"), F.lit("\u0001"), F.col("stream_offset"))).otherwise(
        F.concat(F.lit("\u0002"), id_col)
    )


def with_slot(events: DataFrame) -> DataFrame:
    """Add ``slot``, the event's position in its chain; null where it has none."""
    whole = F.col("chain_code").isNotNull() & F.col("stream_offset").isNotNull()
    return events.withColumn("slot", F.when(whole, _slot(F.lit(""))))


def _firsts(open_rows: DataFrame, key: str, seq: str, name: str) -> DataFrame:
    return open_rows.groupBy(key).agg(F.min(seq).alias(name))


def _first_of_both(open_rows: DataFrame, seq: str) -> DataFrame:
    """Rows that come first in both of their groups: nothing can keep them out."""
    firsts = open_rows.join(_firsts(open_rows, "unique_event_id", seq, "_id1"), "unique_event_id").join(
        _firsts(open_rows, "_slot", seq, "_slot1"), "_slot"
    )
    return firsts.where((F.col(seq) == F.col("_id1")) & (F.col(seq) == F.col("_slot1"))).select(*open_rows.columns)


def _along_chains(open_rows: DataFrame, seq: str, cut) -> DataFrame:
    """Rows that enter because they are first in both groups, or by way of a chain that starts at such a row.

    A row with a single earlier row in both groups together enters exactly if
    that one does not. Such rows form chains, settled by pointer doubling: each
    step every row looks where its target points to, so a chain of n rows takes
    log n steps. Rows behind one with several earlier rows are left to a later round.
    """
    marked = open_rows.join(_firsts(open_rows, "unique_event_id", seq, "_id1"), "unique_event_id").join(
        _firsts(open_rows, "_slot", seq, "_slot1"), "_slot"
    )
    marked = cut(marked.select("unique_event_id", "_slot", F.col(seq).alias("_at"), "_id1", "_slot1"), "marked")
    # Two minima, not a window: a group may hold most of the rows.
    second_id = _firsts(marked.where("_at > _id1"), "unique_event_id", "_at", "_id2")
    second_slot = _firsts(marked.where("_at > _slot1"), "_slot", "_at", "_slot2")
    only = F.expr("case when _at = _id1 and _at = _slot2 then _slot1 when _at = _slot1 and _at = _id2 then _id1 end").alias("_to")
    enters = F.expr("case when _at = _id1 and _at = _slot1 then true end").alias("_enters")
    linked = marked.join(second_id, "unique_event_id", "left").join(second_slot, "_slot", "left")
    # ``_odd``: the row's fate is the opposite of its target's.
    state = cut(linked.select("_at", only, F.lit(True).alias("_odd"), enters).where("_to is not null or _enters"), "chains")
    while not state.where("_to is not null").isEmpty():
        target = state.select(F.col("_at").alias("_to"), F.col("_to").alias("_next"), F.col("_odd").alias("_next_odd"), F.col("_enters").alias("_known"))
        moved = state.where("_to is not null").join(target, "_to").select(
            "_at", F.col("_next").alias("_to"), F.expr("if(_next is null, _odd, _odd <> _next_odd)").alias("_odd"), F.expr("_known <> _odd").alias("_enters")
        )
        state = cut(state.where("_to is null").unionByName(moved), "chains")
    return open_rows.join(state.where("_enters").select(F.col("_at").alias(seq)), seq, "left_semi")


def new_events(log: DataFrame, batch: DataFrame, seq: str = "seq", cut=materialize) -> DataFrame:
    """Batch rows that enter the log when inserted one by one in ``seq`` order.

    A row enters unless its id, or its (chain, offset), is already taken by the
    log or by an earlier row that entered. The earliest row of both of its
    groups always enters and rules out the rest of both groups, which settles a
    batch unless rows conflict in chains: a row that did not enter blocks nobody.
    Later rounds settle whole chains, of any length, at once; rounds repeat until
    nothing is open. ``seq`` must be unique.
    """
    slotted = batch.withColumn("_slot", _slot(F.col("unique_event_id")))
    # Copies share both groups, so they share the fate of the first of them.
    slotted = first_arrivals(slotted, ["unique_event_id", "_slot"], seq)
    taken = log.select("unique_event_id", _slot(F.col("unique_event_id")).alias("_slot"))
    open_rows = slotted.join(taken.select("unique_event_id"), "unique_event_id", "left_anti").join(
        taken.select("_slot"), "_slot", "left_anti"
    )
    open_rows = cut(open_rows, "open")
    entered = None
    while True:
        winners = cut(_first_of_both(open_rows, seq) if entered is None else _along_chains(open_rows, seq, cut), "entered")
        entered = winners if entered is None else entered.unionByName(winners)
        open_rows = cut(
            open_rows.join(winners.select("unique_event_id"), "unique_event_id", "left_anti").join(
                winners.select("_slot"), "_slot", "left_anti"
            ),
            "open",
        )
        if open_rows.isEmpty():
            return entered.select(*batch.columns)


def register_events(log: DataFrame, batch: DataFrame, entered: DataFrame, seq: str = "seq") -> DataFrame:
    """The log row each batch row finds after registration, by its id first, else by (chain, offset): ``log_id`` and ``status``.

    A row sees what had entered by its own turn, not what enters later in the
    batch. Two equality joins; one join on either condition would compare all pairs.
    """
    always = F.lit(None).cast("bigint").alias("_at")
    known = log.select("unique_event_id", "chain_code", "stream_offset", "status", always).unionByName(
        entered.select("unique_event_id", "chain_code", "stream_offset", F.lit("RECEIVED").alias("status"), F.col(seq).alias("_at"))
    )
    by_id = known.select("unique_event_id", F.col("status").alias("_by_id"), F.col("_at").alias("_id_at"))
    by_slot = known.where("chain_code is not null and stream_offset is not null").select(
        _slot(F.col("unique_event_id")).alias("_slot"), F.col("status").alias("_by_slot"), F.col("unique_event_id").alias("_slot_id")
    )
    by_own = F.col("_by_id").isNotNull() & F.coalesce(F.col("_id_at") <= F.col(seq), F.lit(True))
    return (
        batch.withColumn("_slot", _slot(F.col("unique_event_id")))
        .join(by_id, "unique_event_id", "left")
        .join(by_slot, "_slot", "left")
        .withColumn("status", F.when(by_own, F.col("_by_id")).otherwise(F.col("_by_slot")))
        .withColumn("log_id", F.when(by_own, F.col("unique_event_id")).otherwise(F.col("_slot_id")))
        .select(*batch.columns, "log_id", "status")
    )


def upsert_resource_snapshot(target: DataFrame, batch: DataFrame, seq: str = "seq") -> DataFrame:
    """Last response per (event, type, resource) by fetch time, then arrival."""
    key = ["unique_event_id", "resource_type", "resource_id"]
    both = target.withColumn(seq, F.lit(-1).cast("bigint")).unionByName(batch.select(*target.columns, seq))
    rest = [c for c in target.columns if c not in key]
    # The hotel is written on insert only, so it stays with the first row.
    kept = [c for c in rest if c != "hotel_id"]
    order = F.struct(F.col("fetched_at"), F.col(seq))
    merged = both.groupBy(*key).agg(
        F.max_by(F.struct(*kept), order).alias("_row"), F.min_by("hotel_id", order).alias("hotel_id")
    )
    return merged.select(*key, "hotel_id", "_row.*").select(*target.columns)


def event_outcomes(log: DataFrame, outcomes: DataFrame, seq: str = "seq") -> DataFrame:
    """Fold outcomes (COMPLETED, DELETED or FAILED, with ``at``, ``error`` and perhaps ``tries``) into the log."""
    tries = F.col("tries").cast("bigint") if "tries" in outcomes.columns else F.lit(1).cast("bigint")
    failed = F.col("outcome") == "FAILED"
    when_failed, when_done = F.when(failed, F.col(seq)), F.when(~failed, F.col(seq))
    folded = outcomes.groupBy("unique_event_id").agg(
        F.max_by(F.struct("outcome", S.truncate_error(F.col("error")).alias("error")), seq).alias("_last"),
        F.max_by("at", when_done).alias("_done_at"),
        F.max_by("at", when_failed).alias("_failed_at"),
        F.coalesce(F.sum(F.when(failed, tries)), F.lit(0)).cast("int").alias("_failures"),
    )
    changed = F.col("_last").isNotNull()
    error = F.when(F.col("_last.outcome") == "FAILED", F.col("_last.error"))
    return log.join(folded, "unique_event_id", "left").select(
        *[
            {
                "status": F.coalesce(F.col("_last.outcome"), F.col("status")),
                "completed_at": F.coalesce("_done_at", "completed_at"),
                "failed_at": F.coalesce("_failed_at", "failed_at"),
                "retry_count": F.col("retry_count") + F.coalesce("_failures", F.lit(0)),
                "error_message": F.when(changed, error).otherwise(F.col("error_message")),
            }.get(c, F.col(c)).alias(c)
            for c in log.columns
        ]
    )


def accepted_ops(ops: DataFrame, keys: list[str], seq: str = "seq", at: str = "event_at", span: int = SPAN) -> DataFrame:
    """Operations not older than anything that arrived before them for the same key."""
    seen = earlier(ops, keys, seq, F.col(at), "_seen", "max", span)
    return seen.where(F.col("_seen").isNull() | (F.col(at) >= F.col("_seen"))).drop("_seen")


def merge_core(
    target: DataFrame | None,
    ops: DataFrame,
    keys: list[str],
    attributes: list[str],
    seq: str = "seq",
    span: int = SPAN,
) -> DataFrame:
    """Apply upserts and deletes in arrival order, ignoring those older than the row they meet.

    ``ops`` carries keys, attributes, ``op`` ('upsert' or 'delete'),
    ``event_id``, ``event_at``, ``applied_at`` and the arrival number ``seq``.
    An upsert replaces every attribute, nulls included; a delete only sets
    ``deleted_at``; neither clears it. Equal times go to the later arrival.

    Accepted operations of a key never go back in time, so a run of operations
    is fully described by its latest time, its last accepted operation, upsert
    and delete: if any of these is too old for what came before the run, so is
    everything of its kind earlier in the run. Runs (spans of ``seq``) are
    therefore reduced on their own, and only one row per key and span meets the
    target. A key holding most of the batch is spread over its spans.
    """
    values = F.struct(*[F.col(a) for a in attributes]) if attributes else F.struct(F.lit(None).cast("string").alias("_"))
    in_run = Window.partitionBy(*keys, "_span").orderBy(seq).rowsBetween(Window.unboundedPreceding, -1)
    run = ops.withColumn("_span", span_of(seq, span)).withColumn("_seen", F.max("event_at").over(in_run))
    run = run.where(F.col("_seen").isNull() | (F.col("event_at") >= F.col("_seen")))
    upsert, delete = F.col("op") == "upsert", F.col("op") == "delete"
    reduced = run.groupBy(*keys, "_span").agg(
        F.max("event_at").alias("_latest"),
        F.max_by(F.struct("event_id", "event_at", "applied_at"), seq).alias("_last"),
        F.max_by(F.struct(values.alias("v"), F.col("event_at")), F.when(upsert, F.col(seq))).alias("_up"),
        F.max_by(F.struct(F.col("applied_at").alias("gone_at"), F.col("event_at")), F.when(delete, F.col(seq))).alias("_del"),
        F.min_by("applied_at", seq).alias("_born"),
    )
    if target is not None:
        base = target.select(
            *keys,
            F.lit(-1).cast("bigint").alias("_span"),
            F.col("last_event_at").alias("_latest"),
            F.struct(
                F.col("last_event_id").alias("event_id"),
                F.col("last_event_at").alias("event_at"),
                F.col("updated_at").alias("applied_at"),
            ).alias("_last"),
            F.struct(values.alias("v"), F.col("last_event_at").alias("event_at")).alias("_up"),
            F.when(
                F.col("deleted_at").isNotNull(),
                F.struct(F.col("deleted_at").alias("gone_at"), F.col("last_event_at").alias("event_at")),
            ).alias("_del"),
            F.col("created_at").alias("_born"),
        )
        reduced = base.unionByName(reduced)
    across = Window.partitionBy(*keys).orderBy("_span").rowsBetween(Window.unboundedPreceding, -1)
    linked = reduced.withColumn("_before", F.max("_latest").over(across))

    def still_good(part: str) -> Column:
        fresh = F.col("_before").isNull() | (F.col(f"{part}.event_at") >= F.col("_before"))
        return F.when(F.col(part).isNotNull() & fresh, F.col("_span"))

    final = linked.groupBy(*keys).agg(
        F.max_by("_last", still_good("_last")).alias("_last"),
        F.max_by("_up", still_good("_up")).alias("_up"),
        F.max_by("_del", still_good("_del")).alias("_del"),
        F.min_by("_born", "_span").alias("created_at"),
    )
    return final.select(
        *keys,
        *[F.col(f"_up.v.{a}").alias(a) for a in attributes],
        F.col("_last.event_id").alias("last_event_id"),
        F.col("_last.event_at").alias("last_event_at"),
        "created_at",
        F.col("_last.applied_at").alias("updated_at"),
        F.col("_del.gone_at").alias("deleted_at"),
    )


# Resource types whose rows a delete can name; a folio is looked up by reservation.
DELETABLE = ["reservation", "profile", "folio_transaction"]


def soft_delete(target: DataFrame | None, deletes: DataFrame, resource_type: str, keys: list[str], attributes: list[str], seq: str = "seq") -> DataFrame | None:
    """Mark rows deleted under the same age guard; a missing row becomes a stub.

    Types a delete cannot name leave the table as it is.
    """
    if resource_type not in DELETABLE:
        return target
    schema = {f.name: f.dataType for f in target.schema.fields} if target is not None else {}
    ops = deletes.select(
        *keys,
        *[F.lit(None).cast(schema.get(a, "string")).alias(a) for a in attributes],
        F.lit("delete").alias("op"),
        "event_id",
        "event_at",
        "applied_at",
        seq,
    )
    return merge_core(target, ops, keys, attributes, seq)
