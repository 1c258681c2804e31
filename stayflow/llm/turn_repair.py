"""Repair the turn structure of conversations by weighted CYK interval parsing.

A sound conversation has the role initials ``(s?(ua)+)?``. The repair grammar
is in Chomsky normal form: the symbol (p, q) stands for a stretch of rows that
brings the pattern from state p to state q, ``(p, r) -> (p, q) (q, r)`` joins
two neighbouring stretches, and a single row is kept, given another role or
deleted, after the insertions that closure allows in front of it. A cell holds,
per symbol, the least (cost, audit). Stretches are combined bottom-up by their
length, doubling it each time: as all symbols meet in a state, every split of a
stretch gives the same cell, so one split per stretch is enough. Insertions
stand in front of a row or at the very end, so audits of a stretch are never
prefixes of each other and their order is kept as ranks; no audit is built
before the parse is over.

No conversation has to fit in a task. Rows are range sorted, a batch of them is
parsed as a block, and a conversation that lies in several blocks is parsed
once more over its blocks' cells, some 16 numbers per block. Only the digest of
a conversation is sequential; it is streamed.

Nulls: a null role or text is one space, a null turn sorts first, a null
conv_id is a conversation of its own. Rows of equal turn are ordered by role,
the first 200 characters of the text, and its SHA-256. Repeated rows are one
row with a count and stand next to each other. Empty texts are blank rows; very
long ones are read whole, one batch at a time. Empty tables give no rows. Other
columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stayflow.llm.common import BLANKS, importable, total_order
from stayflow.session import materialize

START, SYSTEM, USER, ASSISTANT = range(4)
STATES = 4
#: Costs of the edits. Keep costs nothing.
INSERT, REROLE, DELETE, TRUNCATED = 3, 3, 4, 3
NEVER = 1 << 40
#: What may happen at a row, least audit first: its place is its rank.
STEPS = ["D", "IIK", "IIR", "IK", "IR", "K", "R"]
#: Insertions that bring a state to the end of the pattern.
CLOSING = [0, 2, 1, 0]
ROLE = {USER: "user", ASSISTANT: "assistant"}
INITIALS = {"s": 1, "u": 2, "a": 3}
SOUND = {"su", "ua", "au"}


def _next(state: int) -> int:
    """Where a user or assistant row leads from a state."""
    return ASSISTANT if state == USER else USER


def _row_cells() -> tuple[np.ndarray, np.ndarray]:
    """Cost and step of every symbol for a row that stays, by the row's initial (0: none of s, u, a)."""
    cost = np.full((4, STATES, STATES), NEVER, np.int64)
    step = np.zeros((4, STATES, STATES), np.int64)
    for initial in range(4):
        for p in range(STATES):
            state = p
            for inserted in range(3):
                choices = [("R", _next(state), REROLE)]
                if initial == SYSTEM and state == START:
                    choices.append(("K", SYSTEM, 0))
                if initial == _next(state):
                    choices.append(("K", initial, 0))
                for edit, q, paid in choices:
                    found = (inserted * INSERT + paid, STEPS.index("I" * inserted + edit))
                    if found < (cost[initial, p, q], step[initial, p, q]):
                        cost[initial, p, q], step[initial, p, q] = found
                state = _next(state)
    return cost, step


ROW_COST, ROW_STEP = _row_cells()


def row_cells(initial: np.ndarray, gone: np.ndarray, truncated: np.ndarray, copies: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Cells of single rows. ``gone`` rows have to be deleted; so have ``copies`` after the row."""
    cost = ROW_COST[initial] + (TRUNCATED * truncated)[:, None, None]
    cost[gone] = NEVER
    step = ROW_STEP[initial].copy()
    for p in range(STATES):
        deleted = DELETE <= cost[:, p, p]
        cost[deleted, p, p], step[deleted, p, p] = DELETE, 0
    return np.minimum(cost + (DELETE * copies)[:, None, None], NEVER), step


class Chart:
    """Cells of all stretches of several conversations, bottom-up by length.

    ``owner`` numbers the conversation of every leaf, in ascending order.
    ``cost`` and ``rank`` of the whole conversations are left in ``roots``.
    """

    def __init__(self, cost: np.ndarray, rank: np.ndarray, owner: np.ndarray):
        self.levels: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        while len(owner) and (owner[1:] == owner[:-1]).any():
            first = np.searchsorted(owner, owner)
            left = np.flatnonzero((np.arange(len(owner)) - first) % 2 == 0)
            paired = np.zeros(len(left), bool)
            inside = left + 1 < len(owner)
            paired[inside] = owner[left[inside] + 1] == owner[left[inside]]
            a, b = left[paired], left[paired] + 1
            # cost first, then the audit of the left stretch, then that of the right
            sums = ((cost[a][:, :, :, None] + cost[b][:, None, :, :]) << 8) + (rank[a][:, :, :, None] << 4) + rank[b][:, None, :, :]
            split = sums.argmin(axis=2)
            best = sums.min(axis=2)
            cost, rank, owner = cost[left], rank[left], owner[left]
            cost[paired] = np.minimum(best >> 8, NEVER)
            rank[paired] = self._ranks(best & 255)
            self.levels.append((left, paired, split))
        self.roots = cost, rank

    @staticmethod
    def _ranks(audits: np.ndarray) -> np.ndarray:
        flat = audits.reshape(len(audits), -1)
        order = flat.argsort(axis=1, kind="stable")
        ordered = np.take_along_axis(flat, order, 1)
        new = np.zeros(flat.shape, np.int64)
        new[:, 1:] = ordered[:, 1:] != ordered[:, :-1]
        out = np.empty(flat.shape, np.int64)
        np.put_along_axis(out, order, new.cumsum(axis=1), 1)
        return out.reshape(audits.shape)

    def leaves(self, p: np.ndarray, q: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The symbol of every leaf, given those of the roots."""
        for left, paired, split in reversed(self.levels):
            middle = split[np.arange(len(split)), p[paired], q[paired]]
            n = len(left) + int(paired.sum())
            below_p, below_q = np.empty(n, np.int64), np.empty(n, np.int64)
            below_p[left], below_q[left] = p, q
            below_q[left[paired]] = middle
            below_p[left[paired] + 1], below_q[left[paired] + 1] = middle, q[paired]
            p, q = below_p, below_q
        return p, q


def best_end(cost: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Last state and whole cost of conversations, from the cells of all their rows."""
    total = cost[:, START, :] + INSERT * np.array(CLOSING)
    end = ((total << 8) + rank[:, START, :]).argmin(axis=1)
    return end, np.take_along_axis(total, end[:, None], 1)[:, 0]


def replay(steps: list[int], entered: list[int], left: list[int], copies: list[int], roles: list[str], texts: list[str], closing: int) -> tuple[str, list[tuple[str, str]]]:
    """Audit and repaired rows of a stretch of rows; ``closing`` is its state at the conversation's end, or -1 before it."""
    audit, turns = [], []

    def insert(state: int, n: int) -> None:
        for _ in range(n):
            state = _next(state)
            turns.append((ROLE[state], ""))

    for step, p, q, more, role, text in zip(steps, entered, left, copies, roles, texts):
        name = STEPS[step]
        audit.append(name)
        insert(p, len(name) - 1)
        if name[-1] == "K":
            turns.append((role, text))
        elif name[-1] == "R":
            turns.append((ROLE[q], text))
        if more:
            audit.append("D" * more)
    if closing >= 0:
        audit.append("I" * CLOSING[closing])
        insert(closing, CLOSING[closing])
    return "".join(audit), turns


def _digest(turns: list[tuple[str, str]]) -> str:
    return hashlib.sha256("\n".join(f"{role}:{text}" for role, text in turns).encode()).hexdigest()


_COUNTS = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
_TURNS = pa.list_(pa.struct([("role", pa.string()), ("text", pa.string())]))
#: What is known of a block beside its conversation: its place, counts, ends, cells, and what a whole conversation or an open one needs next.
_BLOCK = [
    ("part", pa.int64()), ("seq", pa.int64()), ("open", pa.bool_()),
    *((name, pa.int64()) for name in _COUNTS),
    ("turns", pa.int64()), ("least", pa.int64()), ("most", pa.int64()), ("first", pa.string()), ("last", pa.string()),
    ("cells", pa.list_(pa.int64())), ("ranks", pa.list_(pa.int64())),
    ("audit", pa.string()), ("sha", pa.string()), ("repaired", _TURNS),
    ("kinds", pa.list_(pa.int64())), ("copies", pa.list_(pa.int64())), ("said", _TURNS),
]
_SPARK = {pa.int64(): "bigint", pa.bool_(): "boolean", pa.string(): "string", pa.list_(pa.int64()): "array<bigint>", _TURNS: "array<struct<role:string,text:string>>"}


def _schema(fields: list[tuple[str, pa.DataType]], conv_id: T.StructField) -> T.StructType:
    out = T.StructType([T.StructField("conv_id", conv_id.dataType)])
    for name, kind in fields:
        out = out.add(name, T._parse_datatype_string(_SPARK[kind]))
    return out


def _out(fields: list[tuple[str, pa.DataType]], ids: pa.Array, rows: list[dict]) -> pa.RecordBatch:
    arrays = [pa.array([r.get(name) for r in rows], kind) for name, kind in fields]
    return pa.RecordBatch.from_arrays([ids, *arrays], names=["conv_id", *(name for name, _ in fields)])


def _parse_block(batch: pa.RecordBatch, part: int, seq: int, keep_turns: bool) -> pa.RecordBatch:
    """One row per stretch of a conversation in a batch of sorted rows."""
    ids, turns = batch.column("conv_id").to_pylist(), batch.column("turn").to_pylist()
    roles, texts = batch.column("role").to_pylist(), batch.column("text").to_pylist()
    more = np.array(batch.column("copies").to_pylist(), np.int64) - 1
    seen = np.array(batch.column("seen").to_pylist(), bool)
    ends = [t.rstrip(BLANKS)[-1:] for t in texts]
    blank = np.array([not e for e in ends])
    duplicate = seen & ~blank
    truncated = np.array([bool(e) and e not in ".!?" for e in ends]) & ~duplicate
    marks = [r[:1] for r in roles]
    initial = np.array([INITIALS.get(m, 0) for m in marks])
    starts = [0] + [k for k in range(1, len(ids)) if ids[k] != ids[k - 1]]
    stops = [*starts[1:], len(ids)]
    owner = np.repeat(np.arange(len(starts)), np.diff([*starts, len(ids)]))
    # a repeated blank row is blank each time, any other a duplicate of its first
    copies_blank = np.where(blank, more, 0)
    cost, step = row_cells(initial, blank | duplicate, truncated, more)
    chart = Chart(cost, step, owner)
    end, paid = best_end(*chart.roots)
    p, q = chart.leaves(np.zeros(len(starts), np.int64), end)
    chosen = step[np.arange(len(ids)), p, q]
    rows = []
    for k, (a, b) in enumerate(zip(starts, stops)):
        known = sorted({t for t in turns[a:b] if t is not None})
        row = {
            "part": part,
            "seq": seq + k,
            "open": a == 0 or b == len(ids),
            "blank": int(blank[a:b].sum() + copies_blank[a:b].sum()),
            "duplicate": int(duplicate[a:b].sum() + more[a:b].sum() - copies_blank[a:b].sum()),
            "truncated": int(truncated[a:b].sum()),
            "illegal": int(more[a:b].sum()) + sum(marks[i] + marks[i + 1] not in SOUND for i in range(a, b - 1)),
            "cost": int(paid[k]),
            "turns": len(known),
            "least": known[0] if known else None,
            "most": known[-1] if known else None,
            "first": marks[a],
            "last": marks[b - 1],
        }
        row["gaps"] = row["most"] - row["least"] + 1 - len(known) if known else 0
        if row["open"]:
            row["cells"], row["ranks"] = chart.roots[0][k].ravel().tolist(), chart.roots[1][k].ravel().tolist()
            row["kinds"] = (initial[a:b] + 4 * (blank | duplicate)[a:b] + 8 * truncated[a:b]).tolist()
            row["copies"] = more[a:b].tolist()
            row["said"] = [{"role": r, "text": t} for r, t in zip(roles[a:b], texts[a:b])]
        else:
            row["audit"], said = replay(chosen[a:b].tolist(), p[a:b].tolist(), q[a:b].tolist(), more[a:b].tolist(), roles[a:b], texts[a:b], int(end[k]))
            row["sha"] = _digest(said)
            if keep_turns:
                row["repaired"] = [{"role": r, "text": t} for r, t in said]
        rows.append(row)
    return _out(_BLOCK, batch.column("conv_id").take(pa.array(starts)), rows)


def _parse(keep_turns: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, seq = TaskContext.get().partitionId(), 0
        for batch in batches:
            if batch.num_rows:
                yield _parse_block(batch, part, seq, keep_turns)
                seq += batch.num_rows

    return run


_SETTLED = [("at_part", pa.int64()), ("at_seq", pa.int64()), ("entered", pa.int64()), ("ended", pa.int64()), ("is_last", pa.bool_()), *((f"all_{name}", pa.int64()) for name in _COUNTS)]
_MISSING = object()


def _settle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The states in which every block of an open conversation begins and ends, and the conversation's counts."""

    def settled(blocks: list[dict]) -> pa.RecordBatch:
        shape = (len(blocks), STATES, STATES)
        cost = np.array([b["cells"] for b in blocks], np.int64).reshape(shape)
        rank = np.array([b["ranks"] for b in blocks], np.int64).reshape(shape)
        chart = Chart(cost, rank, np.zeros(len(blocks), np.int64))
        end, paid = best_end(*chart.roots)
        p, q = chart.leaves(np.zeros(1, np.int64), end)
        sums = {name: sum(b[name] for b in blocks) for name in ("blank", "duplicate", "truncated", "illegal")}
        sums["illegal"] += sum(a["last"] + b["first"] not in SOUND for a, b in zip(blocks, blocks[1:]))
        dated = [b for b in blocks if b["least"] is not None]
        distinct = sum(b["turns"] for b in dated) - sum(a["most"] == b["least"] for a, b in zip(dated, dated[1:]))
        sums["gaps"] = dated[-1]["most"] - dated[0]["least"] + 1 - distinct if dated else 0
        sums["cost"] = int(paid[0])
        totals = {f"all_{name}": n for name, n in sums.items()}
        rows = [{"at_part": b["part"], "at_seq": b["seq"], "entered": int(p[k]), "ended": int(q[k]), "is_last": k == len(blocks) - 1, **totals} for k, b in enumerate(blocks)]
        return _out(_SETTLED, pa.array([b["conv_id"] for b in blocks], kind), rows)

    held, kind = [], None
    for batch in batches:
        kind = batch.schema.field("conv_id").type
        for row in batch.to_pylist():
            if held and held[0]["conv_id"] != row["conv_id"]:
                yield settled(held)
                held = []
            held.append(row)
    if held:
        yield settled(held)


_PIECE = [("part", pa.int64()), ("seq", pa.int64()), *((name, pa.int64()) for name in _COUNTS), ("audit", pa.string()), ("repaired", _TURNS)]


def _replay(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Audit and repaired rows of the blocks of open conversations."""
    for batch in batches:
        rows = []
        for b in batch.to_pylist():
            kinds, copies = np.array(b["kinds"], np.int64), np.array(b["copies"], np.int64)
            cost, step = row_cells(kinds & 3, (kinds & 4) > 0, (kinds & 8) >> 3, copies)
            p, q = Chart(cost, step, np.zeros(len(kinds), np.int64)).leaves(np.array([b["entered"]]), np.array([b["ended"]]))
            roles, texts = [s["role"] for s in b["said"]], [s["text"] for s in b["said"]]
            audit, said = replay(step[np.arange(len(kinds)), p, q].tolist(), p.tolist(), q.tolist(), b["copies"], roles, texts, b["ended"] if b["is_last"] else -1)
            rows.append({"part": b["part"], "seq": b["seq"], "audit": audit, "repaired": [{"role": r, "text": t} for r, t in said], **{name: b[f"all_{name}"] for name in _COUNTS}})
        yield _out(_PIECE, batch.column("conv_id"), rows)


_REPORT = [*((name, pa.int64()) for name in _COUNTS), ("audit", pa.string()), ("sha", pa.string())]


def _join_pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per open conversation; its pieces come in order and are hashed as they come."""
    current, counts, audit, sha, begun, kind = _MISSING, {}, [], None, False, None

    def done() -> pa.RecordBatch:
        return _out(_REPORT, pa.array([current], kind), [{**counts, "audit": "".join(audit), "sha": sha.hexdigest()}])

    for batch in batches:
        kind = batch.schema.field("conv_id").type
        for row in batch.to_pylist():
            if current is _MISSING or row["conv_id"] != current:
                if current is not _MISSING:
                    yield done()
                current, counts, audit, sha, begun = row["conv_id"], {name: row[name] for name in _COUNTS}, [], hashlib.sha256(), False
            audit.append(row["audit"])
            for turn in row["repaired"]:
                sha.update(f"{chr(10) if begun else ''}{turn['role']}:{turn['text']}".encode())
                begun = True
    if current is not _MISSING:
        yield done()


def _same(left: Column, right: Column) -> Column:
    return left.eqNullSafe(right)


def _blocks(conversations: DataFrame, keep_turns: bool) -> DataFrame:
    """The parsed blocks, written: whole conversations are done, open ones have their cells."""
    importable(conversations.sparkSession)
    spaced = lambda name: F.coalesce(F.col(name), F.lit(" ")).alias(name)
    rows = conversations.select("conv_id", F.col("turn").cast("bigint").alias("turn"), spaced("role"), spaced("text"))
    key = F.unhex(F.sha2(F.concat_ws(":", F.octet_length("role"), "role", "text"), 256)).alias("said_key")
    # the turn at which something is said first, where it is said at several
    said = rows.select("conv_id", "turn", key).groupBy("conv_id", "said_key").agg(F.min(F.struct("turn")).alias("first"), F.max(F.struct("turn")).alias("final")).where(~_same(F.col("first"), F.col("final")))
    again = materialize(said.select(F.col("conv_id").alias("again_id"), F.col("said_key").alias("again_key"), F.col("first.turn").alias("first_turn"), F.lit(True).alias("again")), "said-again")
    one = rows.groupBy("conv_id", "turn", "role", "text").agg(F.count(F.lit(1)).alias("copies")).withColumn("said_key", key)
    flagged = one.join(again, _same(F.col("conv_id"), F.col("again_id")) & (F.col("said_key") == F.col("again_key")), "left")
    flagged = flagged.withColumn("seen", F.coalesce(F.col("again") & ~_same(F.col("turn"), F.col("first_turn")), F.lit(False)))
    order = total_order(F.col("conv_id"), F.col("turn"), F.col("role"), F.substring("text", 1, 200), F.col("said_key"))
    ranged = flagged.repartitionByRange(*order).sortWithinPartitions(*order).select("conv_id", "turn", "role", "text", "copies", "seen")
    return materialize(ranged.mapInArrow(_parse(keep_turns), _schema(_BLOCK, conversations.schema["conv_id"])), "turn-blocks")


def _open_pieces(blocks: DataFrame) -> DataFrame:
    """Pieces of the conversations that lie in several blocks, or at the edge of one."""
    conv_id = blocks.schema["conv_id"]
    of = blocks.where("open")
    narrow = of.drop("audit", "sha", "repaired", "kinds", "copies", "said")
    order = total_order(F.col("conv_id"), F.col("part"), F.col("seq"))
    settled = narrow.repartition("conv_id").sortWithinPartitions(*order).mapInArrow(_settle, _schema(_SETTLED, conv_id)).drop("conv_id")
    needed = of.select("conv_id", "part", "seq", "kinds", "copies", "said").join(settled, (F.col("part") == F.col("at_part")) & (F.col("seq") == F.col("at_seq")))
    return needed.drop("at_part", "at_seq").mapInArrow(_replay, _schema(_PIECE, conv_id))


def repair_report(conversations: DataFrame) -> DataFrame:
    """One row per conversation: conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, sha.

    ``sha`` is the hex SHA-256 of the repaired ``role:text`` rows, joined by newlines.
    """
    blocks = _blocks(conversations, keep_turns=False)
    order = total_order(F.col("conv_id"), F.col("part"), F.col("seq"))
    pieces = _open_pieces(blocks).repartition("conv_id").sortWithinPartitions(*order)
    joined = pieces.mapInArrow(_join_pieces, _schema(_REPORT, blocks.schema["conv_id"]))
    return blocks.where(~F.col("open")).select("conv_id", *_COUNTS, "audit", "sha").unionByName(joined)


def repaired_turns(conversations: DataFrame) -> DataFrame:
    """The repaired conversations: conv_id, part, seq, place (ascending in this order), role, text."""
    blocks = _blocks(conversations, keep_turns=True)
    columns = ["conv_id", "part", "seq", "repaired"]
    pieces = blocks.where(~F.col("open")).select(columns).unionByName(_open_pieces(blocks).select(columns))
    return pieces.select("conv_id", "part", "seq", F.posexplode("repaired").alias("place", "turn")).select("conv_id", "part", "seq", "place", "turn.role", "turn.text")
