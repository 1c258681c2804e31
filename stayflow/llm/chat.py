"""Format conversations for training, and read them back.

A turn is ``open role \\n text close``. Assistant turns stand between ``<s>``
and ``</s>``, all others between ``[INST]`` and ``[/INST]``. A control string
inside a text gets a backslash after its first character, one that has
backslashes there already gets one more, so every text comes back as it was.

Turns are dealt by conversation and sorted inside their task. A batch of turns
is laid out column by column: segment lengths, their running sums, and the
places to scatter the bytes to, all into one preallocated buffer that becomes
the Arrow column. A conversation that is longer than a batch continues in a
further ``piece``, so memory is bounded by the batch.

Nulls: a null text or role is empty; null conversation ids are one
conversation; null turns come first. Rows of equal turn are ordered by role and
text. An empty table gives no rows. Other columns are left out.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stayflow.llm.common import importable, sliced, total_order

TRAINED_ROLE = "assistant"
MARKS = {True: ("<s>", "</s>"), False: ("[INST]", "[/INST]")}
_CONTROL = r"(/?s>|/?INST\])"
_ESCAPE = (r"([<\[])(\\*)" + _CONTROL, r"\1\\\2\3")
_UNESCAPE = re.compile(r"([<\[])\\(\\*)" + _CONTROL)
_TURN = re.compile(r"(<s>|\[INST\])([^\n]*)\n")
#: Turns laid out at a time.
BATCH_TURNS = 2_000


def unescape(text: str) -> str:
    return _UNESCAPE.sub(r"\1\2\3", text)


def _parts(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Offsets and bytes of a string array without nulls."""
    column = column.cast(pa.large_string())
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(data, np.uint8) if data else np.zeros(0, np.uint8)
    return offsets, data


def _scatter(out: np.ndarray, places: np.ndarray, offsets: np.ndarray, data: np.ndarray) -> None:
    """Copy string ``i`` of a column to ``places[i]``."""
    lengths = np.diff(offsets)
    source = data[offsets[0] : offsets[-1]]
    out[np.arange(len(source)) + np.repeat(places - (offsets[:-1] - offsets[0]), lengths)] = source


def assemble(roles: pa.Array, texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The formatted turns in one buffer: (bytes, row offsets, text starts, text ends), all in bytes."""
    trained = pc.equal(roles, TRAINED_ROLE)
    opening = pc.if_else(trained, *(MARKS[k][0] for k in (True, False)))
    closing = pc.if_else(trained, *(MARKS[k][1] for k in (True, False)))
    line = pc.replace_substring(pc.replace_substring(roles, "\\", "\\\\"), "\n", "\\n")
    head = pc.binary_join_element_wise(opening, line, pa.scalar("", pa.string()), "")
    head = pc.binary_join_element_wise(head, pa.scalar("", pa.string()), "\n")
    body = pc.replace_substring_regex(texts, *_ESCAPE)
    segments = [_parts(x) for x in (head, body, closing)]
    lengths = np.stack([np.diff(offsets) for offsets, _ in segments])
    rows = np.concatenate(([0], np.cumsum(lengths.sum(axis=0))))
    places = rows[:-1] + np.concatenate((np.zeros((1, lengths.shape[1]), np.int64), np.cumsum(lengths, axis=0)))[:-1]
    out = np.empty(rows[-1], np.uint8)
    for place, (offsets, data) in zip(places, segments):
        _scatter(out, place, offsets, data)
    return out, rows, places[1], places[2]


def _format(turns: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
        open_id, piece = object(), 0
        for batch in sliced(batches, turns):
            if not batch.num_rows:
                continue
            out, rows, starts, ends = assemble(batch.column("role"), batch.column("text"))
            ids = batch.column("conv_id").to_pylist()
            first = [i for i in range(len(ids)) if i == 0 or ids[i] != ids[i - 1]]
            bounds = np.array([*first, len(ids)])
            # code points before each byte
            points = np.concatenate(([0], np.cumsum((out & 0xC0) != 0x80)))
            trained = np.array(pc.equal(batch.column("role"), TRAINED_ROLE).to_pylist())
            pieces, spans = [], []
            for i, j in zip(bounds[:-1], bounds[1:]):
                piece = piece + 1 if i == 0 and ids[0] == open_id else 0
                pieces.append(piece)
                at = points[rows[i]]
                spans.append([{"start": int(points[starts[k]] - at), "end": int(points[ends[k]] - at)} for k in range(i, j) if trained[k]])
            open_id = ids[-1]
            text = pa.LargeStringArray.from_buffers(len(first), pa.py_buffer(rows[bounds].tobytes()), pa.py_buffer(out))
            yield pa.RecordBatch.from_arrays(
                [pa.array([ids[i] for i in first], batch.schema.field("conv_id").type), pa.array(pieces, pa.int64()), pa.array(np.diff(bounds), pa.int64()), text.cast(pa.string()), pa.array(spans, kind)],
                names=["conv_id", "piece", "n_turns", "formatted", "loss_spans"],
            )

    return run


def format_chat(conversations: DataFrame) -> DataFrame:
    """Formatted conversations: conv_id, piece, n_turns, formatted, loss_spans.

    ``loss_spans`` are the code points of ``formatted`` to train on. Pieces of a
    conversation follow each other in their partition.
    """
    importable(conversations.sparkSession)
    turns = conversations.select("conv_id", "turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    dealt = turns.repartition("conv_id").sortWithinPartitions(*total_order(*[F.col(c) for c in ("conv_id", "turn", "role", "text")]))
    span = T.ArrayType(T.StructType([T.StructField("start", T.LongType()), T.StructField("end", T.LongType())]))
    schema = T.StructType([conversations.schema["conv_id"], T.StructField("piece", T.LongType()), T.StructField("n_turns", T.LongType()), T.StructField("formatted", T.StringType()), T.StructField("loss_spans", span)])
    return dealt.drop("turn").mapInArrow(_format(BATCH_TURNS), schema)


def read_turns(formatted: str) -> list[tuple[str, str]]:
    """The (role, text) of a formatted conversation or piece."""
    turns, at = [], 0
    while at < len(formatted):
        mark = _TURN.match(formatted, at)
        close = MARKS[mark[1] == "<s>"][1]
        end = formatted.index(close, mark.end())
        role = re.sub(r"\\(n|\\)", lambda m: "\n" if m[1] == "n" else "\\", mark[2])
        turns.append((role, unescape(formatted[mark.end() : end])))
        at = end + len(close)
    return turns


def _read_back(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
    kinds = [None, pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
    held: list | None = None
    closed: list[list] = []

    def flush(kind: pa.DataType) -> pa.RecordBatch:
        columns = list(zip(*([c[0], c[1], c[2].hexdigest(), c[3], c[4].hexdigest(), c[5]] for c in closed)))
        closed.clear()
        return pa.RecordBatch.from_arrays([pa.array(c, k or kind) for c, k in zip(columns, kinds)], names=names)

    kind = pa.int64()
    for batch in batches:
        kind = batch.schema.field("conv_id").type
        for row in batch.to_pylist():
            if row["piece"] == 0 or held is None:
                if held:
                    closed.append(held)
                held = [row["conv_id"], 0, hashlib.sha256(), 0, hashlib.sha256(), 0]
            for role, text in read_turns(row["formatted"]):
                held[1] += 1
                held[2].update(f"{role}\n{text}\n".encode("utf-8", "surrogatepass"))
            for span in row["loss_spans"]:
                text = unescape(row["formatted"][span["start"] : span["end"]])
                held[3] += len(text)
                held[4].update(text.encode("utf-8", "surrogatepass"))
            held[5] += len(row["formatted"])
        if closed:
            yield flush(kind)
    if held:
        closed.append(held)
        yield flush(kind)


def read_back(formatted: DataFrame) -> DataFrame:
    """Digests of what the output of ``format_chat`` says, one row per conversation.

    conv_id, n_turns, turns_sha256 (role, line end, text, line end per turn),
    loss_chars and loss_sha256 (the texts under the loss spans), formatted_chars.
    """
    schema = T.StructType([
        formatted.schema["conv_id"],
        T.StructField("n_turns", T.LongType()), T.StructField("turns_sha256", T.StringType()),
        T.StructField("loss_chars", T.LongType()), T.StructField("loss_sha256", T.StringType()),
        T.StructField("formatted_chars", T.LongType()),
    ])
    return formatted.mapInArrow(_read_back, schema)
