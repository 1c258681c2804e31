"""Pack documents into sequences of bounded length, with a certificate of how good the packing is.

A document's token ids and its end token are cut only where they exceed a
sequence: into whole sequences, the rest in front. Pieces shorter than a
sequence are dealt at random into groups and each group is packed by best-fit
decreasing. Dual feasible functions of the piece lengths bound the number of
sequences of a group from below; a group that meets its bound is certified. A
group with a gap exchanges all its pieces, a certified one those of its
emptiest sequence, in further rounds of fewer groups, until the whole meets the
bound of all lengths or a round no longer saves a sequence. A round counts only
if it saves some.

Memory: ids of one document and the pieces of one group. Groups are drawn by a
row number, so copies and repeated rows spread like all others.

Nulls: a null text is empty, a document of the end token alone; a null id is
kept. Repeated rows are packed each; ties in length are in no particular order.
A very long text is encoded whole; a task holds its ids, four bytes each. Empty
tables give no rows. Other columns are not read.
"""

from __future__ import annotations

import json
import zlib
from collections.abc import Iterator
from functools import lru_cache
from itertools import pairwise

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stayflow.llm.common import importable, sliced
from stayflow.session import materialize

CAPACITY = 1024
#: Pieces of a group, about. Many to a group fit well; few bound a task.
GROUP_PIECES = 16_384
ID = np.dtype("<u4")
#: What splits a text before the merges of a byte-level vocabulary; a fixed value of such vocabularies.
WORDS = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


def byte_letters() -> dict[str, int]:
    """The letter that stands for each byte in a byte-level vocabulary: itself if it is printable, else the next one after 255."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in shown]
    return {chr(b): b for b in shown} | {chr(256 + k): b for k, b in enumerate(hidden)}


class Encoder:
    """Ids of texts as little-endian 32-bit numbers, by a tokenizer file of the ``tokenizers`` library.

    The merges of most byte-level vocabularies are numbered in the order they
    apply. Such a file is a table of ranks, and ``tiktoken`` finds the same ids
    from it several times faster; any other goes through its own library.
    Special strings inside a text are tokens, as the library takes them.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.model = Tokenizer.from_file(path)
        self.model.no_truncation()
        self.model.no_padding()
        self.ranked = self._ranked(json.loads(self.model.to_str()))

    @staticmethod
    def _ranked(file: dict):
        before, model = file["pre_tokenizer"] or {}, file["model"]
        byte_level = before.get("type") == "ByteLevel" and before.get("use_regex") and not before.get("add_prefix_space")
        odd = ("dropout", "unk_token", "continuing_subword_prefix", "end_of_word_suffix", "byte_fallback", "ignore_merges")
        added = file["added_tokens"]
        if not byte_level or model["type"] != "BPE" or file["normalizer"] or any(model.get(k) for k in odd) or any(t["lstrip"] or t["rstrip"] or t["single_word"] for t in added):
            return None
        letters, special = byte_letters(), {t["content"]: t["id"] for t in added}
        ranks = {bytes(letters[c] for c in token): n for token, n in model["vocab"].items() if token not in special}
        merged = [model["vocab"]["".join(m if isinstance(m, list) else m.split(" "))] for m in model["merges"]]
        if any(a >= b for a, b in pairwise(merged)) or len(merged) + 256 != len(ranks) or any(len(token) > 1 and n < 256 for token, n in ranks.items()):
            return None
        import tiktoken

        return tiktoken.Encoding("ranked", pat_str=WORDS, mergeable_ranks=ranks, special_tokens=special)

    def encode(self, texts: list[str]) -> Iterator[bytes]:
        if self.ranked:
            for text in texts:
                yield self.ranked.encode_to_numpy(text, allowed_special="all").astype(ID).tobytes()
        else:
            for e in self.model.encode_batch(texts, add_special_tokens=False):
                yield np.array(e.ids, ID).tobytes()


@lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    return Encoder(path)


def cut(n: int, capacity: int) -> list[tuple[int, int]]:
    """(start, length) of the pieces of ``n`` ids: whole sequences, the rest in front."""
    rest = n % capacity
    starts = [0] * (rest > 0) + list(range(rest, n, capacity))
    return [(a, b - a) for a, b in zip(starts, [*starts[1:], n])]


_PIECES = [("piece", T.IntegerType()), ("start", T.LongType()), ("length", T.LongType()), ("ids_crc32", T.LongType())]


def pieces(documents: DataFrame, tokenizer_path: str, end_id: int, capacity: int = CAPACITY, with_ids: bool = False) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32 of every piece, and the ids themselves (``ids``, binary) if wanted."""
    importable(documents.sparkSession)
    end = np.array([end_id], ID).tobytes()
    names = ["doc_id", *(n for n, _ in _PIECES), *(["ids"] if with_ids else [])]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(tokenizer_path).encode
        for batch in sliced(batches):
            owner, rows = [], []
            for k, ids in enumerate(encode(batch.column("text").to_pylist())):
                ids += end
                for n, (start, length) in enumerate(cut(len(ids) // 4, capacity)):
                    part = ids[4 * start : 4 * (start + length)]
                    owner.append(k)
                    rows.append((n, start, length, zlib.crc32(part), *([part] if with_ids else [])))
            kinds = [pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.binary()]
            columns = [pa.array(c, k) for c, k in zip(zip(*rows), kinds)] if rows else [pa.array([], k) for k in kinds[: len(names) - 1]]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id").take(pa.array(owner, pa.int64())), *columns], names=names)

    schema = T.StructType([documents.schema["doc_id"], *(T.StructField(n, t) for n, t in _PIECES)])
    if with_ids:
        schema = schema.add("ids", T.BinaryType())
    return documents.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).mapInArrow(run, schema)


def best_fit_decreasing(lengths: np.ndarray, capacity: int = CAPACITY) -> tuple[np.ndarray, np.ndarray]:
    """(sequence, offset) of every piece: the longest first, each into the fullest sequence that takes it."""
    order = np.argsort(-lengths, kind="stable")
    sequence, offset = np.empty(len(lengths), np.int64), np.empty(len(lengths), np.int64)
    by_room: list[list[int]] = [[] for _ in range(capacity + 1)]
    rooms, used = 0, 0  # a bit per room that some sequence has left
    for k, size in zip(order.tolist(), lengths[order].tolist()):
        fitting = rooms >> size
        if fitting:
            room = size + (fitting & -fitting).bit_length() - 1
            at = by_room[room].pop()
            if not by_room[room]:
                rooms ^= 1 << room
        else:
            room, at, used = capacity, used, used + 1
        sequence[k], offset[k] = at, capacity - room
        by_room[room - size].append(at)
        rooms |= 1 << (room - size)
    return sequence, offset


def dual_feasible_bound(counts: np.ndarray, capacity: int = CAPACITY) -> int:
    """Least number of sequences for ``counts[n]`` pieces of length n, whatever the packing.

    The largest of the bounds by: the sum of the lengths; long pieces taken as
    whole and short ones as nothing, for every limit; lengths rounded down to
    parts of a sequence, those that are whole parts kept.
    """
    n = np.arange(capacity + 1)
    total = int((counts * n).sum())
    best = -(-total // capacity)
    limits = np.arange(1, capacity // 2 + 1)[:, None]
    whole = np.where(n > capacity - limits, capacity, np.where(n >= limits, n, 0))
    best = max(best, int((-(-(whole @ counts) // capacity)).max()))
    for parts in range(1, min(capacity, 100) + 1):
        scaled = n * (parts + 1)
        # in units of 1 / (parts * capacity)
        worth = np.where(scaled % capacity == 0, n * parts, scaled // capacity * capacity)
        best = max(best, -(-int((worth * counts).sum()) // (parts * capacity)))
    return best


_PACKED = [("group", T.LongType()), ("bin", T.LongType()), ("offset", T.LongType()), ("bins", T.LongType()), ("bound", T.LongType()), ("loose", T.BooleanType())]


def _pack_groups(capacity: int, names: list[str]):
    """Pack the groups of a partition sorted by them."""

    def packed(table: pa.Table) -> pa.RecordBatch:
        lengths = table.column("length").to_numpy()
        sequence, offset = best_fit_decreasing(lengths, capacity)
        bound = dual_feasible_bound(np.bincount(lengths, minlength=capacity + 1), capacity)
        bins = int(sequence.max()) + 1
        filled = np.bincount(sequence, lengths, bins)
        # what goes on to the next round: everything behind a gap, else the emptiest sequence if it has room
        loose = np.ones(len(lengths), bool) if bins > bound else (sequence == filled.argmin()) & (filled.min() < capacity)
        added = [sequence, offset, np.full(len(lengths), bins), np.full(len(lengths), bound), loose]
        out = table.combine_chunks().to_batches()[0]
        return pa.RecordBatch.from_arrays([*out.columns, *(pa.array(a) for a in added)], names=[*names, *(n for n, _ in _PACKED[1:])])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for batch in batches:
            groups = batch.column("group").to_numpy()
            edges = [0, *(np.flatnonzero(groups[1:] != groups[:-1]) + 1).tolist(), len(groups)]
            for a, b in zip(edges, edges[1:]):
                if b == a:
                    continue
                if held and held[0].column("group")[0].as_py() != groups[a]:
                    yield packed(pa.Table.from_batches(held))
                    held = []
                held.append(batch.slice(a, b - a))
        if held:
            yield packed(pa.Table.from_batches(held))

    return run


def _round(short: DataFrame, count: int, number: int, capacity: int, group_pieces: int) -> DataFrame:
    """Pack ``count`` pieces in groups drawn anew for the round; written."""
    groups = max(1, -(-count // group_pieces))
    group = F.pmod(F.xxhash64(F.lit(number), "row"), F.lit(groups)).alias("group")
    dealt = short.select("*", group).repartition("group").sortWithinPartitions("group", "row")
    schema = T.StructType([*dealt.schema.fields, *(T.StructField(n, t) for n, t in _PACKED[1:])])
    return materialize(dealt.mapInArrow(_pack_groups(capacity, dealt.columns), schema), f"packing-{number}")


def pack(cut_pieces: DataFrame, capacity: int = CAPACITY, rounds: int = 6, group_pieces: int = GROUP_PIECES) -> tuple[DataFrame, dict[str, int]]:
    """The pieces with ``sequence_id`` and ``offset``, and (sequences, bound, rounds) of the short ones.

    The driver holds the counts of piece lengths, at most ``capacity`` numbers,
    and sums over groups.
    """
    spark = cut_pieces.sparkSession
    importable(spark)
    own = cut_pieces.columns
    written = materialize(cut_pieces.select("*", F.monotonically_increasing_id().alias("row")), "pieces")
    whole = written.where(F.col("length") == capacity).select(*own, (-F.col("row") - 1).alias("sequence_id"), F.lit(0).cast("bigint").alias("offset"))
    short = written.where(F.col("length") < capacity)
    counts = np.zeros(capacity + 1, np.int64)
    for r in short.groupBy("length").count().collect():
        counts[r["length"]] = r["count"]
    bound, settled, packed, number = dual_feasible_bound(counts, capacity), [], None, 0
    total = loose_bins = 0
    left, n = short, int(counts.sum())
    while n and number < rounds:
        new = _round(left, n, number, capacity, group_pieces)
        group = new.groupBy("group").agg(F.max("bins").alias("bins"), F.sum(F.col("loose").cast("bigint")).alias("loose"), F.count(F.lit(1)).alias("n"))
        # a group's loose pieces are all of it, or those of one sequence
        sums = group.agg(F.sum("bins").alias("bins"), F.sum("loose").alias("loose"), F.sum(F.when(F.col("loose") == F.col("n"), F.col("bins")).when(F.col("loose") > 0, 1).otherwise(0)).alias("loose_bins")).first()
        if packed is not None:
            if sums["bins"] >= loose_bins:
                break
            settled.append(_with_place(packed.where(~F.col("loose")), own, number - 1))
            total -= loose_bins
        packed, number = new, number + 1
        total += sums["bins"]
        left, n, loose_bins = new.where("loose").select(*own, "row"), sums["loose"] or 0, sums["loose_bins"]
        if total == bound:
            break
    if packed is not None:
        settled.append(_with_place(packed, own, number - 1))
    out = whole
    for part in settled:
        out = out.unionByName(part)
    return out, {"sequences": total, "bound": bound, "rounds": number}


def _with_place(packed: DataFrame, own: list[str], number: int) -> DataFrame:
    place = F.shiftleft(F.lit(number).cast("bigint"), 58) + F.shiftleft("group", 20) + F.col("bin")
    return packed.select(*own, place.alias("sequence_id"), "offset")


def pack_documents(documents: DataFrame, tokenizer_path: str, end_id: int, capacity: int = CAPACITY) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset."""
    return pack(pieces(documents, tokenizer_path, end_id, capacity), capacity)[0]


def sequences(packed: DataFrame) -> DataFrame:
    """The packed sequences themselves: sequence_id, length, ids. ``packed`` has the pieces' ``ids``.

    A sequence has at most as many pieces as tokens, so a group is bounded.
    """
    of = packed.groupBy("sequence_id").agg(F.sort_array(F.collect_list(F.struct("offset", "ids"))).alias("parts"), F.sum("length").alias("length"))
    joined = F.aggregate("parts", F.lit(b""), lambda whole, part: F.concat(whole, part["ids"]))
    return of.select("sequence_id", "length", joined.alias("ids"))
