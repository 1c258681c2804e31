"""Remove benchmark passages from training text.

The words of the test items go into a generalised suffix automaton. A document
is streamed through it word by word; the automaton's state is the longest
suffix of what was read that occurs in an item, and its length tells whether a
window of an item ends here. The items of a window are those of the state that
holds it.

Items are cut into blocks of about ``block_words`` words, one automaton per
block, and broadcast one at a time: some 600 bytes a word in the driver and in
every worker, whatever the number of items. With one block a document is read
once and nothing is shuffled; with several the hits of each block are written
before the next, and united at the end. A very long text is one row of a batch.

Nulls: a null text has no words; a null item id is listed as an empty text.
Items without words have no window. Repeated items count once per id. Empty
tables give no rows, or no hits. Extra columns of the documents are kept.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from functools import reduce
from itertools import repeat
from string import ascii_lowercase, ascii_uppercase

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stayflow.llm.common import fresh, importable, sliced
from stayflow.session import materialize

#: Bytes that end a word, and upper case letters, as the words' lower case.
_FOLD = bytes(b if 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80 else b + 32 if 0x41 <= b <= 0x5A else 0x20 for b in range(256))
ITEM_WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def words_of(text: str | None) -> list[bytes]:
    """Lower-cased words of letters, digits and characters beyond ASCII, as UTF-8."""
    return (text or "").encode("utf-8", "surrogatepass").translate(_FOLD).split()


class SuffixAutomaton:
    """Generalised suffix automaton over the words of several items.

    ``items`` are (position in ``ids``, words). ``window`` is the length of a
    window; an item of fewer words is one window of its own length.
    """

    def __init__(self, items: Iterable[tuple[str, list[bytes]]], window: int):
        self.window = window
        self.vocabulary: dict[bytes, int] = {}
        self.next: list[dict[int, int]] = [{}]
        self.link, self.length = [-1], [0]
        #: items with a whole window in the state, and shorter items that are the state's suffix of their length
        self.items: dict[int, set[str]] = {}
        self.short: dict[int, dict[int, set[str]]] = {}
        entries = [(i, [self.vocabulary.setdefault(w, len(self.vocabulary)) for w in words]) for i, words in items if words]
        for _, word_ids in entries:
            last = 0
            for w in word_ids:
                last = self._extend(last, w)
        for item, word_ids in entries:
            self._enter(item, word_ids)
        self.least = min((min(len(word_ids), window) for _, word_ids in entries), default=0)
        self._pairs(entries)

    def _add(self, length: int, moves: dict[int, int], link: int) -> int:
        self.next.append(moves)
        self.length.append(length)
        self.link.append(link)
        return len(self.length) - 1

    def _extend(self, last: int, w: int) -> int:
        known = self.next[last].get(w)
        if known is not None:
            return known if self.length[known] == self.length[last] + 1 else self._split(last, w, known)
        new, at = self._add(self.length[last] + 1, {}, 0), last
        while at >= 0 and w not in self.next[at]:
            self.next[at][w] = new
            at = self.link[at]
        if at >= 0:
            to = self.next[at][w]
            self.link[new] = to if self.length[to] == self.length[at] + 1 else self._split(at, w, to)
        return new

    def _split(self, at: int, w: int, to: int) -> int:
        part = self._add(self.length[at] + 1, dict(self.next[to]), self.link[to])
        self.link[to] = part
        while at >= 0 and self.next[at].get(w) == to:
            self.next[at][w] = part
            at = self.link[at]
        return part

    def step(self, state: int, length: int, w: int) -> tuple[int, int]:
        """The state and matched length after one more word."""
        while state and w not in self.next[state]:
            state = self.link[state]
            length = self.length[state]
        to = self.next[state].get(w)
        return (0, 0) if to is None else (to, length + 1)

    def holder(self, state: int, n: int) -> int:
        """The state on the suffix chain that holds the suffix of ``n`` words."""
        while self.length[self.link[state]] >= n:
            state = self.link[state]
        return state

    def _enter(self, item: str, word_ids: list[int]) -> None:
        n, state, length = min(len(word_ids), self.window), 0, 0
        for w in word_ids:
            state, length = self.step(state, length, w)
            if length >= n:
                held = self.holder(state, n)
                if n == self.window:
                    self.items.setdefault(held, set()).add(item)
                else:
                    self.short.setdefault(held, {}).setdefault(n, set()).add(item)

    def _pairs(self, entries: list[tuple[str, list[int]]]) -> None:
        """Neighbouring words of the items as sorted numbers: a match crosses no other pair."""
        size = len(self.vocabulary)
        found = {a * size + b for _, word_ids in entries for a, b in zip(word_ids, word_ids[1:])}
        self.pairs = np.array(sorted(found) or [-1], dtype=np.int64)

    def runs(self, word_ids: np.ndarray) -> list[tuple[int, int]]:
        """Stretches of known words and known pairs that can hold a window."""
        if not self.least or len(word_ids) < self.least:
            return []
        known = word_ids >= 0
        joined = known[1:] & known[:-1]
        at = np.flatnonzero(joined)
        code = word_ids[at] * len(self.vocabulary) + word_ids[at + 1]
        place = np.minimum(np.searchsorted(self.pairs, code), len(self.pairs) - 1)
        joined[at[self.pairs[place] != code]] = False
        starts = np.flatnonzero(known & ~np.concatenate(([False], joined)))
        ends = np.flatnonzero(known & ~np.concatenate((joined, [False]))) + 1
        long = ends - starts >= self.least
        return list(zip(starts[long].tolist(), ends[long].tolist()))

    def scan(self, words: list[bytes]) -> tuple[np.ndarray, set[str]]:
        """Which words lie in a window of an item, and the items whose windows occur."""
        hit, found = np.zeros(len(words) + 1, dtype=np.int32), set()
        word_ids = np.fromiter(map(self.vocabulary.get, words, repeat(-1)), dtype=np.int64, count=len(words))
        window, seen = self.window, set()
        for start, end in self.runs(word_ids):
            state = length = 0
            for t, w in enumerate(word_ids[start:end].tolist(), start + 1):
                state, length = self.step(state, length, w)
                if length >= window:
                    held = self.holder(state, window)
                    if held in self.items:
                        hit[t - window] += 1
                        hit[t] -= 1
                        if held not in seen:
                            seen.add(held)
                            found |= self.items[held]
                if self.short:
                    chain = state
                    while chain > 0:
                        for n, items in self.short.get(chain, {}).items():
                            if n <= length:
                                hit[t - n] += 1
                                hit[t] -= 1
                                found |= items
                        chain = self.link[chain]
        return np.cumsum(hit[:-1]) > 0, found


def _items(benchmark: DataFrame) -> DataFrame:
    return benchmark.select(F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item"), F.col("text")).where("text is not null")


def _block_count(benchmark: DataFrame, block_words: int) -> int:
    total = _items(benchmark).agg(F.coalesce(F.sum(F.regexp_count("text", F.lit(ITEM_WORD))), F.lit(0))).first()[0]
    return max(1, -(-int(total) // block_words))


def _blocks(benchmark: DataFrame, window: int, count: int, block_words: int) -> Iterator[SuffixAutomaton]:
    """One automaton per block of items. The driver holds one block at a time."""
    items = _items(benchmark)
    for block in range(count):
        part = items.where(F.pmod(F.xxhash64("item", "text"), F.lit(count)) == block) if count > 1 else items
        yield SuffixAutomaton(((r.item, words_of(r.text)) for r in part.toLocalIterator()), window)


def _spans(hit: np.ndarray) -> list[dict[str, int]]:
    edge = np.flatnonzero(np.diff(np.concatenate(([0], hit.view(np.int8), [0]))))
    return [{"start": int(a), "end": int(b)} for a, b in zip(edge[::2], edge[1::2])]


SPANS = T.ArrayType(T.StructType([T.StructField("start", T.LongType()), T.StructField("end", T.LongType())]))


_SPAN = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
_MATCH = pa.struct([("n_words", pa.int64()), ("n_hit", pa.int64()), ("item_ids", pa.list_(pa.string())), ("spans", _SPAN)])
MATCH = T.StructType([T.StructField("n_words", T.LongType()), T.StructField("n_hit", T.LongType()), T.StructField("item_ids", T.ArrayType(T.StringType())), T.StructField("spans", SPANS)])


def find_contamination(documents: DataFrame, benchmark: DataFrame, window: int = 13, block_words: int = 500_000, column: str = "match") -> DataFrame:
    """The documents with a struct ``match``: n_words, n_hit, item_ids and the hit word ``spans``.

    The struct replaces a column of its name. Spans are maximal runs of hit
    words, counted from 0, end excluded.
    """
    spark = documents.sparkSession
    importable(spark)
    rows = documents.drop(column)
    if _block_count(benchmark, block_words) > 1:
        return _by_blocks(rows, benchmark, window, block_words, column)
    fields = rows.schema.fields
    match = T.StructField(column, MATCH)
    automaton = next(_blocks(benchmark, window, 1, block_words))
    return rows.mapInArrow(_pass(spark.sparkContext.broadcast(automaton), len(fields), [*rows.columns, column]), T.StructType([*fields, match]))


def _pass(shared, width: int, names: list[str]):
    """Add what an automaton finds behind the ``width`` first columns."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = shared.value
        for batch in sliced(batches):
            out = []
            for text in batch.column("text"):
                words = words_of(text.as_py())
                hit, items = automaton.scan(words)
                out.append({"n_words": len(words), "n_hit": int(hit.sum()), "item_ids": sorted(items), "spans": _spans(hit)})
            yield pa.RecordBatch.from_arrays([*batch.columns[:width], pa.array(out, _MATCH)], names=names)

    return run


def _by_blocks(rows: DataFrame, benchmark: DataFrame, window: int, block_words: int, column: str) -> DataFrame:
    """The same with several blocks, one after the other.

    The documents are written with a row number; of a block only the rows it
    hits are written, and its automaton is freed before the next is built. The
    spans of a row's blocks are united at the end.
    """
    spark, width = rows.sparkSession, len(rows.columns)
    row, count = fresh(rows.columns, "row"), _block_count(benchmark, block_words)
    rows = materialize(rows.withColumn(row, F.monotonically_increasing_id()), "documents")
    texts, hits = rows.select(F.col(row).alias("row"), "text"), []
    found = T.StructType([T.StructField("row", T.LongType()), T.StructField("text", rows.schema["text"].dataType), T.StructField("match", MATCH)])
    for automaton in _blocks(benchmark, window, count, block_words):
        shared = spark.sparkContext.broadcast(automaton)
        marked = texts.mapInArrow(_pass(shared, 2, found.names), found)
        hits.append(materialize(marked.where("match.n_hit > 0").select("row", "match.item_ids", "match.spans"), "hits"))
        shared.destroy()
    every = reduce(DataFrame.unionByName, hits)
    united = every.groupBy("row").agg(
        F.sort_array(F.array_distinct(F.flatten(F.collect_list("item_ids")))).alias("item_ids"), F.sort_array(F.flatten(F.collect_list("spans"))).alias("all_spans")
    )
    # spans in order: one that begins within or right behind the last is part of it
    ended = lambda done: F.element_at(done, -1)["end"]
    longer = lambda done, s: F.concat(F.slice(done, F.lit(1), F.size(done) - 1), F.array(F.struct(F.element_at(done, -1)["start"].alias("start"), F.greatest(ended(done), s["end"]).alias("end"))))
    joined = F.aggregate("all_spans", F.array().cast(SPANS), lambda done, s: F.when((F.size(done) > 0) & (s["start"] <= F.coalesce(F.try_element_at(done, F.lit(-1))["end"], F.lit(-1))), longer(done, s)).otherwise(F.concat(done, F.array(s))))
    united = united.select(F.col("row").alias("at_row"), "item_ids", joined.alias("spans"))
    n_hit = F.aggregate(F.coalesce("spans", F.array().cast(SPANS)), F.lit(0).cast("bigint"), lambda n, s: n + s["end"] - s["start"])
    match = F.struct(
        F.coalesce(F.regexp_count(F.translate("text", ascii_uppercase, ascii_lowercase), F.lit(ITEM_WORD)), F.lit(0)).cast("bigint").alias("n_words"),
        n_hit.alias("n_hit"),
        F.coalesce("item_ids", F.array().cast("array<string>")).alias("item_ids"),
        F.coalesce("spans", F.array().cast(SPANS)).alias("spans"),
    )
    met = rows.join(united, F.col(row) == F.col("at_row"), "left")
    return met.select(*[F.col(f"`{c}`") for c in rows.columns[:width]], match.alias(column))


def is_contaminated(match: Column, coverage_pct: int = 5) -> Column:
    """Some words hit, and at least ``coverage_pct`` percent of them."""
    return (match["n_hit"] > 0) & (F.lit(100) * match["n_hit"] >= F.lit(coverage_pct) * match["n_words"])


def contamination_report(documents: DataFrame, benchmark: DataFrame, window: int = 13, coverage_pct: int = 5) -> DataFrame:
    """One row per document: doc_id, n_words, n_hit, n_items, items_sha256, contaminated, spans."""
    found = find_contamination(documents.select("doc_id", "text"), benchmark, window)
    items = F.array_join(F.sort_array("match.item_ids"), ",")
    return found.select(
        "doc_id", "match.n_words", "match.n_hit",
        F.size("match.item_ids").cast("bigint").alias("n_items"),
        F.sha2(items.cast("binary"), 256).alias("items_sha256"),
        is_contaminated(F.col("match"), coverage_pct).alias("contaminated"),
        F.col("match.spans").alias("spans"),
    )


def decontaminate(documents: DataFrame, benchmark: DataFrame, window: int = 13, coverage_pct: int = 5) -> DataFrame:
    """The documents under the coverage limit, as they are, without the contaminated ones."""
    column = fresh(documents.columns, "match")
    found = find_contamination(documents, benchmark, window, column=column)
    return found.where(~is_contaminated(F.col(column), coverage_pct)).drop(column)


def text_without(text: str | None, spans: list[tuple[int, int]]) -> str | None:
    """The text without the words of the spans; what stands between words of a span goes with them."""
    if text is None or not spans:
        return text
    raw = text.encode("utf-8", "surrogatepass")
    folded = np.frombuffer(b" " + raw.translate(_FOLD) + b" ", np.uint8) != 0x20
    edge = np.flatnonzero(folded[1:] != folded[:-1])
    starts, ends = edge[::2], edge[1::2]
    out, at = [], 0
    for a, b in spans:
        out.append(raw[at : starts[a]])
        at = int(ends[b - 1])
    return b"".join([*out, raw[at:]]).decode("utf-8", "surrogatepass")


def remove_spans(documents: DataFrame, benchmark: DataFrame, window: int = 13, least_words: int = 13) -> DataFrame:
    """The documents with every hit span of ``least_words`` words or more taken out of ``text``."""
    column = fresh(documents.columns, "match")
    found = find_contamination(documents, benchmark, window, column=column)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches):
            out = []
            for text, match in zip(batch.column("text").to_pylist(), batch.column(column).to_pylist()):
                out.append(text_without(text, [(s["start"], s["end"]) for s in match["spans"] if s["end"] - s["start"] >= least_words]))
            at = batch.schema.get_field_index("text")
            columns = [*batch.columns]
            columns[at] = pa.array(out, pa.string())
            yield pa.RecordBatch.from_arrays(columns[:-1], names=batch.schema.names[:-1])

    return found.mapInArrow(run, found.drop(column).schema)
