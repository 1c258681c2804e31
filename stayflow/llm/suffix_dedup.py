"""Remove repeated passages by suffix sorting, one bucket of suffixes at a time.

Every string of ``length`` bytes falls into the bucket of the smallest hash
among its short grams, which is the same wherever the string stands. Neighbours
in a text mostly share a bucket, so a bucket is written as runs: stretches of
text that hold a number of consecutive strings. Only buckets with more than one
run are looked at, runs of equal content are one, and their text is fetched
once. The strings of a bucket are then sorted as suffixes in blocks of bounded
size, long ties being settled by the ranks of a difference cover
(``cover_sort``), and equal neighbours are repeats.

A bucket of very many different runs, such as those around a passage that a
third of all texts share, is not put into one task: its strings are counted by
a hash of 128 bits each, with a map-side step.

Texts are taken as UTF-8 bytes; equal texts are read once and count as often as
they occur. Nulls: a null text is empty, a null id takes part. Texts shorter
than ``length`` bytes lose nothing. Repeated rows are copies of each other.
Empty tables give no rows. Other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stayflow.llm.common import importable, sliced
from stayflow.llm.cover_sort import repeated
from stayflow.session import materialize

GRAM = 32
#: Text sorted at a time, in bytes: what a core keeps close by. The result is the same for any value.
BLOCK_BYTES = 128 << 10
#: Text hashed at a time, in bytes; also without any effect on the result.
HASHED_BYTES = 48 << 10
#: Different runs up to which a bucket is sorted in one task.
BUCKET_RUNS = 4_000
_MIX = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F)]
_BASE = np.uint64(0x5851F42D4C957F2D)
_BASE_2 = np.uint64(0xDA942042E4DD58B5)


def _words(data: np.ndarray) -> np.ndarray:
    """The eight bytes from every place on."""
    return np.lib.stride_tricks.as_strided(data, (len(data) - 7, 8), (1, 1)).copy().view(np.uint64).ravel()


def _stir(x: np.ndarray) -> np.ndarray:
    x ^= x >> np.uint64(31)
    x *= _MIX[1]
    x ^= x >> np.uint64(29)
    return x


def gram_hashes(data: np.ndarray) -> np.ndarray:
    """A hash of the ``GRAM`` bytes from every place on; the last places read into what follows."""
    words = _words(data)
    n = len(words) - GRAM + 8
    out = np.zeros(n, np.uint64)
    for k in range(GRAM // 8):
        out += words[8 * k : 8 * k + n] * _MIX[k]
        _stir(out)
    return out


def _sliding_least(values: np.ndarray, width: int) -> np.ndarray:
    """The least of ``width`` values from every place on."""
    reach = 1
    while reach * 2 <= width:
        values = np.minimum(values[:-reach], values[reach:])
        reach *= 2
    rest = width - reach
    return np.minimum(values[:-rest], values[rest:]) if rest else values


def _powers(base: np.uint64, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[0] = 1
    return np.cumprod(out, dtype=np.uint64)


def _sums(values: np.ndarray, base: np.uint64) -> tuple[np.ndarray, np.ndarray]:
    """Running sums of values times powers, and the inverse powers, modulo 2**64."""
    inverse = np.uint64(pow(int(base), -1, 1 << 64))
    return np.concatenate((np.zeros(1, np.uint64), np.cumsum(values * _powers(base, len(values)), dtype=np.uint64))), _powers(inverse, len(values) + 1)


def runs_of(texts: list[bytes], length: int) -> tuple[np.ndarray, ...]:
    """(text, start, strings, bucket, content, inner) of every run of the texts.

    ``strings`` consecutive strings of ``length`` bytes begin at ``start`` and
    share the bucket; ``content`` is a hash of all bytes they cover. ``inner``
    tells whether the bucket's gram is there twice: only then can a run repeat
    itself.
    """
    sizes = np.array([len(t) for t in texts], np.int64)
    data = np.frombuffer(b"".join(texts) + bytes(length + GRAM + 8), np.uint8)
    begins = np.cumsum(sizes) - sizes
    grams = gram_hashes(data)
    least = _sliding_least(grams, length - GRAM + 1)
    counts = np.maximum(sizes - length + 1, 0)
    owner = np.repeat(np.arange(len(texts)), counts)
    places = np.arange(len(owner)) - np.repeat(np.cumsum(counts) - counts, counts) + begins[owner]
    if not len(places):
        none = np.zeros(0, np.int64)
        return none, none, none, none, none, none.astype(bool)
    bucket = least[places]
    first = np.ones(len(places), bool)
    first[1:] = (bucket[1:] != bucket[:-1]) | (owner[1:] != owner[:-1])
    at = np.flatnonzero(first)
    strings = np.diff(np.append(at, len(places)))
    start = places[at]
    # grams that lie in the run, so nothing after it counts
    sums, inverse = _sums(grams, _BASE)
    end = start + strings + length - GRAM
    content = (sums[end] - sums[start]) * inverse[start] + strings.astype(np.uint64) * _MIX[4]
    _stir(content)
    spans = strings + length - GRAM
    ahead = np.cumsum(spans) - spans
    same = grams[np.arange(spans.sum()) + np.repeat(start - ahead, spans)] == np.repeat(bucket[at], spans)
    inner = np.add.reduceat(same, ahead, dtype=np.int64) > 1
    return owner[at], start - begins[owner[at]], strings, bucket[at].view(np.int64), content.view(np.int64), inner


def _key(text: Column) -> list[Column]:
    """128 bits that stand for a text."""
    return [F.xxhash64(text).alias("k1"), F.xxhash64(F.lit("text"), text).alias("k2")]


def _slices(texts: list[bytes], least: int) -> Iterator[tuple[int, int]]:
    """Places to cut the texts at, so that each slice but the last has ``least`` bytes."""
    begin = size = 0
    for i, text in enumerate(texts):
        size += len(text)
        if size >= least:
            yield begin, i + 1
            begin, size = i + 1, 0
    if begin < len(texts):
        yield begin, len(texts)


def _emit_runs(length: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches):
            texts = [t.as_py() for t in batch.column("text")]
            found = [(a, runs_of(texts[a:b], length)) for a, b in _slices(texts, HASHED_BYTES)]
            owner = np.concatenate([a + r[0] for a, r in found] or [np.zeros(0, np.int64)])
            start, strings, bucket, content, inner = (np.concatenate([r[k] for _, r in found] or [np.zeros(0, np.int64)]) for k in range(1, 6))
            keys = [batch.column(k).to_numpy(zero_copy_only=False)[owner] for k in ("k1", "k2")] if len(owner) else [np.zeros(0, np.int64)] * 2
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip([*keys, start, strings, bucket, content, inner], [pa.int64()] * 2 + [pa.int32()] * 2 + [pa.int64()] * 2 + [pa.bool_()])], names=["k1", "k2", "start", "strings", "bucket", "content", "inner"])

    return run


def _cut_runs(length: int, hot: bool):
    """Of a text and its listed runs: one row per run with its bytes, or per string with its hash."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches):
            rows = []
            for text, listed in zip(batch.column("text"), batch.column("runs").to_pylist()):
                raw = text.as_py()
                for r in listed:
                    part = raw[r["start"] : r["start"] + r["strings"] + length - 1]
                    if not hot:
                        rows.append((r["bucket"], r["content"], r["strings"], r["times"], part))
                        continue
                    grams = gram_hashes(np.frombuffer(part + bytes(GRAM + 8), np.uint8))
                    n = np.arange(r["strings"])
                    hashes = []
                    for base in (_BASE, _BASE_2):
                        sums, inverse = _sums(grams, base)
                        hashes.append(_stir((sums[n + length - GRAM + 1] - sums[n]) * inverse[n]).view(np.int64).tolist())
                    rows.extend((r["bucket"], r["content"], i, r["times"], a, b) for i, (a, b) in enumerate(zip(*hashes)))
            kinds = _HOT if hot else _RUN
            columns = list(zip(*rows)) or [[]] * len(kinds)
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, kinds)], schema=kinds)

    return run


_RUN = pa.schema([("bucket", pa.int64()), ("content", pa.int64()), ("strings", pa.int32()), ("times", pa.int64()), ("part", pa.binary())])
_HOT = pa.schema([("bucket", pa.int64()), ("content", pa.int64()), ("at", pa.int32()), ("times", pa.int64()), ("h1", pa.int64()), ("h2", pa.int64())])
_SPAN = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))
_SPANS = "array<struct<start:int,end:int>>"


def _flags_to_spans(flags: np.ndarray) -> list[dict[str, int]]:
    edge = np.flatnonzero(np.diff(np.concatenate(([0], flags.view(np.int8), [0]))))
    return [{"start": int(a), "end": int(b)} for a, b in zip(edge[::2], edge[1::2])]


def _sort_buckets(length: int):
    """Runs in bucket order: the strings of each run that another run, or the run itself, has again."""

    def solve(held: list[tuple]) -> pa.RecordBatch:
        bucket, content, strings, parts = zip(*held)
        sizes = np.array([len(p) for p in parts])
        data = np.frombuffer(b"".join(parts) + bytes(length + 64), np.uint8)
        counts = np.array(strings)
        places = np.repeat(np.cumsum(sizes) - sizes, counts) + np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
        of = np.unique(np.array(bucket), return_inverse=True)[1]
        flags = np.split(repeated(data, places, np.repeat(of, counts), length), np.cumsum(counts)[:-1])
        spans = [_flags_to_spans(f) for f in flags]
        return pa.RecordBatch.from_arrays([pa.array(bucket, pa.int64()), pa.array(content, pa.int64()), pa.array(spans, _SPAN)], names=["bucket", "content", "found"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        size = 0
        for batch in sliced(batches):
            for row in zip(*(batch.column(c).to_pylist() for c in ("bucket", "content", "strings", "part"))):
                if size >= BLOCK_BYTES and row[0] != held[-1][0]:
                    yield solve(held)
                    held, size = [], 0
                held.append(row)
                size += len(row[3])
        if held:
            yield solve(held)

    return run


def repeated_runs(documents: DataFrame, length: int) -> tuple[DataFrame, DataFrame]:
    """(texts, marks): distinct texts by key, and per text the repeated strings of its runs."""
    importable(documents.sparkSession)
    rows = documents.select(F.coalesce("text", F.lit("")).cast("binary").alias("text"))
    keyed = rows.select(*_key(F.col("text")), "text")
    runs = materialize(keyed.where(F.octet_length("text") >= length).mapInArrow(_emit_runs(length), "k1 long, k2 long, start int, strings int, bucket long, content long, inner boolean"), "runs")
    shared = runs.groupBy("bucket").agg(F.count("*").alias("rows"), F.max("inner").alias("inner")).where("rows > 1 or inner").select("bucket")
    met = runs.join(shared, "bucket").groupBy("bucket", "content", "inner", "k1", "k2", "start", "strings").agg(F.count("*").alias("times"))
    met = materialize(met, "shared_runs")

    contents = met.groupBy("bucket", "content", "inner").agg(F.sum("times").alias("times"), F.min(F.struct("k1", "k2", "start", "strings")).alias("at"))
    contents = materialize(contents, "contents")
    wide = contents.groupBy("bucket").agg(F.count("*").alias("contents"), F.max("inner").alias("any_inner")).where("contents > 1 or any_inner")
    open_ = contents.join(wide, "bucket")
    # a run that occurs again is repeated as a whole, and so is all of it that others have
    whole = contents.where("times > 1").select("bucket", "content", F.array(F.struct(F.lit(0).alias("start"), F.col("at.strings").alias("end"))).alias("found"))

    texts = keyed.groupBy("k1", "k2").agg(F.first("text").alias("text"))

    def fetched(wanted: DataFrame, hot: bool, schema: str) -> DataFrame:
        run = F.struct("bucket", "content", F.col("at.start").alias("start"), F.col("at.strings").alias("strings"), "times")
        listed = wanted.groupBy(F.col("at.k1").alias("k1"), F.col("at.k2").alias("k2")).agg(F.collect_list(run).alias("runs"))
        return texts.join(listed, ["k1", "k2"]).select("text", "runs").mapInArrow(_cut_runs(length, hot), schema)

    narrow = fetched(open_.where(F.col("contents") <= BUCKET_RUNS), False, "bucket long, content long, strings int, times long, part binary")
    sorted_ = narrow.repartition("bucket").sortWithinPartitions("bucket").mapInArrow(_sort_buckets(length), f"bucket long, content long, found {_SPANS}")
    found = sorted_
    if not wide.where(F.col("contents") > BUCKET_RUNS).isEmpty():
        strings = fetched(open_.where(F.col("contents") > BUCKET_RUNS), True, "bucket long, content long, at int, times long, h1 long, h2 long")
        again = strings.groupBy("h1", "h2").agg(F.count("*").alias("n")).where("n > 1")
        each = strings.join(again, ["h1", "h2"]).groupBy("bucket", "content").agg(F.collect_list(F.struct(F.col("at").alias("start"), (F.col("at") + 1).alias("end"))).alias("found"))
        found = found.unionByName(each)
    found = found.join(whole.select("bucket", "content"), ["bucket", "content"], "left_anti").where(F.size("found") > 0).unionByName(whole)
    at = F.transform("found", lambda s: F.struct((F.col("start") + s["start"]).alias("start"), (F.col("start") + s["end"] + (length - 1)).alias("end")))
    marks = met.join(found, ["bucket", "content"]).select("k1", "k2", at.alias("spans")).groupBy("k1", "k2").agg(F.flatten(F.collect_list("spans")).alias("spans"))
    return texts, marks


def _merged(spans: list[dict[str, int]], n: int) -> list[tuple[int, int]]:
    out: list[list[int]] = []
    for a, b in sorted((s["start"], min(s["end"], n)) for s in spans):
        if out and a <= out[-1][1]:
            out[-1][1] = max(out[-1][1], b)
        else:
            out.append([a, b])
    return [(a, b) for a, b in out]


def _apply(with_text: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches):
            removed, spans, digests, kept = [], [], [], []
            for text, marks in zip(batch.column("marked"), batch.column("spans")):
                if not marks.is_valid:
                    removed.append(0)
                    spans.append([])
                    digests.append(None)
                    kept.append(None)
                    continue
                raw = text.as_py()
                gone = _merged(marks.as_py(), len(raw))
                rest, at = [], 0
                for a, b in gone:
                    rest.append(raw[at:a])
                    at = b
                left = b"".join([*rest, raw[at:]])
                removed.append(len(raw) - len(left))
                spans.append([{"start": a, "end": b} for a, b in gone])
                digests.append(hashlib.sha256(left).hexdigest())
                kept.append(left if with_text else None)
            columns = [*(batch.column(c) for c in ("k1", "k2", "n_bytes", "plain")), pa.array(removed, pa.int64()), pa.array(spans, _SPAN), pa.array(digests, pa.string()), pa.array(kept, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, names=["k1", "k2", "n_bytes", "plain", "n_removed", "spans", "digest", "kept"])

    return run


def repeat_report(documents: DataFrame, length: int = 200) -> DataFrame:
    """One row per document: doc_id, n_bytes, n_removed, n_spans, kept_sha256."""
    return _results(documents, length, False).select("doc_id", "n_bytes", "n_removed", F.size("spans").cast("bigint").alias("n_spans"), F.coalesce("digest", "plain").alias("kept_sha256"))


def remove_repeats(documents: DataFrame, length: int = 200) -> DataFrame:
    """One row per document: doc_id, spans (removed bytes, end excluded), kept (the other bytes; null if all are kept)."""
    return _results(documents, length, True).select("doc_id", "spans", "kept")


def _results(documents: DataFrame, length: int, with_text: bool) -> DataFrame:
    texts, marks = repeated_runs(documents, length)
    marked = texts.join(marks, ["k1", "k2"], "left")
    rows = marked.select(
        "k1", "k2",
        F.octet_length("text").cast("bigint").alias("n_bytes"),
        F.when(F.col("spans").isNull(), F.sha2("text", 256)).alias("plain"),
        F.when(F.col("spans").isNotNull(), F.col("text")).alias("marked"),
        "spans",
    )
    done = rows.mapInArrow(_apply(with_text), f"k1 long, k2 long, n_bytes long, plain string, n_removed long, spans {_SPANS}, digest string, kept binary")
    keys = documents.select("doc_id", *_key(F.coalesce("text", F.lit("")).cast("binary")))
    return keys.join(done, ["k1", "k2"])
