"""Language ID by a byte convolutional network.

Filters of several widths run over the bytes of fixed-length windows, the
largest response of each filter over a window goes to a softmax layer. The
network is trained in numpy on the driver from a bounded sample of labelled
windows and applied to all windows of every text; a document's probabilities
are those of its windows, weighted by their bytes.

The first layer reads single bytes, so a filter's response is a sum of table
entries. For use, tables of neighbouring bytes are joined into one of pairs.

Nulls: a null text, or one without a letter, is ``und`` with score 0. Without
any labelled document every text is ``und``. A null id is trained on like any
other. Repeated rows get a row each, an empty table none. Other columns are not
read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stayflow.llm.common import fresh, importable, share_of, sliced

WINDOW = 256
WIDTHS = (2, 3, 4)
FILTERS = 8
UNDETERMINED = "und"
#: Windows that are laid out at a time.
_CHUNK = 2048
#: Upper case as lower case, digits as one, control characters as a space.
_FOLD = bytes(b + 32 if 0x41 <= b <= 0x5A else 0x30 if 0x30 <= b <= 0x39 else 0x20 if b < 0x20 else b for b in range(256))
_FOLD_ARRAY = np.frombuffer(_FOLD, np.uint8)


@dataclass
class Network:
    """``filters[width]``: responses by place in the filter, byte and filter; then the softmax layer."""

    languages: list[str]
    filters: dict[int, np.ndarray]
    shift: dict[int, np.ndarray]
    weights: np.ndarray
    bias: np.ndarray

    def tables(self) -> dict[int, list[np.ndarray]]:
        """Tables over pairs of bytes, and over one byte where the width is odd."""
        out = {}
        for width, f in self.filters.items():
            joined = [(f[j][:, None, :] + f[j + 1][None, :, :]).reshape(1 << 16, -1) for j in range(0, width - 1, 2)]
            out[width] = [np.ascontiguousarray(t, dtype=np.float32) for t in [*joined, *([f[width - 1]] if width % 2 else [])]]
        return out

    def probabilities(self, windows: np.ndarray, tables: dict[int, list[np.ndarray]]) -> np.ndarray:
        """Softmax per window of folded bytes."""
        pair = windows[:, :-1].astype(np.uint16) << 8 | windows[:, 1:]
        pooled = []
        for width, parts in tables.items():
            n = windows.shape[1] - width + 1
            response = None
            for k, table in enumerate(parts):
                code = (windows[:, 2 * k : 2 * k + n] if len(table) == 256 else pair[:, 2 * k : 2 * k + n])
                got = table.take(code, axis=0)
                response = got if response is None else np.add(response, got, out=response)
            pooled.append(response.max(axis=1) + self.shift[width])
        return _softmax(np.maximum(np.concatenate(pooled, axis=1), 0) @ self.weights + self.bias)


def _softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def fold_windows(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """One folded window of zeros at the end per text, and the bytes in each."""
    out = np.zeros((len(texts), WINDOW), np.uint8)
    for row, text in zip(out, texts):
        row[: len(text)] = _FOLD_ARRAY[np.frombuffer(text, np.uint8)]
    return out, np.array([len(t) for t in texts])


def fit(windows: np.ndarray, labels: np.ndarray, languages: list[str], steps: int = 400, batch: int = 128, rate: float = 0.01, seed: int = 42) -> Network:
    """Train by Adam on the cross entropy. The same data give the same network."""
    rng = np.random.default_rng(seed)
    classes = len(languages)
    p = {("f", w): rng.normal(0, 0.3, (w, 256, FILTERS)).astype(np.float32) for w in WIDTHS}
    p |= {("s", w): np.zeros(FILTERS, np.float32) for w in WIDTHS}
    p |= {"w": rng.normal(0, 0.3, (FILTERS * len(WIDTHS), classes)).astype(np.float32), "b": np.zeros(classes, np.float32)}
    m = {k: np.zeros_like(v) for k, v in p.items()}
    v = {k: np.zeros_like(x) for k, x in p.items()}
    # every language as often as any other
    per_class = [np.flatnonzero(labels == c) for c in range(classes)]
    for step in range(1, steps + 1):
        chosen = np.concatenate([rng.choice(rows, max(1, batch // classes)) for rows in per_class])
        x, y = windows[chosen], labels[chosen]
        n = len(x)
        pooled, peaks = [], {}
        for w in WIDTHS:
            span = WINDOW - w + 1
            response = sum(p["f", w][j].take(x[:, j : j + span], axis=0) for j in range(w))
            peaks[w] = response.argmax(axis=1)
            pooled.append(np.take_along_axis(response, peaks[w][:, None, :], axis=1)[:, 0] + p["s", w])
        raw = np.concatenate(pooled, axis=1)
        hidden = np.maximum(raw, 0)
        slope = _softmax(hidden @ p["w"] + p["b"])
        slope[np.arange(n), y] -= 1
        slope /= n
        g = {"w": hidden.T @ slope, "b": slope.sum(axis=0)}
        back = (slope @ p["w"].T) * (raw > 0)
        for i, w in enumerate(WIDTHS):
            part = back[:, i * FILTERS : (i + 1) * FILTERS]
            g["s", w] = part.sum(axis=0)
            g["f", w] = np.zeros_like(p["f", w])
            for j in range(w):
                # only the place of the largest response is moved
                np.add.at(g["f", w][j], (np.take_along_axis(x, peaks[w] + j, axis=1), np.arange(FILTERS)), part)
        for k in p:
            m[k] = 0.9 * m[k] + 0.1 * g[k]
            v[k] = 0.999 * v[k] + 0.001 * g[k] ** 2
            p[k] = p[k] - rate * (m[k] / (1 - 0.9**step)) / (np.sqrt(v[k] / (1 - 0.999**step)) + 1e-8)
    return Network(languages, {w: p["f", w] for w in WIDTHS}, {w: p["s", w] for w in WIDTHS}, p["w"], p["b"])


def held_out(doc_id: Column) -> Column:
    """Documents that are never learnt from: a remainder of the id's CRC-32, which is 0 for a null id."""
    return F.pmod(F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")), F.lit(5)) == 0


def training_windows(documents: DataFrame, per_language: int = 400, max_languages: int = 200) -> DataFrame:
    """(lang, piece): one window's worth of characters from each of a bounded number of documents a language.

    The documents are those of the smallest hashes, the place in the text comes
    from the hash too. Repeated rows, of one id and text, are one document, so
    they take no place from others and are not drawn or left out as a block.
    Held-out and unlabelled documents are left out. More than ``max_languages``
    languages raise an error.
    """
    usable = documents.where(F.col("lang").isNotNull() & F.col("text").isNotNull() & ~held_out(F.col("doc_id"))).where(F.length("text") > 0)
    name = F.coalesce(F.col("doc_id").cast("string"), F.lit(""))
    # a share of each language that is far more than enough comes first, so tasks send few rows
    drawing = F.xxhash64(F.lit("draw"), name, "text", "lang")
    counts = usable.groupBy("lang").agg(F.approx_count_distinct(drawing).alias("count")).limit(max_languages + 1).collect()
    if len(counts) > max_languages:
        raise ValueError(f"more than {max_languages} languages")
    share = F.lit(0.0)
    for r in counts:
        share = F.when(F.col("lang") == r["lang"], F.lit(8.0 * per_language / max(1, r["count"]))).otherwise(share)
    draw = F.col("draw")
    drawn = usable.select("lang", "text", drawing.alias("draw")).where(share_of(draw, share))
    at = F.pmod(draw, F.greatest(F.length("text") - WINDOW, F.lit(1)).cast("bigint")) + 1
    drawn = drawn.select("lang", draw.alias("draw"), F.substring("text", at.cast("int"), F.lit(WINDOW)).alias("piece")).distinct()
    return drawn.withColumn("n", F.row_number().over(W.partitionBy("lang").orderBy("draw", "piece"))).where(F.col("n") <= per_language).select("lang", "piece")


def train(documents: DataFrame, per_language: int = 400, max_languages: int = 200, steps: int = 400) -> Network | None:
    """A network learnt from at most ``per_language`` windows of each language; None without any.

    What the driver holds is bounded by the two parameters.
    """
    drawn = training_windows(documents, per_language, max_languages).collect()
    if not drawn:
        return None
    languages = sorted({r.lang for r in drawn})
    drawn.sort(key=lambda r: (r.lang, r.piece))
    index = {name: i for i, name in enumerate(languages)}
    windows, _ = fold_windows([r.piece.encode("utf-8", "ignore")[:WINDOW] for r in drawn])
    return fit(windows, np.array([index[r.lang] for r in drawn]), languages, steps)


def document_windows(raw: list[bytes]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(windows, document of each, bytes in each) in bounded chunks; windows overlap by what a filter spans."""
    step = WINDOW - max(WIDTHS) + 1
    data = _FOLD_ARRAY[np.frombuffer(b"".join(raw) + bytes(WINDOW), np.uint8)]
    lengths = np.array([len(t) for t in raw])
    begins = np.cumsum(lengths) - lengths
    counts = np.maximum(1, -(-(lengths - (WINDOW - step)) // step))
    owner = np.repeat(np.arange(len(raw)), counts)
    place = (np.arange(len(owner)) - np.repeat(np.cumsum(counts) - counts, counts)) * step
    sizes = np.minimum(lengths[owner] - place, WINDOW)
    for a in range(0, len(owner), _CHUNK):
        part = slice(a, a + _CHUNK)
        offsets = np.arange(WINDOW)
        windows = data[(begins[owner[part]] + place[part])[:, None] + offsets]
        windows[offsets >= sizes[part][:, None]] = 0
        yield windows, owner[part], sizes[part]


def predict(documents: DataFrame, network: Network | None, names: tuple[str, str] = ("lang_pred", "score")) -> DataFrame:
    """The documents with the predicted language and its score, which replace columns of these names."""
    spark = documents.sparkSession
    importable(spark)
    rows = documents.drop(*names)
    schema = T.StructType([*rows.schema.fields, T.StructField(names[0], T.StringType()), T.StructField(names[1], T.DoubleType())])
    shared = spark.sparkContext.broadcast(network)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        tables = model.tables() if model else None
        for batch in sliced(batches):
            texts = batch.column("text").to_pylist()
            known = [i for i, t in enumerate(texts) if model and t and any(map(str.isalpha, t))]
            best_of, scores = [UNDETERMINED] * len(texts), [0.0] * len(texts)
            if known:
                total, weight = np.zeros((len(known), len(model.languages))), np.zeros(len(known))
                for windows, owner, sizes in document_windows([texts[i].encode("utf-8", "surrogatepass") for i in known]):
                    np.add.at(total, owner, model.probabilities(windows, tables) * sizes[:, None])
                    np.add.at(weight, owner, sizes)
                mean = total / weight[:, None]
                for i, best, share in zip(known, mean.argmax(axis=1).tolist(), mean.max(axis=1).tolist()):
                    best_of[i], scores[i] = model.languages[best], min(1.0, share)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(best_of, pa.string()), pa.array(scores, pa.float64())], names=schema.names)

    return rows.mapInArrow(run, schema)


def identify(documents: DataFrame, per_language: int = 400) -> DataFrame:
    """One row per document: doc_id, held_out, lang_pred, score."""
    network = train(documents, per_language)
    rows = documents.select("doc_id", "text", held_out(F.col("doc_id")).alias("held_out"))
    return predict(rows, network).select("doc_id", "held_out", "lang_pred", "score")


def keep_identified(documents: DataFrame, least_score: float = 0.4, per_language: int = 400) -> DataFrame:
    """The documents that have a language, with a score of at least ``least_score``; columns as they are."""
    names = fresh(documents.columns, "lang_pred"), fresh(documents.columns, "score")
    found = predict(documents, train(documents, per_language), names)
    return found.where((F.col(names[0]) != UNDETERMINED) & (F.col(names[1]) >= least_score)).drop(*names)
