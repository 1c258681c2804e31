"""Token counts of whole texts, lengths only.

Texts are cut at safe boundaries into segments: before the spaces that follow
another character. The vocabulary is checked first: if no piece continues over
such a boundary, and spaces are plain characters for the tokenizer, the tokens
of a text are those of its segments. Segments of many rows go through the
encoder in batches of about equal bytes, whatever the lengths of the texts, and
short segments are counted once per task while a bounded memory holds them.
Only lengths leave the encoder.

For other tokenizers (a vocabulary with pieces over a boundary, or another
library) whole texts are encoded, in batches of about equal bytes.

A very long text without any space is one segment and is encoded whole, as the
vocabulary names no other boundary: merges may reach across any two letters.

Nulls: a null text is empty and has no tokens. Repeated rows get a row each,
an empty table no rows.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stayflow.llm.common import importable, sliced

#: Bytes that are encoded at a time, about.
BATCH_BYTES = 1 << 20
#: Short segments remembered by a task, and what is short.
HELD_SEGMENTS = 200_000
SHORT = 48
_SEGMENT = re.compile(" *[^ ]+| +")


class PieceCounter:
    """Lengths by a sentencepiece model."""

    def __init__(self, path: str):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        size = range(self.model.vocab_size())
        pieces = [self.model.id_to_piece(i) for i in size]
        # plain spaces: kept as they are, one put in front, none taken away
        plain = self.model.encode("a  b", out_type=str) == self.model.encode("a", out_type=str) + ["▁"] + self.model.encode("b", out_type=str) and self.model.encode(" ", out_type=str) == ["▁▁"]
        special = any(self.model.is_control(i) is False and self.model.is_unused(i) for i in size)
        self.safe = plain and not special and not any("▁" in p.lstrip("▁") for p in pieces)
        self.held: dict[str, int] = {}

    def _encode(self, texts: list[str]) -> list[int]:
        """Lengths of whole texts, in batches of about equal bytes."""
        out, batch, size = [], [], 0
        for text in texts:
            batch.append(text)
            size += len(text.encode())
            if size >= BATCH_BYTES:
                out.extend(map(len, self.model.encode(batch, num_threads=1)))
                batch, size = [], 0
        if batch:
            out.extend(map(len, self.model.encode(batch, num_threads=1)))
        return out

    def lengths(self, texts: list[str]) -> list[int]:
        if not self.safe:
            return self._encode(texts)
        if len(self.held) > HELD_SEGMENTS:
            self.held.clear()
        held, out = self.held, []
        cut = []
        for text in texts:
            segments = _SEGMENT.findall(text)
            # the encoder puts one space in front, so a later segment goes without its first
            cut.append(segments[:1] + [s[1:] for s in segments[1:]])
        missing = [s for s in {s for segments in cut for s in segments} if s not in held]
        counts = dict(zip(missing, self._encode(missing)))
        if "" in counts:
            counts[""] = 1  # a single space at the end
        long = {s: n for s, n in counts.items() if len(s) > SHORT}
        held.update((s, n) for s, n in counts.items() if len(s) <= SHORT)
        for segments in cut:
            out.append(sum(held[s] if len(s) <= SHORT else long[s] for s in segments))
        return out


class JsonCounter:
    """Lengths by a tokenizer file of the ``tokenizers`` library."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.model = Tokenizer.from_file(path)
        self.model.no_truncation()
        self.model.no_padding()

    def lengths(self, texts: list[str]) -> list[int]:
        return [len(e.ids) for e in self.model.encode_batch(texts, add_special_tokens=False)]


@lru_cache(maxsize=2)
def counter(path: str) -> PieceCounter | JsonCounter:
    return PieceCounter(path) if path.endswith(".model") else JsonCounter(path)


def _balanced(texts: list[str], sizes: list[int], least_bytes: int) -> Iterator[list[str]]:
    """Rows in groups of about ``least_bytes`` of UTF-8; a longer text is a group of its own."""
    group, size = [], 0
    for text, n in zip(texts, sizes):
        if group and size + n > least_bytes:
            yield group
            group, size = [], 0
        group.append(text)
        size += n
    if group:
        yield group


def token_counts(documents: DataFrame, tokenizer_path: str, limit: int = 4096) -> DataFrame:
    """One row per document: doc_id, n_bytes, n_tokens, over_limit.

    ``tokenizer_path`` is a file that every worker has, as part of its
    installation. Without begin, end or added special tokens.
    """
    importable(documents.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = counter(tokenizer_path)
        for batch in sliced(batches, 1024):
            texts = batch.column("text").to_pylist()
            tokens = [n for group in _balanced(texts, batch.column("n_bytes").to_pylist(), BATCH_BYTES) for n in count.lengths(group)]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("n_bytes"), pa.array(tokens, pa.int64())], names=["doc_id", "n_bytes", "n_tokens"])

    rows = documents.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).withColumn("n_bytes", F.octet_length("text").cast("bigint"))
    schema = T.StructType([documents.schema["doc_id"], T.StructField("n_bytes", T.LongType()), T.StructField("n_tokens", T.LongType())])
    return rows.mapInArrow(run, schema).withColumn("over_limit", F.col("n_tokens") > limit)
