"""Near duplicates by SimHash and multi-index hashing.

Fingerprints are 64 bits over word shingles. They are cut into segments; two
fingerprints within ``max_bits`` of each other differ by at most ``max_bits``
over the number of segments in one of them. So each fingerprint looks up the
small Hamming ball around each of its segments in a table of all segments, and
the whole distance is verified on what is found.

Only distinct fingerprints are looked up: copies share one, however many they
are. Links are joined to groups by alternating star contraction, one written
table per step in the shared folder.

Nulls: a null text has no words and the fingerprint zero, like an empty one.
A text of fewer words than a shingle is one shingle. A null id belongs to the
group of its fingerprint but is never the group's name while another id is
there. Repeated rows are documents of their own. Empty tables give no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stayflow.llm.common import fresh, importable, sliced
from stayflow.session import materialize

SEED = 42
_LOWER = bytes(b + 32 if 0x41 <= b <= 0x5A else b for b in range(256))
#: Shingles whose bits are counted at a time.
_CHUNK = 1 << 16


def fingerprint(text: str | None, shingle: int = 3) -> int:
    """Bit i is set if it is set in over half of the shingles' XXH64, repeats included."""
    words = (text or "").encode("utf-8", "surrogatepass").translate(_LOWER).split()
    if not words:
        return 0
    line = b" ".join(words)
    lengths = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
    ends = np.cumsum(lengths + 1) - 1
    n = min(shingle, len(words))
    starts, ends = (ends - lengths)[: len(words) - n + 1].tolist(), ends[n - 1 :].tolist()
    digest = xxhash.xxh64_intdigest
    counts = np.zeros(64, dtype=np.int64)
    for at in range(0, len(starts), _CHUNK):
        hashes = np.array([digest(line[a:b], SEED) for a, b in zip(starts[at : at + _CHUNK], ends[at : at + _CHUNK])], dtype="<u8")
        counts += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * counts > len(starts), bitorder="little").view("<i8")[0])


def with_fingerprint(documents: DataFrame, keep: list[str], shingle: int = 3, column: str = "fp") -> DataFrame:
    """The columns ``keep`` of the documents and their fingerprint as a signed long."""
    importable(documents.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches):
            prints = pa.array([fingerprint(t.as_py(), shingle) for t in batch.column(0)], pa.int64())
            yield pa.RecordBatch.from_arrays([*batch.columns[1:], prints], names=[*batch.schema.names[1:], column])

    kept = documents.select(*keep)
    text = F.col("text").alias(fresh(keep, "hashed_text"))
    return documents.select(text, *keep).mapInArrow(run, T.StructType([*kept.schema.fields, T.StructField(column, T.LongType())]))


def _balls(width: int, radius: int) -> list[int]:
    """All masks of at most ``radius`` of ``width`` bits, as signed longs."""
    masks = [sum(1 << b for b in bits) for r in range(radius + 1) for bits in combinations(range(width), r)]
    return [m - (1 << 64) if m >> 63 else m for m in masks]


def links(prints: DataFrame, max_bits: int = 3, segments: int = 2) -> DataFrame:
    """Pairs (a, b), a < b, of distinct fingerprints within ``max_bits``; a pair may be found twice.

    ``prints`` has a column ``fp`` without repeats. With two segments of 32 bits
    a table entry is found by few fingerprints also in very large tables.
    """
    width = 64 // segments
    if width * segments != 64:
        raise ValueError("segments must divide 64")
    part = lambda s: F.shiftrightunsigned("fp", s * width).bitwiseAND(F.lit((1 << width) - 1)) if segments > 1 else F.col("fp")
    # the segment's number goes into the key, above the segment's bits where there is room
    keyed = prints.select("fp", F.explode(F.array(*[F.struct(F.lit(s).alias("segment"), part(s).alias("bits")) for s in range(segments)])).alias("at")).select("fp", "at.*")
    table = keyed.select(F.col("fp").alias("b"), "segment", "bits")
    masks = F.array(*[F.lit(m).cast("bigint") for m in _balls(width, max_bits // segments)])
    probes = keyed.select(F.col("fp").alias("a"), "segment", F.col("bits"), F.explode(masks).alias("mask")).select("a", "segment", F.col("bits").bitwiseXOR(F.col("mask")).alias("bits"))
    if width < 62:
        room = F.shiftleft(F.col("segment").cast("bigint"), width)
        table = table.select("b", room.bitwiseOR(F.col("bits")).alias("key"))
        probes = probes.select("a", room.bitwiseOR(F.col("bits")).alias("key"))
        meet = probes["key"] == table["key"]
    else:
        meet = (probes["segment"] == table["segment"]) & (probes["bits"] == table["bits"])
    near = F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= max_bits
    # sizes are guessed before the rows of a fingerprint are multiplied, so no side may be broadcast on the guess
    return probes.join(table.hint("merge"), meet & (F.col("a") < F.col("b")) & near).select("a", "b")


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of the edges (a, b); the root is the smallest node reachable.

    Alternating large-star and small-star steps (Kiveris et al. 2014). A step
    reads the table the step before has written; hubs are met by aggregation
    and by a join that adaptive execution may split.
    """
    pairs = materialize(edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "edges")
    seen = None
    while True:
        both = pairs.unionByName(pairs.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        large = materialize(large, "large")
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").where("v <> m").select(F.greatest("v", "m").alias("u"), F.least("v", "m").alias("v"))
        pairs = materialize(small.unionByName(least.select("u", F.col("m").alias("v"))).distinct(), "small")
        state = tuple(pairs.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())
        if state == seen:
            break
        seen = state
    roots = pairs.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    return roots.unionByName(pairs.select(F.col("u").alias("node"), F.col("v").alias("root")))


def _grouped(documents: DataFrame, shingle: int, max_bits: int, segments: int) -> DataFrame:
    """One row per document: doc_id, fp, root, component_id. A group is its root; two groups may have one name, or none."""
    docs = materialize(with_fingerprint(documents, ["doc_id"], shingle), "fingerprints")
    prints = materialize(docs.groupBy("fp").agg(F.min("doc_id").alias("least")), "prints")
    found = links(prints.select("fp"), max_bits, segments)
    rooted = prints.join(components(found), prints["fp"] == F.col("node"), "left").select("fp", "least", F.coalesce("root", "fp").alias("root"))
    rooted = materialize(rooted, "rooted")
    named = rooted.join(rooted.groupBy("root").agg(F.min("least").alias("component_id")), "root").select("fp", "root", "component_id")
    return docs.join(named, "fp").select("doc_id", "fp", "root", "component_id")


def near_duplicate_groups(documents: DataFrame, shingle: int = 3, max_bits: int = 3, segments: int = 2) -> DataFrame:
    """One row per document: doc_id, fp (signed long), component_id.

    ``component_id`` is the smallest id reachable over links of ``max_bits`` or
    fewer differing bits. The fingerprints are written once; all later steps
    read them and no text.
    """
    return _grouped(documents, shingle, max_bits, segments).select("doc_id", "fp", "component_id")


def deduplicate(documents: DataFrame, shingle: int = 3, max_bits: int = 3) -> DataFrame:
    """The document of the smallest id of every group, with its columns as they are.

    Where several rows of a group have that id, or none has an id, the smallest
    text stays. An id that only one row of the table has tells the row; rows of
    any other id, or none, are told by their fingerprint too.
    """
    groups = materialize(_grouped(documents, shingle, max_bits, 2), "groups")
    heads = groups.where(F.col("doc_id").eqNullSafe(F.col("component_id"))).select("doc_id", "fp", "root").distinct()
    times = groups.where("doc_id is not null").groupBy("doc_id").agg((F.count("*") == 1).alias("alone"))
    named = heads.where("doc_id is not null").join(times, "doc_id")
    kept = materialize(named.unionByName(heads.where("doc_id is null").withColumn("alone", F.lit(False))), "kept")
    rows = documents.join(kept.where("alone").select("doc_id"), "doc_id", "left_semi").select(documents.columns)
    shared = kept.where("not alone")
    if shared.isEmpty():
        return rows
    fp, root = fresh(documents.columns, "fp"), fresh(documents.columns, "root")
    of_id = documents.join(shared.select("doc_id").distinct(), "doc_id", "left_semi").select(documents.columns).unionByName(documents.where("doc_id is null"))
    printed = with_fingerprint(of_id, documents.columns, shingle, fp)
    smallest = F.struct(F.col("row.text").isNotNull(), F.col("row.text"))
    # copies are reduced before they meet their group
    printed = printed.select(F.struct(*[F.col(f"`{c}`") for c in documents.columns]).alias("row"), F.col(fp).alias("fp"))
    printed = printed.groupBy("row.doc_id", "fp").agg(F.min_by("row", smallest).alias("row")).select("fp", "row")
    same = (F.col("row.doc_id").eqNullSafe(F.col("k.doc_id"))) & (printed["fp"] == F.col("k.fp"))
    of_group = printed.join(shared.alias("k"), same).select("row", F.col("k.root").alias(root))
    return rows.unionByName(of_group.groupBy(root).agg(F.min_by("row", smallest).alias("row")).select("row.*"))
