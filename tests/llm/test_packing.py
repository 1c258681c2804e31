"""Packing: ids against the library, packings against what they promise, bounds against exact ones."""

import os
import random
import sys
import zlib
from itertools import pairwise

import numpy as np
import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from stayflow.llm import packing  # noqa: E402
from stayflow.llm.common import read_table  # noqa: E402
from stayflow.llm.queries import QUERIES, tokenizer_path  # noqa: E402

DOCS = "doc_id long, text string, piece string, sequence_id string, row string"
PATH = tokenizer_path("byte_bpe_50k.json")


def library_ids(texts):
    from tokenizers import Tokenizer

    model = Tokenizer.from_file(PATH)
    return [[*e.ids, 2] for e in model.encode_batch([t or "" for t in texts], add_special_tokens=False)]


def check(rows, texts):
    """All pieces of all documents are there with their ids, and no sequence is too long or has a gap."""
    want = []
    for doc_id, ids in zip(texts, library_ids(texts.values())):
        first = len(ids) % 1024
        starts = [*([0] if first else []), *range(first, len(ids), 1024)]
        for k, (a, b) in enumerate(pairwise([*starts, len(ids)])):
            want.append((doc_id, k, a, b - a, zlib.crc32(np.array(ids[a:b], "<u4").tobytes())))
    assert sorted((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows) == sorted(want)
    placed = {}
    for r in rows:
        placed.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for parts in placed.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 1024
    return len(placed)


def bound(rows):
    return packing.dual_feasible_bound(np.bincount([r.length for r in rows if r.length < 1024], minlength=1025)) + sum(r.length == 1024 for r in rows)


def test_all_documents_of_a_table(spark, sf_dir):
    texts = {r.doc_id: r.text for r in read_table(spark, sf_dir, "documents").collect()}
    rows = QUERIES["op12_pack"](spark, sf_dir).collect()
    assert 0 <= check(rows, texts) - bound(rows) <= 1


def test_awkward_documents(spark):
    pick = random.Random(4)
    letters = [*"ab 'sé1.\n\t\x0b\x85  \x1c<|", "  ", "<|endoftext|>", " \n", "\n ", "'ll", "中", " "]
    texts = {k: "".join(pick.choices(letters, k=pick.randint(0, 40))) for k in range(300)}
    texts |= {1000: None, 1001: "", 1002: "word " * 200_000, 1003: "x" * 30_000, 1004: "one " * 1023, 1005: "one " * 1024, 1006: "\n" * 5_000}
    frame = spark.createDataFrame([(k, t, "p", "s", "r") for k, t in texts.items()], DOCS)
    rows = packing.pack_documents(frame, PATH, end_id=2).collect()
    assert 0 <= check(rows, texts) - bound(rows) <= 1
    assert packing.pack_documents(frame.limit(0), PATH, end_id=2).count() == 0
    repeated = packing.pack_documents(spark.createDataFrame([(None, "so " * 300, "", "", "")] * 50, DOCS), PATH, end_id=2).collect()
    assert len(repeated) == 50 and len({(r.sequence_id, r.offset) for r in repeated}) == 50
    assert len({r.sequence_id for r in repeated}) == 17 == bound(repeated)


def test_other_vocabularies_go_through_the_library(spark):
    frame = spark.createDataFrame([(1, "Some words, some MORE words", "", "", "")], DOCS)
    path = tokenizer_path("word_bpe_49k.json")
    from tokenizers import Tokenizer

    ids = Tokenizer.from_file(path).encode("Some words, some MORE words", add_special_tokens=False).ids
    got = packing.pieces(frame, path, end_id=2, with_ids=True).first()
    assert packing.encoder(path).ranked is None and np.frombuffer(got.ids, "<u4").tolist() == [*ids, 2]


def fewest(sizes, capacity):
    """Exact, by trying each size in every open sequence."""

    def place(k, rooms, best):
        if len(rooms) >= best:
            return best
        if k == len(sizes):
            return len(rooms)
        for i in range(len(rooms)):
            if rooms[i] >= sizes[k] and rooms[i] not in rooms[:i]:
                best = min(best, place(k + 1, [*rooms[:i], rooms[i] - sizes[k], *rooms[i + 1 :]], best))
        return min(best, place(k + 1, [*rooms, capacity - sizes[k]], best))

    return place(0, [], len(sizes) + 1)


@pytest.mark.parametrize("seed", range(60))
def test_bound_is_below_every_packing(seed):
    pick = random.Random(seed)
    capacity = pick.choice([10, 12, 30])
    sizes = sorted((pick.randint(1, capacity) for _ in range(pick.randint(0, 9))), reverse=True)
    least = fewest(sizes, capacity)
    low = packing.dual_feasible_bound(np.bincount(sizes, minlength=capacity + 1) if sizes else np.zeros(capacity + 1, np.int64), capacity)
    assert low <= least and least - low <= 1
    if sizes:
        sequence, offset = packing.best_fit_decreasing(np.array(sizes), capacity)
        assert least <= sequence.max() + 1 <= least + 1
    assert packing.dual_feasible_bound(np.bincount([6] * 7, minlength=11), 10) == 7
    assert packing.dual_feasible_bound(np.bincount([4] * 5, minlength=11), 10) == 3


def test_groups_with_gaps_exchange(spark):
    """Groups of some dozen pieces leave gaps that the rounds close."""
    pick = random.Random(9)
    frame = spark.createDataFrame([(k, 0, pick.choice([300, 350, 374, 500, 524, 17])) for k in range(3_000)], "doc_id long, piece int, length long")
    packed, found = packing.pack(frame, group_pieces=40)
    rows = packed.collect()
    assert len(rows) == 3_000 and len({r.doc_id for r in rows}) == 3_000
    used = {}
    for r in rows:
        used[r.sequence_id] = used.get(r.sequence_id, 0) + r.length
    assert max(used.values()) <= 1024 and len(used) == found["sequences"]
    whole = packing.best_fit_decreasing(np.array([r.length for r in rows]))[0].max() + 1
    assert found["rounds"] > 1 and found["bound"] <= found["sequences"] <= whole * 1.02
    once, first = packing.pack(frame, group_pieces=40, rounds=1)
    assert first["sequences"] > found["sequences"]


def test_sequences_hold_the_ids(spark):
    frame = spark.createDataFrame([(k, f"text number {k} " * (k % 40 + 1), "", "", "") for k in range(200)], DOCS)
    packed, _ = packing.pack(packing.pieces(frame, PATH, end_id=2, with_ids=True))
    packed = packed.persist()
    whole = {r.sequence_id: np.frombuffer(r.ids, "<u4").tolist() for r in packing.sequences(packed).collect()}
    assert sum(map(len, whole.values())) == sum(r.length for r in packed.collect())
    for r in packed.collect():
        assert np.array(whole[r.sequence_id][r.offset : r.offset + r.length], "<u4").tobytes() == bytes(r.ids)
