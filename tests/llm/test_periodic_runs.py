"""Runs against comparing all words at all distances."""

import os
import random
import sys

import numpy as np
import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from llm import brute_more as brute  # noqa: E402
from stayflow.llm import periodic_runs  # noqa: E402
from stayflow.llm.common import read_table  # noqa: E402
from stayflow.llm.queries import QUERIES  # noqa: E402

COLUMNS = ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]


def words(seed, n):
    """Few kinds of words, some stretches repeated with small faults."""
    pick = random.Random(seed)
    out = []
    while len(out) < n:
        part = [pick.choice("abc") for _ in range(pick.randint(1, 9))]
        out += part * pick.choice([1, 1, 2, 3, 5, 12])
        if pick.random() < 0.3:
            out.append(pick.choice("abcd"))
    return out[: pick.randint(n // 2, n)]


@pytest.mark.parametrize("seed", range(150))
def test_all_runs_of_a_word(seed):
    word = words(seed, 12 if seed < 60 else 160)
    numbers = np.array([ord(c) for c in word], np.int64)
    for least, exponent in ((2, 2), (3, 3), (24, 3)):
        assert [tuple(r) for r in periodic_runs.runs_of(numbers, least, exponent).tolist()] == sorted(brute.runs(word, least, exponent), key=lambda r: (r[0], r[2]))
    raw = [w.encode() for w in word]
    assert [tuple(r) for r in periodic_runs.text_runs(raw).tolist()] == sorted(brute.runs(word), key=lambda r: (r[0], r[2]))


def test_tree_has_every_suffix():
    word = np.array([ord(c) for c in "mississippi"], np.int64)
    of = periodic_runs.Extensions(word, both_orders=True)
    suffixes = sorted(range(12), key=lambda k: "mississippi"[k:])
    assert of.rank[suffixes].tolist() == list(range(12))
    flipped = "mississippi".translate({a: b for a, b in zip(b"imps", b"spmi")})
    assert of.opposite[sorted(range(12), key=lambda k: flipped[k:])].tolist() == list(range(12))
    a, b = (x.ravel() for x in np.meshgrid(np.arange(12), np.arange(12)))
    a, b = a[a != b], b[a != b]
    text = "mississippi\0"
    assert of.common(a, b).tolist() == [len(os.path.commonprefix([text[i:], text[j:]])) for i, j in zip(a, b)]


def test_query_on_awkward_documents(spark, sf_dir, tmp_path):
    texts = [None, "", " \t\x0b", "a", "la " * 30, "one two three " * 9 + "one four", "\x85x y\n" * 40, *(" ".join(words(s, 200)) for s in range(40)), " ".join(words(77, 1500))]
    rows = [(k, t) for k, t in enumerate(texts)] + [(None, "da di " * 40), (5, "twice " * 50), (5, "twice " * 50)]
    frame = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "'x' as runs", "doc_id as collapsed", "1 as whole_text", "2 as best")
    frame.write.parquet(str(tmp_path / "documents.parquet"))
    got = QUERIES["op13_periodic_runs"](spark, str(tmp_path)).select(*COLUMNS)
    assert sorted(map(tuple, got.collect()), key=repr) == sorted((brute.run_report(k, t) for k, t in rows), key=repr)
    found = periodic_runs.find_runs(frame)
    assert found.columns == ["doc_id", "whole_text", "best", "runs", "collapsed"] and periodic_runs.find_runs(frame.limit(0)).count() == 0
    table = [(r.doc_id, r.text) for r in read_table(spark, sf_dir, "documents").collect()]
    small = {k: t for k, t in table if len((t or "").split()) < 400}
    whole = {r.doc_id: tuple(r) for r in QUERIES["op13_periodic_runs"](spark, sf_dir).select(*COLUMNS).collect()}
    assert len(whole) == len(table) and sum(r[1] > 0 for r in whole.values()) > 5
    assert all(whole[k] == brute.run_report(k, t) for k, t in small.items())


def test_a_long_text(spark):
    row = [f"w{k}" for k in range(1_000)] * 50
    found = periodic_runs.find_runs(spark.createDataFrame([(1, " ".join(row))], "doc_id long, text string")).first()
    assert [tuple(r) for r in found.runs] == [(0, 50_000, 1_000)] and found.collapsed == " ".join(row[:1_000])
