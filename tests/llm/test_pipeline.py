"""The pipeline's stages against plain versions, and on awkward tables."""

import re

import corpus_pipeline
import pytest
from llm import brute
from llm.test_operators import DOCS, awkward, clashing, nothing  # noqa: F401

SF = "/root/testdata/sf0.001"


def test_stages_hold_their_decisions(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    columns = docs.columns
    out = {}
    for name, stage in corpus_pipeline.STAGES:
        before = docs.collect()
        made = stage(spark, docs, SF)
        docs = spark.createDataFrame(made.collect(), made.schema)
        out[name] = (before, docs.collect())
        if name != "mixing":
            assert docs.columns == columns
    before, after = out["language_id"]
    assert {r.doc_id for r in before if any(map(str.isalpha, r.text or ""))} >= {r.doc_id for r in after}
    assert len(after) >= 0.97 * sum(any(map(str.isalpha, r.text or "")) for r in before)
    before, after = out["near_duplicates"]
    assert sorted(r.doc_id for r in after) == sorted({c for _, _, c in brute.groups([(r.doc_id, r.text) for r in before])})
    before, after = out["decontamination"]
    bad = {d[0] for d in brute.contamination([(r.doc_id, r.text) for r in before], items) if d[5]}
    assert {r.doc_id for r in before} - bad == {r.doc_id for r in after}
    before, after = out["secrets"]
    assert len(before) == len(after) and not any(re.search(r'token = "[0-9a-f]{40}"', r.text) for r in after)
    before, after = out["mixing"]
    sizes, taken = {}, {}
    for r in before:
        sizes[r.source] = sizes.get(r.source, 0) + len(brute.SPACED.findall(r.text or ""))
    for r in after:
        taken[r.source] = taken.get(r.source, 0) + len(brute.SPACED.findall(r.text or ""))
    assert taken == {s: int(t + 1e-9) for s, t in brute.targets(sizes).items()}


@pytest.mark.parametrize("table", ["awkward", "clashing", "nothing"])
def test_stages_take_awkward_tables(spark, request, table):
    docs = request.getfixturevalue(table)
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, SF)
        assert out.columns == docs.columns + (["epoch"] if name == "mixing" else [])
        kept = out.collect()
        assert len(kept) <= 2 * docs.count()
