import json
import random

import pytest
from pyspark.sql import functions as F

from stayflow.functions import jsontree as J

NAMES = ["id", "kind", "x", "code"]


def walk(value, names):
    """Plain recursive search over sorted keys, the meaning to match."""
    if isinstance(value, dict):
        for key in sorted(value):
            if key in names and value[key] is not None and value[key] != "":
                return value[key]
        for key in sorted(value):
            hit = walk(value[key], names)
            if hit is not None:
                return hit
    if isinstance(value, list):
        for item in value:
            hit = walk(item, names)
            if hit is not None:
                return hit
    return None


def text(value):
    if value is None:
        return None
    if isinstance(value, bool):
        return "true" if value else "false"
    if isinstance(value, (dict, list)):
        return json.dumps(value, sort_keys=True, separators=(",", ":"), ensure_ascii=False)
    return str(value)


def random_doc(rng, depth):
    kind = rng.random()
    if depth == 0 or kind < 0.35:
        return rng.choice([None, "", "v", 'q"uo\\te', "é{", "a,\"id\":1", 0, 7, True, "null", "[x"])
    if kind < 0.75:
        keys = rng.sample([*NAMES, "a", "b", "m", 'w"id', "z"], rng.randint(0, 4))
        return {k: random_doc(rng, depth - 1) for k in keys}
    return [random_doc(rng, depth - 1) for _ in range(rng.randint(0, 3))]


def test_search_equals_plain_recursion(spark):
    rng = random.Random(5)
    docs = []
    while len(docs) < 400:
        doc = random_doc(rng, rng.randint(1, 7))
        if isinstance(doc, (dict, list)):
            docs.append(doc)
    fields = {"one": ["id"], "two": ["kind", "x"], "three": NAMES}
    rows = [(i, json.dumps(d)) for i, d in enumerate(docs)]
    df = spark.createDataFrame(rows, "n int, j string").withColumn("doc", F.expr(J.parse("j")))
    df = df.withColumn("canon", F.to_json("doc"))
    got = J.search_fields(df, "doc", "canon", fields).withColumn(
        "direct", F.expr(J.find_first("doc", "canon", NAMES))
    )
    for row in got.collect():
        doc = docs[row.n]
        for field, names in fields.items():
            expected = text(walk(doc, set(names)))
            assert (row[field].text if row[field] else None) == expected, (doc, field)
        assert row.direct == text(walk(doc, set(NAMES)))


def test_search_has_no_depth_limit(spark):
    doc = {"id": "deep"}
    for _ in range(60):
        doc = {"n": [doc]}
    deep = {"a": doc, "b": {"id": "shallow"}}
    df = spark.createDataFrame([(json.dumps(deep),)], "j string").withColumn("doc", F.expr(J.parse("j")))
    df = df.withColumn("canon", F.to_json("doc"))
    assert J.search_fields(df, "doc", "canon", {"f": ["id"]}).first().f.text == "deep"


@pytest.mark.parametrize("bad", ["nope", "3", '"s"'])
def test_search_of_non_documents_is_null(spark, bad):
    df = spark.createDataFrame([(bad,)], "j string").withColumn("doc", F.expr(J.parse("j")))
    df = df.withColumn("canon", F.to_json("doc"))
    assert J.search_fields(df, "doc", "canon", {"f": ["id"]}).first().f is None


def test_canonical_json_sorts_and_compacts(spark):
    df = spark.createDataFrame([('{"b": 2, "a": 1}',), ('{"a":1,"b":2}',)], "j string")
    assert {r[0] for r in df.selectExpr(J.canonical_json("j")).collect()} == {'{"a":1,"b":2}'}
