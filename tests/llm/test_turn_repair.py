"""Turn repair against trying everything, however rows are cut into blocks."""

import os
import random
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from llm import brute_more as brute  # noqa: E402
from stayflow.llm import turn_repair  # noqa: E402
from stayflow.llm.queries import QUERIES, damaged  # noqa: E402

ROWS = "conv_id long, turn long, role string, text string"
COLUMNS = ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit"]


def conversations(seed, n, longest=9):
    pick = random.Random(seed)
    roles = ["user", "assistant", "user", "assistant", "system", "tool", None, "", "umpire"]
    texts = ["Yes.", "No!", "why", "", None, " \t", "ok?\n", "ü.\x85", "so. "]
    for conv in range(n):
        for k in range(pick.randint(1, longest)):
            yield (conv if conv else None, pick.choice([k, k, k, k + 2, None]), pick.choice(roles), pick.choice(texts))


def spaced(rows):
    return [(c, t, " " if r is None else r, " " if x is None else x) for c, t, r, x in rows]


def got(df, sha="sha"):
    return sorted((tuple(r) for r in df.select(*COLUMNS, sha).collect()), key=repr)


@pytest.fixture
def small_blocks(spark):
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    spark.conf.set(key, "5")
    yield
    spark.conf.unset(key)


def test_repairs_are_the_cheapest(spark):
    rows = list(conversations(1, 150))
    frame = spark.createDataFrame(rows, ROWS).selectExpr("*", "conv_id as audit", "turn as open", "text as said_key")
    assert got(turn_repair.repair_report(frame)) == sorted(brute.repairs(spaced(rows)), key=repr)


def test_blocks_do_not_show(spark, small_blocks):
    rows = [*conversations(2, 40), *((500, k, ["user", "assistant"][k % 3 % 2], f"row {k % 11}." if k % 5 else "open") for k in range(60)), *[(501, 3, "user", "Same.")] * 300]
    frame = spark.createDataFrame(rows, ROWS).repartition(7)
    want = sorted(brute.repairs(spaced(rows)), key=repr)
    assert got(turn_repair.repair_report(frame)) == want
    turns = turn_repair.repaired_turns(frame).where("conv_id = 500").orderBy("part", "seq", "place").collect()
    held = [r[2:] for r in sorted((r for r in rows if r[0] == 500), key=lambda r: r[1])]
    assert [(t.role, t.text) for t in turns] == brute.cheapest(held)[2]


def test_damaged_conversations(spark, sf_dir, tmp_path):
    rows = [*conversations(3, 60), (900, 1, "user", "x" * 500_000 + "."), (900, 2, "assistant", "y" * 500_000 + "?")]
    spark.createDataFrame(rows, ROWS).write.parquet(str(tmp_path / "conversations.parquet"))
    spoiled = list(brute.damage(rows))
    assert sorted(map(tuple, damaged(spark.createDataFrame(rows, ROWS)).collect()), key=repr) == sorted(spoiled, key=repr)
    gone = [(c, 0, 0, 0, 0, 0, 0, "", brute.sha("")) for c in {r[0] for r in rows} - {r[0] for r in spoiled}]
    query = QUERIES["op11_turn_repair"]
    assert got(query(spark, str(tmp_path)), "repaired_sha256") == sorted([*brute.repairs(spoiled), *gone], key=repr)
    spark.createDataFrame([], ROWS).write.parquet(str(tmp_path / "none" / "conversations.parquet"))
    assert query(spark, str(tmp_path / "none")).count() == 0
    table = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    assert len(got(query(spark, sf_dir), "repaired_sha256")) == len({r[0] for r in table})
    found = {r[0]: r for r in got(query(spark, sf_dir), "repaired_sha256")}
    assert all(found[r[0]] == r for r in brute.repairs(brute.damage(table)))
