"""State tables: latest row per key, replays, merges, and how much a batch reads."""

import random

import pytest
from pyspark.sql import functions as F

from stayflow.schemas import _table
from stayflow.session import scratch_path
from stayflow.sources import manifest
from stayflow.sources.state import StateTable

SCHEMA = _table("hotel string, no bigint, value string, payload string")
KEYS = ["hotel", "no"]


def changes(spark, batch, rows):
    return spark.createDataFrame([(h, n, f"{batch}", "p" * 20) for h, n in rows], SCHEMA)


def held(df):
    return {(r.hotel, r.no): r.value for r in df.collect()}


def test_state_equals_a_dictionary_and_reads_no_more_as_batches_pass(spark):
    pick = random.Random(5)
    table = StateTable(spark, scratch_path(spark, "state"), KEYS, SCHEMA, buckets=3, fan=3)
    want, at, read, stored = {}, {}, [], []
    for batch in range(30):
        keys = {(pick.choice(["a", "b", None]), pick.randrange(12)) for _ in range(8)}
        read.append(len(table.folders(batch)))
        table.write(changes(spark, batch, keys), batch)
        want |= {k: str(batch) for k in keys}
        at[batch + 1] = dict(want)
        stored.append(len(manifest.names(spark, f"{table.path}/data")))
    assert held(table.read()) == want
    assert held(table.read(before=27)) == at[27]
    # three levels at most after 27 batches, two runs a level, three buckets
    assert max(read) <= 3 * 2 * 4 and max(read[20:]) <= max(read[:20]) + 6
    # folders out of use are removed, and so are old manifests
    assert len(manifest.versions(spark, f"{table.path}/_manifest")) == manifest.KEPT
    listed = {f for r in table._live(None)["runs"].values() for f, _ in r}
    assert all(manifest.exists(spark, f"{table.path}/{f}") for f in listed)
    assert table.read().count() == len(want) == table.read().select(*KEYS).distinct().count()


def test_only_the_buckets_of_the_keys_are_read(spark):
    table = StateTable(spark, scratch_path(spark, "state"), KEYS, SCHEMA)
    table.write(changes(spark, 0, [("h", n) for n in range(400)]), 0)
    one = spark.createDataFrame([("h", 7)], "hotel string, no bigint")
    assert len(table.folders()) == 16 and len(table.folders(only=one)) == 1
    assert held(table.read(only=one)) == {("h", 7): "0"}
    assert table.read(only=one.where("false")).count() == 0
    plan = table.read(only=one)._jdf.queryExecution().executedPlan().toString()
    assert "SortAggregate" not in plan


def test_a_replay_and_a_batch_that_died(spark):
    path = scratch_path(spark, "state")
    table = StateTable(spark, path, KEYS, SCHEMA, buckets=2, fan=2)
    for batch in range(5):
        table.write(changes(spark, batch, [("h", n) for n in range(batch, batch + 3)]), batch)
    before = held(table.read())
    # files without a manifest are not part of the table
    table._write_run(changes(spark, 9, [("h", 99)]).withColumn("_batch", F.lit(9).cast("bigint")), f"{5:012d}")
    assert held(StateTable(spark, path, KEYS, SCHEMA).read()) == before
    for _ in range(2):
        table.write(changes(spark, 4, [("h", n) for n in range(4, 7)]), 4)
        assert held(table.read()) == before
    table.write(changes(spark, 5, []), 5)
    assert held(table.read()) == before
    assert StateTable(spark, path, KEYS, SCHEMA, buckets=64).buckets == 2


def test_an_absent_table_is_empty(spark):
    table = StateTable(spark, scratch_path(spark, "state"), KEYS, SCHEMA)
    assert table.read().count() == 0 and table.read().columns == SCHEMA.fieldNames()


def test_manifest_versions(spark):
    folder = scratch_path(spark, "versions")
    assert manifest.read_version(spark, folder) == (None, None)
    for n in range(3):
        manifest.write_version(spark, folder, n, {"n": n})
    manifest.write_version(spark, folder, 1, {"n": "again"})
    assert manifest.read_version(spark, folder) == (2, {"n": 2}) and manifest.read_version(spark, folder, before=2) == (1, {"n": "again"})
    assert [n for n in manifest.names(spark, folder) if n.endswith(".new")] == []
    with pytest.raises(Exception):
        manifest.read_json(spark, f"{folder}/missing.json")
