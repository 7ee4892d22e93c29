from __future__ import annotations

import os

import pytest

from footfall.operators.upsert import merge_versions, stack_versions
from footfall.sinks.keyed_table import KeyedTable
from tests.helpers import rows

SCHEMA = "date STRING, k BIGINT, n BIGINT"


def frame(spark, *data):
    return spark.createDataFrame(list(data), SCHEMA)


def table(spark, path, mode, **more):
    more = {"keys": ["date", "k"], "values": ["n"], "partition": "date", **more}
    return KeyedTable(spark, str(path), SCHEMA, mode, **more)


def test_empty(spark, tmp_path):
    assert table(spark, tmp_path / "t", "add").read().count() == 0


def test_add(spark, tmp_path):
    t = table(spark, tmp_path / "t", "add")
    t.write(frame(spark, ("20240101", 1, 5), ("20240102", 2, 1)), 0)
    t.write(frame(spark, ("20240101", 1, 2), ("20240101", 3, 1)), 1)
    want = [("20240101", 1, 7), ("20240101", 3, 1), ("20240102", 2, 1)]
    assert rows(t.read()) == want
    assert rows(t.read(upto=0)) == [("20240101", 1, 5), ("20240102", 2, 1)]
    assert rows(t.read(partitions=["20240102"])) == want[2:]
    assert rows(t.read(partitions=[])) == []
    t.write(frame(spark, ("20240101", 1, 2), ("20240101", 3, 1)), 1)
    assert rows(t.read()) == want


def test_overwrite(spark, tmp_path):
    t = table(spark, tmp_path / "t", "overwrite")
    t.write(frame(spark, ("d", 1, 5), ("d", 2, 6)), 0)
    t.write(frame(spark, ("d", 2, 1), ("d", 3, 1)), 1)
    assert rows(t.read()) == [("d", 1, 5), ("d", 2, 1), ("d", 3, 1)]


def test_replace_groups(spark, tmp_path):
    t = table(spark, tmp_path / "t", "replace_groups", group=["date"])
    t.write(frame(spark, ("a", 1, 5), ("a", 2, 6), ("a", 3, 7), ("b", 1, 1)), 0)
    t.write(frame(spark, ("a", 9, 9)), 1)
    assert rows(t.read()) == [("a", 9, 9), ("b", 1, 1)]


def test_insert_distinct(spark, tmp_path):
    t = KeyedTable(spark, str(tmp_path / "t"), "u BIGINT", "insert_distinct", ["u"], compact_every=2)
    for batch, users in enumerate([[1, 2], [2, 3], [], [4], [1]]):
        t.write(spark.createDataFrame([(u,) for u in users], "u BIGINT"), batch)
    assert rows(t.read()) == [(1,), (2,), (3,), (4,)]


@pytest.mark.parametrize("mode", ["add", "overwrite", "replace_groups"])
@pytest.mark.parametrize("every", [1, 2, 100])
def test_compaction_changes_nothing(spark, tmp_path, mode, every):
    more = {"keys": ["date", "k"], "values": ["n"], "group": ["date"]}
    t = table(spark, tmp_path / "t", mode, group=["date"], compact_every=every)
    writes = []
    for batch in range(4):
        data = {(f"2024010{(batch + i) % 3}", i): batch * 10 + i for i in range(3)}
        writes.append(frame(spark, *[(d, k, n) for (d, k), n in data.items()]))
        t.write(writes[-1], batch)
    t.write(writes[-1], batch)  # the same batch again
    want = rows(merge_versions(stack_versions(*writes), mode, **more))
    assert rows(t.read()) == want
    assert rows(t.read(partitions=["20240101"])) == [r for r in want if r[0] == "20240101"]


def test_compaction_rewrites_touched_partitions_and_cleans_up(spark, tmp_path):
    t = table(spark, tmp_path / "t", "add", compact_every=2)
    for batch, day in enumerate(["a", "a", "b", "b", "b", "b"]):
        t.write(frame(spark, (day, 1, 1)), batch)
    base = tmp_path / "t" / "base"
    cut = {v: sorted(n for n in os.listdir(base / v) if n.startswith("date=")) for v in os.listdir(base)}
    assert cut == {"version=1": ["date=a"], "version=3": ["date=b"], "version=5": ["date=b"]}
    # Deltas are kept back to the base before the last one.
    assert sorted(os.listdir(tmp_path / "t" / "delta")) == ["version=4", "version=5"]
    assert rows(t.read()) == [("a", 1, 2), ("b", 1, 4)]
    t.write(frame(spark, ("b", 1, 1)), 6)
    t.write(frame(spark, ("b", 1, 1)), 7)
    assert sorted(os.listdir(base)) == ["version=1", "version=5", "version=7"]
    assert rows(t.read()) == [("a", 1, 2), ("b", 1, 6)]


def test_unfinished_writes_are_ignored(spark, tmp_path):
    t = table(spark, tmp_path / "t", "add")
    t.write(frame(spark, ("a", 1, 1)), 0)
    t.write(frame(spark, ("a", 1, 1)), 1)
    (tmp_path / "t" / "delta" / "version=1" / "_SUCCESS").unlink()
    assert rows(t.read()) == [("a", 1, 1)]


def test_unknown_mode(spark):
    with pytest.raises(ValueError):
        merge_versions(stack_versions(frame(spark)), "upsert", ["k"])


def test_reads_of_one_day_load_that_day_alone(spark, tmp_path, monkeypatch):
    table = KeyedTable(spark, str(tmp_path / "t"), "day STRING, k INT, n BIGINT", "add",
                       ["day", "k"], ["n"], partition="day", compact_every=2)
    for batch_id in range(4):
        data = [(f"2024010{d}", batch_id, 1) for d in range(1, 6)]
        table.write(spark.createDataFrame(data, "day STRING, k INT, n BIGINT"), batch_id)
    loaded = []
    load = KeyedTable._load
    monkeypatch.setattr(KeyedTable, "_load", lambda self, f: loaded.extend(f) or load(self, f))
    assert table.read(partitions=["20240102"]).count() == 4
    assert [f.rsplit("/", 1)[1] for f in loaded] == ["day=20240102"]
    assert table.read(partitions=[]).count() == 0
