"""Dated snapshots: listed by folder, read by day, replaced as a whole."""

from datetime import date

import pytest

from tidemark.sources.snapshots import SnapshotStore


def rows(spark, *values):
    return spark.createDataFrame(list(values), "id int, v string")


def test_two_latest_days(spark, folder):
    store = SnapshotStore(spark, str(folder / "s"), "day")
    assert store.dates() == []
    for day, v in (("2024-01-31", "a"), ("2024-03-01", "b"), ("2024-02-29", "c"), ("2024-05-01", "later")):
        store.add(rows(spark, (1, v), (2, v)), day)
    assert store.dates("2024-03-31") == [date(2024, 1, 31), date(2024, 2, 29), date(2024, 3, 1)]
    got = store.latest(2, upto="2024-03-31")
    assert got.columns == ["id", "v", "day"]
    assert sorted(map(tuple, got.collect())) == [(i, v, d) for i in (1, 2) for v, d in (("b", date(2024, 3, 1)), ("c", date(2024, 2, 29)))]
    # the other folders aren't opened
    assert {f.split("day=")[1][:10] for f in got.inputFiles()} == {"2024-02-29", "2024-03-01"}
    assert store.read().count() == 8
    with pytest.raises(ValueError):
        store.latest(1, upto="2023-01-01")


def test_a_rerun_replaces_its_day_only(spark, folder):
    store = SnapshotStore(spark, str(folder / "s"), "day")
    store.add(rows(spark, (1, "a")), "2024-01-01")
    for _ in range(2):
        store.add(rows(spark, (1, "b"), (2, "b")), date(2024, 1, 2))
    assert sorted(r.v for r in store.read().collect()) == ["a", "b", "b"]
    store.add(rows(spark, (1, "b")).limit(0), "2024-01-02")
    assert store.dates() == [date(2024, 1, 1), date(2024, 1, 2)] and [r.v for r in store.latest(2).collect()] == ["a"]


def test_an_unfinished_day_is_not_stored(spark, folder):
    store = SnapshotStore(spark, str(folder / "s"), "day")
    store.add(rows(spark, (1, "a")), "2024-01-01")
    (folder / "s" / "day=2024-01-02").mkdir()
    assert store.dates() == [date(2024, 1, 1)]
