"""Merged intervals against intervals built anew."""

import datetime as dt
import random

import pytest

from placelens.operators import interval_store, joins
from placelens.operators.interval_store import IntervalStore
from placelens.operators.versions import version_intervals
from placelens.session import shared_folder
from placelens.sinks import snapshots

SCHEMA = "id int, seq int, optype string, modifydate timestamp, starttime timestamp, endtime timestamp"
DAY = dt.datetime(2024, 1, 1)


def _edits(count, seed):
    """Times repeat, an entry has a third of all edits, some ids and times are NULL."""
    draw = random.Random(seed)
    rows = []
    for seq in range(count):
        at = DAY + dt.timedelta(hours=draw.randrange(24 * 8))
        entry = 0 if draw.random() < 0.33 else draw.choice([1, 2, 3, 4, None])
        start = None if draw.random() < 0.1 else at + dt.timedelta(hours=draw.randrange(-5, 5))
        end = None if draw.random() < 0.1 else at + dt.timedelta(hours=draw.randrange(40))
        rows.append((entry, seq, draw.choice(["update", "delete"]), None if draw.random() < 0.02 else at, start, end))
    return rows


def _rows(df):
    return sorted(map(tuple, df.select(sorted(df.columns)).collect()), key=str)


@pytest.mark.parametrize("fits", [True, False])
def test_deliveries_in_any_order(spark, monkeypatch, fits):
    if not fits:
        monkeypatch.setattr(interval_store, "fits_broadcast", lambda df: False)
        monkeypatch.setattr(joins, "fits_broadcast", lambda df: False)
    rows = _edits(120, 5)
    store = IntervalStore(spark, shared_folder(spark, "intervals"), SCHEMA)
    random.Random(1).shuffle(rows)
    so_far = []
    for part in (rows[:70], rows[70:100], rows[60:80], rows[100:]):
        store.merge(spark.createDataFrame(part, SCHEMA))
        so_far = list(dict.fromkeys(so_far + part))
        assert _rows(store.read()) == _rows(version_intervals(spark.createDataFrame(so_far, SCHEMA)))


def test_only_touched_parts_are_written(spark):
    at = lambda day, hour: DAY + dt.timedelta(days=day, hours=hour)
    old = [(entry, 10 * entry + day, "update", at(day, 8), at(day, 8), at(day + 9, 0)) for entry in range(3) for day in range(6)]
    path = shared_folder(spark, "intervals")
    store = IntervalStore(spark, path, SCHEMA)
    assert store.merge(spark.createDataFrame(old, SCHEMA)) == [f"2024010{day + 1}" for day in range(6)]
    before = snapshots.versions(spark, path)
    # A late edit of one entry on the third day ends its version of that day; the next day's begins as it did.
    late = [(1, 900, "update", at(2, 20), at(2, 20), at(9, 0))]
    assert store.merge(spark.createDataFrame(late, SCHEMA)) == ["20240103"]
    # A new day ends the versions of the last one, of the two entries that are edited.
    new = [(entry, 910 + entry, "update", at(6, 1), at(6, 1), at(9, 0)) for entry in (0, 2)]
    assert store.merge(spark.createDataFrame(new, SCHEMA)) == ["20240106", "20240107"]
    after = snapshots.versions(spark, path)
    assert {part for part in after if after[part] != before.get(part)} == {"20240103", "20240106", "20240107"}
    assert store.merge(spark.createDataFrame(new + late, SCHEMA)) == []
    assert snapshots.versions(spark, path) == after
    assert _rows(store.read()) == _rows(version_intervals(spark.createDataFrame(old + late + new, SCHEMA)))


def test_empty(spark):
    store = IntervalStore(spark, shared_folder(spark, "intervals"), SCHEMA)
    assert store.merge(spark.createDataFrame([], SCHEMA)) == []
    assert store.read().collect() == []
