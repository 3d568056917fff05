"""Ten-minute increments and their merge."""

import pytest

from placelens.operators import increments
from placelens.operators.attribution import slot_traffic
from placelens.session import shared_folder
from placelens.sinks import snapshots

SLOTS = "typename string, idx string, pagenum string, content string, real_starttime bigint, real_endtime bigint"
LOG = "typename string, idx string, pagenum string, content string, visitor string, dateline bigint"
DAY, MIDNIGHT = "20240115", 1_705_276_800


def _slots(spark):
    rows = [("a", 0, 86_399), ("a", 0, 86_399), ("a", 3000, 50_000), ("b", -500, 90_000), ("c", 80_000, 90_000)]
    return spark.createDataFrame([("t", "0", "1", c, MIDNIGHT + lo, MIDNIGHT + hi) for c, lo, hi in rows], SLOTS)


def _log(spark, step):
    """A third of the hits are one visitor's on one slot; some are at midnight, before it and after it."""
    rows = [("abc"[n % 2], f"v{n % 11}", n * step) for n in range(-5, 300)] + [("a", "hot", n * 600 % 86_400) for n in range(150)]
    rows += [("c", "last", 86_399), ("c", "next", 86_400), ("b", None, 100), ("a", "v1", None)]
    return spark.createDataFrame([("t", "0", "1", c, v, None if at is None else MIDNIGHT + at) for c, v, at in rows], LOG)


def _rows(df):
    return sorted(map(tuple, df.select(sorted(df.columns)).collect()), key=str)


@pytest.mark.parametrize("seconds", [600, 7200, 86_400])
def test_runs_cover_a_day_once(seconds):
    bounds = [increments.run_window(run, seconds) for run in increments.runs_of(DAY, seconds)]
    assert [begin for begin, _, _ in bounds] == [MIDNIGHT + n * seconds for n in range(86_400 // seconds)]
    assert all(end - begin == seconds and day == DAY for begin, end, day in bounds)


def test_a_run_in_between_counts_to_the_report_time():
    assert increments.run_window("20240115120759") == (MIDNIGHT + 42_600, MIDNIGHT + 43_200, DAY)
    assert increments.part_name("20240115120759") == increments.part_name("20240115120000")
    assert increments.run_window("20240115000000")[2] == "20240114"


def test_merged_runs_equal_a_recount(spark):
    slots, logs, path = _slots(spark), {"active": _log(spark, 290), "show": _log(spark, 311)}, shared_folder(spark, "increments")
    whole = {name: log.where(f"dateline >= {MIDNIGHT} AND dateline < {MIDNIGHT + 86_400}") for name, log in logs.items()}
    expected = _rows(slot_traffic(slots, whole))
    runs = increments.runs_of(DAY, 4 * 3600)
    for run in (*runs[3:], *runs[:3], runs[1]):  # out of order, one of them twice
        increments.deliver(path, slots, logs, run, seconds=4 * 3600)
    found = increments.day_traffic(spark, path, DAY, list(logs))
    assert _rows(found) == expected
    before = snapshots.versions(spark, path)
    increments.deliver(path, slots, logs, runs[2], seconds=4 * 3600)
    after = snapshots.versions(spark, path)
    assert [part for part in after if after[part] != before[part]] == [increments.part_name(runs[2])]
    assert _rows(increments.day_traffic(spark, path, DAY, list(logs))) == expected


def test_a_corrected_run_replaces_its_own_increment(spark):
    slots, path = _slots(spark), shared_folder(spark, "increments")
    log, run = _log(spark, 290), increments.runs_of(DAY)[3]
    increments.deliver(path, slots, {"active": log}, run)
    increments.deliver(path, slots, {"active": log.where("visitor = 'hot'")}, run)
    rows = increments.day_increments(spark, path, DAY).collect()
    assert {row.visitor for row in rows} == {"hot"} and {row.run for row in rows} == {increments.part_name(run)}
    assert increments.day_traffic(spark, path, "20240116", ["active"]).collect() == []
