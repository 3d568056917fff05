import threading

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from placelens.session import shared_folder
from placelens.sinks import snapshots

SCHEMA = "n bigint"


def _rows(spark, hour, start, count=50):
    return spark.range(start, start + count).select(F.lit(hour).alias("hour"), F.col("id").alias("n"))


def _numbers(df):
    return sorted(row.n for row in df.collect())


def test_parts_are_replaced_alone_and_together(spark):
    path = shared_folder(spark, "snapshots")
    assert snapshots.read(spark, path, SCHEMA).collect() == []
    snapshots.publish(_rows(spark, "00", 0).unionByName(_rows(spark, "01", 100)), path, "hour")
    snapshots.publish(_rows(spark, "00", 200), path, "hour")
    assert _numbers(snapshots.read(spark, path, SCHEMA)) == [*range(100, 150), *range(200, 250)]
    assert _numbers(snapshots.read(spark, path, SCHEMA, ["01"])) == list(range(100, 150))
    named = snapshots.read(spark, path, SCHEMA, part_col="hour").groupBy("hour").count().collect()
    assert {tuple(row) for row in named} == {("00", 50), ("01", 50)}
    snapshots.publish(_rows(spark, "02", 300), path, "hour", ["00", "02"])
    assert _numbers(snapshots.read(spark, path, SCHEMA)) == [*range(100, 150), *range(300, 350)]
    snapshots.withdraw(spark, path, ["01", "02"])
    assert snapshots.read(spark, path, SCHEMA).collect() == []
    assert snapshots.read(spark, path, SCHEMA, part_col="hour").columns == ["n", "hour"]


def test_an_open_reader_finishes_on_the_old_rows(spark):
    path = shared_folder(spark, "snapshots")
    snapshots.publish(_rows(spark, "00", 0), path, "hour")
    before = snapshots.read(spark, path, SCHEMA)
    snapshots.publish(_rows(spark, "00", 500), path, "hour")
    assert _numbers(before) == list(range(50))
    assert snapshots.remove_old(spark, path) == 0  # not old enough
    assert _numbers(before) == list(range(50))
    assert snapshots.remove_old(spark, path, older_than=-5) == 1
    assert _numbers(snapshots.read(spark, path, SCHEMA)) == list(range(500, 550))


def test_readers_never_meet_parts_half_way(spark):
    """Two parts change together, and a reader beside the writer only ever sees both old or both new."""
    path = shared_folder(spark, "snapshots")

    def both(turn):
        return _rows(spark, "a", 100 * turn).unionByName(_rows(spark, "b", 100 * turn + 50))

    snapshots.publish(both(0), path, "hour")
    seen, failed, stop = [], [], threading.Event()

    def look():
        while not stop.is_set() and not failed:
            try:
                seen.append(tuple(_numbers(snapshots.read(spark, path, SCHEMA))))
            except Exception as error:  # shown by the test below
                failed.append(error)

    reader = threading.Thread(target=look)
    reader.start()
    for turn in range(1, 5):
        snapshots.publish(both(turn), path, "hour")
    stop.set()
    reader.join()
    assert not failed and len(seen) > 1
    assert set(seen) <= {tuple(range(100 * turn, 100 * turn + 100)) for turn in range(5)}


def test_a_failed_write_leaves_the_old_rows(spark):
    path = shared_folder(spark, "snapshots")
    snapshots.publish(_rows(spark, "00", 0), path, "hour")
    with pytest.raises(PySparkException):
        snapshots.publish(_rows(spark, "00", 0).withColumn("n", F.raise_error(F.lit("lost")).cast("bigint")), path, "hour")
    with pytest.raises(ValueError):
        snapshots.publish(_rows(spark, "01", 0), path, "hour", ["00"])
    assert _numbers(snapshots.read(spark, path, SCHEMA)) == list(range(50))


def test_a_version_counts_once(spark):
    path = shared_folder(spark, "snapshots")
    for start in (0, 100):
        snapshots.publish(_rows(spark, "00", start), path, "hour", ["00"], version="run-1")
    assert _numbers(snapshots.read(spark, path, SCHEMA)) == list(range(50))
    snapshots.publish(_rows(spark, "00", 100), path, "hour", ["00"], version="run-2")
    assert _numbers(snapshots.read(spark, path, SCHEMA)) == list(range(100, 150))


def test_tables_beside_are_committed_with_the_rows(spark):
    path = shared_folder(spark, "snapshots")
    for start in (0, 100):
        sums = _rows(spark, "00", start).groupBy("hour").agg(F.sum("n").alias("total"))
        snapshots.publish(_rows(spark, "00", start), path, "hour", beside={"sums": sums})
        assert [r.total for r in snapshots.read(spark, path, "total bigint", name="sums").collect()] == [sum(range(start, start + 50))]


@pytest.mark.parametrize("part", ["", "a/b", "..", "_x", "a b"])
def test_names_of_parts(spark, part):
    with pytest.raises(ValueError):
        snapshots.publish(_rows(spark, "00", 0), shared_folder(spark, "snapshots"), "hour", [part])
