"""Stateful traffic and the ledger of micro-batches, with late rows, restarts and failures."""

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from placelens.operators.tokens import token_count
from placelens.session import shared_folder
from placelens.sinks import snapshots
from placelens.sources.streams import file_messages, kafka_rows
from placelens.streaming import ledger, traffic

LOG = "typename string, idx string, pagenum string, content string, visitor string, dateline bigint"


def _arrive(spark, path, rows):
    spark.createDataFrame([("t", "0", "1", c, v, at) for c, v, at in rows], LOG).coalesce(1).write.mode("append").parquet(path)


def test_windows_with_late_rows_and_a_restart(spark):
    source, state, out = (shared_folder(spark, name) for name in ("in", "state", "out"))

    def run():
        totals = traffic.windowed_traffic(spark.readStream.schema(LOG).parquet(source), ["content"], delay="10 minutes")
        traffic.run(totals, out, state).awaitTermination()
        return {(r.from_second, r.content): (r.pv, r.uv) for r in snapshots.read(spark, out, totals.schema).collect()}

    _arrive(spark, source, [("a", "v1", 5), ("a", "v1", 10), ("a", "v2", 599), ("b", "v1", 30), ("a", "v1", 1500)])
    first = {(0, "a"): (3, 2), (0, "b"): (1, 1)}
    assert run() == first  # 1500 - 600 has passed 600
    # Too late for the first window, in time for the second and third; v1 comes again in the third after a restart.
    _arrive(spark, source, [("a", "v9", 20), ("b", "v3", 700), ("a", "v1", 1600), ("a", "v4", 1700), ("z", "v1", 9000)])
    second = first | {(600, "b"): (1, 1), (1200, "a"): (3, 2)}
    assert run() == second
    assert run() == second  # nothing new, nothing twice


def test_the_ledger_after_a_failure_before_the_commit(spark, monkeypatch):
    """The write is done and the commit fails; the batch is repeated and every message counts once."""
    source, out, offsets = (shared_folder(spark, name) for name in ("in", "out", "offsets"))

    def arrive(*messages):
        spark.createDataFrame([(m,) for m in messages], "body string").coalesce(1).write.mode("append").parquet(source)

    def run():
        stream = file_messages(spark, source, "body string", "body", positions=True, maxFilesPerTrigger="1")
        ledger.start(stream, token_count, out, offsets).awaitTermination()

    def totals():
        rows = ledger.results(spark, out, "token string, n bigint").groupBy("token").agg(F.sum("n").alias("n"))
        return {r.token: r.n for r in rows.collect()}

    arrive("a b", "a")
    run()
    arrive("b c")
    real = snapshots._commit
    monkeypatch.setattr(snapshots, "_commit", lambda *some: (_ for _ in ()).throw(OSError("lost")))
    with pytest.raises(StreamingQueryException):
        run()
    assert totals() == {"a": 2, "b": 1}
    monkeypatch.setattr(snapshots, "_commit", real)
    run()
    run()
    assert totals() == {"a": 2, "b": 2, "c": 1}
    entries = ledger.entries(spark, out).orderBy("batch").collect()
    assert [(r.batch, r.first, r.last, r.messages) for r in entries] == [("batch-000000000000", 0, 1, 2), ("batch-000000000001", 0, 0, 1)]
    assert len({r.source for r in entries}) == 2


def test_the_ledger_after_a_failure_behind_the_commit(spark):
    """The batch is seen again although it was committed: it is skipped, whatever it holds."""
    out = shared_folder(spark, "out")
    batch = spark.createDataFrame([("f", 0, "a b"), ("f", 1, "a")], "source string, position bigint, value string")
    assert ledger.commit(batch, token_count, out, 7)
    assert not ledger.commit(batch, token_count, out, 7)
    assert {r.token: r.n for r in ledger.results(spark, out, "token string, n bigint").collect()} == {"a": 2, "b": 1}
    assert not ledger.commit(batch.limit(0), token_count, out, 7)


def test_positions_of_kafka_rows(spark):
    rows = spark.createDataFrame([(b"k", b"v w", "t", 3, 17), (None, None, "t", 0, 2)], "key binary, value binary, topic string, partition int, offset bigint")
    found = [tuple(r) for r in kafka_rows(rows, positions=True).collect()]
    assert found == [("k", "v w", "t-3", 17), (None, None, "t-0", 2)]
    assert kafka_rows(rows).columns == ["key", "value"]
