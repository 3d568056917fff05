"""Per-batch token counts."""

from collections import Counter

import pytest

from placelens.jobs import tokens as tokens_job
from placelens.operators.tokens import token_count
from placelens.sources.streams import file_messages
from placelens.streaming import tokens


def counts(df):
    return {row["token"]: row["n"] for row in df.collect()}


def test_token_count(spark):
    rows = spark.createDataFrame([("a b  a",), (" b ",), ("   ",), ("",), (None,)], "value string")
    assert counts(token_count(rows)) == {"a": 2, "b": 2, "": 3}


def test_batches_are_counted_separately(spark, tmp_path):
    source, out, offsets = (str(tmp_path / name) for name in ("in", "out", "offsets"))

    def arrive(*messages):
        spark.createDataFrame([(m,) for m in messages], "body string").coalesce(1).write.mode("append").parquet(source)

    def run():
        stream = file_messages(spark, source, "body string", "body", maxFilesPerTrigger="1")
        tokens.start(stream, tokens.batch_files(out), offsets, trigger=None).awaitTermination()

    arrive("a b  a")
    run()
    arrive("a", " b ")
    run()
    run()
    batches = spark.read.schema("token string, n bigint, batch_id int").parquet(out)
    found = {n: counts(batches.where(f"batch_id = {n}")) for n in (0, 1)}
    assert found == {0: {"a": 2, "b": 1, "": 1}, 1: {"a": 1, "b": 1, "": 1}}
    assert Counter(row["batch_id"] for row in batches.collect()) == {0: 3, 1: 3}


def test_repeated_batch_replaces_itself(spark, tmp_path):
    write = tokens.batch_files(str(tmp_path / "out"))
    batch = token_count(spark.createDataFrame([("x y",)], "value string"))
    for _ in range(2):
        write(batch, 4)
    assert spark.read.parquet(str(tmp_path / "out")).count() == 2


def test_show_prints_the_batch(spark, capfd):
    tokens.show(1)(token_count(spark.createDataFrame([("x y",)], "value string")), 3)
    out = capfd.readouterr().out
    assert "batch 3" in out and "only showing top 1 row" in out


def test_the_job_keeps_every_pair_unless_told_to_show(spark, tmp_path):
    given = ["--servers", "h:1", "--topics", "t", "--checkpoint", "c"]
    for bad in ([], ["--output", "o", "--show", "3"]):
        with pytest.raises(SystemExit):
            tokens_job.sink(tokens_job.parser().parse_args([*given, *bad]))
    out = str(tmp_path / "out")
    sink = tokens_job.sink(tokens_job.parser().parse_args([*given, "--output", out]))
    sink(token_count(spark.createDataFrame([(" ".join(f"t{n}" for n in range(500)),)], "value string")), 0)
    assert spark.read.parquet(out).count() == 500


def test_timed_batches(spark, tmp_path):
    """The pace of a live run, ended by hand once the waiting files are counted."""
    source, out = str(tmp_path / "in"), str(tmp_path / "out")
    spark.createDataFrame([("a b a",)], "body string").write.parquet(source)
    stream = file_messages(spark, source, "body string", "body")
    run = tokens.start(stream, tokens.batch_files(out), str(tmp_path / "offsets"))
    try:
        run.processAllAvailable()
    finally:
        run.stop()
    assert counts(spark.read.schema("token string, n bigint").parquet(out)) == {"a": 2, "b": 1}


def test_stream_equals_batch(spark, tmp_path):
    messages = spark.range(2000).selectExpr("concat_ws(' ', id % 7, id % 3, '', id % 11) as body")
    messages.write.parquet(str(tmp_path / "in"))
    stream = file_messages(spark, str(tmp_path / "in"), "body string", "body")
    tokens.start(stream, tokens.batch_files(str(tmp_path / "out")), str(tmp_path / "offsets"), trigger=None).awaitTermination()
    assert counts(spark.read.schema("token string, n bigint").parquet(str(tmp_path / "out"))) == counts(token_count(messages, "body"))
