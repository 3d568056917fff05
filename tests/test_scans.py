"""Filters and columns must reach the files."""

import pytest

from placelens.operators.attribution import interval_join
from placelens.plans.catalog import QUERIES, REPORT_DAY
from placelens.sources import logs


@pytest.fixture(scope="module")
def clicks(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("logs") / "clicks")
    rows = [(f"v{n}", n, "top", "0", "1", f"http://a/{n}.html", "app", "unused", f"2024011{n % 3}") for n in range(30)]
    schema = """clientime string, dateline bigint, urlfrom string, idx02 string, pgnum string, urlto string, app string,
      agent string, dt string"""
    spark.createDataFrame(rows, schema).write.partitionBy("dt").parquet(path)
    return spark.read.parquet(path)


def physical(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_log_scan_prunes_and_pushes(clicks, capsys):
    logs.click_log(clicks, "20240111", app="app").explain("formatted")
    plan = capsys.readouterr().out
    assert "20240111)]" in next(line for line in plan.splitlines() if line.startswith("PartitionFilters"))
    pushed = next(line for line in plan.splitlines() if line.startswith("PushedFilters"))
    for part in ("EqualTo(app,app)", "StringStartsWith(urlto,http)", "IsNotNull(clientime)", "IsNotNull(idx02)"):
        assert part in pushed
    columns = next(line for line in plan.splitlines() if line.startswith("ReadSchema"))
    assert "agent" not in columns and "dt" not in columns
    assert "Exchange" not in plan


@pytest.mark.parametrize("name", ["log_scan_day", "impression_scan_day"])
def test_registered_day_scans_prune(spark, name, capsys):
    QUERIES[name](spark, "/root/testdata/sf0.001").explain("formatted")
    plan = capsys.readouterr().out
    assert f"{REPORT_DAY})]" in next(line for line in plan.splitlines() if line.startswith("PartitionFilters"))


def test_url_pattern_runs_once_per_row(spark, clicks):
    """The join must not test the URL key for NULL below the projection that computes it."""
    slots = spark.createDataFrame(
        [("top", "0", "1", "4", 0, 9)],
        "typename string, idx string, pagenum string, content string, real_starttime bigint, real_endtime bigint",
    )
    joined = interval_join(slots, logs.click_log(clicks))
    assert physical(joined).count("regexp_extract(") == 1
    assert [row["visitor"] for row in joined.collect()] == ["v4"]


def test_repartition_only_on_request(clicks):
    assert "Exchange" not in physical(logs.click_log(clicks))
    assert "Exchange RoundRobinPartitioning(7)" in physical(logs.click_log(clicks, partitions=7))
