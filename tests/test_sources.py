"""Logs, text tables, positional lines, databases and message sources."""

from collections import Counter

import pytest
from pyspark.errors import AnalysisException

from placelens.sources import jdbc, logs, partitions, streams, synthetic, tsv


def test_click_log(spark):
    rows = [
        ("v1", 10, "top", 1, 2, "http://a/7.html", "20240115", "x"),
        ("null", 10, "top", 1, 2, "http://a/7.html", "20240115", "x"),
        ("", 10, "top", 1, 2, "http://a/7.html", "20240115", "x"),
        (None, 10, "top", 1, 2, "http://a/7.html", "20240115", "x"),
        ("v2", 10, "http://p", 1, 2, "http://a/7.html", "20240115", "x"),
        ("v3", 10, "top", 1, 2, "ftp://a/7.html", "20240115", "x"),
        ("v4", None, "top", 1, 2, "https://a/b?c", "20240115", "x"),
        ("v5", 10, "top", 1, 2, "http://a/7.html", "20240114", "x"),
        ("v6", 10, "top", 1, 2, "http://a/7.html", "20240115", "y"),
    ]
    table = spark.createDataFrame(
        rows, "clientime string, dateline bigint, urlfrom string, idx02 int, pgnum int, urlto string, dt string, app string"
    )
    for spread in (None, 3):
        found = {tuple(row) for row in logs.click_log(table, "20240115", spread, app="x").collect()}
        assert found == {("top", "1", "2", "7", "v1", 10), ("top", "1", "2", "https://a/b", "v4", None)}


def text_table(spark, root, lines):
    spark.createDataFrame(lines, "dt string, value string").write.partitionBy("dt").text(root)


def test_day_range(spark, tmp_path):
    root = str(tmp_path / "days")
    text_table(spark, root, [(tag, tag) for tag in ("20240225", "20240226", "20240229", "20240301", "20240302")])
    found = partitions.day_range(spark, root, "20240301")
    assert {tuple(row) for row in found.collect()} == {(tag, tag) for tag in ("20240226", "20240229", "20240301")}
    assert found.schema.simpleString() == "struct<value:string,dt:string>"
    assert partitions.day_range(spark, root, "20230101").count() == 0
    with pytest.raises(AnalysisException):
        partitions.day_range(spark, root + "-mistyped", "20240301")


def test_one_hour(spark, tmp_path):
    root = str(tmp_path / "hours")
    text_table(spark, root, [("2024011510", "1\t2.5"), ("2024011511", "1\t3.5")])
    scores = tsv.score_lines(partitions.one_hour(spark, root, "2024011510"))
    assert [tuple(row) for row in scores.collect()] == [("20240115", "10", "1", 2.5)]
    with pytest.raises(AnalysisException):
        partitions.one_hour(spark, root, "2024011512")


def lines(spark, rows):
    return spark.createDataFrame([(row,) for row in rows], "value string")


def test_catalogue_lines(spark):
    def line(url, title="t", typepy="k", more=()):
        return "\t".join(["0", url, title, *"345678", typepy, *more])

    rows = [
        line("http://a/7.html"),
        line("http://a/8.html", more=("x", "")),
        line("http://a/9.html", typepy=""),
        line("http://a/10.html", typepy="", more=("x",)),
        "\t".join(["0", "http://a/11.html", "t"]),
        line(""),
        line("x"),
        line("xy"),
        "",
    ]
    found = Counter(tuple(row) for row in tsv.catalogue_lines(lines(spark, rows), tsv.CRAWLER).collect())
    assert found == Counter([
        ("t", "k", "http://a/7.html", "7"), ("t", "k", "http://a/8.html", "8"), ("t", "", "http://a/10.html", "10"),
        ("t", "k", "", ""), ("t", "k", "xy", ""),
    ])


@pytest.mark.parametrize("layout", [tsv.VIDEO, tsv.CRAWLER, tsv.SHORT_VIDEO])
def test_layouts(spark, layout):
    cells = [f"c{n}" for n in range(layout.parts)]
    cells[layout.url] = "http://a/5.html"
    rows = ["\t".join(cells), "\t".join(cells[:-1])]
    found = [tuple(row) for row in tsv.catalogue_lines(lines(spark, rows), layout).collect()]
    assert found == [(f"c{layout.title}", f"c{layout.typepy}", "http://a/5.html", "5")]


def test_score_lines(spark):
    rows = ["1\t2.5", "2\tabc", "3\t1.5d", "4\t 1.5 ", "5", "6\t", "\t2", "7\t1\tmore"]
    found = [tuple(row) for row in tsv.score_lines(lines(spark, rows), "2024011510").orderBy("url").collect()]
    assert found == [
        ("20240115", "10", "", 2.0), ("20240115", "10", "1", 2.5), ("20240115", "10", "3", 1.5),
        ("20240115", "10", "4", 1.5), ("20240115", "10", "7", 1.0),
    ]


def test_jdbc_scan_and_query(spark):
    url = "jdbc:derby:memory:sources;create=true"
    spark.range(100).selectExpr("id", "id % 7 as part").write.jdbc(url, "numbers", mode="overwrite")
    whole = jdbc.scan(spark, url, "numbers")
    ranges = jdbc.scan(spark, url, "numbers", column="id", bounds=(0, 100), partitions=4)
    assert whole.rdd.getNumPartitions() == 1 and ranges.rdd.getNumPartitions() == 4
    assert ranges.exceptAll(whole).count() == 0 and ranges.count() == 100
    assert jdbc.bounds(spark, url, "numbers", "id") == (0, 100)
    spark.range(0).write.jdbc(url, "nothing", mode="overwrite")
    assert jdbc.bounds(spark, url, "nothing", "id") is None
    found = jdbc.query(spark, url, 'SELECT "part", COUNT(*) AS "n" FROM numbers GROUP BY "part"')
    assert {row["part"]: row["n"] for row in found.collect()} == {n: 15 if n < 2 else 14 for n in range(7)}
    plan = whole.where("part in (1, 2)")._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [*In(part" in plan


def test_kafka_options():
    assert streams.kafka_options("host:1", "a,b") == {
        "kafka.bootstrap.servers": "host:1", "subscribe": "a,b", "startingOffsets": "latest",
    }


def test_synthetic_messages(spark):
    messages = synthetic.token_messages(spark.range(5000), "id")
    found = [row["value"] for row in messages.collect()]
    assert {len(message) for message in found} == set(range(1, synthetic.LONGEST + 1))
    assert set("".join(found)) == set(synthetic.ALPHABET)
    assert found == [row["value"] for row in messages.collect()]


def test_jdbc_scan_by_quantiles(spark):
    """Nine ids in ten lie in a tenth of the range, some are NULL, one comes often: no part is twice the mean, and no row is lost."""
    url = "jdbc:derby:memory:quantiles;create=true"
    skewed = spark.range(900).selectExpr("id * 11 % 1000 as id").unionByName(spark.range(100).selectExpr("1000 + id * 90 as id"))
    skewed.unionByName(spark.range(20).selectExpr("CAST(NULL AS BIGINT) as id")).write.jdbc(url, "skewed", mode="overwrite")
    even = jdbc.scan_evenly(spark, url, "skewed", "id", partitions=8)
    sizes = [len(part) for part in even.rdd.glom().collect()]
    assert sum(sizes) == 1020 and len(sizes) == 8 and max(sizes) < 2 * 1020 / 8
    assert sorted(str(r.id) for r in even.collect()) == sorted(str(r.id) for r in jdbc.scan(spark, url, "skewed").collect())
    strided = jdbc.scan(spark, url, "skewed", column="id", bounds=(0, 10_000), partitions=8)
    assert max(len(part) for part in strided.rdd.glom().collect()) > 4 * 1020 / 8  # what equal ranges give
    spark.range(50).selectExpr("CAST(IF(id < 40, 3, id) AS BIGINT) as id").write.jdbc(url, "busy", mode="overwrite")
    assert jdbc.quantiles(spark, url, "busy", "id", 5) == [3, 40]
    assert jdbc.scan_evenly(spark, url, "busy", "id", partitions=5).count() == 50
    spark.range(0).write.jdbc(url, "empty", mode="overwrite")
    assert jdbc.scan_evenly(spark, url, "empty", "id").count() == 0


def test_range_predicates_of_dates():
    import datetime as dt

    cuts = [dt.date(2024, 1, 1), dt.date(2024, 2, 1)]
    assert jdbc.range_predicates("d", cuts, "`") == ["`d` < '2024-01-01' OR `d` IS NULL", "`d` >= '2024-01-01' AND `d` < '2024-02-01'", "`d` >= '2024-02-01'"]
    assert jdbc.range_predicates("d", []) == ["1 = 1"]
