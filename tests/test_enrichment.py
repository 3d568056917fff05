"""Lookups and the priority order of catalogues."""

from collections import Counter

import pytest
from pyspark.sql import functions as F

from placelens.operators import enrichment
from placelens.operators.enrichment import priority_enrich
from placelens.operators.joins import fits_broadcast, repeat_rows
from placelens.operators.lookups import lookup_fallback, resolve_rooms

SCORES = "dt string, hour string, url string, rate double"
ITEM = "urlid string, title string, typepy string, url string"


@pytest.fixture(params=["broadcast", "merge"])
def form(request, monkeypatch):
    if request.param == "merge":
        monkeypatch.setattr(enrichment, "fits_broadcast", lambda *args, **kwargs: False)
    return request.param


def scores(spark, ids):
    return spark.createDataFrame([("20240115", "10", key, float(n)) for n, key in enumerate(ids)], SCORES)


def catalogue(spark, name, rows):
    return spark.createDataFrame([(key, title, name, f"{name}/{key}") for key, title in rows], ITEM)


def found(df):
    return Counter((row["rate"], row["title"], row["type1"], row["url"]) for row in df.collect())


def test_priority(spark, form):
    crawler = catalogue(spark, "c", [("1", "c1"), ("4", None), ("", "c-empty")])
    video = catalogue(spark, "b", [("1", "b1"), ("2", "b2"), ("4", "b4")])
    short = catalogue(spark, "d", [("1", "d1"), ("2", "d2"), ("3", "d3")])
    result = priority_enrich(scores(spark, ["1", "2", "3", "4", "5", "", None]), [crawler, video, short])
    assert result.columns == ["dt", "hour", "title", "type1", "url", "rate"]
    expected = Counter([
        (0.0, "c1", "c", "c/1"), (1.0, "b2", "b", "b/2"), (2.0, "d3", "d", "d/3"), (3.0, None, "c", "c/4"),
        (4.0, None, None, "5"), (5.0, None, None, ""), (6.0, None, None, None),
    ])
    assert found(result) == expected
    result = priority_enrich(scores(spark, ["1", "2", "3", "4", "5", "", None]), [crawler, video, short], keep_empty=True)
    assert found(result) == expected - Counter([(5.0, None, None, "")]) + Counter([(5.0, "c-empty", "c", "c/")])


def test_rows_without_an_id_do_not_multiply(spark, form):
    parts = [catalogue(spark, name, [("", f"{name}{n}") for n in range(rows)]) for name, rows in (("c", 20), ("b", 10), ("d", 5))]
    one = scores(spark, [""])
    assert priority_enrich(one, parts).count() == 1
    assert priority_enrich(one, parts, keep_empty=True).count() == 20 * 10 * 5


def test_repeated_ids_multiply(spark, form):
    """As three left joins would: each winner once per combination of the other catalogues' rows."""
    crawler = catalogue(spark, "c", [("1", "x"), ("1", "y")])
    video = catalogue(spark, "b", [("1", "b")] * 3 + [("2", "b")] * 2)
    short = catalogue(spark, "d", [("1", "d")] * 2 + [("2", "d")] * 5)
    inputs = scores(spark, ["1", "2"])
    assert found(priority_enrich(inputs, [crawler, video, short])) == Counter({
        (0.0, "x", "c", "c/1"): 6, (0.0, "y", "c", "c/1"): 6, (1.0, "b", "b", "b/2"): 10,
    })
    assert found(priority_enrich(inputs, [crawler, video, short], dedup=True)) == Counter({
        (0.0, "x", "c", "c/1"): 1, (1.0, "b", "b", "b/2"): 1,
    })


def test_repeat_rows(spark):
    rows = spark.createDataFrame([(1,), (3,), (4,), (5,), (8,), (9,)], "n bigint")
    for step in (1, 4, 4096):
        found = Counter(row["n"] for row in repeat_rows(rows, F.col("n"), step).collect())
        assert found == Counter({n: n for n in (1, 3, 4, 5, 8, 9)})


def test_copies_and_busy_ids(spark, form):
    """A third of all scores and catalogue rows under one id, copies included: as three left joins."""
    ids = F.when(F.col("id") % 3 == 0, "0").otherwise((F.col("id") % 17).cast("string"))
    many = spark.range(60).select(F.lit("20240115").alias("dt"), F.lit("10").alias("hour"), ids.alias("url"), (F.col("id") % 2).cast("double").alias("rate"))
    parts = [
        spark.range(rows).select(ids.alias("urlid"), F.lit(name).alias("title"), F.lit(name).alias("typepy"), F.concat(F.lit(name), F.col("id") % 2).alias("url"))
        for name, rows in (("c", 9), ("b", 12), ("d", 30))
    ]
    c, b, d = (part.select(*(F.col(n).alias(f"{letter}_{n}") for n in part.columns)) for letter, part in zip("cbd", parts, strict=True))
    plain = many.join(b, many.url == b.b_urlid, "left").join(c, many.url == c.c_urlid, "left").join(d, many.url == d.d_urlid, "left")

    def pick(name, otherwise):
        return F.when(F.col("c_urlid").isNotNull(), F.col(f"c_{name}")).when(F.col("b_urlid").isNotNull(), F.col(f"b_{name}")).when(
            F.col("d_urlid").isNotNull(), F.col(f"d_{name}")).otherwise(otherwise)

    expected = plain.select("dt", "hour", pick("title", None).alias("title"), pick("typepy", None).alias("type1"), pick("url", F.col("url")).alias("link"), "rate")
    ours = priority_enrich(many, parts)
    assert ours.exceptAll(expected).count() == 0 and expected.exceptAll(ours).count() == 0


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_lookups_are_measured(spark):
    """A database table has no size; counted, its few rows are broadcast. What can't be measured is not."""
    url = "jdbc:derby:memory:lookups;create=true"
    names = spark.createDataFrame([("a", "first")], "typeid string, typename string")
    names.write.option("createTableColumnTypes", "typeid VARCHAR(9), typename VARCHAR(9)").jdbc(url, "names", mode="overwrite")
    rows = spark.range(10).select(F.concat(F.lit("a"), F.col("id").cast("string")).alias("typeid"))
    assert "BroadcastHashJoin" in plan(lookup_fallback(rows, spark.read.jdbc(url, "names"), "typeid", "typename"))
    lists = spark.createDataFrame([("a", ["x"])], "typeid string, typename array<string>")
    assert not fits_broadcast(lists)
    assert fits_broadcast(names) and not fits_broadcast(names, limit=40)


def test_lookup_fallback(spark):
    rows = spark.createDataFrame([(1, "a"), (2, "b"), (3, None)], "n int, typeid string")
    names = spark.createDataFrame([("a", "first"), ("a", "second"), ("c", "other")], "typeid string, typename string")
    repeated = lookup_fallback(rows, names, "typeid", "typename")
    assert Counter((row["n"], row["typename"]) for row in repeated.collect()) == Counter(
        [(1, "first"), (1, "second"), (2, "b"), (3, None)]
    )
    single = lookup_fallback(rows, names, "typeid", "typename", dedup=True)
    assert sorted((row["n"], row["typename"]) for row in single.where("n < 3").collect()) == [(1, "first"), (2, "b")]


def test_resolve_rooms(spark):
    rows = [(1, "room1"), (2, "https://m.example/160120110929839111.html"), (3, "https://m.example/12.html"), (4, None), (5, "room9")]
    slots = spark.createDataFrame(rows, "n int, content string")
    rooms = spark.createDataFrame([("room1", "http://live/1.flv"), ("room9", None)], "roomkey string, flvurl string")
    result = {row["n"]: (row["content"], row["url"]) for row in resolve_rooms(slots, rooms).collect()}
    assert result == {
        1: ("http://live/1.flv", "http://live/1.flv"),
        2: ("160120110929839111", "https://m.example/160120110929839111.html"),
        3: ("", "https://m.example/12.html"),
        4: (None, None),
        5: ("", "room9"),
    }
