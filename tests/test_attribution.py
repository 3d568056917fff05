"""Interval joins, traffic counts and the report on small fixtures, in every join form."""

from collections import Counter

import pytest
from pyspark.sql import functions as F

from placelens.operators import attribution
from placelens.operators.attribution import interval_join, pv_uv, slot_report, slot_traffic

SLOTS = "typename string, idx string, pagenum string, content string, real_starttime bigint, real_endtime bigint, n int"
LOG = "typename string, idx string, pagenum string, content string, visitor string, dateline bigint"


def slots(spark, rows):
    return spark.createDataFrame([("t", "0", "1", content, lo, hi, n) for content, lo, hi, n in rows], SLOTS)


def log(spark, rows):
    return spark.createDataFrame([("t", "0", "1", content, visitor, at) for content, visitor, at in rows], LOG)


@pytest.fixture(params=["broadcast", "merge"])
def form(request, monkeypatch):
    """Run a test with slots that fit a broadcast and with slots that do not."""
    if request.param == "merge":
        monkeypatch.setattr(attribution, "measurable", lambda df: False)
    return request.param


CASES = [("a", 100, 200, 1), ("a", 200, 300, 2), ("a", 250, 240, 3), ("b", 100, 100, 4), (None, 100, 200, 5), ("a", 100, 200, 6)]
HITS = [
    ("a", "start", 100), ("a", "meet", 200), ("a", "end", 300), ("a", "before", 99), ("a", "after", 301), ("a", "inverted", 245),
    ("b", "point", 100), ("b", "off", 101), (None, "nokey", 150), ("a", "notime", None), ("c", "nowhere", 150),
]


def test_interval_join(spark, form):
    joined = interval_join(slots(spark, CASES), log(spark, HITS))
    found = Counter((row["n"], row["visitor"]) for row in joined.collect())
    assert found == Counter({
        (1, "start"): 1, (6, "start"): 1, (1, "meet"): 1, (6, "meet"): 1, (2, "meet"): 1,
        (2, "end"): 1, (2, "inverted"): 1, (4, "point"): 1,
    })


def test_right_open_counts_a_shared_second_once(spark, form):
    joined = interval_join(slots(spark, CASES), log(spark, HITS), right_open=True)
    assert Counter(row["n"] for row in joined.where("visitor = 'meet'").collect()) == Counter({2: 1})


@pytest.mark.parametrize("span", [None, (0, 10), (150, 160), (10_000, 20_000), (100, 100)])
@pytest.mark.parametrize("slices", [1, 3, 32])
def test_span_and_slices_never_change_the_result(spark, span, slices):
    rows = [("a", n * 3, n * 3 + n % 40, n) for n in range(100)] + [("a", 0, 4_000_000_000, 1000)]
    hits = [("a", f"v{n}", n * 7 % 331) for n in range(200)]
    expected = Counter(
        (n, visitor) for _, lo, hi, n in rows for _, visitor, at in hits if lo <= at <= hi
    )
    joined = interval_join(slots(spark, rows), log(spark, hits), span=span, slices=slices)
    assert Counter((row["n"], row["visitor"]) for row in joined.collect()) == expected


def test_empty_log(spark, form):
    assert interval_join(slots(spark, CASES), log(spark, [])).count() == 0


def test_long_slots_are_repeated_at_most_once_per_slice(spark):
    forever = slots(spark, [("a", -(10**12), 10**12, n) for n in range(10)])
    joined = interval_join(forever, log(spark, [("a", "v", 0), ("a", "v", 10**9)]), broadcast_bytes=0)
    assert joined.count() == 20


def test_pv_uv(spark):
    rows = log(spark, [("a", "v1", 1), ("a", "v1", 2), ("a", "v2", 3), ("b", "v1", 1)])
    found = {row["content"]: (row["pv"], row["uv"]) for row in pv_uv(rows, ["content"], "visitor", "pv", "uv").collect()}
    assert found == {"a": (3, 2), "b": (1, 1)}


def test_traffic_and_report(spark, form):
    """Copies of a slot double its page views, not its visitors; slots without traffic stay."""
    table = slots(spark, CASES)
    clicks = log(spark, [("a", "v1", 100), ("a", "v1", 100), ("a", "v2", 150), ("a", "v1", 200), ("b", "v9", 100)])
    views = log(spark, [("a", "v1", 250), ("a", "v3", 250)])
    report = slot_report(table, slot_traffic(table, {"active": clicks, "show": views}))
    found = {
        row["n"]: (row["pv_active"], row["uv_active"], row["pv_show"], row["uv_show"]) for row in report.collect()
    }
    assert found == {
        1: (8, 2, None, None), 6: (8, 2, None, None), 2: (1, 1, 2, 2), 3: (None,) * 4, 4: (1, 1, None, None), 5: (None,) * 4,
    }


def test_traffic_equals_the_separate_steps(spark, form):
    """One pass over stacked logs gives what join, count and count again give per log."""
    rows = spark.range(300).select(
        F.lit("t").alias("typename"), F.lit("0").alias("idx"), F.lit("1").alias("pagenum"),
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("c"), F.col("id") % 20)).alias("content"),
        (F.col("id") % 50 * 10).alias("real_starttime"), (F.col("id") % 50 * 10 + F.col("id") % 90).alias("real_endtime"),
        F.col("id").cast("int").alias("n"),
    )
    hits = spark.range(3000).select(
        F.lit("t").alias("typename"), F.lit("0").alias("idx"), F.lit("1").alias("pagenum"),
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("c"), F.col("id") % 25)).alias("content"),
        F.concat(F.lit("v"), F.pmod(F.xxhash64("id"), F.lit(40))).alias("visitor"),
        F.pmod(F.xxhash64(F.lit(1), "id"), F.lit(600)).alias("dateline"),
    )
    keys = [*attribution.SLOT_KEYS, *attribution.INTERVAL]
    traffic = slot_traffic(rows, {"x": hits, "y": hits.where("dateline > 300")})
    for name, part in (("x", hits), ("y", hits.where("dateline > 300"))):
        ours = traffic.where(f"pv_{name} is not null").select(*keys, f"pv_{name}", f"uv_{name}")
        steps = pv_uv(interval_join(rows, part), keys, "visitor", f"pv_{name}", f"uv_{name}")
        assert ours.exceptAll(steps).count() == 0 and steps.exceptAll(ours).count() == 0
        assert ours.where(f"uv_{name} < 1 or pv_{name} < uv_{name}").count() == 0


def test_plans_have_no_nested_loops(spark, form):
    joined = interval_join(slots(spark, CASES), log(spark, HITS))
    plan = joined._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan
    assert ("SortMergeJoin" in plan) == (form == "merge")


def test_busy_keys_get_more_parts(spark):
    """The number of parts follows from the versions of the busiest key, unless slots would repeat too often."""
    short = spark.range(5000).selectExpr(
        "if(id < 1000, 'hot', concat('k', id)) as content", "id * 100 as real_starttime", "id * 100 + 90 as real_endtime"
    )
    assert attribution._measured(short, ["content"], "real_starttime", "real_endtime", None, None)[2] == 32
    busy = short.withColumn("content", F.lit("hot"))
    assert attribution._measured(busy, ["content"], "real_starttime", "real_endtime", None, None)[2] == 128
    lasting = busy.withColumn("real_endtime", F.lit(500_000).cast("bigint"))
    assert attribution._measured(lasting, ["content"], "real_starttime", "real_endtime", None, None)[2] == 32
