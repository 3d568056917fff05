"""One key with a third of all rows: adaptive execution must be free to split it."""

import pytest
from pyspark.sql import functions as F

from placelens.operators import attribution, enrichment, lookups
from placelens.operators.attribution import SLOT_KEYS, interval_join, pv_uv, slot_traffic
from placelens.operators.enrichment import priority_enrich
from placelens.operators.lookups import lookup_fallback
from placelens.operators.versions import version_intervals

SMALL = {
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "4KB",
    "spark.sql.adaptive.coalescePartitions.minPartitionSize": "1KB",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "8KB",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "false",
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
}


@pytest.fixture
def scaled_down(spark, monkeypatch):
    """The cluster's thresholds shrunk to the size of the fixtures; nothing counts as small."""
    before = {name: spark.conf.get(name, None) for name in SMALL}
    for name, value in SMALL.items():
        spark.conf.set(name, value)
    monkeypatch.setattr(attribution, "measurable", lambda df: False)
    for module in (enrichment, lookups):
        monkeypatch.setattr(module, "fits_broadcast", lambda *args, **kwargs: False)
    yield
    for name, value in before.items():
        spark.conf.unset(name) if value is None else spark.conf.set(name, value)


def final_plan(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


def third(name, others):
    """A key with a third of the rows, the rest spread over `others`."""
    return F.when(F.col("id") % 3 == 0, name).otherwise(F.concat(F.lit("k"), F.col("id") % others))


def place(df):
    return df.withColumns({"typename": F.lit("t"), "idx": F.lit("0"), "pagenum": F.lit("1")})


@pytest.fixture
def slots(spark):
    return place(spark.range(400).select(
        F.when(F.col("id") < 20, "hot").otherwise(F.concat(F.lit("k"), F.col("id"))).alias("content"),
        (F.col("id") % 20 * 50).alias("real_starttime"), (F.col("id") % 20 * 50 + 40).alias("real_endtime"),
    ))


@pytest.fixture
def log(spark):
    return place(spark.range(0, 60_000, 1, 8).select(
        third("hot", 400).alias("content"),
        F.concat(F.lit("v"), F.pmod(F.xxhash64("id"), F.lit(500))).alias("visitor"),
        (10 + F.col("id") % 2).alias("dateline"),
    ))


def test_busy_slot_is_split(slots, log, scaled_down):
    """All clicks of the slot within two seconds, so the time parts alone do not help."""
    traffic = slot_traffic(slots, {"x": log})
    assert "SortMergeJoin(skew=true)" in final_plan(traffic)
    keys = [*SLOT_KEYS, *attribution.INTERVAL]
    steps = pv_uv(interval_join(slots, log), keys, "visitor", "pv_x", "uv_x")
    assert traffic.select(*steps.columns).exceptAll(steps).count() == 0
    assert traffic.where("content = 'hot'").first()["pv_x"] == 20_000


def test_busy_lookup_key_is_split(spark, scaled_down):
    rows = spark.range(0, 60_000, 1, 8).select("id", third("hot", 300).alias("typeid"))
    names = spark.range(300).select(F.concat(F.lit("k"), "id").alias("typeid"), F.lit("n").alias("typename"))
    named = lookup_fallback(rows, names, "typeid", "typename")
    assert "SortMergeJoin(skew=true)" in final_plan(named)
    assert named.where("typename = 'hot'").count() == 20_000


def test_busy_id_is_split_in_enrichment(spark, scaled_down):
    scores = spark.range(0, 60_000, 1, 8).select(
        F.lit("d").alias("dt"), F.lit("h").alias("hour"), third("hot", 300).alias("url"), F.col("id").cast("double").alias("rate")
    )
    items = spark.range(300).select(
        F.concat(F.lit("k"), "id").alias("urlid"), F.lit("n").alias("title"), F.lit("y").alias("typepy"), F.lit("u").alias("url")
    )
    enriched = priority_enrich(scores, [items, items])
    assert "SortMergeJoin(skew=true)" in final_plan(enriched)
    assert enriched.count() == 60_000 and enriched.where("url = 'hot'").count() == 20_000


def test_copies_of_one_edit_are_split(spark, scaled_down):
    """A third of the history edits one entry at one instant."""
    edits = spark.range(0, 60_000, 1, 8).select(
        F.when(F.col("id") % 3 == 0, -1).otherwise(F.col("id")).alias("id"),
        F.col("id").alias("seq"),
        F.timestamp_seconds(F.when(F.col("id") % 3 == 0, 1_704_067_200).otherwise(1_704_067_200 + F.col("id"))).alias("modifydate"),
    ).withColumns({"starttime": F.col("modifydate"), "endtime": F.expr("modifydate + interval 1 day")})
    versions = version_intervals(edits)
    assert "SortMergeJoin(skew=true)" in final_plan(versions)
    open_copies = versions.where("id = -1 and real_endtime > real_starttime")
    assert versions.count() == 60_000 and [row["seq"] for row in open_copies.collect()] == [59_997]
