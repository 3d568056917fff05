"""Every registered query: name -> (spark, sf_dir) -> DataFrame."""

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from placelens.functions import dates, text, urls
from placelens.operators import attribution, enrichment, increments, interval_store, lookups, ranking, tokens, versions
from placelens.plans import inputs
from placelens.plans.attribution import PAGE_SOURCETYPES, VIDEO_SOURCETYPES, attribution_report, slot_table
from placelens.plans.scoring import ScoreInputs, score_enrichment
from placelens.session import shared_folder, single_machine, written
from placelens.sinks import jdbc as jdbc_sink
from placelens.sinks import snapshots
from placelens.sinks import tables as table_sink
from placelens.sources import jdbc, logs, partitions, streams, synthetic, tsv
from placelens.streaming import ledger
from placelens.streaming import tokens as token_stream
from placelens.streaming import traffic as stream_traffic

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

TABLES = [
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
]
REPORT_DAY, LATER_DAY = "20240115", "20240116"
SCORE_RUN = "2024010100"
JDBC_URL_SETTING = "spark.placelens.jdbc.url"


def query(function: Query) -> Query:
    QUERIES[function.__name__.rstrip("_")] = function
    return function


# --- placement attribution -------------------------------------------------------------------------


def _histories(spark, sf_dir):
    return [
        logs.position_history(inputs.history(spark, sf_dir, "signup"), PAGE_SOURCETYPES, apptypeid="main"),
        logs.position_history(inputs.history(spark, sf_dir, "purchase"), VIDEO_SOURCETYPES, apptypeid="main"),
    ]


def _rooms(spark, sf_dir, day=None):
    return logs.live_rooms(inputs.room_table(spark, sf_dir), day, appid="BUILDING")


_prepared: dict[tuple[str, str, str], str] = {}


def prepared(spark: SparkSession, sf_dir: str, name: str, write: Callable[[str], None]) -> str:
    """The folder of an input in the form it is kept in, written by the first query of a session that needs it."""
    key = (spark.sparkContext.applicationId, sf_dir, name)
    if key not in _prepared:
        path = shared_folder(spark, name)
        write(path)
        _prepared[key] = path
    return _prepared[key]


def _by_day(table, sf_dir, name):
    """The table as it is kept: in one folder per `dt`."""
    spark, balanced = table.sparkSession, table.hint("rebalance", F.col("dt"))
    path = prepared(spark, sf_dir, name, lambda folder: balanced.write.partitionBy("dt").parquet(folder))
    return spark.read.schema(table.schema).parquet(path)


def _lines_by_tag(lines, sf_dir, name):
    """The folder of lines of text as they are kept: in one folder per `dt`."""
    balanced = lines.hint("rebalance", F.col("dt"))
    return prepared(lines.sparkSession, sf_dir, name, lambda folder: balanced.write.partitionBy("dt").text(folder))


def _slots(spark, sf_dir):
    return slot_table(_histories(spark, sf_dir), inputs.types(spark, sf_dir), _rooms(spark, sf_dir))


def _clicks(spark, sf_dir, day=None, **options):
    table = inputs.click_table(spark, sf_dir)
    return logs.click_log(_by_day(table, sf_dir, "clicks") if day else table, day, apptypeid="main", suptop="0001", **options)


def _views(spark, sf_dir, day=None):
    table = inputs.view_table(spark, sf_dir)
    return logs.view_log(_by_day(table, sf_dir, "views") if day else table, day, domain="main", newstag="0001")


def _report(spark, sf_dir, day=None):
    return attribution_report(
        _histories(spark, sf_dir),
        inputs.types(spark, sf_dir),
        _rooms(spark, sf_dir, day),
        _clicks(spark, sf_dir, day),
        _views(spark, sf_dir, day),
        day,
    )


@query
def attribution_report_(spark, sf_dir):
    return _report(spark, sf_dir)


@query
def attribution_report_day(spark, sf_dir):
    return _report(spark, sf_dir, REPORT_DAY)


VERSION_COLUMNS = ["id", "seq", "title", "modifydate", "real_starttime", "real_endtime", "real_startdate", "real_enddate"]


def _versions(spark, sf_dir, event_type="signup"):
    return versions.drop_tombstones(versions.version_intervals(inputs.history(spark, sf_dir, event_type)))


@query
def version_intervals(spark, sf_dir):
    return _versions(spark, sf_dir).select(*VERSION_COLUMNS)


@query
def version_intervals_day(spark, sf_dir):
    return versions.started_on(_versions(spark, sf_dir), REPORT_DAY).select(*VERSION_COLUMNS)


@query
def version_intervals_orders(spark, sf_dir):
    """Orders as versions of a customer; many share one instant."""
    orders = inputs.table(spark, sf_dir, "orders").select(
        F.col("o_custkey").alias("id"),
        F.col("o_orderkey").alias("seq"),
        F.col("o_orderdate").alias("modifydate"),
        F.col("o_orderdate").alias("starttime"),
        (F.col("o_orderdate") + F.make_dt_interval(days=F.length("o_orderpriority") * 30)).alias("endtime"),
    )
    return versions.version_intervals(orders).select("id", "seq", "real_starttime", "real_endtime")


@query
def version_intervals_merge(spark, sf_dir):
    """The intervals of all edits, merged day by day into a table: first all but two days, then the later, then the earlier and both again."""
    edits = written(inputs.history(spark, sf_dir), "edits")
    store = interval_store.IntervalStore(spark, shared_folder(spark, "intervals"), edits.schema)
    day = dates.day_tag("modifydate")
    late = [REPORT_DAY, LATER_DAY]
    for part in (edits.where(~day.isin(late)), edits.where(day == LATER_DAY), edits.where(day.isin(late))):
        store.merge(part)
    return versions.drop_tombstones(store.read()).select(*VERSION_COLUMNS)


@query
def explode_types(spark, sf_dir):
    return versions.explode_list(inputs.history(spark, sf_dir)).select("id", "seq", "newstype", "typeid")


@query
def union_histories(spark, sf_dir):
    sources = (inputs.history(spark, sf_dir, event_type) for event_type in ("signup", "purchase"))
    intervals = versions.version_intervals(versions.union_histories(*sources), ["source", "id"])
    return versions.drop_tombstones(intervals).select("id", "seq", "real_starttime", "real_endtime")


@query
def filter_in_list(spark, sf_dir):
    first, second = _histories(spark, sf_dir)
    return first.unionByName(second).select("id", "seq", "sourcetype", "apptypeid")


@query
def lookup_fallback(spark, sf_dir):
    documents = inputs.table(spark, sf_dir, "documents").select("doc_id", F.col("doc_id").cast("string").alias("key"), "lang")
    quality = inputs.table(spark, sf_dir, "labels").select(
        F.col("doc_id").cast("string").alias("key"),
        F.concat(F.lit("quality-"), F.col("quality").cast("string")).alias("name"),
    )
    return lookups.lookup_fallback(documents, quality, "key", "name")


@query
def lookup_types(spark, sf_dir):
    exploded = versions.explode_list(inputs.history(spark, sf_dir)).select("seq", "typeid")
    return lookups.lookup_fallback(exploded, inputs.types(spark, sf_dir), "typeid", "typename")


@query
def lookup_filtered_subquery(spark, sf_dir):
    history = inputs.history(spark, sf_dir).select("id", "seq", urls.strip_query(F.col("content")).alias("content"))
    return lookups.resolve_rooms(history, _rooms(spark, sf_dir)).select("id", "seq", "content", "url")


@query
def log_scan_filtered(spark, sf_dir):
    return _clicks(spark, sf_dir)


@query
def impression_scan_keyed(spark, sf_dir):
    return _views(spark, sf_dir)


@query
def log_scan_day(spark, sf_dir):
    """One day of the click log, which is kept by day."""
    return _clicks(spark, sf_dir, REPORT_DAY)


@query
def impression_scan_day(spark, sf_dir):
    return _views(spark, sf_dir, REPORT_DAY)


@query
def log_scan_offset_key(spark, sf_dir):
    """Clicks whose URLs without an id have the empty key."""
    return _clicks(spark, sf_dir, key=urls.url_key_offset)


@query
def filter_sentinel(spark, sf_dir):
    raw = inputs.click_table(spark, sf_dir)
    return raw.where(text.is_present(F.col("clientime"))).select("clientime", "dateline")


JOIN_COLUMNS = [*attribution.SLOT_KEYS, *attribution.INTERVAL, "visitor", "dateline"]


def _attributed_clicks(spark, sf_dir):
    return attribution.interval_join(written(_slots(spark, sf_dir), "slots"), _clicks(spark, sf_dir))


def _attributed_views(spark, sf_dir):
    return attribution.interval_join(written(_slots(spark, sf_dir), "slots"), _views(spark, sf_dir))


@query
def interval_join_clicks(spark, sf_dir):
    return _attributed_clicks(spark, sf_dir).select(*JOIN_COLUMNS)


@query
def interval_join_views(spark, sf_dir):
    return _attributed_views(spark, sf_dir).select(*JOIN_COLUMNS)


@query
def pv_uv_clicks(spark, sf_dir):
    keys = [*attribution.SLOT_KEYS, *attribution.INTERVAL]
    return attribution.pv_uv(_attributed_clicks(spark, sf_dir), keys, "visitor", "pv_active", "uv_active")


@query
def pv_uv_views(spark, sf_dir):
    keys = [*attribution.SLOT_KEYS, *attribution.INTERVAL]
    return attribution.pv_uv(_attributed_views(spark, sf_dir), keys, "visitor", "pv_show", "uv_show")


@query
def pv_uv_slot_total(spark, sf_dir):
    return attribution.pv_uv(_attributed_clicks(spark, sf_dir), attribution.SLOT_KEYS, "visitor", "pv_active", "uv_active")


@query
def pv_uv_increments(spark, sf_dir):
    """The report day in three runs, of which one is delivered twice, merged."""
    slots, seconds = written(_slots(spark, sf_dir), "slots"), 8 * 3600
    clicks = logs.click_log(inputs.click_table(spark, sf_dir), REPORT_DAY, apptypeid="main", suptop="0001")
    views = logs.view_log(inputs.view_table(spark, sf_dir), REPORT_DAY, domain="main", newstag="0001")
    path = shared_folder(spark, "increments")
    first, second, last = increments.runs_of(REPORT_DAY, seconds)
    for run in (first, second, second, last):
        increments.deliver(path, slots, {"active": clicks, "show": views}, run, seconds=seconds)
    return increments.day_traffic(spark, path, REPORT_DAY, ["active", "show"])


# --- score enrichment ------------------------------------------------------------------------------


def _keyed_catalogues(spark, sf_dir):
    """Each catalogue is keyed once and kept as a table, as the pipeline does."""
    return [
        written(catalogue.withColumn("urlid", urls.url_key_offset(F.col("url"))), "catalogue")
        for catalogue in inputs.catalogues(spark, sf_dir)
    ]


@query
def priority_enrichment(spark, sf_dir):
    return enrichment.priority_enrich(inputs.scores(spark, sf_dir), _keyed_catalogues(spark, sf_dir))


@query
def priority_enrichment_dedup(spark, sf_dir):
    return enrichment.priority_enrich(inputs.scores(spark, sf_dir), _keyed_catalogues(spark, sf_dir), dedup=True)


@query
def tsv_positional_parse(spark, sf_dir):
    return tsv.catalogue_lines(inputs.part_text(spark, sf_dir), tsv.CRAWLER)


@query
def tsv_score_parse(spark, sf_dir):
    return tsv.score_lines(inputs.score_text(spark, sf_dir))


def _text_table(spark, sf_dir, tag_format):
    """Write all events as lines `id <tab> value` in one folder per tag."""
    lines = inputs.events(spark, sf_dir).select(
        F.concat_ws("\t", F.col("event_id").cast("string"), F.col("value").cast("string")).alias("value"),
        F.date_format("ts", tag_format).alias("dt"),
    )
    return _lines_by_tag(lines, sf_dir, f"lines-{tag_format}")


@query
def partition_range_scan(spark, sf_dir):
    """The report day and the four days before it, next to a range that has no folders at all."""
    root = _text_table(spark, sf_dir, "yyyyMMdd")
    return partitions.day_range(spark, root, REPORT_DAY).unionByName(partitions.day_range(spark, root, "20230115"))


@query
def hour_partition_scan(spark, sf_dir):
    root = _text_table(spark, sf_dir, "yyyyMMddHH")
    return tsv.score_lines(partitions.one_hour(spark, root, SCORE_RUN), SCORE_RUN)


@query
def replace_partition_sink(spark, sf_dir):
    """All day-hours are written, then one day twice more with other rates; the rest must survive."""
    path = shared_folder(spark, "result")
    rows = inputs.scores(spark, sf_dir).select(
        "dt", "hour", F.lit("score").alias("urltype"), "url", F.concat(F.lit("title "), F.col("url")).alias("title"), "rate"
    )
    changed = rows.where(F.col("dt") == REPORT_DAY).withColumn("rate", F.col("rate") + 1)
    for part in (rows, changed, changed):
        table_sink.replace_parts(part, path)
    return spark.read.schema(rows.schema).parquet(path).select(*table_sink.RESULT_COLUMNS)


@query
def snapshot_replace_sink(spark, sf_dir):
    """The same replacements by snapshots; a reader opened before the last one counts the rows it began with."""
    path = shared_folder(spark, "snapshots")
    rows = inputs.scores(spark, sf_dir).select(
        "hour", F.lit("score").alias("urltype"), "url", F.concat(F.lit("title "), F.col("url")).alias("title"), "rate", "dt"
    )
    changed = rows.where(F.col("dt") == REPORT_DAY).withColumn("rate", F.col("rate") + 1)
    for part in (rows, changed, changed):
        snapshots.publish(part, path, "dt")
    return snapshots.read(spark, path, rows.drop("dt").schema, part_col="dt").select(*table_sink.RESULT_COLUMNS)


@query
def replace_table_sink(spark, sf_dir):
    """A partitioned catalogue table: all days written, then one of them twice more with other rates."""
    rows = inputs.scores(spark, sf_dir).select(
        "hour", F.lit("score").alias("urltype"), "url", F.concat(F.lit("title "), F.col("url")).alias("title"), "rate", "dt"
    )
    changed = rows.where(F.col("dt") == REPORT_DAY).withColumn("rate", F.col("rate") + 1)
    name = table_sink.new_table(rows.limit(0), f"scores_{uuid.uuid4().hex}", ["dt"])
    for part in (rows, changed, changed):
        table_sink.replace_in_table(part, name)
    return spark.table(name).select(*table_sink.RESULT_COLUMNS)


@query
def score_enrichment_run(spark, sf_dir):
    """One hour from text tables to the result: days of three catalogues, scores, priority, and the hour replaced twice."""
    day, hour = SCORE_RUN[:8], SCORE_RUN[8:]
    catalogues = enumerate(inputs.catalogue_text(spark, sf_dir, day))
    roots = [_lines_by_tag(lines, sf_dir, f"catalogue-text-{number}") for number, lines in catalogues]
    texts = ScoreInputs(_lines_by_tag(inputs.score_text(spark, sf_dir), sf_dir, "score-text"), *roots)
    rows = written(table_sink.result_rows(score_enrichment(spark, SCORE_RUN, texts)), "enriched")
    path = shared_folder(spark, "result")
    for _ in range(2):
        table_sink.replace_one_part(rows, path, {"dt": day, "hour": hour})
    return spark.read.schema(rows.schema).parquet(path).select(*table_sink.RESULT_COLUMNS)


def _database(spark, name):
    """The database the session names, else one inside this process (single-machine sessions only)."""
    named = spark.conf.get(JDBC_URL_SETTING, None)
    if not named and not single_machine(spark):
        raise ValueError(f"set {JDBC_URL_SETTING} to a database that all executors reach")
    return named or f"jdbc:derby:memory:{name};create=true"


def _nation_summary(spark, sf_dir):
    """Customers per nation: at most one row per nation reaches the database."""
    customers = inputs.table(spark, sf_dir, "customer").groupBy("c_nationkey").agg(
        F.count("*").alias("customers"), F.max("c_acctbal").alias("best")
    )
    nations = inputs.table(spark, sf_dir, "nation")
    return nations.join(customers, F.col("n_nationkey") == F.col("c_nationkey")).select(
        "n_nationkey", "n_name", "n_regionkey", "customers", "best"
    )


@query
def jdbc_roundtrip(spark, sf_dir):
    """All but one part written, that part appended in batches and then replaced, scan in parallel ranges."""
    url = _database(spark, "roundtrip")
    rows = _nation_summary(spark, sf_dir).withColumn("part", F.col("n_regionkey").cast("string"))
    kinds = "n_name VARCHAR(64), part VARCHAR(8)"
    one, others = rows.where(F.col("part") == "1"), rows.where(F.col("part") != "1")
    others.write.option("createTableColumnTypes", kinds).jdbc(url, "nation_summary", mode="overwrite")
    jdbc_sink.append(one, url, "nation_summary")
    doubled = one.withColumn("customers", F.col("customers") * 2)
    jdbc_sink.replace_part(doubled, url, "nation_summary", {"part": "1"}, kinds)
    return jdbc.scan(spark, url, "nation_summary", column="n_nationkey", bounds=(0, 25), partitions=4)


@query
def jdbc_query_pushdown(spark, sf_dir):
    """An aggregate that the database evaluates."""
    url = _database(spark, "pushdown")
    rows = _nation_summary(spark, sf_dir)
    rows.write.option("createTableColumnTypes", "n_name VARCHAR(64)").jdbc(url, "nation_totals", mode="overwrite")
    return jdbc.query(
        spark,
        url,
        'SELECT "n_regionkey", SUM("customers") AS "customers" FROM nation_totals WHERE "best" > 0 GROUP BY "n_regionkey"',
    )


@query
def jdbc_quantile_scan(spark, sf_dir):
    """A table most of whose ids lie in a small part of their range, read in parts of like size."""
    url = _database(spark, "quantiles")
    rows = _nation_summary(spark, sf_dir).withColumn("id", F.when(F.col("n_nationkey") < 22, F.col("n_nationkey")).otherwise(F.col("n_nationkey") * 1000))
    rows.write.option("createTableColumnTypes", "n_name VARCHAR(64)").jdbc(url, "nation_skewed", mode="overwrite")
    return jdbc.scan_evenly(spark, url, "nation_skewed", "id", partitions=5)


# --- streams and tokens ----------------------------------------------------------------------------


@query
def token_count(spark, sf_dir):
    return tokens.token_count(inputs.table(spark, sf_dir, "documents"), "text")


@query
def stream_token_count(spark, sf_dir):
    """All documents through the streaming job, read back from its per-batch folders."""
    schema = inputs.table(spark, sf_dir, "documents").schema
    # The pattern lets the table be one file or a folder of files; a plain path must be a folder.
    messages = streams.file_messages(spark, f"{sf_dir}/{{documents.parquet}}", schema, "text")
    out = shared_folder(spark, "token-batches")
    run = token_stream.start(messages, token_stream.batch_files(out), shared_folder(spark, "token-offsets"), trigger=None)
    run.awaitTermination()
    return spark.read.schema("token string, n bigint, batch_id int").parquet(out).select("token", "n")


@query
def stream_pv_uv(spark, sf_dir):
    """Clicks per place and ten minutes from a stream that is stopped in between; the rows after the stop are mostly late.

    Every tenth event arrives after the others. Windows that the stream has given out by then do not change.
    """
    arrivals = shared_folder(spark, "arrivals")
    raw = inputs.table(spark, sf_dir, "events")
    checkpoint, path = shared_folder(spark, "traffic-state"), shared_folder(spark, "traffic")
    for late in (False, True):
        raw.where((F.col("event_id") % 10 == 0) == late).write.mode("append").parquet(arrivals)
        stream = spark.readStream.schema(raw.schema).parquet(arrivals)
        clicks = logs.click_log(inputs.click_rows(inputs.numbered_events(stream)), apptypeid="main", suptop="0001")
        totals = stream_traffic.windowed_traffic(clicks, ["typename"])
        stream_traffic.run(totals, path, checkpoint).awaitTermination()
    return snapshots.read(spark, path, totals.schema)


@query
def stream_token_ledger(spark, sf_dir):
    """Tokens of all documents through the ledger: totals over its batches, one of which is committed twice."""
    schema = inputs.table(spark, sf_dir, "documents").schema
    messages = streams.file_messages(spark, f"{sf_dir}/{{documents.parquet}}", schema, "text", positions=True)
    path = shared_folder(spark, "token-ledger")

    def compute(batch):
        return tokens.token_count(batch)

    ledger.start(messages, compute, path, shared_folder(spark, "ledger-offsets")).awaitTermination()
    again = inputs.table(spark, sf_dir, "documents").select(F.lit("again").alias("source"), F.lit(0).alias("position"), F.col("text").alias("value"))
    ledger.commit(again, compute, path, 0)
    counted = ledger.results(spark, path, "token string, n bigint")
    return counted.groupBy("token").agg(F.sum("n").alias("n"))


@query
def synthetic_tokens(spark, sf_dir):
    return synthetic.token_messages(inputs.table(spark, sf_dir, "events"), "event_id")


@query
def source_counts(spark, sf_dir):
    counted = None
    for name in TABLES:
        one = inputs.table(spark, sf_dir, name).agg(F.count("*").alias("n")).select(F.lit(name).alias("source"), "n")
        counted = one if counted is None else counted.unionByName(one)
    return counted


# --- ranking ---------------------------------------------------------------------------------------


@query
def top_m(spark, sf_dir):
    return ranking.top_m(inputs.table(spark, sf_dir, "lineitem"), "l_extendedprice", 100)


@query
def top_m_per_group(spark, sf_dir):
    orders = inputs.table(spark, sf_dir, "orders").select("o_orderpriority", "o_orderkey", "o_totalprice")
    return ranking.top_m_per_group(orders, ["o_orderpriority"], [F.desc("o_totalprice"), F.col("o_orderkey")], 10)


@query
def result_limit(spark, sf_dir):
    return ranking.first_rows(inputs.table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice"), ["o_orderkey"])


# --- scalar functions ------------------------------------------------------------------------------


@query
def url_key(spark, sf_dir):
    return inputs.table(spark, sf_dir, "pages").select("page_id", urls.url_key(F.col("url")).alias("content"))


@query
def url_key_long(spark, sf_dir):
    long_url = F.concat("url", F.lit("/a"), F.lpad(F.col("page_id").cast("string"), 16, "0"), F.lit(".html?x=1"))
    return inputs.table(spark, sf_dir, "pages").select(
        "page_id",
        urls.url_id(F.col("url"), urls.SLOT_ID_DIGITS).alias("plain"),
        urls.url_id(long_url, urls.SLOT_ID_DIGITS).alias("content"),
    )


@query
def url_key_offset(spark, sf_dir):
    page = F.col("page_id").cast("string")
    return inputs.table(spark, sf_dir, "pages").select(
        "page_id",
        urls.url_key_offset(F.col("url")).alias("urlid"),
        urls.url_key_offset(F.concat(page, F.lit(".html"))).alias("short_urlid"),
        urls.url_key_offset(F.lit(None).cast("string")).alias("null_urlid"),
    )


@query
def url_strip_query(spark, sf_dir):
    return inputs.table(spark, sf_dir, "pages").select("page_id", urls.strip_query(F.col("url")).alias("stripped"))


def _part_lists(spark, sf_dir):
    """Lists with empty, trailing and only empty elements."""
    size = F.col("p_size")
    listed = (
        F.when(size < 5, "").when(size < 10, ",,")
        .when(size < 20, F.concat(F.col("p_type"), F.lit(",,"), F.col("p_brand"), F.lit(",,")))
        .when(size < 30, F.concat(F.lit(","), F.col("p_name")))
        .otherwise(F.concat_ws(",", "p_type", "p_brand", "p_name"))
    )
    return inputs.table(spark, sf_dir, "part").select("p_partkey", listed.alias("listed"))


@query
def java_split(spark, sf_dir):
    parts = text.java_split(F.col("listed"), ",")
    return _part_lists(spark, sf_dir).select("p_partkey", F.posexplode(parts).alias("position", "element"))


def _part_numbers(spark, sf_dir):
    size, key = F.col("p_size"), F.col("p_partkey").cast("string")
    number = (
        F.when(size < 5, "").when(size < 8, "-").when(size < 11, "+").when(size < 20, F.concat(F.lit("-"), key))
        .when(size < 25, F.concat(key, F.lit("\n"))).when(size < 30, F.concat(key, F.lit(".0"))).otherwise(key)
    )
    return inputs.table(spark, sf_dir, "part").select("p_partkey", number.alias("number"))


@query
def is_integer(spark, sf_dir):
    return _part_numbers(spark, sf_dir).select("p_partkey", text.is_integer(F.col("number")).alias("flag"))


def _dated_orders(spark, sf_dir):
    """Keys followed by one to six date suffixes, some of them no dates."""
    suffix = F.date_format("o_orderdate", "yyMMdd")
    repeats = F.length("o_orderpriority") - 4
    key = F.concat(F.lit("o"), F.col("o_orderkey").cast("string"), F.lit("x"))
    dated = (
        F.when(F.col("o_orderstatus") == "F", F.concat(key, F.repeat(suffix, repeats)))
        .when(F.col("o_orderstatus") == "O", F.concat(key, F.lit("+1"), F.date_format("o_orderdate", "MMdd")))
        .otherwise(F.concat(key, F.date_format("o_orderdate", "yyddMM")))
    )
    return inputs.table(spark, sf_dir, "orders").select("o_orderkey", dated.alias("dated"))


@query
def trim_date_suffix(spark, sf_dir):
    return _dated_orders(spark, sf_dir).select("o_orderkey", text.trim_date_suffix(F.col("dated")).alias("trimmed"))


@query
def trim_date_suffix5(spark, sf_dir):
    return _dated_orders(spark, sf_dir).select("o_orderkey", text.trim_date_suffix(F.col("dated"), 5).alias("trimmed"))


@query
def trim_special(spark, sf_dir):
    quoted = F.concat(F.lit("'"), F.col("text"), F.lit("\\n'"))
    return inputs.table(spark, sf_dir, "documents").select("doc_id", text.trim_special(quoted).alias("trimmed"))


@query
def is_clean_token(spark, sf_dir):
    """Source names are clean tokens, whole texts mostly are not."""
    documents = inputs.table(spark, sf_dir, "documents")
    return documents.select(
        "doc_id",
        text.is_clean_token(F.concat_ws("|", "source", "lang")).alias("source_flag"),
        text.is_clean_token(F.col("text")).alias("text_flag"),
    )


@query
def null_default(spark, sf_dir):
    documents = inputs.table(spark, sf_dir, "documents").select("doc_id")
    labels = inputs.table(spark, sf_dir, "labels").select("doc_id", F.col("quality").cast("bigint").alias("quality"))
    joined = documents.join(labels, "doc_id", "left")
    return joined.select("doc_id", text.null_default(F.col("quality"), -1).alias("quality"))


@query
def date_compact_to_text(spark, sf_dir):
    compact = F.date_format("ts", dates.COMPACT_FORMAT)
    return inputs.table(spark, sf_dir, "events").select("event_id", dates.compact_to_text(compact).alias("moment"))


@query
def date_yesterday(spark, sf_dir):
    return inputs.table(spark, sf_dir, "events").select("event_id", dates.yesterday_tag(F.col("ts")).alias("day"))


@query
def date_today(spark, sf_dir):
    return inputs.table(spark, sf_dir, "events").select("event_id", dates.day_tag(F.col("ts")).alias("day"))


@query
def date_roundtrip(spark, sf_dir):
    parsed = dates.from_text(F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss"))
    broken = dates.from_text(F.date_format("o_orderdate", "yyyy-13-dd HH:mm:ss"))
    return inputs.table(spark, sf_dir, "orders").select(
        "o_orderkey", dates.to_text(parsed).alias("moment"), dates.to_text(broken).alias("broken")
    )


@query
def date_lenient(spark, sf_dir):
    """Texts whose month, day, hour, minute and second may lie beyond their range; some are no dates."""
    order, at = F.col("o_orderkey"), F.col("o_orderdate")
    field = lambda part, more: (F.date_part(F.lit(part), at) + order % more).cast("int").cast("string")
    clock = [(order % most).cast("int").cast("string") for most in (50, 130, 70)]
    rolled = F.concat_ws(" ", F.concat_ws("-", field("YEAR", 2), field("MONTH", 25), field("DAY", 60)), F.concat_ws(":", *clock))
    text_ = F.when(order % 7 == 0, F.concat(F.lit("on "), rolled)).when(order % 5 == 0, F.concat(rolled, F.lit(" or so"))).otherwise(rolled)
    moment = dates.from_text_lenient(text_)
    return inputs.table(spark, sf_dir, "orders").select("o_orderkey", text_.alias("given"), dates.to_text(moment).alias("moment"))


@query
def date_midnight(spark, sf_dir):
    return inputs.table(spark, sf_dir, "events").select(
        "event_id", dates.to_text(dates.midnight(F.col("ts"))).alias("midnight")
    )


@query
def date_floor_10min(spark, sf_dir):
    return inputs.table(spark, sf_dir, "events").select(
        "event_id", dates.to_text(dates.floor_to_run(F.col("ts"))).alias("run")
    )


@query
def date_x_days_ago(spark, sf_dir):
    tag = dates.day_tag(F.col("o_orderdate"))
    return inputs.table(spark, sf_dir, "orders").select("o_orderkey", dates.tag_days_before(tag, 4).alias("day"))


@query
def epoch_seconds(spark, sf_dir):
    return inputs.table(spark, sf_dir, "events").select("event_id", dates.epoch_seconds(F.col("ts")).alias("second"))


@query
def bucket_10min_counts(spark, sf_dir):
    """Events per report interval [t - 600, t), tagged with the day the interval belongs to."""
    begin = dates.epoch_seconds(dates.floor_to_run(F.col("ts")))
    day = F.date_format(F.timestamp_seconds("from_second"), dates.DAY_FORMAT)
    return (
        inputs.table(spark, sf_dir, "events")
        .groupBy(begin.alias("from_second"))
        .agg(F.count("*").alias("n"))
        .select("from_second", (F.col("from_second") + dates.RUN_SECONDS).alias("to_second"), day.alias("day"), "n")
    )
