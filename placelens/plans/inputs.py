"""The operators' inputs, derived by Spark from the whole test tables."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from placelens.functions.dates import epoch_seconds
from placelens.session import pin_utc

_schemas: dict[str, StructType] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A test table. Its schema is read once in a process: the tables do not change."""
    path = f"{sf_dir}/{name}.parquet"
    if path not in _schemas:
        _schemas[path] = pin_utc(spark).read.parquet(path).schema
    return pin_utc(spark).read.schema(_schemas[path]).parquet(path)


def numbered_events(raw: DataFrame) -> DataFrame:
    """Rows of `events`, a table or a stream, with `k`, the number in their properties (0 to 99)."""
    return raw.selectExpr("*", "cast(substring_index(rtrim('}', props), ' ', -1) as int) as k")


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return numbered_events(table(spark, sf_dir, "events"))


ARTICLE = "concat('https://site.example/{site}/', lpad(cast(user_id as string), 16, '0'), '.html?', {query})"


def history(spark: SparkSession, sf_dir: str, event_type: str = "signup") -> DataFrame:
    """Edit history: each user is an entry, each of their events of one type a version."""
    article = ARTICLE.format(site="a", query="'from=top'")
    return events(spark, sf_dir).where(f"event_type = '{event_type}'").selectExpr(
        "user_id as id",
        "event_id as seq",
        "if(k < 10, 'delete', 'update') as optype",
        f"if(k >= 70, concat('room', user_id), {article}) as content",
        "concat('title ', event_id) as title",
        "concat_ws(',', user_id % 25, 25 + k % 5) as newstype",
        "string(user_id % 3) as idx",
        "string(user_id % 2) as pagenum",
        "concat('editor', k % 8) as createuser",
        "ts as modifydate",
        "ts + make_dt_interval(0, 6 * (k % 3)) as starttime",
        "ts + make_dt_interval(1 + k % 20) as endtime",
        "get(array('news', 'topic', 'live', 'video', 'ad', 'test'), k % 6) as sourcetype",
        "if(value < 40, 'main', 'lite') as apptypeid",
    )


VISITOR = "case k when 0 then null when 1 then 'null' when 2 then '' else concat('v', k) end"
ORIGIN = """case when k >= 95 then 'http://portal.example/' when k % 2 = 0 then concat('channel-', user_id % 25)
  else string(25 + k % 5) end"""
TARGET = f"""case when k >= 70 then concat('http://live.example/', user_id, '.flv?src=app')
  when k >= 66 then concat('ftp://files.example/', user_id)
  else {ARTICLE.format(site="{site}", query="concat('x=', k)")} end"""
APP = "if(value < 40, 'main', 'lite')"
TAG = "if(k % 10 < 8, '0001', '0002')"
DAY = "date_format(ts, 'yyyyMMdd')"


def click_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw click log."""
    return click_rows(events(spark, sf_dir))


def click_rows(numbered: DataFrame) -> DataFrame:
    """The raw click log in rows of `numbered_events`."""
    return (
        numbered.where("event_type = 'click'").withColumn("dateline", epoch_seconds("ts")).selectExpr(
            f"{VISITOR} as clientime", "dateline", f"{ORIGIN} as urlfrom", "string(user_id % 3) as idx02",
            "string(user_id % 2) as pgnum", f"{TARGET.format(site='m')} as urlto", f"{APP} as apptypeid",
            f"{TAG} as suptop", f"{DAY} as dt",
        )
    )


def view_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw impression log; its place columns are numbers."""
    return (
        events(spark, sf_dir).where("event_type = 'view'").withColumn("dateline", epoch_seconds("ts")).selectExpr(
            f"{VISITOR} as ime", "dateline", f"{ORIGIN} as type", "user_id % 3 as idx", "user_id % 2 as pagenum",
            f"{TARGET.format(site='v')} as url", f"{APP} as domain", f"{TAG} as newstag", f"{DAY} as dt",
        )
    )


def types(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Names of the types 0 to 24; types from 25 on have none."""
    return table(spark, sf_dir, "nation").selectExpr(
        "string(n_nationkey) as typeid", "concat('channel-', n_nationkey) as typename"
    )


def room_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Live rooms of all applications."""
    return table(spark, sf_dir, "customer").selectExpr(
        "concat('room', c_custkey) as roomkey",
        "concat('http://live.example/', c_custkey, '.flv') as flvurl",
        "c_mktsegment as appid",
        "if(c_custkey % 3 = 0, '20240114', '20240115') as dt",
    )


def _items(df: DataFrame, site: str, key: str, title: str, typepy: str) -> DataFrame:
    return df.selectExpr(
        f"{title} as title", f"string({typepy}) as typepy", f"concat('https://{site}.example/', {key}, '.html') as url"
    )


def catalogues(spark: SparkSession, sf_dir: str) -> list[DataFrame]:
    """Crawler, video and short-video catalogue; the last holds many rows per id."""
    return [
        _items(table(spark, sf_dir, "supplier"), "c", "s_suppkey", "s_name", "s_nationkey"),
        _items(table(spark, sf_dir, "customer"), "v", "c_custkey", "c_name", "c_mktsegment"),
        _items(table(spark, sf_dir, "orders"), "s", "o_custkey", "o_orderpriority", "o_orderstatus"),
    ]


def _lines(df: DataFrame, cells: dict[int, str], width: int, number: str, last_day: str) -> DataFrame:
    """Lines of `width` columns, spread over the seven days up to `last_day`."""
    row = ", ".join(cells.get(n, f"'f{n}'") for n in range(width))
    day = f"date_format(date_sub(to_date('{last_day}', 'yyyyMMdd'), cast({number} % 7 as int)), 'yyyyMMdd')"
    return df.selectExpr(f"concat_ws('\t', {row}) as value", f"{day} as dt")


def catalogue_text(spark: SparkSession, sf_dir: str, last_day: str) -> list[DataFrame]:
    """The catalogues as lines by day, each in its own layout."""
    page = "concat('https://{site}.example/', {key}, '.html')"
    crawler = {1: page.format(site="c", key="s_suppkey"), 2: "s_name", 9: "string(s_nationkey)"}
    video = {23: page.format(site="v", key="c_custkey"), 12: "c_name", 7: "c_mktsegment"}
    short = {6: page.format(site="s", key="o_custkey"), 4: "o_orderpriority", 9: "o_orderstatus"}
    return [
        _lines(table(spark, sf_dir, "supplier"), crawler, 10, "s_suppkey", last_day),
        _lines(table(spark, sf_dir, "customer"), video, 24, "c_custkey", last_day),
        _lines(table(spark, sf_dir, "orders"), short, 10, "o_orderkey", last_day),
    ]


def scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").selectExpr(
        f"{DAY} as dt", "date_format(ts, 'HH') as hour", "string(event_id) as url", "value as rate"
    )


def score_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Score lines by hour; some numbers are unusual and some are none."""
    number = """case when k < 5 then 'abc' when k < 10 then concat(value, 'd') when k < 15 then concat(' ', value, ' ')
      when k < 18 then '' else string(value) end"""
    return events(spark, sf_dir).selectExpr(
        f"concat_ws('\t', event_id, {number}) as value", "date_format(ts, 'yyyyMMddHH') as dt"
    )


def part_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Catalogue lines of ten columns; some are cut short, end in empty columns or lack the URL."""
    head = """p_partkey, case when p_size <= 3 then '' when p_size <= 6 then 'x'
      else concat('https://c.example/', p_partkey, '.html') end, p_name"""
    short = f"concat_ws('\t', {head})"
    full = f"""concat_ws('\t', {head}, 'f3', 'f4', 'f5', 'f6', 'f7', 'f8',
      if(p_size between 7 and 10, '', p_type))"""
    return table(spark, sf_dir, "part").selectExpr(
        f"case when p_size > 45 then {short} when p_size > 40 then concat({full}, '\t\t') else {full} end as value"
    )
