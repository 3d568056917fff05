"""Placement report of one day.

python -m placelens.jobs.attribution 20240115120000 --jdbc-url ... --page-history ... (see --help)
"""

import argparse

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from placelens.functions.urls import url_key, url_key_offset
from placelens.jobs.options import add_jdbc, pair
from placelens.plans.attribution import PAGE_SOURCETYPES, VIDEO_SOURCETYPES, attribution_report
from placelens.session import build_session, remove_written, written
from placelens.sources.jdbc import bounds, scan, scan_evenly
from placelens.sources.logs import click_log, live_rooms, position_history, view_log


def parser() -> argparse.ArgumentParser:
    parser = argparse.ArgumentParser(description=__doc__)
    parser.add_argument("run", help="yyyyMMddHHmmss; the report covers that day")
    add_jdbc(parser)
    for table in ("page-history", "video-history", "types"):
        parser.add_argument(f"--{table}", required=True, help="database table")
    for table in ("rooms", "clicks", "views"):
        parser.add_argument(f"--{table}", required=True, help="catalogue table partitioned by dt")
    for table in ("history", "room", "click", "view"):
        parser.add_argument(f"--{table}-filter", type=pair, action="append", default=[], help="column=value")
    parser.add_argument("--database", help="current database for the catalogue tables")
    parser.add_argument("--partition-column", help="whole-number column by whose ranges the histories are read in parallel")
    parser.add_argument("--by-quantiles", action="store_true", help="ranges of like many rows, which the database is asked for, not of like width")
    parser.add_argument("--partitions", type=int, default=8, help="ranges of the partition column")
    parser.add_argument("--quote", default='"', help="the database's mark around column names")
    parser.add_argument("--offset-key", action="store_true", help="clicks on a URL without an id have the empty key")
    parser.add_argument("--output", help="folder for the report")
    parser.add_argument("--show", type=int, metavar="N", help="instead of --output: print N rows in order, no others")
    parser.add_argument("--dedup", action="store_true", help="one row per repeated lookup key")
    return parser


def history(table: DataFrame, sourcetypes: tuple[str, ...], filters: dict[str, str]) -> DataFrame:
    """The database is read once. Edits of the same instant are ordered by what they say, whichever arrives first.

    Only edits that agree in every column are told apart by a row number.
    """
    rows = position_history(table, sourcetypes, **filters)
    said = F.sha2(F.to_json(F.struct(*sorted(rows.columns))).cast("binary"), 256)
    number = F.lpad(F.monotonically_increasing_id().cast("string"), 20, "0")
    return written(rows.withColumn("seq", F.concat_ws("-", said, number)), "history")


def history_table(spark: SparkSession, args: argparse.Namespace, table: str) -> DataFrame:
    """A history in the database, read in ranges if there is a column for it."""
    properties, column = dict(args.jdbc_option), args.partition_column
    if column and args.by_quantiles:
        return scan_evenly(spark, args.jdbc_url, table, column, properties, args.partitions, args.quote)
    ends = bounds(spark, args.jdbc_url, table, column, properties, args.quote) if column else None
    return scan(spark, args.jdbc_url, table, properties, column if ends else None, ends, args.partitions)


def report(spark: SparkSession, args: argparse.Namespace) -> DataFrame:
    properties = dict(args.jdbc_option)
    day = args.run[:8]
    if args.database:
        spark.catalog.setCurrentDatabase(args.database)
    histories = [
        history(history_table(spark, args, table), kinds, dict(args.history_filter))
        for table, kinds in ((args.page_history, PAGE_SOURCETYPES), (args.video_history, VIDEO_SOURCETYPES))
    ]
    return attribution_report(
        histories,
        scan(spark, args.jdbc_url, args.types, properties).select("typeid", "typename"),
        live_rooms(spark.table(args.rooms), day, **dict(args.room_filter)),
        click_log(spark.table(args.clicks), day, key=url_key_offset if args.offset_key else url_key, **dict(args.click_filter)),
        view_log(spark.table(args.views), day, **dict(args.view_filter)),
        day,
        dedup=args.dedup,
    )


def deliver(rows: DataFrame, args: argparse.Namespace) -> None:
    """The whole report to a folder, or the rows asked for to the screen."""
    if args.output:
        rows.write.mode("overwrite").parquet(args.output)
    else:
        rows.orderBy("typename", "pagenum", "idx", "real_starttime", "content").show(args.show, truncate=False)


def main() -> None:
    args = parser().parse_args()
    if bool(args.output) == bool(args.show):
        raise SystemExit("give either --output or --show")
    spark = build_session(f"placement-report-{args.run}")
    try:
        deliver(report(spark, args), args)
    finally:
        remove_written(spark)
        spark.stop()


if __name__ == "__main__":
    main()
