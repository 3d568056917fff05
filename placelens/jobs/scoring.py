"""Enriched scores of one hour, replacing that hour in the result.

python -m placelens.jobs.scoring 2024011510 --scores ... --crawler ... --video ... --short-video ... --output ...
"""

import argparse
import json

from pyspark.sql import Observation, SparkSession

from placelens.jobs.options import add_jdbc
from placelens.operators.observed import observed
from placelens.plans.scoring import ScoreInputs, score_enrichment
from placelens.session import build_session, remove_written
from placelens.sinks.jdbc import replace_part
from placelens.sinks.tables import replace_one_part, result_rows

# Fixed value: types of the key columns in a database; the others get its type for text without bound.
RESULT_TYPES = "dt VARCHAR(8), hour VARCHAR(2)"


def parser() -> argparse.ArgumentParser:
    parser = argparse.ArgumentParser(description=__doc__)
    parser.add_argument("run", help="yyyyMMddHH")
    for root in ("scores", "crawler", "video", "short-video"):
        parser.add_argument(f"--{root}", required=True, help="root folder of the text table")
    parser.add_argument("--dedup", action="store_true", help="one row per id and catalogue")
    parser.add_argument("--keep-empty", action="store_true", help="let catalogue rows without an id match scores without one")
    parser.add_argument("--output", help="root folder of the result")
    add_jdbc(parser)
    parser.add_argument("--table", help="result table in the database, instead of --output")
    parser.add_argument("--quote", default='"', help="the database's mark around column names")
    return parser


def run(spark: SparkSession, args: argparse.Namespace) -> dict[str, dict[str, int]]:
    """Replace the hour; how many lines of each input were kept and dropped."""
    inputs = ScoreInputs(args.scores, args.crawler, args.video, args.short_video)
    seen = {name: Observation() for name in ("scores", "crawler", "video", "short_video")}
    rows = result_rows(score_enrichment(spark, args.run, inputs, args.dedup, args.keep_empty, seen))
    part = {"dt": args.run[:8], "hour": args.run[8:10]}
    if args.output:
        replace_one_part(rows, args.output, part)
    else:
        replace_part(rows, args.jdbc_url, args.table, part, RESULT_TYPES, dict(args.jdbc_option), args.quote)
    return {name: observed(one) for name, one in seen.items()}


def main() -> None:
    args = parser().parse_args()
    if bool(args.output) == bool(args.table):
        raise SystemExit("give either --output or --table")
    spark = build_session(f"scores-{args.run}")
    try:
        print(json.dumps(run(spark, args)))
    finally:
        remove_written(spark)
        spark.stop()


if __name__ == "__main__":
    main()
