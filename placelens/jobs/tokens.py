"""Token counts of a Kafka stream, every three seconds.

python -m placelens.jobs.tokens --servers host:9092 --topics a,b --checkpoint ... --output ...
"""

import argparse

from placelens.session import build_session
from placelens.sources.streams import kafka_messages
from placelens.streaming import tokens


def parser() -> argparse.ArgumentParser:
    parser = argparse.ArgumentParser(description=__doc__)
    parser.add_argument("--servers", required=True)
    parser.add_argument("--topics", required=True, help="comma-separated")
    parser.add_argument("--checkpoint", required=True, help="shared folder for the offsets")
    parser.add_argument("--starting", default="latest")
    parser.add_argument("--output", help="folder that keeps the counts of every batch")
    parser.add_argument("--show", type=int, metavar="N", help="instead of --output: print N pairs of every batch, no others")
    return parser


def sink(args: argparse.Namespace):
    """Where the counts of a batch go; all are kept unless only some were asked to be shown."""
    if bool(args.output) == bool(args.show):
        raise SystemExit("give either --output or --show")
    return tokens.batch_files(args.output) if args.output else tokens.show(args.show)


def main() -> None:
    args = parser().parse_args()
    target = sink(args)
    spark = build_session("token-stream")
    messages = kafka_messages(spark, args.servers, args.topics, args.starting)
    tokens.start(messages, target, args.checkpoint).awaitTermination()


if __name__ == "__main__":
    main()
