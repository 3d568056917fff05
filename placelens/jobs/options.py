"""Argument types shared by the jobs."""

import argparse


def pair(text: str) -> tuple[str, str]:
    name, found, value = text.partition("=")
    if not found:
        raise argparse.ArgumentTypeError(f"{text!r} is not name=value")
    return name, value


def add_jdbc(parser: argparse.ArgumentParser) -> None:
    parser.add_argument("--jdbc-url")
    parser.add_argument("--jdbc-option", type=pair, action="append", default=[], help="driver, user, ... as name=value")
