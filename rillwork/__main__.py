"""Start a job from the command line: ``python -m rillwork branched|multi|template --option ...``.

Options mirror the job objects of ``rillwork.plans.jobs``; outputs that are not named are not built.
"""

from __future__ import annotations

import argparse
import importlib
from datetime import timedelta

from pyspark.sql import SparkSession

from rillwork.plans.jobs import BranchedJob, MultiTopicJob, TemplateJob, wait
from rillwork.session import build_session
from rillwork.sources.tables import table_scan, to_profile_rows
from rillwork.sources.topics import REPLAY_FORMATS, replay_stream
from rillwork.streaming.lookups import CachedLookup, ExternalLookup

COMMON = ["bootstrap_servers", "consumer_group_id", "kafka_read_offset", "quarantine"]
JOBS = {
    "branched": (BranchedJob, ["topic", "output_table", "generic_output_table",
                               "aggregation_table", "width", "delay"]),
    "multi": (MultiTopicJob, ["user_events_topic", "user_profiles_topic", "product_updates_topic",
                              "user_profiles_table", "enriched_events_table", "width", "delay"]),
    "template": (TemplateJob, ["topic", "output_table"]),
}


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="rillwork", description=__doc__.splitlines()[0])
    sub = top.add_subparsers(dest="job", required=True)
    for name, (_, own) in JOBS.items():
        p = sub.add_parser(name)
        p.add_argument("--checkpoint", required=True)
        for option in COMMON + own:
            p.add_argument("--" + option.replace("_", "-"))
        p.add_argument("--replay", metavar="FOLDER",
                       help="read stored messages from FOLDER/<topic> instead of a broker")
        p.add_argument("--replay-format", choices=REPLAY_FORMATS, default="parquet")
        trigger = p.add_mutually_exclusive_group()
        trigger.add_argument("--every", metavar="INTERVAL", help="micro-batch interval")
        trigger.add_argument("--available-now", action="store_true",
                             help="stop after what is there now")
        p.add_argument("--no-wait", action="store_true", help="return after the start")
    sub.choices["branched"].add_argument("--separate-scans", action="store_true",
                                         help="a query of its own for each table")
    multi = sub.choices["multi"]
    multi.add_argument("--refresh-seconds", type=float)
    multi.add_argument("--spread", type=int, help="parts per product and per user")
    multi.add_argument("--lookup", choices=["external", "cached"],
                       help="look profiles up per micro-batch instead of once")
    multi.add_argument("--ttl-seconds", type=float, default=3600.0, help="expiry of --lookup cached")
    sub.choices["template"].add_argument("--transform", metavar="MODULE:FUNCTION",
                                         help="function from a Column to a Column")
    return top


def job_from(args: argparse.Namespace):
    cls, own = JOBS[args.job]
    given = {o: getattr(args, o) for o in [*COMMON, *own] if getattr(args, o) is not None}
    if args.available_now:
        given["trigger"] = {"availableNow": True}
    elif args.every:
        given["trigger"] = {"processingTime": args.every}
    if args.replay:
        folder, fmt = args.replay.rstrip("/"), args.replay_format
        given["open_topic"] = lambda spark, topic: replay_stream(spark, f"{folder}/{topic}", fmt)
    for extra in ("refresh_seconds", "spread"):
        if getattr(args, extra, None) is not None:
            given[extra] = getattr(args, extra)
    if getattr(args, "separate_scans", False):
        given["one_scan"] = False
    if getattr(args, "lookup", None):
        given["lookup"] = lookup_from(args)
    if getattr(args, "transform", None):
        module, _, name = args.transform.partition(":")
        given["transform"] = getattr(importlib.import_module(module), name)
    return cls(checkpoint=args.checkpoint, **given)


def lookup_from(args: argparse.Namespace):
    def load():
        return to_profile_rows(table_scan(SparkSession.active(), args.user_profiles_table)).rows

    if args.lookup == "external":
        return ExternalLookup(load)
    return CachedLookup(load, timedelta(seconds=args.ttl_seconds), f"{args.checkpoint}/cache")


def main(argv: list[str] | None = None) -> None:
    args = parser().parse_args(argv)
    running = job_from(args).start(build_session(f"rillwork-{args.job}"))
    if not args.no_wait:
        wait(running)


if __name__ == "__main__":
    main()
