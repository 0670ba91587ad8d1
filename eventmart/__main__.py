"""Command line for spark-submit: one job per call."""

from __future__ import annotations

import argparse
import json

from eventmart.functions import vocab as V
from eventmart.operators.conform import flatten
from eventmart.operators.quality import event_profile
from eventmart.plans.pipeline import FULL, GOLD_TABLES, INCREMENTAL, MODEL_TABLES, Mart
from eventmart.session import build_session
from eventmart.sources.events import read_events, slim_events, write_events
from eventmart.sources.snapshots import mirror
from eventmart.streaming.ingest import event_stream, ingest


def _arguments() -> argparse.Namespace:
    parser = argparse.ArgumentParser(prog="eventmart")
    parser.add_argument("--root", required=True, help="folder of the mart's tables")
    parser.add_argument("--as-of", help="evaluation date, today if left out")
    jobs = parser.add_subparsers(dest="job", required=True)

    def job(name: str, **options) -> None:
        sub = jobs.add_parser(name)
        for option, settings in options.items():
            sub.add_argument(f"--{option.replace('_', '-')}", **settings)

    needed, number = {"required": True}, {"type": int}
    job("slim", input=needed, output=needed)
    job("profile", input=needed, output=needed, pattern={})
    job(
        "silver",
        input=needed,
        mode={"choices": [FULL, INCREMENTAL], "default": INCREMENTAL},
        pattern={},
        quarantine={},
    )
    job("drain", input=needed, checkpoint=needed, quarantine={}, pattern={})
    job(
        "worklist",
        output=needed,
        year=number,
        percent={"type": float},
        top_n=number,
        shards={**number, "default": 1},
    )
    job("metadata", input=needed)
    job("shards", input=needed, year=number)
    job("contributors")
    job("gold", mode={"choices": [FULL, INCREMENTAL], "default": FULL})
    job("compact")
    job("mirror", output=needed)
    job("views", output=needed)
    job("train", boundary={**number, "default": 2020})
    job("score")
    job(
        "trajectories",
        first={**number, "default": 2016},
        last={**number, "default": 2025},
        early_to={**number, "default": 2020},
    )
    job("trends", years={**number, "nargs": "+", "default": [2026, 2027]})
    return parser.parse_args()


def main() -> None:
    args = _arguments()
    spark = build_session(f"eventmart-{args.job}")
    mart = Mart(spark, args.root, args.as_of)
    result = None
    match args.job:
        case "slim":
            write_events(slim_events(read_events(spark, args.input)), args.output)
        case "silver":
            result = mart.build_silver(
                args.input, args.mode, args.pattern, quarantine=args.quarantine
            )
        case "profile":
            rows = event_profile(flatten(read_events(spark, args.input, args.pattern)))
            rows.write.mode("overwrite").parquet(args.output)
        case "drain":
            stream = event_stream(spark, args.input, pattern=args.pattern)
            ingest(
                stream, args.root, args.checkpoint, V.EARLIEST_EVENT, args.as_of, args.quarantine
            ).start().awaitTermination()
        case "worklist":
            percent = 40.0 if args.percent is None and args.top_n is None else args.percent
            rows = mart.worklist(args.year, percent, args.shards, args.top_n)
            rows.write.mode("overwrite").partitionBy("shard").parquet(args.output)
        case "metadata":
            result = mart.load_metadata(args.input)
        case "shards":
            result = mart.load_shards(args.input, args.year)
        case "contributors":
            result = mart.load_contributors()
        case "gold":
            result = mart.build_gold(mode=args.mode)
        case "compact":
            mart.compact()
        case "mirror":
            result = mirror(spark, args.root, args.output, (*GOLD_TABLES, *MODEL_TABLES))
        case "views":
            result = mart.write_views(args.output)
        case "train":
            result = mart.train(args.boundary)
        case "score":
            result = mart.score()
        case "trajectories":
            years = list(range(args.first, args.last + 1))
            result = mart.trajectories(years, args.early_to)
        case "trends":
            result = mart.language_trends(args.years)
    print(json.dumps({"job": args.job, "result": result}, default=str))


if __name__ == "__main__":
    main()
