"""Command line of the jobs: ``spark-submit ... -m subscope`` or ``python -m subscope``."""

import argparse
import json
import logging
import uuid

from .operators.modeling import FOLDS, PARALLELISM, WIDE_GRID
from .plans.etl import run_etl
from .plans.profiling import DENSITY_RESOLUTION, run_profile
from .plans.streams import run_stream
from .plans.training import run_scoring, run_training
from .session import build_session, session_config
from .sources.run_log import timed_job
from .streaming.sources import kafka_options, read_kafka, read_text_files


def _parser() -> argparse.ArgumentParser:
    parser = argparse.ArgumentParser(prog="subscope")
    parser.add_argument("--log", help="Parquet folder for run records")
    parser.add_argument("--cluster", action="store_true", help="cluster settings")
    jobs = parser.add_subparsers(dest="job", required=True)

    etl = jobs.add_parser("etl", help="CSV to processed Parquet")
    etl.add_argument("input")
    etl.add_argument("output")
    etl.add_argument("--bounds", help="folder for the fitted bounds")
    etl.add_argument("--stage", help="folder for a Parquet copy, to parse text once")
    etl.add_argument("--include-label", action="store_true")
    etl.add_argument("--partitions", type=int, help="deal the result out anew")

    profile = jobs.add_parser("profile", help="tables of the data profile")
    profile.add_argument("data")
    profile.add_argument("output")
    profile.add_argument("--cache", action="store_true")
    profile.add_argument("--columns", nargs="+")
    profile.add_argument("--categories", nargs="+")
    profile.add_argument("--bins", type=lambda x: x if x == "auto" else int(x), default="auto")
    profile.add_argument("--box-method", choices=("exact", "approx"), default="exact")
    profile.add_argument("--resolution", type=int, default=DENSITY_RESOLUTION, help="0: exact")

    training = jobs.add_parser("train", help="fit, evaluate and save a model")
    training.add_argument("data")
    training.add_argument("model")
    training.add_argument("--fit-on", choices=("train", "all"), default="train")
    training.add_argument("--weighted", action="store_true")
    training.add_argument("--importance", help="folder for the top features")
    training.add_argument("--params", type=json.loads, help="tree parameters as JSON")
    training.add_argument("--grid", type=json.loads, help="value lists as JSON; {} for none")
    training.add_argument("--wide-grid", action="store_true")
    training.add_argument("--oversample", action="store_true")
    training.add_argument("--search", choices=("grid", "halving"), default="grid")
    training.add_argument("--validation", type=float, help="share of rows held out to end the rounds by")
    training.add_argument("--folds", type=int, default=FOLDS)
    training.add_argument("--parallelism", type=int, default=PARALLELISM)

    scoring = jobs.add_parser("score", help="score a table with a saved model")
    scoring.add_argument("data")
    scoring.add_argument("model")
    scoring.add_argument("output")

    stream = jobs.add_parser("stream", help="events to Parquet")
    stream.add_argument("output")
    stream.add_argument("checkpoint")
    source = stream.add_mutually_exclusive_group(required=True)
    source.add_argument("--servers", help="brokers; needs --topic")
    source.add_argument("--text", help="read text files of this folder instead")
    stream.add_argument("--topic")
    stream.add_argument("--starting-offsets", default="latest")
    stream.add_argument("--max-offsets-per-trigger", type=int)
    stream.add_argument("--min-partitions", type=int)
    stream.add_argument("--on-malformed", choices=("keep", "drop"), default="keep")
    stream.add_argument("--interval", default="60 seconds")
    stream.add_argument("--available-now", action="store_true")
    return parser


def main(argv: list[str] | None = None) -> None:
    parser = _parser()
    args = parser.parse_args(argv)
    if args.job == "stream" and args.servers and not args.topic:
        parser.error("--servers needs --topic")
    run_id = uuid.uuid4().hex
    logging.basicConfig(
        level=logging.INFO, format="%(asctime)s %(levelname)s %(name)s %(message)s"
    )
    spark = build_session(session_config(f"subscope-{args.job}", cluster=args.cluster))

    def body():
        if args.job == "etl":
            return run_etl(
                spark,
                args.input,
                args.output,
                args.bounds,
                args.stage,
                args.include_label,
                args.partitions,
            )
        if args.job == "profile":
            return run_profile(
                spark,
                args.data,
                args.output,
                args.cache,
                columns=args.columns,
                categories=args.categories,
                bins=args.bins,
                box_method=args.box_method,
                resolution=args.resolution or None,
            )
        if args.job == "train":
            return run_training(
                spark,
                args.data,
                args.model,
                log_path=args.log,
                importance_path=args.importance,
                fit_on=args.fit_on,
                weighted=args.weighted,
                params=args.params,
                grid=WIDE_GRID if args.wide_grid else args.grid,
                search=args.search,
                oversample=args.oversample,
                validation=args.validation,
                folds=args.folds,
                parallelism=args.parallelism,
                run_id=run_id,
            )
        if args.job == "score":
            return run_scoring(spark, args.data, args.model, args.output)
        if args.text:
            source = read_text_files(spark, args.text)
        else:
            options = kafka_options(
                args.servers,
                args.topic,
                starting_offsets=args.starting_offsets,
                max_offsets_per_trigger=args.max_offsets_per_trigger,
                min_partitions=args.min_partitions,
            )
            source = read_kafka(spark, options)
        run_stream(
            source,
            args.output,
            args.checkpoint,
            interval=args.interval,
            available_now=args.available_now,
            on_malformed=args.on_malformed,
        )
        return {}

    timed_job(spark, args.job, body, args.log, run_id)


if __name__ == "__main__":
    main()
