"""Command line: the three roles of a deployment, each one call into the library.

    spark-submit agrosense/cli.py replay --csv DIR --source meteo_2020 (--kafka HOST | --out DIR)
    spark-submit agrosense/cli.py stream (--kafka HOST --topics a,b | --files DIR) --out DIR
                                         [--checkpoint DIR] [--mode event_time|per_batch]
                                         [--available-now] [--state-partitions N] [--dedupe]
                                         [--kafka-option NAME=VALUE] [--threshold NAME=VALUE]
    spark-submit agrosense/cli.py compact --archive DIR [--retention-hours 24] [--small-mb 64]
    spark-submit agrosense/cli.py batch --archive DIR --out DIR [--topics a,b]
                                        [--from-partials | --since DAY --until DAY]
                                        [--threshold NAME=VALUE] [--on-error fail]
                                        [--daily DIR] [--run-id ID]

``stream --log`` archives to tables on a commit log (``sinks.log``) and closes hours by a watermark
per topic; ``compact`` rewrites such an archive's small files and deletes what is out of use.
``batch --daily`` keeps a table of daily measures up from the days that changed and computes the
results from it; ``--run-id`` commits each result once per id.

``replay`` publishes a sensor CSV as channel records, ``stream`` runs the raw archive and the
hourly jobs until stopped (or once over what is there with ``--available-now``), ``batch``
computes and writes the five daily results from the archive. Paths are arguments; the
session comes from ``spark-submit`` (no master is set here).
"""

from __future__ import annotations

import argparse
import os
import sys
from dataclasses import fields

if __package__ in (None, ""):
    sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import SparkSession  # noqa: E402

from agrosense.functions.columns import ON_ERROR  # noqa: E402
from agrosense.operators.readings import weather_readings  # noqa: E402
from agrosense.params import StreamSettings, Thresholds  # noqa: E402
from agrosense.plans.suite import run_batch_suite, run_suite_once  # noqa: E402
from agrosense.schemas import DEFAULT_TOPICS  # noqa: E402
from agrosense.session import apply_defaults  # noqa: E402
from agrosense.sources.files import channel_files, csv_replay  # noqa: E402
from agrosense.sources.kafka import (  # noqa: E402
    MAX_OFFSETS_PER_TRIGGER,
    kafka_channel,
    publish_kafka,
)
from agrosense.sources.tables import stored_daily, stored_readings  # noqa: E402
from agrosense.streaming.archive import (  # noqa: E402
    compact_archive,
    kept_daily,
    refresh_daily,
    start_archive,
)
from agrosense.streaming.jobs import await_all, kind_topics, start_all  # noqa: E402
from agrosense.streaming.per_topic import start_per_topic_hours  # noqa: E402
from agrosense.streaming.supervise import Supervisor  # noqa: E402


def _topics(text: str | None):
    return [t for t in text.split(",") if t] if text else None


def _pairs(items: list[str] | None) -> dict:
    return dict(i.split("=", 1) for i in items or ())


def _thresholds(args) -> Thresholds:
    """``--threshold name=value`` for any field of ``Thresholds``."""
    given = _pairs(args.threshold)
    kinds = {f.name: type(f.default) for f in fields(Thresholds)}
    unknown = set(given) - set(kinds)
    if unknown:
        raise SystemExit(f"unknown thresholds: {', '.join(sorted(unknown))}")
    number = lambda n, v: kinds[n](v) if kinds[n] in (int, float, str) else int(v)
    return Thresholds(**{n: number(n, v) for n, v in given.items()})


def replay(spark: SparkSession, args) -> None:
    channel = csv_replay(spark, args.csv, args.source)
    if args.kafka:
        publish_kafka(channel, args.kafka)
    else:
        channel.write.mode("append").parquet(args.out)


def stream(spark: SparkSession, args) -> None:
    settings = StreamSettings(mode=args.mode, available_now=args.available_now,
                              state_partitions=args.state_partitions, dedupe=args.dedupe,
                              max_files_per_trigger=args.max_files_per_trigger,
                              trigger_seconds=args.trigger_seconds)
    topics = _topics(args.topics)
    if args.kafka:
        topics = topics or list(DEFAULT_TOPICS)

        def channel(own):
            return kafka_channel(spark, args.kafka, own or topics, starting_offsets=args.starting_offsets,
                                 options=_pairs(args.kafka_option), max_offsets=args.max_offsets_per_trigger)
    else:
        channel = channel_files(spark, args.files, streaming=True,
                                max_files_per_trigger=args.max_files_per_trigger)
    # The checkpoint belongs to the output: a restart with the same --out resumes it.
    checkpoint = args.checkpoint or f"{args.out.rstrip('/')}/_checkpoint"
    with Supervisor(spark) as supervisor:
        if args.log:
            of = channel if callable(channel) else lambda _: channel
            queries = [start_archive(of(topics), f"{args.out}/raw", f"{checkpoint}/raw", settings, topics, _thresholds(args))]
            for kind in ("meteo", "suolo"):
                own = kind_topics(topics, kind)
                if own is None or own:
                    queries.append(start_per_topic_hours(of(own), kind, args.out, f"{checkpoint}/{kind}", settings, own))
        else:
            queries = start_all(channel, args.out, checkpoint, settings, _thresholds(args), topics)
        for name, t in await_all(queries, supervisor=supervisor).items():
            print(f"{name}: {t.batches} batches, {t.input_rows} rows, {t.late_rows} dropped as late")


def compact(spark: SparkSession, args) -> None:
    done = compact_archive(spark, args.archive, args.small_mb << 20, args.retention_hours * 3600)
    for name, d in done.items():
        print(f"{name}: {d['removed']} files to {d['added']}, {d['deleted']} deleted")


def batch(spark: SparkSession, args) -> None:
    topics = _topics(args.topics)
    if args.daily:
        refresh_daily(spark, f"{args.archive}/meteo", args.daily, topics, _thresholds(args))
        src = kept_daily(spark, args.daily)
    elif args.from_partials:
        src = stored_daily(spark, f"{args.archive}/daily_partials", topics, _thresholds(args))
    else:
        src = weather_readings(stored_readings(spark, f"{args.archive}/meteo", "meteo", topics,
                                               since=args.since, until=args.until),
                               on_error=args.on_error)
    if args.run_id:
        run_suite_once(src, args.out, args.run_id, _thresholds(args))
    else:
        run_batch_suite(src, args.out, _thresholds(args))


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="agrosense")
    sub = p.add_subparsers(dest="role", required=True)
    r = sub.add_parser("replay")
    r.add_argument("--csv", required=True)
    r.add_argument("--source", required=True)
    g = r.add_mutually_exclusive_group(required=True)
    g.add_argument("--kafka")
    g.add_argument("--out")
    s = sub.add_parser("stream")
    g = s.add_mutually_exclusive_group(required=True)
    g.add_argument("--kafka")
    g.add_argument("--files")
    s.add_argument("--topics")
    s.add_argument("--out", required=True)
    s.add_argument("--checkpoint")
    s.add_argument("--mode", default="event_time", choices=["event_time", "per_batch"])
    s.add_argument("--available-now", action="store_true")
    s.add_argument("--state-partitions", type=int)
    s.add_argument("--max-files-per-trigger", type=int)
    s.add_argument("--dedupe", action="store_true")
    s.add_argument("--trigger-seconds", type=int, default=StreamSettings.trigger_seconds)
    s.add_argument("--kafka-option", action="append", metavar="NAME=VALUE")
    s.add_argument("--starting-offsets")
    s.add_argument("--max-offsets-per-trigger", type=int, default=MAX_OFFSETS_PER_TRIGGER)
    s.add_argument("--threshold", action="append", metavar="NAME=VALUE")
    s.add_argument("--log", action="store_true")
    c = sub.add_parser("compact")
    c.add_argument("--archive", required=True)
    c.add_argument("--retention-hours", type=float, default=24.0)
    c.add_argument("--small-mb", type=int, default=64)
    b = sub.add_parser("batch")
    b.add_argument("--daily", help="kept table of daily measures (log archives)")
    b.add_argument("--run-id")
    b.add_argument("--archive", required=True)
    b.add_argument("--out", required=True)
    b.add_argument("--topics")
    b.add_argument("--from-partials", action="store_true")
    b.add_argument("--since", help="first day (time text), archive scans only")
    b.add_argument("--until", help="end day, exclusive")
    b.add_argument("--threshold", action="append", metavar="NAME=VALUE")
    b.add_argument("--on-error", default="quarantine", choices=ON_ERROR)
    return p


def main(argv=None, spark: SparkSession | None = None) -> None:
    args = parser().parse_args(argv)
    spark = apply_defaults(spark or SparkSession.builder.appName(f"agrosense-{args.role}")
                           .getOrCreate())
    {"replay": replay, "stream": stream, "batch": batch, "compact": compact}[args.role](spark, args)


if __name__ == "__main__":
    main()
