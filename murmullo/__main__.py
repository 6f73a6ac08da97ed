"""Command line for ``spark-submit``: one sub-command per job.

    spark-submit --py-files murmullo.zip run.py report user_risk_score IN OUT
    python -m murmullo synonyms IN OUT MODEL --min-count 5
    python -m murmullo throughput --servers HOST:9092 --checkpoint DIR
"""

from __future__ import annotations

import argparse
import json
from collections.abc import Sequence

from murmullo import schemas
from murmullo.functions.text import emoji_names
from murmullo.operators.scorers import lexicon_scorer
from murmullo.plans import batch
from murmullo.session import get_session
from murmullo.sources.topics import FileTopic, KafkaTopic, Topic
from murmullo.streaming import jobs
from murmullo.wordlists import EMOJI_NAMES


def _topic(args: argparse.Namespace, name: str) -> Topic:
    if args.folder:
        return FileTopic(f"{args.folder.rstrip('/')}/{name}")
    return KafkaTopic(args.servers, name)


def _lexicons(path: str):
    """A JSON file ``{"hate": {label: [words]}, "sentiment": {label: [words]}}``."""
    with open(path, encoding="utf-8") as file:
        words = json.load(file)
    return (
        lexicon_scorer(words["hate"]),
        lexicon_scorer(
            words["sentiment"], schemas.SENTIMENT_LABELS, rest_label=schemas.NEUTRAL
        ),
    )


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="murmullo")
    commands = top.add_subparsers(dest="command", required=True)

    report = commands.add_parser("report", help="a batch report, table to table")
    report.add_argument("name", choices=sorted(batch.REPORTS))
    report.add_argument("source")
    report.add_argument("target")
    report.add_argument("--k", type=int, help="top_hate_terms: how many")
    report.add_argument("--min-comments", type=int, help="user_risk_score: comments an author needs")
    report.add_argument("--hours-behind", type=int, help="hourly_trend: local time behind UTC")

    synonyms = commands.add_parser("synonyms", help="word vectors and neighbours")
    for name in ("source", "target", "model"):
        synonyms.add_argument(name)
    synonyms.add_argument("--min-count", type=int, default=1)
    synonyms.add_argument("--from-counts", action="store_true",
                          help="vectors from co-occurrence counts, for vocabularies of any size")
    synonyms.add_argument("--terms", nargs="*", default=list(batch.KEY_TERMS))

    publish = commands.add_parser("publish", help="a table of comments to the raw topic")
    publish.add_argument("source")
    export = commands.add_parser("export", help="the final topic to Parquet")
    export.add_argument("paths", nargs="+")
    export.add_argument("--max-messages", type=int, help="default: the whole topic")
    streams = {
        "clean": "raw records to cleaned records",
        "hate": "cleaned records to classified records",
        "sentiment": "classified records to final records",
        "enrich": "raw records to final records in one query",
        "throughput": "messages per second of the raw topic",
        "sentiment-windows": "sentiment counts of the final topic",
    }
    streaming = [commands.add_parser(name, help=text) for name, text in streams.items()]
    for stream in streaming:
        stream.add_argument("--checkpoint", required=True)
        stream.add_argument("--trigger")
        stream.add_argument("--max-per-trigger", type=int, help="messages (files with --folder)")
    for command in [publish, export, *streaming]:
        command.add_argument("--servers", default="localhost:9092")
        command.add_argument("--folder", help="folders of JSON lines instead of Kafka")
    for name in ("hate", "sentiment", "enrich"):
        commands.choices[name].add_argument("--lexicons", required=True)
    for name in ("clean", "enrich"):
        commands.choices[name].add_argument(
            "--emoji", help="Parquet table with columns emoji, nombre; default: a short list")
    for name in ("hate", "enrich"):
        commands.choices[name].add_argument(
            "--threshold", type=float, default=schemas.HATE_THRESHOLD)
    for name in ("clean", "hate", "sentiment", "enrich", "sentiment-windows"):
        commands.choices[name].add_argument(
            "--on-malformed", choices=("fail", "skip"), default="fail")
    for name in ("throughput", "sentiment-windows"):
        closing = commands.choices[name].add_mutually_exclusive_group(required=True)
        closing.add_argument("--late", help="how late a message may come, such as '10 minutes'")
        closing.add_argument(
            "--idle", type=float, help="close a window after so many seconds without a message for it")
    return top


def main(argv: Sequence[str] | None = None) -> None:
    args = parser().parse_args(argv)
    spark = get_session(f"murmullo-{args.command}")
    if args.command == "report":
        given = {name: getattr(args, name) for name in ("k", "min_comments", "hours_behind")}
        options = {name: value for name, value in given.items() if value is not None}
        batch.run_report(spark, args.name, args.source, args.target, **options)
    elif args.command == "synonyms":
        batch.run_synonyms(
            spark, args.source, args.target, args.model, args.terms, from_counts=args.from_counts,
            min_count=args.min_count,
        )
    elif args.command == "publish":
        batch.run_publish(spark, args.source, _topic(args, schemas.TOPIC_RAW))
    elif args.command == "export":
        topic = _topic(args, schemas.TOPIC_FINAL)
        batch.run_export(spark, topic, args.paths, args.max_messages)
    else:
        _stream(spark, args).awaitTermination()


def _stream(spark, args: argparse.Namespace):
    common = {
        "checkpoint": args.checkpoint, "name": args.command, "trigger": args.trigger,
        "max_per_trigger": args.max_per_trigger,
    }
    for setting in ("on_malformed", "late", "idle"):
        if hasattr(args, setting):
            common[setting] = getattr(args, setting)

    def topics(source: str, sink: str) -> tuple[Topic, Topic]:
        return _topic(args, source), _topic(args, sink)

    emoji = EMOJI_NAMES
    if getattr(args, "emoji", None):
        emoji = emoji_names(spark.read.parquet(args.emoji))
    if args.command == "clean":
        ends = topics(schemas.TOPIC_RAW, schemas.TOPIC_CLEAN)
        return jobs.start_stage(spark, *ends, jobs.clean_stage(emoji), **common)
    if args.command == "throughput":
        ends = topics(schemas.TOPIC_RAW, schemas.TOPIC_THROUGHPUT)
        return jobs.start_throughput(spark, *ends, **common)
    if args.command == "sentiment-windows":
        ends = topics(schemas.TOPIC_FINAL, schemas.TOPIC_SENTIMENT)
        return jobs.start_sentiment_windows(spark, *ends, **common)
    hate, sentiment = _lexicons(args.lexicons)
    if args.command == "hate":
        ends = topics(schemas.TOPIC_CLEAN, schemas.TOPIC_CLASSIFIED)
        return jobs.start_stage(spark, *ends, jobs.hate_stage(hate, args.threshold), **common)
    if args.command == "sentiment":
        ends = topics(schemas.TOPIC_CLASSIFIED, schemas.TOPIC_FINAL)
        return jobs.start_stage(spark, *ends, jobs.sentiment_stage(sentiment), **common)
    ends = topics(schemas.TOPIC_RAW, schemas.TOPIC_FINAL)
    return jobs.start_enrichment(spark, *ends, hate, sentiment, threshold=args.threshold, emoji=emoji, **common)


if __name__ == "__main__":
    main()
