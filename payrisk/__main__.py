"""Command line: ``spark-submit`` this module's jobs, or ``python -m payrisk ...``."""

from __future__ import annotations

import argparse

from payrisk import operators as ops
from payrisk import plans, sources
from payrisk.functions import with_risk
from payrisk.schema import LABEL_COUNT_SCHEMA
from payrisk.session import create_session
from payrisk.streaming import kafka_options, read_tx_stream


def _parser() -> argparse.ArgumentParser:
    parser = argparse.ArgumentParser(prog="payrisk", description=__doc__)
    commands = parser.add_subparsers(dest="command", required=True)

    def command(name: str, about: str, *arguments: str) -> argparse.ArgumentParser:
        sub = commands.add_parser(name, help=about)
        for argument in arguments:
            sub.add_argument(argument)
        return sub

    command("train", "features, label counts, three models, test-set scores", "data", "out")
    command("export", "score a whole table to CSV parts", "data", "model", "out")
    marts = command("marts", "BI tables from exported scores", "scored", "labels", "out")
    marts.add_argument("--limit", type=int, help="sample the fact table to so many rows")
    command("distributions", "histograms of exported scores", "scored", "out")
    score = command("score", "score a table to CSV parts, show the riskiest", "data", "model", "out")
    score.add_argument("--rows", type=int, default=20, help="rows to show")
    stream = command("stream", "score a Kafka topic until stopped", "model", "out")
    stream.add_argument("--bootstrap")
    stream.add_argument("--topic")
    publish = command("publish", "send transactions to a Kafka topic", "data", "bootstrap", "topic")
    publish.add_argument("--limit", type=int, help="only the first rows of the scan")
    return parser


def main(argv: list[str] | None = None) -> None:
    args = _parser().parse_args(argv)
    spark = create_session(f"payrisk-{args.command}")
    if args.command == "train":
        rows = sources.read_transactions(spark, args.data)
        plans.run_training(rows, args.out).show(truncate=False)
    elif args.command == "export":
        model = ops.load_model(spark, args.model)
        plans.run_export(sources.read_transactions(spark, args.data), model, args.out)
    elif args.command == "marts":
        labels = sources.read_csv_parts(spark, args.labels, LABEL_COUNT_SCHEMA, False)
        scored = sources.read_scored(spark, args.scored, may_be_missing=False)
        tables = plans.build_marts(scored, labels, args.limit)
        plans.write_marts(tables, args.out)
    elif args.command == "distributions":
        scored = with_risk(sources.read_scored(spark, args.scored, may_be_missing=False))
        sources.write_mart(ops.distributions(scored), args.out)
    elif args.command == "score":
        model = ops.load_model(spark, args.model)
        rows = sources.read_transactions(spark, args.data)
        scored = ops.score_transactions(rows, model)
        sources.write_csv(scored, args.out)
        written = sources.read_csv_parts(spark, args.out, scored.schema, False)
        ops.top_risk(written, args.rows).show(args.rows)
    elif args.command == "stream":
        events = read_tx_stream(spark, options=kafka_options(args.bootstrap, args.topic))
        model = ops.load_model(spark, args.model)
        plans.run_stream(spark, model, args.out, events).awaitTermination()
    else:
        rows = sources.read_transactions(spark, args.data)
        rows = rows if args.limit is None else ops.head_transactions(rows, args.limit)
        sources.publish_events(rows, args.bootstrap, args.topic)


if __name__ == "__main__":
    main()
