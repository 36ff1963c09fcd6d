"""Jobs: python -m editengine {publish,pipeline,reports,compact,train} ..."""

from __future__ import annotations

import argparse

from pyspark.sql import functions as F

from editengine.operators import ingest
from editengine.plans import registry, training
from editengine.session import build_session
from editengine.sources import tables
from editengine.streaming import pipeline, sinks


def arguments() -> argparse.Namespace:
    parser = argparse.ArgumentParser(prog="editengine")
    jobs = parser.add_subparsers(dest="job", required=True)

    publish = jobs.add_parser("publish", help="enrich JSON lines of the feed and publish them as messages")
    publish.add_argument("lines", help="folder of JSON text lines")
    publish.add_argument("--wiki")
    publish.add_argument("--types", nargs="*")
    publish.add_argument("--checkpoint", help="keep publishing new files as a stream, with its checkpoint here")

    run = jobs.add_parser("pipeline", help="run the four streams")
    run.add_argument("root", help="folder of the layer tables")
    run.add_argument("--once", action="store_true", help="process what is there and end")
    run.add_argument("--rejects", action="store_true", help="keep the messages that bronze leaves out in a table")

    for job in (publish, run):
        target = job.add_mutually_exclusive_group(required=True)
        target.add_argument("--folder", help="folder of (key, value) message files")
        target.add_argument("--servers", help="Kafka bootstrap servers")
        job.add_argument("--topic", default="edits")

    reports = jobs.add_parser("reports", help="print reports of an edit store")
    reports.add_argument("store")
    reports.add_argument("keys", nargs="*", help="report keys; all of them by default")
    reports.add_argument("--snapshot", help="a snapshot that the store's batches follow")

    compact = jobs.add_parser("compact", help="turn a store of micro-batches into a snapshot without expired rows")
    compact.add_argument("store")
    compact.add_argument("snapshot")
    compact.add_argument("--earlier", help="the snapshot that the store's batches follow")

    train = jobs.add_parser("train", help="fit, evaluate and save the models of a silver table")
    train.add_argument("silver")
    train.add_argument("out")
    return parser.parse_args()


def main() -> None:
    args = arguments()
    spark = build_session(f"editengine-{args.job}")
    if args.job == "publish":
        lines = tables.read_lines(spark, args.lines, stream=args.checkpoint is not None)
        if args.checkpoint:
            # Counters of all batches and runs, beside the checkpoint.
            spark.streams.addListener(sinks.StreamTotals(spark, f"{args.checkpoint.rstrip('/')}-totals"))
            messages = ingest.publishable(ingest.observed(lines, wiki=args.wiki, types=args.types), args.wiki, args.types)
            if args.servers:
                running = sinks.stream_kafka(messages, args.servers, args.topic, args.checkpoint)
            else:
                running = sinks.write_parquet(messages, args.folder, args.checkpoint)
            running.awaitTermination()
        elif args.servers:
            sinks.write_kafka(ingest.publishable(lines, args.wiki, args.types), args.servers, args.topic)
        else:
            sinks.write_messages(ingest.publishable(lines, args.wiki, args.types), args.folder)
    elif args.job == "pipeline":
        if args.servers:
            # A run that ends with what is there must begin with what is there.
            starting = "earliest" if args.once else "latest"
            messages = tables.read_kafka_stream(spark, args.servers, args.topic, starting)
        else:
            messages = tables.read_message_stream(spark, args.folder)
        running = pipeline.start(messages, args.root, available_now=args.once, keep_rejects=args.rejects)
        if not args.once:
            running.await_any()
    elif args.job == "reports":
        store = tables.scan_store(spark, args.store, snapshot=args.snapshot)
        for key in args.keys or registry.REPORTS:
            report = registry.REPORTS[key]
            print(f"{report.label}: {report.description}")
            registry.run_report(store, key).show(20, truncate=False)
    elif args.job == "compact":
        sinks.compact_store(spark, args.store, args.snapshot, F.current_timestamp(), args.earlier)
    else:
        training.train_all(tables.read_silver(spark, args.silver), args.out).summary.show(truncate=False)
    spark.stop()


if __name__ == "__main__":
    main()
