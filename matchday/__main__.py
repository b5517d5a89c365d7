"""Run a job from the command line: ``python -m matchday <job> ...`` or through spark-submit.

Connectors come with ``--packages`` of spark-submit; their options, with secrets, with ``--source``,
``--documents`` and ``--sink`` as name=value.
"""

from __future__ import annotations

import argparse

from pyspark.sql import functions as F

from matchday.plans.publish import FIRST_YEAR, LAST_YEAR, publish
from matchday.session import build_session
from matchday.sources.streams import stream
from matchday.streaming import jobs, sinks


def _pairs(values: list[str] | None) -> dict[str, str]:
    return dict(value.split("=", 1) for value in values or [])


def _arguments() -> argparse.Namespace:
    parser = argparse.ArgumentParser(prog="matchday")
    parser.add_argument("--master")
    parser.add_argument("--conf", action="append", help="Spark setting name=value")
    jobs_of = parser.add_subparsers(dest="job", required=True)

    send = jobs_of.add_parser("publish", help="CSV files to messages")
    send.add_argument("--files", required=True, help="folder of <league>_<season>.csv files")
    send.add_argument("--format", default="kafka")
    send.add_argument("--sink", action="append", metavar="NAME=VALUE")
    send.add_argument("--report", help="folder for the report as CSV, a row per season and league")
    send.add_argument("--first-year", type=int, default=FIRST_YEAR)
    send.add_argument("--last-year", type=int, default=LAST_YEAR)

    for name, text in (
        ("land", "messages to Parquet and documents"),
        ("features-a", "feature table A per micro-batch"),
        ("features-b", "feature table B per micro-batch"),
    ):
        job = jobs_of.add_parser(name, help=text)
        job.add_argument("--format", default="kafka")
        job.add_argument("--source", action="append", metavar="NAME=VALUE")
        job.add_argument("--schema", help="columns of a file source, with value")
        job.add_argument("--max-per-trigger", type=int, help="offsets, or files, of one micro-batch")
        job.add_argument("--checkpoint", required=True)
        job.add_argument("--out", required=True, help="Parquet folder of this job alone")
        job.add_argument("--documents-format")
        job.add_argument("--documents", action="append", metavar="NAME=VALUE")
        job.add_argument("--documents-key", metavar="NAME,NAME", help="replace documents by these fields, with MongoDB's options")
        job.add_argument("--once", action="store_true", help="stop when all is read")
        if name == "land":
            job.add_argument("--console", action="store_true")
            job.add_argument("--quarantine", help="Parquet folder for texts that are no record")
        else:
            job.add_argument("--documents-ledger", help="folder that says which batches a store without upsert has")
            job.add_argument("--tie", default="partition,offset", help="columns that order matches of a day")
    return parser.parse_args()


def main() -> None:
    args = _arguments()
    spark = build_session(f"matchday {args.job}", args.master, **_pairs(args.conf))
    if args.job == "publish":
        options = _pairs(args.sink)
        report = publish(spark, args.files, args.format, options, args.first_year, args.last_year)
        if args.report:
            report.write.mode("overwrite").option("header", True).csv(args.report)
        # one line per outcome; the pairs are in the report
        report.groupBy("status").agg(F.count("*").alias("pairs"), F.sum("rows").alias("rows")).orderBy("status").show()
        return
    messages = stream(spark, args.format, _pairs(args.source), args.schema, args.max_per_trigger)
    documents = _pairs(args.documents)
    if args.documents_key:
        key = args.documents_key.split(",")
        documents = {**sinks.upsert_options(documents.get("database", ""), documents.get("collection", ""), key), **documents}
    if args.job == "land":
        started = jobs.landing_job(
            messages, args.out, args.checkpoint, args.documents_format, documents, args.console, args.once,
            args.quarantine,
        )
    else:
        writes = [sinks.replace_batch(args.out)]
        if args.documents_format:
            writes.append(
                sinks.append_once(args.documents_format, documents, args.documents_ledger)
                if args.documents_ledger
                else sinks.append_documents(args.documents_format, documents)
            )
        start = jobs.feature_job_a if args.job == "features-a" else jobs.feature_job_b
        started = [start(messages, args.tie.split(","), args.checkpoint, *writes, once=args.once)]
    sinks.wait(spark, started)


if __name__ == "__main__":
    main()
