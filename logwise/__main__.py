"""Command line for the two applications.

  python -m logwise logs --input DIR --output DIR --checkpoint DIR [--once]
      watch a folder of log files: error records, incomplete lines, counts
      per level, 4 s / 2 s windows per level (2 s micro-batches).
  python -m logwise comments (--brokers B --topics T | --input DIR) \\
        --dictionary PATH --ledger DIR --checkpoint DIR [--once]
      comment word counts into the monthly ledger (3 s micro-batches,
      dictionary reloaded every 5 minutes, its versions kept beside the
      checkpoint so that a replay sees the same words).
  python -m logwise totals --ledger DIR [--compacted DIR] [--month yyyyMM]
      print the monthly totals.

``--once`` processes what is there and stops (a catch-up or replay run).
"""

from __future__ import annotations

import argparse
import sys

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from logwise.session import build_session
from logwise.settings import COMMENT_BATCH, LOG_BATCH
from logwise.sinks.ledger import monthly_totals
from logwise.sources.comments import read_comments
from logwise.sources.dictionary import RefreshingDictionary, load_words
from logwise.streaming.apps import start_comment_word_counts, start_log_analysis
from logwise.streaming.runner import drain


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="python -m logwise", description=__doc__.split("\n\n")[0])
    sub = p.add_subparsers(dest="command", required=True)

    logs = sub.add_parser("logs", help="log analysis over a folder of log files")
    logs.add_argument("--input", required=True)
    logs.add_argument("--output", required=True)
    logs.add_argument("--checkpoint", required=True)
    logs.add_argument("--glob", default=None)
    logs.add_argument("--files-per-trigger", type=int, default=None)
    logs.add_argument("--once", action="store_true")

    com = sub.add_parser("comments", help="comment word counts into the monthly ledger")
    src = com.add_mutually_exclusive_group(required=True)
    src.add_argument("--topics")
    src.add_argument("--input", help="folder of parquet files with a 'value' (and 'timestamp') column")
    com.add_argument("--brokers")
    com.add_argument("--dictionary", required=True, help="parquet table with a 'word' column")
    com.add_argument("--ledger", required=True)
    com.add_argument("--checkpoint", required=True)
    com.add_argument("--method", choices=["spaces", "dictionary", "substrings"], default="spaces")
    com.add_argument("--once", action="store_true")

    tot = sub.add_parser("totals", help="print monthly totals from the ledger")
    tot.add_argument("--ledger", required=True)
    tot.add_argument("--compacted", default=None)
    tot.add_argument("--month", action="append", default=None)
    tot.add_argument("--rows", type=int, default=20)
    return p


def run(argv: list[str] | None = None, spark: SparkSession | None = None) -> int:
    args = parser().parse_args(sys.argv[1:] if argv is None else argv)
    spark = spark or build_session(app_name=f"logwise-{args.command}")

    if args.command == "logs":
        query = start_log_analysis(
            spark,
            args.input,
            args.output,
            args.checkpoint,
            trigger=None if args.once else LOG_BATCH,
            glob=args.glob,
            max_files_per_trigger=args.files_per_trigger,
        )
        drain(query)
        return 0

    if args.command == "comments":
        if args.topics:
            if not args.brokers:
                raise SystemExit("--topics needs --brokers")
            comments = read_comments(spark, args.brokers, args.topics)
        else:
            comments = spark.readStream.schema("value string, timestamp timestamp").parquet(args.input)
            comments = comments.withColumn("timestamp", F.coalesce("timestamp", F.current_timestamp()))
        dictionary = RefreshingDictionary(
            spark, lambda: load_words(spark, path=args.dictionary), store_path=f"{args.checkpoint}-dictionary"
        )
        q = start_comment_word_counts(
            comments,
            dictionary,
            args.ledger,
            args.checkpoint,
            trigger=None if args.once else COMMENT_BATCH,
            method=args.method,
        )
        drain(q)
        return 0

    totals = monthly_totals(spark, args.ledger, months=args.month, compacted_path=args.compacted)
    totals.orderBy("month", "date", F.desc("count")).show(args.rows, truncate=False)
    return 0


if __name__ == "__main__":
    sys.exit(run(sys.argv[1:]))
