"""Command line of the batch jobs.

    convert        raw log -> canonical events as Parquet, or as a table bucketed by user
    store-sessions any log -> its sessions added to those stored before
    json-sessions  JSON log -> sessions with pages, top pages
    csv-sessions   CSV log -> sessions with products, product statistics
    basic, engagement, products, timing, returns, behavior, overview
                   any log -> one Parquet dataset per result under --out

A text log is parsed once: the job first stores the canonical events as Parquet,
where each result reads only the columns it needs, in the folder that --staging
names or beside the results. With --no-staging every result parses the log
again. `convert` stores the events alone, for several jobs.

Jobs that make sessions also write `dropped_events`, the number of events that
have no timestamp and therefore no session.
"""

from __future__ import annotations

import argparse
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession

from clicktrail.functions.events import DEFAULT_GAP_MINUTES
from clicktrail.operators.session_store import SessionStore
from clicktrail.operators.sessions import NULL_TS_POLICIES, dropped_events, session_table
from clicktrail.plans import analyses
from clicktrail.session import build_spark
from clicktrail.sources.readers import LOG_READERS, READERS, event_format, read_events
from clicktrail.sources.writers import write_csv, write_event_table, write_parquet


def _read(spark: SparkSession, args: argparse.Namespace, fmt: str | None, keep: Sequence[str] = ()) -> DataFrame:
    """The input's events; with --rejects, lines that are none are written and counted."""
    chosen = event_format(args.input, fmt)
    if not args.rejects or chosen not in LOG_READERS:
        return read_events(spark, args.input, fmt, keep)
    log = LOG_READERS[chosen](spark, args.input, keep)
    write_parquet(log.rejects, args.rejects)
    spark.read.parquet(args.rejects).groupBy("file", "reason").count().show(truncate=False)
    return log.events


def _events(spark: SparkSession, args: argparse.Namespace, fmt: str | None) -> DataFrame:
    events = _read(spark, args, fmt)
    if args.no_staging or (event_format(args.input, fmt) == "parquet" and not args.staging):
        return events
    staging = args.staging or f"{getattr(args, 'out', None) or args.out_sessions}_events"
    write_parquet(events, staging)
    return read_events(spark, staging, "parquet")


def _convert(spark: SparkSession, args: argparse.Namespace) -> None:
    events = _read(spark, args, args.format, args.keep)
    if args.buckets:
        write_event_table(events, args.table, args.out, args.buckets)
    else:
        write_parquet(events, args.out)


def _store_sessions(spark: SparkSession, args: argparse.Namespace) -> None:
    store = SessionStore(spark, args.store, args.gap_minutes, args.lists)
    added = store.add(_read(spark, args, args.format), args.batch)
    print(f"batch {args.batch!r} {'added' if added else 'was there already'}")
    if args.compact:
        store.compact()
    if args.out:
        write_parquet(store.sessions(), args.out)


def _dropped(events: DataFrame, args: argparse.Namespace) -> None:
    write_parquet(dropped_events(events, args.null_ts), f"{args.out_sessions}_dropped_events")


def _json_sessions(spark: SparkSession, args: argparse.Namespace) -> None:
    events = _events(spark, args, "json")
    sessions, pages = analyses.page_analysis(events, args.gap_minutes, args.null_ts)
    write_parquet(sessions, args.out_sessions)
    write_parquet(pages, args.out_top)
    _dropped(events, args)


def _csv_sessions(spark: SparkSession, args: argparse.Namespace) -> None:
    events = _events(spark, args, "csv")
    sessions, products = analyses.product_analysis(
        events, args.gap_minutes, args.null_ts, args.cart_scope
    )
    write_parquet(sessions, args.out_sessions)
    write_parquet(products, args.out_products)
    _dropped(events, args)
    # The summaries read the stored results, not the log again.
    analyses.session_summary(spark.read.parquet(args.out_sessions)).show()
    stored = spark.read.parquet(args.out_products)
    analyses.top_five_products(stored.orderBy(stored["view_count"].desc(), "ProductID")).show()


def _stored_sessions(spark: SparkSession, events: DataFrame, args: argparse.Namespace) -> DataFrame:
    """The session table, written once and read by every result built on it."""
    path = f"{args.out}/session_table"
    write_parquet(session_table(events, args.gap_minutes, args.null_ts), path)
    return spark.read.parquet(path)


def _basic(spark: SparkSession, events: DataFrame, args: argparse.Namespace) -> dict[str, DataFrame]:
    table = _stored_sessions(spark, events, args)
    return analyses.basic_report(events, args.gap_minutes, args.null_ts, table)


def _engagement(spark: SparkSession, events: DataFrame, args: argparse.Namespace) -> dict[str, DataFrame]:
    table = _stored_sessions(spark, events, args)
    return analyses.engagement_report(events, args.gap_minutes, args.null_ts, table)


def _returns(spark: SparkSession, events: DataFrame, args: argparse.Namespace) -> dict[str, DataFrame]:
    """The gaps are written once; histogram and categories read them."""
    path = f"{args.out}/gaps"
    write_parquet(analyses.return_gaps(events), path)
    return analyses.user_returns(spark.read.parquet(path))


REPORTS: dict[str, Callable[[SparkSession, DataFrame, argparse.Namespace], dict[str, DataFrame]]] = {
    "basic": _basic,
    "engagement": _engagement,
    "products": lambda spark, events, args: analyses.product_report(events),
    "timing": lambda spark, events, args: analyses.timing_patterns(events, args.time_unit),
    "returns": _returns,
    "behavior": lambda spark, events, args: analyses.product_behavior(events),
    "overview": lambda spark, events, args: analyses.overview(events),
}


def _report(spark: SparkSession, args: argparse.Namespace) -> None:
    events = _events(spark, args, args.format)
    for name, result in REPORTS[args.job](spark, events, args).items():
        if args.csv:
            write_csv(result, f"{args.out}/{name}", args.single_file)
        else:
            write_parquet(result, f"{args.out}/{name}")


def _parser() -> argparse.ArgumentParser:
    parser = argparse.ArgumentParser(prog="clicktrail", description=__doc__.split("\n")[0])
    jobs = parser.add_subparsers(dest="job", required=True)

    def add(name: str, run: Callable, sessions: bool) -> argparse.ArgumentParser:
        job = jobs.add_parser(name)
        job.set_defaults(run=run)
        job.add_argument("--input", required=True, help="file or folder")
        job.add_argument("--rejects", help="write lines that are no events here; they are no events then")
        if name not in ("convert", "store-sessions"):
            job.add_argument("--staging", help="store the canonical events here and read them back")
            job.add_argument("--no-staging", action="store_true", help="parse a text log for every result")
        if sessions:
            job.add_argument("--gap-minutes", type=int, default=DEFAULT_GAP_MINUTES)
            job.add_argument("--null-ts", choices=NULL_TS_POLICIES, default="drop")
        return job

    convert = add("convert", _convert, False)
    convert.add_argument("--format", choices=list(READERS))
    convert.add_argument("--keep", nargs="*", default=[], help="further source columns")
    convert.add_argument("--out", required=True)
    convert.add_argument("--buckets", type=int, help="a table laid out by user in so many buckets, for many jobs")
    convert.add_argument("--table", default="events", help="the bucketed table's name")

    store = add("store-sessions", _store_sessions, False)
    store.add_argument("--format", choices=list(READERS))
    store.add_argument("--store", required=True, help="folder of the stored sessions")
    store.add_argument("--batch", required=True, help="name of this batch; a batch is added once")
    store.add_argument("--gap-minutes", type=int, default=DEFAULT_GAP_MINUTES)
    store.add_argument("--lists", action="store_true", help="keep the sessions' events too")
    store.add_argument("--compact", action="store_true", help="write all sessions anew afterwards")
    store.add_argument("--out", help="write the session table here")

    json_sessions = add("json-sessions", _json_sessions, True)
    json_sessions.add_argument("--out-sessions", required=True)
    json_sessions.add_argument("--out-top", required=True)

    csv_sessions = add("csv-sessions", _csv_sessions, True)
    csv_sessions.add_argument("--out-sessions", required=True)
    csv_sessions.add_argument("--out-products", required=True)
    csv_sessions.add_argument("--cart-scope", choices=["viewed_rows", "all_events"], default="viewed_rows")

    for name in REPORTS:
        report = add(name, _report, name in ("basic", "engagement"))
        report.add_argument("--format", choices=list(READERS))
        report.add_argument("--out", required=True)
        report.add_argument("--csv", action="store_true", help="write CSV instead of Parquet")
        report.add_argument("--single-file", action="store_true", help="one CSV file per result")
        if name == "timing":
            report.add_argument("--time-unit", choices=["hour", "day_of_week", "month"], default="hour")
    return parser


def main(argv: Sequence[str] | None = None, session: SparkSession | None = None) -> None:
    """Run a job, in `session` or the running session if there is one."""
    args = _parser().parse_args(argv)
    running = session or SparkSession.getActiveSession()
    spark = running or build_spark(f"clicktrail-{args.job}")
    try:
        args.run(spark, args)
    finally:
        if running is None:
            spark.stop()
