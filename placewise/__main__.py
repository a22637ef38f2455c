"""Run a report over landed posts: ``spark-submit ... -m placewise`` or ``python -m placewise``.

    python -m placewise device_share --posts landing/devices
    python -m placewise hourly_geo --posts landing/times --tz America/New_York --out tables/hours
    python -m placewise place_vs_profile --posts landing/places --profiles landing/users --out tables/pairs
    python -m placewise device_share --posts landing/devices --live --every "30 seconds" \\
        --out tables/devices --checkpoint checkpoints/devices
"""

from __future__ import annotations

import argparse

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql.streaming import StreamingQuery

from placewise.jobs import JOBS
from placewise.operators.counting import ranked
from placewise.session import build_session
from placewise.sources.drift import schema_drift
from placewise.sources.posts import LINES, NO_POSTS, lines_by_batch, read_gender_records, read_posts, stream_gender_records, stream_posts
from placewise.sources.schemas import GENDER_RECORD, POST
from placewise.streaming.reports import ITEMS, land_fresh_genders, windowed_count, windowed_top
from placewise.streaming.sinks import append_files, replace_table, to_console

LOOKUP = "username string, name string, gender string, country string, probability long, total_names long"
# Options of the command line, and their names as arguments of the reports.
OPTIONS = {"strict": "strict", "each_user": "each_user", "every_handle": "every", "ignore_case": "ignore_case", "whole_word": "whole_word"}
OBSERVED = "lines"
REGIONS = "location string, attribute string"


def parse(argv: list[str] | None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(prog="placewise", description=__doc__.splitlines()[0])
    parser.add_argument("report", choices=sorted(JOBS))
    parser.add_argument("--posts", required=True, help="directory of landed posts (of gender records for record_share)")
    parser.add_argument("--profiles", help="directory of posts with profile locations; default: the posts")
    parser.add_argument("--lookup", help=f"directory of JSON lines: {LOOKUP}")
    parser.add_argument("--regions", help=f"directory of JSON lines: {REGIONS}")
    parser.add_argument("--format", default="json", choices=("json", "parquet", "orc"), help="of the posts")
    parser.add_argument("--tz", default="UTC", help="time zone of the hours; 'session' is that of the session")
    parser.add_argument("--strict", action="store_true", help="only posts whose author states a profile location")
    parser.add_argument("--each-user", action="store_true", help="single locations instead of lists of them")
    parser.add_argument("--every-handle", action="store_true", help="all handles of a post instead of the last")
    parser.add_argument("--ignore-case", action="store_true", help="positive words in any case")
    parser.add_argument("--whole-word", action="store_true", help="positive words only as words of their own")
    parser.add_argument("--torn", action="store_true", help="count the lines that are no posts in the same scan, and print their number at the end")
    parser.add_argument("--window", help="live: count by time windows of this length, with bounded state")
    parser.add_argument("--top", type=int, help="with --window: only so many values of each window, from summaries of bounded size")
    parser.add_argument("--fresh", action="store_true", help="live: read the lookup anew for every batch (enriched_genders)")
    parser.add_argument("--watermark", default="1 hour", help="how late posts may come for --window")
    parser.add_argument("--out", help="directory for the result (Parquet); default: print it")
    parser.add_argument("--rows", type=int, default=20, help="rows to print")
    parser.add_argument("--schema", action="store_true", help="print the schema that is read, then run")
    parser.add_argument("--drift", action="store_true", help="print where the first JSON lines differ from the declared schema, then run")
    parser.add_argument("--live", action="store_true", help="keep the report up to date")
    parser.add_argument("--every", help="pause between live batches; default: handle what has landed and end")
    parser.add_argument("--max-files", type=int, help="landed files per live batch; default: all there are")
    parser.add_argument("--checkpoint", help="directory for the state of a live report")
    args = parser.parse_args(argv)
    job = JOBS[args.report]
    if args.live and not job.live:
        parser.error(f"{args.report} has no live form")
    if args.live and args.out and not args.checkpoint:
        parser.error("--live --out needs --checkpoint")
    if args.window and not (args.live and job.window):
        parser.error("--window needs --live and a report of devices, locations or handles")
    if args.top and not args.window:
        parser.error("--top needs --window")
    if args.fresh and not (args.live and args.out and args.report == "enriched_genders"):
        parser.error("--fresh needs --live, --out and the report enriched_genders")
    for option in OPTIONS:
        if getattr(args, option) and option not in job.options:
            parser.error(f"{args.report} takes no --{option.replace('_', '-')}")
    for need in set(job.needs) - {"profiles"}:
        if not getattr(args, need):
            parser.error(f"{args.report} needs --{need}")
    return args


def options(args: argparse.Namespace) -> dict:
    """What the report's function is called with."""
    job = JOBS[args.report]
    found = {OPTIONS[o]: True for o in job.options if getattr(args, o)}
    return found | ({"tz": None if args.tz == "session" else args.tz} if job.zoned else {})


def tables(spark: SparkSession, args: argparse.Namespace) -> list[DataFrame]:
    """The further inputs of the report."""
    job, inputs = JOBS[args.report], []
    if "profiles" in job.needs:
        inputs.append(read_posts(spark, args.profiles or args.posts, *job.fields, format=args.format))
    if "lookup" in job.needs:
        inputs.append(spark.read.schema(LOOKUP).json(args.lookup))
    if "regions" in job.needs:
        inputs.append(spark.read.schema(REGIONS).json(args.regions))
    return inputs


def run_batch(spark: SparkSession, args: argparse.Namespace) -> None:
    job = JOBS[args.report]
    observed = Observation("lines") if args.torn and args.format == "json" and job.reads == "posts" else None
    if job.reads == "records":
        first = read_gender_records(spark, args.posts)
    else:
        first = read_posts(spark, args.posts, *job.fields, format=args.format, observed=observed)
    if args.schema:
        first.printSchema()
    result = job.batch(first, *tables(spark, args), **options(args))
    if args.out:
        result.write.mode("overwrite").parquet(args.out)
    else:
        result.show(args.rows, truncate=False)
    if observed:
        print(f"{observed.get[NO_POSTS]} of {observed.get[LINES]} lines read are no posts")


def run_live(spark: SparkSession, args: argparse.Namespace) -> None:
    job = JOBS[args.report]
    if job.reads == "records":
        first = stream_gender_records(spark, args.posts, args.max_files)
    else:
        stamp = ["data.created_at"] if args.window else []
        first = stream_posts(spark, args.posts, *job.fields, *stamp, format=args.format, max_files=args.max_files,
                             observed=OBSERVED if args.torn and args.format == "json" else None)
    if args.schema:
        first.printSchema()
    run = {"available_now": not args.every, "every": args.every}
    if args.window:
        if args.top:
            rows = windowed_top(first, job.window(), args.watermark, args.window, args.top, max(args.top, ITEMS))
        else:
            rows = windowed_count(first, job.window(), args.watermark, args.window)
        query = append_files(rows, args.out, args.checkpoint, **run) if args.out else to_console(rows, "append", args.checkpoint, **run)
        _await(query, args)
        return
    if args.fresh:
        query = land_fresh_genders(first, lambda session: session.read.schema(LOOKUP).json(args.lookup), args.out, args.checkpoint, **run)
        _await(query, args)
        return
    rows = job.live(first, *tables(spark, args), **options(args))
    if not args.out:
        rows = ranked(rows, *job.rank) if job.rank else rows
        query = to_console(rows, "append" if job.appends else "complete", args.checkpoint, **run)
    elif job.appends:
        query = append_files(rows, args.out, args.checkpoint, job.appends, **run)
    else:
        query = replace_table(rows, args.out, args.checkpoint, job.state_partitions, **run)
    _await(query, args)


def _await(query: StreamingQuery, args: argparse.Namespace) -> None:
    """Waits for a query to end, then prints what its batches counted if that was asked for."""
    query.awaitTermination()
    for number, lines, torn in lines_by_batch(query, OBSERVED) if args.torn else ():
        print(f"batch {number}: {torn} of {lines} lines are no posts")


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> None:
    args = parse(argv)
    spark = spark or build_session()
    if args.drift:
        schema_drift(spark, args.posts, GENDER_RECORD if JOBS[args.report].reads == "records" else POST).show(args.rows, truncate=False)
    (run_live if args.live else run_batch)(spark, args)


if __name__ == "__main__":
    main()
