"""Jobs for ``spark-submit``: ``python -m footfall <job> …``.

    session | page | area   --params '{startDate:"2020-01-01", …}' and a result sink
    ad-stream | traffic-stream | ad-ingest   a line source, --tables and --checkpoint
    report   the day's course reports from the traffic stream's --tables
"""

from __future__ import annotations

import argparse

from footfall.params import task_params_from_json
from footfall.plans import jobs
from footfall.session import build_session
from footfall.sinks.results import ResultSink
from footfall.sources import streams, tables
from footfall.streaming import ad_stream, traffic_stream


def _arguments(argv: list[str] | None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(prog="footfall")
    commands = parser.add_subparsers(dest="job", required=True)
    report = commands.add_parser("report")
    report.add_argument("--tables", required=True, help="folder of the traffic stream's tables")
    report.add_argument("--day", required=True, help="yyyyMMdd")
    report.add_argument("--output", required=True, help="folder of the result tables")
    for name in ("session", "page", "area"):
        job = commands.add_parser(name)
        job.add_argument("--params", required=True, help="task description as JSON")
        sink = job.add_mutually_exclusive_group(required=True)
        sink.add_argument("--output", help="folder of the result tables")
        sink.add_argument("--jdbc", nargs="+", default=[], metavar="KEY=VALUE",
                          help="JDBC options instead of a folder")
        job.add_argument("--actions", default="user_visit_action", help="action table")
        job.add_argument("--users", default="user_info", help="user table")
    for name, interval in (
        ("ad-stream", "5 seconds"), ("traffic-stream", "60 seconds"), ("ad-ingest", "5 seconds"),
    ):
        job = commands.add_parser(name)
        source = job.add_mutually_exclusive_group(required=True)
        source.add_argument("--kafka", nargs=2, metavar=("SERVERS", "TOPIC"))
        source.add_argument("--text", help="folder of text files")
        job.add_argument("--tables", required=True, help="folder of the result tables")
        job.add_argument("--checkpoint", required=True)
        job.add_argument("--interval", default=interval)
        job.add_argument("--once", action="store_true", help="work off what is there and stop")
    return parser.parse_args(argv)


def main(argv: list[str] | None = None) -> None:
    args = _arguments(argv)
    spark = build_session(f"footfall {args.job}")
    if args.job in ("session", "page", "area"):
        if args.jdbc:
            sink = ResultSink("jdbc", options=dict(o.split("=", 1) for o in args.jdbc))
        else:
            sink = ResultSink(path=args.output)
        p = task_params_from_json(spark, args.params)
        actions = tables.user_visit_actions(spark, args.actions)
        if args.job == "session":
            task = jobs.run_session_job(actions, tables.user_info(spark, args.users), p, sink)
        elif args.job == "page":
            task = jobs.run_page_job(actions, p, sink)
        else:
            task = jobs.run_area_job(spark, actions, p, sink)
        print(task)
        return

    if args.job == "report":
        stored = traffic_stream.TrafficTables.at(spark, args.tables)
        print(jobs.run_report_job(stored, args.day, ResultSink(path=args.output)))
        return

    if args.kafka:
        lines = streams.kafka_lines(spark, *args.kafka)
    else:
        lines = streams.text_lines(spark, args.text)
    interval = None if args.once else args.interval
    if args.job == "ad-stream":
        result = ad_stream.AdTables.at(spark, args.tables)
        if args.once:
            ad_stream.run_ad_stream(lines, result, args.checkpoint)
            return
        query = ad_stream.start_ad_stream(lines, result, args.checkpoint, interval)
    elif args.job == "ad-ingest":
        query = ad_stream.start_ad_ingest(lines, args.tables, args.checkpoint, interval)
    else:
        result = traffic_stream.TrafficTables.at(spark, args.tables)
        query = traffic_stream.start_traffic_stream(lines, result, args.checkpoint, interval)
    query.awaitTermination()


if __name__ == "__main__":
    main()
