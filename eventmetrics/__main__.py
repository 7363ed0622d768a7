"""Command line: python -m eventmetrics {batch,stream,refresh,check,peek} --help"""

from __future__ import annotations

import argparse

import eventmetrics as em
from eventmetrics.schema import WINDOW_DURATION
from eventmetrics.streaming.sinks import AVAILABLE_NOW


def _options(pairs: list[str]) -> dict[str, str]:
    return dict(pair.split("=", 1) for pair in pairs)


def _parser() -> argparse.ArgumentParser:
    parser = argparse.ArgumentParser(prog="eventmetrics", description=__doc__)
    commands = parser.add_subparsers(dest="command", required=True)

    def command(name: str, text: str, source: bool = False, out: bool | None = True):
        sub = commands.add_parser(name, help=text)
        if source:
            sub.add_argument("--format", default="kafka",
                             choices=["kafka", "text", "json", "parquet"])
            sub.add_argument("--option", action="append", default=[], metavar="KEY=VALUE",
                             help="source option, such as path=/data/events")
        if out is not False:
            sub.add_argument("--out", required=bool(out), help="folder of the pipeline's output")
        return sub

    batch = command("batch", "rebuild lake and aggregates from a bounded source", source=True)
    stream = command("stream", "stream into lake and aggregate log", source=True)
    for sub in (batch, stream):
        sub.add_argument("--duration", default=WINDOW_DURATION)
    stream.add_argument("--distinct", default="users", choices=["users", "two_level", "update", "approx"])
    stream.add_argument("--watermark", help="accept events this late, such as '1 hour'")
    stream.add_argument("--every", default="30 seconds", help="time between micro-batches")
    stream.add_argument("--available-now", action="store_true",
                        help="process what there is, then stop")

    refresh = command("refresh", "load the serving table from the aggregate log")
    refresh.add_argument("--late-windows", metavar="DURATION",
                         help="count late events too, in windows of this duration")
    check = command("check", "fail unless the serving table passes the quality checks", out=None)
    check.add_argument("--freshness", action="store_true", help="also require recent rows")
    for sub in (refresh, check):
        sub.add_argument("--jdbc", action="append", default=[], metavar="KEY=VALUE",
                         help="use a database table: url=..., dbtable=..., user=...")

    peek = command("peek", "show the first events of a source", source=True, out=False)
    peek.add_argument("--rows", type=int, default=5)
    peek.add_argument("--order-by", nargs="+", metavar="COLUMN",
                      help="order all messages first, such as by partition offset")
    return parser


def main(argv: list[str] | None = None) -> None:
    parser = _parser()
    args = parser.parse_args(argv)
    if args.command == "check" and not (args.out or args.jdbc):
        parser.error("check needs --out or --jdbc")
    spark = em.build_session()
    if args.command == "batch":
        source = em.read_events(spark, args.format, _options(args.option))
        em.run_batch(spark, source, args.out, args.duration)
    elif args.command == "stream":
        source = em.read_event_stream(spark, args.format, _options(args.option))
        trigger = AVAILABLE_NOW if args.available_now else {"processingTime": args.every}
        em.run_stream(spark, source, args.out, args.duration, args.distinct, args.watermark,
                      trigger)
    elif args.command == "refresh":
        em.refresh_aggregates(spark, args.out, _options(args.jdbc) or None,
                              late_windows=args.late_windows)
    elif args.command == "check":
        table = (em.read_aggregates(spark, _options(args.jdbc)) if args.jdbc
                 else em.read_statistics(spark, f"{args.out}/aggregates"))
        em.assert_quality(table, freshness=args.freshness)
        print("all checks passed")
    else:
        source = em.read_events(spark, args.format, _options(args.option))
        em.peek_events(source, args.rows, args.order_by).show(args.rows, truncate=False)


if __name__ == "__main__":
    main()
