"""``python -m feedlake``: one daily load."""

from __future__ import annotations

import argparse
import logging

from feedlake import LoadConfig, build_session, daily_load


def main() -> None:
    parser = argparse.ArgumentParser(prog="feedlake", description="Load one day's feed files.")
    parser.add_argument("--syncday", required=True, help="YYYYMMDD")
    parser.add_argument(
        "--source",
        action="append",
        required=True,
        metavar="NAME=FOLDER",
        help="landing folder of a source; the second one decides how many payloads are expected",
    )
    parser.add_argument("--registry", required=True, help="JSON: record type key to column names")
    parser.add_argument("--target", required=True, help="folder of the published tables")
    parser.add_argument("--ledger", required=True, help="folder of the run ledger")
    parser.add_argument("--work", help="folder for this load's intermediate tables")
    parser.add_argument("--repair", nargs=2, action="append", default=[], metavar=("BAD", "GOOD"))
    parser.add_argument("--strict-markers", action="store_true")
    parser.add_argument("--fail-fast", action="store_true", help="tolerate no rejected line")
    parser.add_argument("--accept-partial", action="store_true", help="files with rejected lines are done, too")
    parser.add_argument("--anchored-headers", action="store_true", help="drop header-shaped lines only")
    parser.add_argument("--trim-lines", action="store_true")
    parser.add_argument("--date-scope", choices=("column", "row"), default="column")
    parser.add_argument("--date-rule", choices=("fallback", "coerce"), default="fallback")
    parser.add_argument("--money-on-error", choices=("fail", "null"), default="fail")
    parser.add_argument("--exclude-column", action="append", metavar="NAME", help="registered column to leave out")
    args = parser.parse_args()

    logging.basicConfig(level=logging.INFO)
    config = LoadConfig(
        sources=dict(source.split("=", 1) for source in args.source),
        registry=args.registry,
        target=args.target,
        ledger=args.ledger,
        work=args.work,
        syncday=args.syncday,
        repairs=[tuple(pair) for pair in args.repair],
        strict_markers=args.strict_markers,
        fail_fast=args.fail_fast,
        accept_partial=args.accept_partial,
        anchored_headers=args.anchored_headers,
        trim_lines=args.trim_lines,
        date_scope=args.date_scope,
        date_rule=args.date_rule,
        money_on_error=args.money_on_error,
        **({"exclude_columns": args.exclude_column} if args.exclude_column else {}),
    )
    spark = build_session("feedlake")
    result = daily_load(spark, config)
    for table, rows in sorted(result.tables.items()):
        print(f"{table}: {rows} rows")
    print(f"{result.status}: {result.published} published, ", end="")
    print(f"{result.held_back} held back, {result.rejected} rejected, ", end="")
    print(f"{result.dropped} dropped because they name their feed")
    if result.rejects is not None:
        print("rejects:", *sorted({path.rsplit("/", 1)[0] for path in result.rejects.inputFiles()}))
    if result.losses is not None:
        losses = result.losses.groupBy("recordtype", "column", "reason").sum("lost")
        for recordtype, column, reason, lost in sorted(losses.toLocalIterator(), key=repr):
            print(f"lost: {lost} x {reason} in {recordtype}{'.' + column if column else ''}")


if __name__ == "__main__":
    main()
