"""Command line: load, migrate, export, list-tables."""

from __future__ import annotations

import argparse
import sys

from tallyport import session
from tallyport.functions import identifiers
from tallyport.operators.remote import Database
from tallyport.operators.sink import OnConflict
from tallyport.operators.verify import VerifyMode
from tallyport.plans import database_load, jobs
from tallyport.sources import delimited


def parser() -> argparse.ArgumentParser:
    out = argparse.ArgumentParser(prog="tallyport", description=__doc__)
    commands = out.add_subparsers(dest="command", required=True)
    load = commands.add_parser("load", help="one file into one table")
    load.add_argument("--source", required=True)
    load.add_argument("--store", required=True, help="where the table's contract is, and its rows unless --database is given")
    load.add_argument("--table", required=True)
    load.add_argument("--database", type=Database.of, help="sqlite:path, or module:function that opens a connection; --job names the load")
    load.add_argument("--job")
    load.add_argument("--connections", type=int, help="tasks that write to the database at once")
    load.add_argument("--schema", default="public")
    load.add_argument("--format", choices=("csv", "tsv", "parquet", "dump"))
    load.add_argument("--on-conflict", default="do-nothing", type=OnConflict.parse)
    load.add_argument("--batch-size", type=int, default=jobs.BATCH_SIZE)
    load.add_argument("--chunk-size", type=identifiers.parse_size, default=jobs.files.CHUNK_BYTES)
    load.add_argument("--delimiter", type=identifiers.parse_char)
    load.add_argument("--quote", type=identifiers.parse_char)
    load.add_argument("--escape", type=identifiers.parse_char)
    load.add_argument("--header", action="store_true")
    load.add_argument("--column-map", type=identifiers.parse_mapping, default={})
    load.add_argument("--exclude-columns", type=identifiers.parse_names, default=[])
    load.add_argument("--if-not-exists", action="store_true")
    load.add_argument("--resume")
    load.add_argument("--verify", default="off", type=VerifyMode.parse)
    load.add_argument("--dry-run", action="store_true")
    migrate = commands.add_parser("migrate", help="a whole dump into a store")
    migrate.add_argument("--source", required=True)
    migrate.add_argument("--store", required=True)
    migrate.add_argument("--verify", default="count", type=VerifyMode.parse)
    migrate.add_argument("--dry-run", action="store_true")
    export = commands.add_parser("export", help="tables as a dump")
    export.add_argument("--store", required=True)
    export.add_argument("--output", required=True)
    export.add_argument("--schema", action="append", default=[])
    export.add_argument("--table", action="append", default=[])
    export.add_argument("--single", action="store_true", help="write one file by the driver, not a folder of parts by the executors")
    listed = commands.add_parser("list-tables", help="the tables of a dump")
    listed.add_argument("--source", required=True)
    return out


def _dialect(args: argparse.Namespace) -> delimited.Dialect | None:
    given = {k: v for k, v in (("delimiter", args.delimiter), ("quote", args.quote), ("escape", args.escape)) if v is not None}
    if not given and not args.header:
        return None
    base = delimited.TSV if args.format == "tsv" or args.source.lower().endswith(".tsv") else delimited.CSV
    return base.with_(header=args.header, **given)


def main(argv: list[str] | None = None) -> int:
    args = parser().parse_args(argv)
    spark = session.configure(session.build())
    try:
        if args.command == "load":
            options = jobs.LoadOptions(
                args.source, args.table, args.schema, args.format, args.on_conflict, args.batch_size, args.chunk_size, _dialect(args), args.column_map,
                tuple(args.exclude_columns), args.if_not_exists, args.resume, args.verify,
            ).validated()
            if args.dry_run:
                print(options)
                return 0
            if args.database is not None:
                if not args.job or args.resume or args.if_not_exists or args.verify is not VerifyMode.OFF:
                    raise ValueError("a load into a database needs --job, and does not go with --resume, --if-not-exists or --verify")
                contract = jobs.Store(spark, args.store).contract(args.schema, args.table)
                loaded = database_load.load(spark, args.database, contract, options, args.job, args.connections)
                print(database_load.as_json(loaded))
                return 1 if loaded.failed else 0
            result = jobs.load(spark, jobs.Store(spark, args.store), options)
            print(jobs.as_json(result))
            for warning in result.warnings:
                print(f"warning: {warning}", file=sys.stderr)
            if result.too_few:
                print(f"{result.loaded + result.failed} rows seen of about {result.estimated}", file=sys.stderr)
            return 0 if result.passed and not result.failed and not result.too_few else 1
        if args.command == "migrate":
            report = jobs.migrate(spark, jobs.Store(spark, args.store), args.source, args.verify, args.dry_run)
            for finding in report.findings:
                print(finding)
            for result in report.tables:
                print(jobs.as_json(result))
            if report.halted:
                print(report.halted, file=sys.stderr)
            return 0 if report.passed else 1
        if args.command == "export":
            store = jobs.Store(spark, args.store)
            if args.single:
                print(jobs.export_tables(store, args.output, tuple(args.schema), tuple(args.table)))
            else:
                print("\n".join(jobs.export_parts(store, args.output, tuple(args.schema), tuple(args.table))))
            return 0
        for row in jobs.list_tables(spark, args.source).collect():
            print(f"{row.schema}\t{row.table}\t{','.join(row.columns)}")
        return 0
    except (ValueError, LookupError) as error:
        print(f"error: {error}", file=sys.stderr)
        return 2


if __name__ == "__main__":
    sys.exit(main())
