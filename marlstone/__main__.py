"""Command line: ``python -m marlstone <command> ...``.

    run        run pipeline stages (extract, silver, gold, publish) over a zone root
    preview    column types and the first rows of a zone table
    inventory  tables and columns of a catalog database
    seed       create the source tables in a catalog database and load the
               sample rows if they are empty

Sources and targets: ``jdbc`` (connection from the DB_* environment
variables) or ``catalog:<database>``; targets also ``views:<database>``. Object-store settings come from the
AWS_* environment variables when ``--s3`` is given. Results are printed as
one JSON line per table.
"""

from __future__ import annotations

import argparse
import json
import sys
from dataclasses import asdict


def _source(spec: str | None, rows_per_slice: int, common_snapshot: bool):
    from marlstone.sources.relational import CatalogSource, JdbcSource, jdbc_options
    if spec is None:
        return None
    if spec == "jdbc":
        return JdbcSource(jdbc_options(), rows_per_slice=rows_per_slice, common_snapshot=common_snapshot)
    if spec.startswith("catalog:"):
        return CatalogSource(spec.split(":", 1)[1] or None)
    raise SystemExit(f"unknown source {spec!r}: use jdbc or catalog:<db>")


def _target(spec: str | None, partitions: int):
    from marlstone.sources.publish import CatalogTarget, JdbcTarget, ViewTarget
    from marlstone.sources.relational import jdbc_options
    if spec is None:
        return None
    if spec == "jdbc":
        return JdbcTarget(jdbc_options(), num_partitions=partitions)
    if spec.startswith("catalog:"):
        return CatalogTarget(spec.split(":", 1)[1] or None)
    if spec.startswith("views:"):
        return ViewTarget(spec.split(":", 1)[1])
    raise SystemExit(f"unknown target {spec!r}: use jdbc, catalog:<db> or views:<db>")


def _session(args):
    from marlstone.session import build_session
    conf = {}
    if getattr(args, "shuffle_gb", None):
        from marlstone.session import scale_conf
        conf.update(scale_conf(args.shuffle_gb << 30, args.cores))
    if getattr(args, "s3", False):
        from marlstone.sources.objectstore import object_store_conf
        conf.update(object_store_conf())
    return build_session(args.master, conf=conf)


def main(argv: list[str] | None = None) -> int:
    parser = argparse.ArgumentParser(prog="python -m marlstone")
    parser.add_argument("--master", help="Spark master for local runs")
    parser.add_argument("--s3", action="store_true",
                        help="configure S3A from AWS_* environment variables")
    parser.add_argument("--shuffle-gb", type=int,
                        help="size shuffles for about this many GB in the largest exchange")
    parser.add_argument("--cores", type=int, default=8,
                        help="cores of the cluster, with --shuffle-gb")
    sub = parser.add_subparsers(dest="command", required=True)

    run = sub.add_parser("run", help="run pipeline stages")
    run.add_argument("--root", required=True, help="zone root URI")
    run.add_argument("--stages", nargs="+",
                     default=["extract", "silver", "gold", "publish"])
    run.add_argument("--source", help="jdbc | catalog:<db>")
    run.add_argument("--target", help="jdbc | catalog:<db> | views:<db>")
    run.add_argument("--resume", action="store_true",
                     help="take up the last run of the root where it stopped")
    run.add_argument("--partitions", type=int, default=8,
                     help="JDBC write connections")
    run.add_argument("--rows-per-slice", type=int, default=1_000_000,
                     help="rows of one JDBC read statement")
    run.add_argument("--separate-snapshots", action="store_true",
                     help="let each JDBC read statement see the rows of its own moment")
    run.add_argument("--max-jobs", type=int, default=4,
                     help="concurrent table writes in the silver / gold stages")

    prev = sub.add_parser("preview", help="describe and preview a zone table")
    prev.add_argument("--root", required=True)
    prev.add_argument("--zone", default="bronze")
    prev.add_argument("--table", default="staging_orders")
    prev.add_argument("-n", type=int, default=5)

    inv = sub.add_parser("inventory", help="tables and columns of a database")
    inv.add_argument("--database")

    seed = sub.add_parser("seed", help="stage the sample source rows")
    seed.add_argument("--database", required=True)

    args = parser.parse_args(argv)
    spark = _session(args)

    if args.command == "run":
        from marlstone.plans.pipeline import run_pipeline
        result = run_pipeline(spark, args.root,
                              source=_source(args.source, args.rows_per_slice, not args.separate_snapshots),
                              target=_target(args.target, args.partitions),
                              stages=args.stages, max_jobs=args.max_jobs, resume=args.resume)
        for stage, rows in result.stages.items():
            for r in rows:
                print(json.dumps({"stage": stage, **asdict(r)}))
    elif args.command == "preview":
        from marlstone.operators import describe_columns, preview
        from marlstone.sources.zones import read_table
        df = read_table(spark, args.root, args.zone, args.table)
        describe_columns(df).show(truncate=False)
        preview(df, args.n).show(truncate=False)
    elif args.command == "inventory":
        from marlstone.operators import schema_inventory
        inv_df = schema_inventory(spark, args.database)
        if inv_df.isEmpty():
            print("no tables")
        inv_df.show(inv_df.count(), truncate=False)
    elif args.command == "seed":
        from marlstone.sources.relational import initialize_source
        from marlstone.sources.sample_data import SAMPLE_ROWS
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {args.database}")
        loaded = initialize_source(spark, SAMPLE_ROWS, database=args.database)
        print(json.dumps({"database": args.database, "sample_rows_loaded": loaded}))
    return 0


if __name__ == "__main__":
    sys.exit(main())
