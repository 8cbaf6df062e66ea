"""Command line: ``python -m helixmart <command>``.

discover   list files by extension
count      rows per table of a folder, without loading
load       run the load pipeline on a folder of TSV files
load-json  insert {"table", "row"} JSON lines
follow     load what is new among {"table", "row"} JSON files, then stop
"""

from __future__ import annotations

import argparse
import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from helixmart.operators.integrity import rows_per_table
from helixmart.plans import pipeline
from helixmart.session import build_session
from helixmart.sources.catalog import MODES, discover_files, only_loadable, route_files
from helixmart.sources.tsv import read_tsv_files
from helixmart.streaming.ingest import ingest_envelopes, ingest_routed, stream_envelopes, stream_files


def count_rows(spark: SparkSession, data_dir: str, mode: str) -> DataFrame:
    files = only_loadable(route_files(discover_files(spark, data_dir, (".tsv",)), mode))
    tables = pipeline.tables_to_load(files)
    if not tables:
        return spark.createDataFrame([], "table string, n_rows bigint")
    return rows_per_table({t: read_tsv_files(files.filter(F.col("table") == t)) for t in tables})


def _parser() -> argparse.ArgumentParser:
    parser = argparse.ArgumentParser(prog="helixmart", description=__doc__, formatter_class=argparse.RawDescriptionHelpFormatter)
    commands = parser.add_subparsers(dest="command", required=True)
    discover = commands.add_parser("discover")
    discover.add_argument("--data-dir", required=True)
    discover.add_argument("--extensions", nargs="+", default=[".tsv", ".zarr"])
    count = commands.add_parser("count")
    count.add_argument("--data-dir", required=True)
    count.add_argument("--mode", choices=MODES, default="all")
    load = commands.add_parser("load")
    load.add_argument("--data-dir", required=True)
    load.add_argument("--mapping", required=True, help="YAML rule mapping")
    load.add_argument("--target", required=True, help="root folder of the tables")
    load.add_argument("--mode", choices=MODES, default="all")
    load.add_argument("--on-error", choices=("fail", "quarantine"), default="fail")
    load.add_argument("--audit", action="store_true")
    load_json = commands.add_parser("load-json")
    load_json.add_argument("input")
    load_json.add_argument("--target", required=True)
    follow = commands.add_parser("follow")
    follow.add_argument("--data-dir", required=True)
    follow.add_argument("--target", required=True)
    follow.add_argument("--checkpoint", required=True)
    follow.add_argument("--mapping", help="YAML rule mapping: follow TSV files of any table instead of JSON lines")
    follow.add_argument("--mode", choices=MODES, default="all")
    follow.add_argument("--on-error", choices=("fail", "quarantine"), default="fail")
    return parser


def main(argv: list[str] | None = None) -> None:
    args = _parser().parse_args(argv)
    spark = build_session()
    if args.command == "discover":
        files = discover_files(spark, args.data_dir, tuple(args.extensions))
        for row in files.select("path").orderBy("path").toLocalIterator():
            print(row["path"])
    elif args.command == "count":
        count_rows(spark, args.data_dir, args.mode).show(truncate=False)
    elif args.command == "load":
        stats = pipeline.run(
            spark, args.data_dir, args.mapping, args.target, args.mode, on_error=args.on_error, audit=args.audit
        )
        print(json.dumps(stats))
    elif args.command == "load-json":
        print(json.dumps(pipeline.load_envelopes(spark, args.input, args.target)))
    elif args.mapping:
        report = lambda _, stats: print(json.dumps(stats))
        stream = stream_files(spark, args.data_dir)
        ingest_routed(stream, args.mapping, args.target, args.checkpoint, args.mode, on_error=args.on_error, on_loaded=report).awaitTermination()
    else:
        ingest_envelopes(stream_envelopes(spark, args.data_dir), args.target, args.checkpoint).awaitTermination()


if __name__ == "__main__":
    main()
