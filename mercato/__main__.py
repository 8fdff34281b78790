"""Run the whole pipeline: ``python -m mercato --raw-dir DIR --geo FILE --out DIR``.

Exit status 1 when a stage raises (for example an empty gold report) or the
audit finds a missing table; quality failures only stop the run for the
datasets named with ``--fail-on``.
"""

from __future__ import annotations

import argparse
import logging
import sys

from mercato.plans.job import run_job
from mercato.session import build_session
from mercato.sources.bronze import discover_tables
from mercato.sources.geo import read_geojson


def main(argv: list[str] | None = None) -> int:
    p = argparse.ArgumentParser(prog="mercato", description=__doc__)
    p.add_argument("--raw-dir", required=True, help="folder with the raw CSV files")
    p.add_argument("--geo", required=True, help="state document (GeoJSON-like)")
    p.add_argument("--out", required=True, help="output folder for bronze/silver/gold/reports")
    p.add_argument("--prefix", default="", help="file-name prefix removed to get table names")
    p.add_argument("--fail-on", nargs="*", default=[], help="datasets whose failed rules stop the run")
    p.add_argument("--master", default=None, help="Spark master (default: from the environment)")
    p.add_argument("--single-line-csv", nargs="*", metavar="TABLE",
                   help="these tables (none named: all) hold no line breaks in fields: let Spark split their files; "
                        "each file of the others is read by one task")
    p.add_argument("--shuffle-partitions", type=int, help="partitions shuffles start with (default: by table size)")
    args = p.parse_args(argv)

    logging.basicConfig(level=logging.INFO, format="  > %(message)s")
    single = args.single_line_csv
    multiline = single != [] if not single else dict.fromkeys(single, False)
    spark = build_session(args.master)
    try:
        result = run_job(spark, args.out, csv_tables=discover_tables(spark, args.raw_dir, args.prefix),
                         geo=read_geojson(spark, args.geo), fail_on=args.fail_on,
                         csv_multiline=multiline, shuffle_partitions=args.shuffle_partitions)
    except Exception as e:  # noqa: BLE001 - reported, then a failing exit status
        logging.error("pipeline failed: %s", e)
        return 1
    for f in result.findings:
        if f["severity"] != "OK":
            logging.warning("%s %s %s: %s", f["layer"], f["table_name"], f["severity"], f["detail"])
    return 0 if result.verified else 1


if __name__ == "__main__":
    sys.exit(main())
