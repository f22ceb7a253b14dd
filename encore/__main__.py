"""Command line: build a warehouse from landed files, run or preview queries.

  python -m encore build   --export DIR [--metadata DIR] [--weather DIR] --out ROOT [--append] [--keep N]
  python -m encore query   KEY [KEY ...] --warehouse ROOT [--rows N | --save PATH]
  python -m encore sql     TEXT --warehouse ROOT [--rows N | --save PATH]
  python -m encore tables  KEY --sf-dir DIR [--rows N]      (driver test tables via the adapters)

Every build is a new version under ROOT (``--append``: DIR holds newly landed files only);
queries read the newest complete one, ``sql`` through its views. Output is printed with ``show`` (results are small
reports); ``--save PATH`` writes the full result as parquet instead.
"""

from __future__ import annotations

import argparse
import sys

from encore.session import build_session, path_join

def _emit(df, save: str | None, rows: int) -> None:
    if save:
        df.write.mode("overwrite").parquet(save)
    else:
        df.show(rows, truncate=False)


def main(argv: list[str] | None = None) -> int:
    p = argparse.ArgumentParser(prog="encore")
    sub = p.add_subparsers(dest="cmd", required=True)
    build = sub.add_parser("build")
    build.add_argument("--export", required=True)
    build.add_argument("--metadata")
    build.add_argument("--weather")
    build.add_argument("--out", required=True)
    build.add_argument("--append", action="store_true")
    build.add_argument("--keep", type=int, default=3)
    for name, what in (("query", "keys"), ("sql", "text")):
        s = sub.add_parser(name)
        s.add_argument(what, nargs="+" if name == "query" else None)
        s.add_argument("--warehouse", required=True)
        s.add_argument("--rows", type=int, default=50)
        s.add_argument("--save")
    t = sub.add_parser("tables")
    t.add_argument("key")
    t.add_argument("--sf-dir", required=True)
    t.add_argument("--rows", type=int, default=50)
    t.add_argument("--save")
    p.add_argument("--master")
    args = p.parse_args(argv)

    from encore.plans.catalog import QUERIES, for_tables
    from encore.sources.warehouse import open_latest, rebuild, sources_from_landed

    spark = build_session(args.master)
    if args.cmd == "build":
        wh = rebuild(spark, sources_from_landed(spark, args.export, args.metadata, args.weather), args.out, args.keep,
                     args.append)
        print(f"warehouse written to {wh.root}")
    elif args.cmd == "tables":
        _emit(for_tables()[args.key](spark, args.sf_dir), args.save, args.rows)
    elif args.cmd == "sql":
        open_latest(spark, args.warehouse)
        _emit(spark.sql(args.text), args.save, args.rows)
    else:
        wh = open_latest(spark, args.warehouse)
        for key in args.keys:
            several = len(args.keys) > 1
            if several:
                print(f"\n-- {key}")
            _emit(QUERIES[key](wh), path_join(args.save, key) if args.save and several else args.save, args.rows)
    return 0


if __name__ == "__main__":
    sys.exit(main())
