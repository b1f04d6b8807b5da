"""Command line: list, run or explain the registered queries, or run SQL
text over the tables.

  python -m relkit list
  python -m relkit run j3_star_join --data /root/testdata/sf0.01 [--rows 20]
  python -m relkit explain a10_running_total --data ...
  python -m relkit sql "SELECT r_name, count(*) FROM region GROUP BY 1" --data ...
  python -m relkit sql --file report.sql --data ...

Results are shown with ``show()``: only the first ``--rows`` rows reach
the driver.
"""

from __future__ import annotations

import argparse
import sys

DEFAULT_DATA = "/root/testdata/sf0.01"


def main(argv: list[str] | None = None) -> int:
    p = argparse.ArgumentParser(prog="relkit")
    sub = p.add_subparsers(dest="cmd", required=True)
    sub.add_parser("list")
    for cmd in ("run", "explain"):
        c = sub.add_parser(cmd)
        c.add_argument("name")
        c.add_argument("--data", default=DEFAULT_DATA)
        c.add_argument("--rows", type=int, default=20)
    c = sub.add_parser("sql")
    c.add_argument("text", nargs="?")
    c.add_argument("--file", help="read the SQL text from this file")
    c.add_argument("--data", default=DEFAULT_DATA)
    c.add_argument("--rows", type=int, default=20)
    args = p.parse_args(argv)

    from relkit.catalog import BY_NAME, QUERIES
    if args.cmd == "list":
        for q in QUERIES:
            print(q.name)
        return 0

    from relkit.session import build_session
    from relkit.sources import Tables
    spark = build_session(app="relkit-cli")
    if args.cmd == "sql":
        text = open(args.file).read() if args.file else args.text
        if not text:
            print("give SQL text or --file", file=sys.stderr)
            return 2
        Tables.from_dir(spark, args.data).register_views()
        spark.sql(text).show(args.rows, truncate=False)
        return 0
    if args.name not in BY_NAME:
        print(f"unknown query {args.name!r}; see `python -m relkit list`", file=sys.stderr)
        return 2
    if args.cmd == "explain":
        BY_NAME[args.name].planned(spark, args.data).explain("formatted")
    else:
        BY_NAME[args.name].run(spark, args.data).show(args.rows, truncate=False)
    return 0


if __name__ == "__main__":
    sys.exit(main())
