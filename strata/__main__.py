"""Command line: load and rebuild, or query the published marts.

    python -m strata build --landing <dir> --root <dir> [--keys 2023,2024] [--json-lines]
    python -m strata serve --root <dir> --page drivers --season 2024 [--rows 25]

``build`` loads the bronze slices of the given keys (default: the dataset's
seasons) in one commit per source, then rebuilds silver and gold with the
tests gating each publication. ``serve`` registers the current marts and runs
one dashboard query with the season bound as a parameter.
"""

from __future__ import annotations

import argparse

from strata.datasets import f1
from strata.plans import build, serve
from strata.session import build_session


def main(argv: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(prog="strata")
    sub = parser.add_subparsers(dest="command", required=True)
    b = sub.add_parser("build", help="load bronze for keys, rebuild silver and gold")
    b.add_argument("--landing", required=True)
    b.add_argument("--root", required=True)
    b.add_argument("--keys", default=",".join(f1.SEASONS))
    b.add_argument("--json-lines", action="store_true")
    s = sub.add_parser("serve", help="run a dashboard query on the published marts")
    s.add_argument("--root", required=True)
    s.add_argument("--page", choices=sorted(serve.PAGES), required=True)
    s.add_argument("--season", type=int, required=True)
    s.add_argument("--rows", type=int, help="print so many rows (default: all)")
    args = parser.parse_args(argv)

    spark = build_session()
    if args.command == "build":
        keys = [k for k in args.keys.split(",") if k]
        ds = f1.dataset(args.landing, seasons=keys, json_lines=args.json_lines)
        gold = build.build_all(spark, ds, keys=keys, root=args.root)
        for name, df in gold.items():
            print(name, df.count())
    else:
        build.open_gold(spark, f1.DATASET, args.root)
        page = serve.page_query(spark, args.page, args.season)
        page.show(page.count() if args.rows is None else args.rows, truncate=False)


if __name__ == "__main__":
    main()
