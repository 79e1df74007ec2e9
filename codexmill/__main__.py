"""python -m codexmill COMMAND: list; run QUERY DIR [--out PATH]; explain QUERY DIR; profile QUERY DIR.

``run`` shows the first rows or writes Parquet, ``profile`` times a run whose
rows are dropped. Cores of a local session are set by --cores; on a cluster the
session is the one that spark-submit brings.
"""

from __future__ import annotations

import argparse
import time
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession


def known() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    from codexmill.plans import registry

    mods = registry.modules()
    return {k: f for m in mods for k, f in m.QUERIES.items()}


def list_(args: argparse.Namespace) -> None:
    for name, f in sorted(known().items()):
        print(f"{name:24}{(f.__doc__ or '').strip().splitlines()[0] if f.__doc__ else ''}")


def _frame(args: argparse.Namespace) -> DataFrame:
    from codexmill.session import local_session

    queries = known()
    if args.query not in queries:
        raise SystemExit(f"no such query: {args.query}")
    spark = SparkSession.getActiveSession() or local_session(cores=args.cores, partitions=args.cores)
    return queries[args.query](spark, args.dir)


def run(args: argparse.Namespace) -> None:
    df = _frame(args)
    if args.out:
        df.write.mode("overwrite").parquet(args.out)
    else:
        df.show(args.rows, truncate=False)


def explain(args: argparse.Namespace) -> None:
    _frame(args).explain("formatted")


def profile(args: argparse.Namespace) -> None:
    began = time.time()
    _frame(args).write.format("noop").mode("overwrite").save()
    print(f"{args.query}: {time.time() - began:.2f} s")


def main(argv: Sequence[str] | None = None) -> None:
    p = argparse.ArgumentParser(prog="codexmill", description=__doc__.splitlines()[0])
    sub = p.add_subparsers(dest="command", required=True)
    sub.add_parser("list").set_defaults(call=list_)
    for name, call in (("run", run), ("explain", explain), ("profile", profile)):
        c = sub.add_parser(name)
        c.add_argument("query")
        c.add_argument("dir")
        c.add_argument("--cores", type=int, default=8)
        c.add_argument("--rows", type=int, default=20, help="rows that run shows")
        c.add_argument("--out", help="where run writes Parquet")
        c.set_defaults(call=call)
    args = p.parse_args(argv)
    args.call(args)


if __name__ == "__main__":
    main()
