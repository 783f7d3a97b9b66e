"""Command line: ``python -m trackspark COMMAND``. Tables are printed or written; ``--json`` prints JSON lines."""

from __future__ import annotations

import argparse
import json
import sys

from pyspark.sql import DataFrame

from trackspark import api, config, recipe
from trackspark.session import session
from trackspark.sources import catalog, discovery, tables


def _emit(df: DataFrame, as_json: bool, most: int) -> None:
    """At most ``most`` rows, for people or programs."""
    if as_json:
        for line in df.limit(most).toJSON().collect():
            print(line)
    else:
        df.show(most, False)


def _parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser("trackspark", description=__doc__)
    p.add_argument("--json", action="store_true")
    p.add_argument("--most", type=int, default=1000)
    p.add_argument("--master")
    sub = p.add_subparsers(dest="command", required=True)
    sub.add_parser("doctor")
    c = sub.add_parser("inspect")
    c.add_argument("root")
    c = sub.add_parser("profile-table")
    c.add_argument("path")
    c = sub.add_parser("plan")
    c.add_argument("assets")
    for name in ("dataset", "modality", "sequence"):
        c.add_argument(f"--{name}", action="append")
    c = sub.add_parser("extract")
    for name in ("recipe", "root", "out"):
        c.add_argument(name)
    c.add_argument("--defaults")
    c.add_argument("--episodes", help="table of dataset, episode_id, duration_s; by default what the recipe's glob finds")
    c = sub.add_parser("rectify")
    for name in ("track", "out"):
        c.add_argument(name)
    c.add_argument("--spans")
    c.add_argument("--set", action="append", default=[], metavar="KEY=VALUE")
    c = sub.add_parser("make-splits")
    for name in ("manifest", "out", "ratios"):
        c.add_argument(name)
    c.add_argument("--seed", type=int, default=7)
    c = sub.add_parser("join-manifests")
    c.add_argument("out")
    c.add_argument("source", nargs="+", help="PATH or PATH=dataset,dataset")
    c.add_argument("--videos", choices=("collected", "absolute", "as_written"), default="collected")
    return p


def main(argv: list[str] | None = None) -> int:
    a = _parser().parse_args(argv)
    spark = session("trackspark", a.master)
    spark.sparkContext.setLogLevel("ERROR")
    show = lambda df: _emit(df, a.json, a.most)
    if a.command == "doctor":
        print(json.dumps(api.doctor(spark), indent=2))
    elif a.command == "inspect":
        show(api.inspect(spark, a.root))
    elif a.command == "profile-table":
        show(catalog.table_profile(spark, a.path))
    elif a.command == "plan":
        show(api.plan_downloads(tables.read_table(spark, a.assets), a.dataset, a.modality, a.sequence))
    elif a.command == "extract":
        r = recipe.load(a.recipe, a.defaults)
        root = f"{a.root.rstrip('/')}/{r.root}".rstrip("/")
        eps = tables.read_table(spark, a.episodes) if a.episodes else discovery.list_episodes(spark, r.dataset, root, r.episodes).selectExpr("dataset", "episode_id", "tokens", "CAST(NULL AS DOUBLE) duration_s")
        for name, df in api.run_extract(spark, r, root, eps).items():
            tables.write_table(df, f"{a.out}/{name}.parquet", ["dataset"])
    elif a.command == "rectify":
        cfg = config.load(overrides=dict(x.split("=", 1) for x in a.set))
        api.run_rectify(tables.read_table(spark, a.track), tables.read_table(spark, a.spans) if a.spans else None, None, a.out, cfg)
    elif a.command == "make-splits":
        show(api.split_index(api.make_splits(tables.read_table(spark, a.manifest), config.ratios(a.ratios), a.seed, a.out)))
    elif a.command == "join-manifests":
        pairs = [(s.partition("=")[0], s.partition("=")[2].split(",") if "=" in s else None) for s in a.source]
        show(api.join_manifests(spark, pairs, a.out, a.videos))
    return 0


if __name__ == "__main__":
    sys.exit(main())
