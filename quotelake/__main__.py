"""Command line for `spark-submit` and cron: stage raw files, build the lake, check it.

    python -m quotelake stage --raw R --staging S --lake L [feed ...]
    python -m quotelake build --raw R --staging S --lake L [entity ...]
    python -m quotelake check --raw R --staging S --lake L
"""

from __future__ import annotations

import argparse

from quotelake.plans.entities import ENTITIES
from quotelake.plans.feeds import FEEDS
from quotelake.plans.lake import Lake
from quotelake.session import build_session


def main(arguments: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(prog="quotelake", description=__doc__)
    parser.add_argument("command", choices=["stage", "build", "check"])
    parser.add_argument("names", nargs="*", help="feeds to stage or entities to build; all if none is given")
    for folder in ("raw", "staging", "lake"):
        parser.add_argument(f"--{folder}", required=True)
    parser.add_argument("--symbols", type=int, help="use only the first symbols of the universe")
    parser.add_argument("--at-once", type=int, default=4, help="feeds or entities in work at a time")
    parser.add_argument("--local-cores", type=int, help="run in local mode")
    options = parser.parse_args(arguments)
    known = {"stage": FEEDS, "build": ENTITIES, "check": {}}[options.command]
    unknown = sorted(set(options.names) - set(known))
    if unknown:
        parser.error(f"unknown names: {', '.join(unknown)}")

    spark = build_session("quotelake", options.local_cores)
    lake = Lake(spark, options.raw, options.staging, options.lake, options.at_once)
    if options.command == "stage":
        lake.stage(options.names or tuple(FEEDS), options.symbols)
    elif options.command == "build":
        for name, rows in lake.build(options.names or tuple(ENTITIES)).items():
            print(f"{name}\t{rows}")
    else:
        lake.staging_report().show(100, truncate=False)
        lake.lake_report().show(100, truncate=False)
        lake.check()


if __name__ == "__main__":
    main()
