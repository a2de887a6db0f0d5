"""Command line: inventories of all files or of samples, and calibration runs. Exit code 2 on any expected failure."""

from __future__ import annotations

import argparse
import json
import sys

from pyspark.sql import SparkSession

from sieveline import config, schemas
from sieveline.plans import runs
from sieveline.sources import labels, sinks


def parser() -> argparse.ArgumentParser:
    out = argparse.ArgumentParser(prog="sieveline")
    sub = out.add_subparsers(dest="command", required=True)
    for name in ("inventory", "calibration", "d1", "d2", "d3"):
        p = sub.add_parser(name)
        p.add_argument("--config", required=True)
        p.add_argument("--run-id", required=True)
        if name in ("d1", "d2", "d3"):
            p.add_argument("--prior-run-id", action="append", default=[], help="d1 run, and for d3 also the d2 run")
        if name == "d3":
            p.add_argument("--target-sample-count", type=int, default=runs.TARGET)
            p.add_argument("--resume", action="store_true")
            p.add_argument("--stop-after", type=int, help="batches")
        elif name == "inventory":
            p.add_argument("--resume", action="store_true")
            p.add_argument("--stop-after", type=int, help="batches")
            p.add_argument("--expect", type=int, nargs=2, metavar=("FILES", "GROUPS"))
        elif name == "calibration":
            p.add_argument("--inventory-run", required=True)
    return out


def main(argv: list[str] | None = None) -> int:
    args = parser().parse_args(argv)
    try:
        settings = config.load(args.config)
        spark = SparkSession.builder.appName("sieveline").getOrCreate()
        if args.command == "inventory":
            out = runs.inventory(spark, settings, args.run_id, expected=tuple(args.expect) if args.expect else None, stop_after=args.stop_after, resume=args.resume)
        elif args.command in ("d1", "d2"):
            out = runs.sample(spark, settings, args.command, args.run_id, args.prior_run_id)
        elif args.command == "d3":
            out = runs.sample(spark, settings, "d3", args.run_id, args.prior_run_id, args.target_sample_count, stop_after=args.stop_after, resume=args.resume)
        else:
            out = runs.calibration(spark, settings, args.inventory_run, args.run_id)
    except (config.ConfigError, schemas.SchemaError, sinks.UnsafePath, sinks.ResumeError, runs.GateError, labels.InputError, FileExistsError) as e:
        print(json.dumps({"error": str(e)}), file=sys.stderr)
        return 2
    print(json.dumps(out, ensure_ascii=False, sort_keys=True))
    return 0


if __name__ == "__main__":
    sys.exit(main())
