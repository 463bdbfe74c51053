"""Command line for cluster jobs (run with ``spark-submit -m``-style launchers or ``python -m urbanlake``).

    python -m urbanlake refresh --source <csv dir> --base <table folder> [--scale 2] [--max-files-per-trigger N]
                                [--zone UTC] [--incremental] [--mixed-headers]
    python -m urbanlake train   --features <parquet> --model <folder> [--trees 100] [--depth 10] [--bins 32]
                                [--task-memory-mb 256]
    python -m urbanlake score   --policies <parquet> --out <folder> [--model <folder>]

The session is the one the launcher provides (``getOrCreate``); no master or
resource settings are made here.  Outputs are written with overwrite, so a
rerun after a failure gives the same tables.
"""

from __future__ import annotations

import argparse
import json
import sys

from pyspark.sql import SparkSession


def _session() -> SparkSession:
    spark = SparkSession.builder.appName("urbanlake").getOrCreate()
    from urbanlake.session import ensure_checkpoint_dir

    ensure_checkpoint_dir(spark)
    return spark


def cmd_refresh(args) -> dict:
    from urbanlake.streaming.refresh import refresh

    out = refresh(_session(), args.source, args.base, scale=args.scale, max_files_per_trigger=args.max_files_per_trigger,
                  zone=args.zone, incremental=args.incremental, mixed_headers=args.mixed_headers)
    return {"base": args.base, "dq_metrics": out["dq_metrics"], "castable_metrics": out["castable_metrics"]}


def cmd_train(args) -> dict:
    from urbanlake.operators.ml import fit_demand_model, save_model, signature

    features = _session().read.parquet(args.features)
    params = {"numTrees": args.trees, "maxDepth": args.depth, "maxBins": args.bins, "maxMemoryInMB": args.task_memory_mb}
    save_model(fit_demand_model(features, params), args.model, signature(features))
    return {"model": args.model}


def cmd_score(args) -> dict:
    from urbanlake.operators import ml, policy

    spark = _session()
    feats = policy.policy_features(policy.validate_policies(spark.read.parquet(args.policies)))
    if args.model:
        scored = ml.score_policies(ml.load_model(spark, args.model), feats, ml.load_signature(spark, args.model))
    else:
        scored = policy.score_elastic(feats)
    scored.write.mode("overwrite").parquet(args.out)
    return {"out": args.out}


def main(argv: list[str] | None = None) -> int:
    p = argparse.ArgumentParser(prog="urbanlake")
    sub = p.add_subparsers(dest="command", required=True)
    r = sub.add_parser("refresh", help="bronze -> silver (streams, new files only) -> gold views")
    r.add_argument("--source", required=True)
    r.add_argument("--base", required=True)
    r.add_argument("--scale", type=int, default=None)
    r.add_argument("--max-files-per-trigger", type=int, default=1000)
    r.add_argument("--zone", default="UTC", help="zone of the wall-clock times that offsets are put in")
    r.add_argument("--incremental", action="store_true", help="merge only new rows into the views' state")
    r.add_argument("--mixed-headers", action="store_true", help="read each file by its own header")
    r.set_defaults(fn=cmd_refresh)
    t = sub.add_parser("train", help="fit the demand model on a feature table")
    t.add_argument("--features", required=True)
    t.add_argument("--model", required=True)
    t.add_argument("--trees", type=int, default=100)
    t.add_argument("--depth", type=int, default=10)
    t.add_argument("--bins", type=int, default=32)
    t.add_argument("--task-memory-mb", type=int, default=256, help="memory of a task's statistics while trees grow")
    t.set_defaults(fn=cmd_train)
    s = sub.add_parser("score", help="demand and revenue of every policy and service")
    s.add_argument("--policies", required=True)
    s.add_argument("--out", required=True)
    s.add_argument("--model", default=None)
    s.set_defaults(fn=cmd_score)
    args = p.parse_args(argv)
    print(json.dumps(args.fn(args), default=str))
    return 0


if __name__ == "__main__":
    sys.exit(main())
