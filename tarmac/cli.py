"""Command line for the jobs (``spark-submit launch.py …`` or ``python -m tarmac …``).

Hyper-parameters default to the environment (N_ESTIMATORS, MAX_DEPTH,
LEARNING_RATE, MIN_SAMPLES, RANDOM_STATE) and then to the fixed defaults.
"""

from __future__ import annotations

import argparse
import json
import os

from tarmac.schema import GBT_PARAMS, MODEL_GROUP, RANDOM_STATE, TEST_SIZE, VAL_SIZE


def _env(name: str, default, cast):
    v = os.environ.get(name)
    return cast(v) if v not in (None, "") else default


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="tarmac")
    sub = p.add_subparsers(dest="cmd", required=True)

    pre = sub.add_parser("preprocess", help="check, label, split, encode, profile")
    pre.add_argument("--input", required=True, help="folder of raw *.csv files")
    pre.add_argument("--output", required=True)
    pre.add_argument("--val-size", type=float, default=VAL_SIZE)
    pre.add_argument("--test-size", type=float, default=TEST_SIZE)
    pre.add_argument("--random-state", type=int, default=RANDOM_STATE)
    pre.add_argument("--id-col", default=None)
    pre.add_argument("--fit-on", choices=["train", "all"], default="train")

    tr = sub.add_parser("train", help="fit the gradient-boosted trees")
    tr.add_argument("--prep", required=True)
    tr.add_argument("--model-dir", required=True)
    tr.add_argument("--n-estimators", type=int,
                    default=_env("N_ESTIMATORS", GBT_PARAMS["n_estimators"], int))
    tr.add_argument("--max-depth", type=int, default=_env("MAX_DEPTH", GBT_PARAMS["max_depth"], int))
    tr.add_argument("--learning-rate", type=float,
                    default=_env("LEARNING_RATE", GBT_PARAMS["learning_rate"], float))
    tr.add_argument("--min-samples", type=int,
                    default=_env("MIN_SAMPLES", GBT_PARAMS["min_samples_leaf"], int))
    tr.add_argument("--random-state", type=int,
                    default=_env("RANDOM_STATE", GBT_PARAMS["random_state"], int))

    ev = sub.add_parser("evaluate", help="challenger vs champion, conditional registration")
    ev.add_argument("--prep", required=True)
    ev.add_argument("--model-dir", required=True)
    ev.add_argument("--registry", required=True)
    ev.add_argument("--output", required=True)
    ev.add_argument("--group", default=MODEL_GROUP)

    bl = sub.add_parser("baseline", help="profile the reference sample once")
    bl.add_argument("--reference", required=True)
    bl.add_argument("--output", required=True)

    sc = sub.add_parser("score", help="score a table of requests")
    sc.add_argument("--requests", required=True, help="folder of parquet files")
    sc.add_argument("--model-dir", required=True)
    sc.add_argument("--output", required=True, help="gets scored/ and quarantine/")
    sc.add_argument("--id-col", default="request_id")

    mo = sub.add_parser("monitor", help="captured requests against the stored baseline")
    mo.add_argument("--capture", required=True)
    mo.add_argument("--model-dir", required=True)
    mo.add_argument("--baseline", required=True)
    mo.add_argument("--output", required=True)

    ls = sub.add_parser("land-stream", help="stream a landing folder into labelled rows")
    ls.add_argument("--landing", required=True)
    ls.add_argument("--output", required=True)
    ls.add_argument("--checkpoint", required=True)
    ls.add_argument("--id-col", default=None)
    ls.add_argument("--continuous", action="store_true", help="go on after the files that are there now")

    ss = sub.add_parser("score-stream", help="stream requests into a capture table")
    ss.add_argument("--requests", required=True)
    ss.add_argument("--model-dir", required=True)
    ss.add_argument("--capture", required=True)
    ss.add_argument("--quarantine", required=True)
    ss.add_argument("--checkpoint", required=True)
    ss.add_argument("--id-col", default="request_id")
    ss.add_argument("--continuous", action="store_true")
    return p


def main(argv: list[str] | None = None) -> dict:
    args = parser().parse_args(argv)
    from tarmac.plans import jobs
    from tarmac.session import build_session
    from tarmac.sources.csv_landing import read_raw_csv

    spark = build_session(app=f"tarmac-{args.cmd}")
    if args.cmd == "preprocess":
        raw = read_raw_csv(spark, args.input, keep_file=False, id_col=args.id_col)
        out = jobs.preprocess(raw, args.output, id_col=args.id_col, val_size=args.val_size,
                              test_size=args.test_size, seed=args.random_state, fit_on=args.fit_on)
    elif args.cmd == "train":
        params = {"n_estimators": args.n_estimators, "max_depth": args.max_depth,
                  "learning_rate": args.learning_rate, "min_samples_leaf": args.min_samples,
                  "random_state": args.random_state}
        out = jobs.train(spark, args.prep, args.model_dir, params=params)
    elif args.cmd == "evaluate":
        from tarmac.operators.registry import read_decision
        d = read_decision(jobs.evaluate(spark, args.prep, args.model_dir, args.registry,
                                        args.output, args.group)).first()
        out = d.asDict() if d else {}
    elif args.cmd == "baseline":
        out = {"written": jobs.baseline_job(spark, args.reference, args.output)}
    elif args.cmd == "score":
        from tarmac.operators.scoring import score
        from tarmac.sources.model_store import ModelBundle
        scored, rejected = score(spark.read.parquet(args.requests), ModelBundle.load(spark, args.model_dir),
                                 keep=[args.id_col])
        scored.write.mode("overwrite").parquet(f"{args.output}/scored")
        rejected.write.mode("overwrite").parquet(f"{args.output}/quarantine")
        out = {k: spark.read.parquet(f"{args.output}/{k}").count() for k in ("scored", "quarantine")}
    elif args.cmd == "monitor":
        from tarmac.sources.model_store import ModelBundle
        encoder = ModelBundle.load(spark, args.model_dir).encoder
        alarm = jobs.monitor_new(spark, args.capture, encoder, args.baseline, args.output)
        out = {"days": alarm.count() if alarm else 0, "alarms": alarm.where("alarm").count() if alarm else 0}
    elif args.cmd == "land-stream":
        from tarmac.streaming.landing import start_landing_stream
        q = start_landing_stream(spark, args.landing, args.output, args.checkpoint, id_col=args.id_col,
                                 available_now=not args.continuous)
        q.awaitTermination()
        out = {"done": True}
    else:
        from tarmac.sources.model_store import ModelBundle
        from tarmac.streaming.scoring import start_scoring_stream
        schema = spark.read.parquet(args.requests).schema
        q = start_scoring_stream(spark, spark.readStream.schema(schema).parquet(args.requests),
                                 ModelBundle.load(spark, args.model_dir), args.capture, args.quarantine,
                                 args.checkpoint, id_col=args.id_col, available_now=not args.continuous)
        q.awaitTermination()
        out = {"done": True}
    print(json.dumps(out, default=str))
    return out
