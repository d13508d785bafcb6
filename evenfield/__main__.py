"""python -m evenfield --config FILE {run PIPELINE | STAGE | take FOLDER | submit PIPELINE | set NAME=VALUE …}"""

from __future__ import annotations

import argparse
import ast
import sys
from pathlib import Path

if not __package__:  # run by its path, as spark-submit does
    sys.path[0] = str(Path(__file__).resolve().parents[1])

from evenfield import config
from evenfield.plans import pipeline
from evenfield.session import ship_package

STAGES = ("emptiness", "stats", "qstack", "basic", "int-stats", "int-aggregate", "correct", "int-apply", "export")


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="evenfield")
    top.add_argument("--config", default="illumination.toml")
    top.add_argument("--master")
    commands = top.add_subparsers(dest="command", required=True)
    run = commands.add_parser("run")
    run.add_argument("pipeline", choices=tuple(pipeline.PIPELINES))
    run.add_argument("--start-at")
    run.add_argument("--stop-after")
    run.add_argument("--dry-run", action="store_true")
    for name in STAGES:
        stage = commands.add_parser(name)
        stage.add_argument("--mode", default="intensity" if name == "int-apply" else "auto")
        stage.add_argument("--apply-basic", action="store_true")
        stage.add_argument("--camera", type=int, action="append", help="only this camera; may be given again")
        stage.add_argument("--setup", type=int, action="append", help="only this setup, of int-stats and correct; may be given again")
    take = commands.add_parser("take", help="fields, empty parts and stacks from TIFFs in a folder")
    take.add_argument("folder")
    submit = commands.add_parser("submit")
    submit.add_argument("pipeline", choices=tuple(pipeline.PIPELINES))
    submit.add_argument("--executors", type=int, default=0, help="0: as many as the cluster gives")
    submit.add_argument("--memory", default="8g")
    put = commands.add_parser("set")
    put.add_argument("changes", nargs="+")
    return top


def submission(config_path: str, name: str, executors: int, memory: str) -> str:
    """The spark-submit line that runs a pipeline on a cluster; lost and slow tasks are the scheduler's."""
    sizing = f"--num-executors {executors}" if executors else "--conf spark.dynamicAllocation.enabled=true"
    here = Path(__file__).resolve()
    return f"spark-submit {sizing} --executor-memory {memory} --conf spark.task.maxFailures=8 --conf spark.speculation=true {here} --config {Path(config_path).resolve()} run {name}"


def main(argv: list[str] | None = None) -> int:
    args = parser().parse_args(argv)
    settings = config.load(args.config)
    if args.command == "set":
        changes = {}
        for change in args.changes:
            name, _, value = change.partition("=")
            try:
                changes[name] = ast.literal_eval(value)
            except (ValueError, SyntaxError):
                changes[name] = value
        config.save(settings, args.config, **changes)
        return 0
    if args.command == "submit":
        print(submission(args.config, args.pipeline, args.executors, args.memory))
        return 0
    if args.command == "run" and args.dry_run:
        print("\n".join(pipeline.plan(args.pipeline, args.start_at, args.stop_after)))
        return 0
    from pyspark.sql import SparkSession

    builder = SparkSession.builder.appName("evenfield")
    spark = (builder.master(args.master) if args.master else builder).getOrCreate()
    ship_package(spark)
    if args.command == "run":
        pipeline.run(spark, settings, args.pipeline, args.start_at, args.stop_after)
    elif args.command == "take":
        print("\n".join(pipeline.Run(spark, settings).take(args.folder)))
    else:
        now = pipeline.Run(spark, settings, apply_basic=args.apply_basic, only_cameras=args.camera, only_setups=args.setup)
        now.stage("correct" if args.command == "int-apply" else args.command, args.mode)
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
