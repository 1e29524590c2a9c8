"""Command line: python -m souklake <history|seed|land|replay|batch|check> …  (or through spark-submit)."""

from __future__ import annotations

import argparse
import json

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from souklake.operators import silver, synth
from souklake.plans import batch, history, publish, validate
from souklake.schemas import SCHEMAS, TABLES, Domain
from souklake.session import session
from souklake.sources.snapshot import exported_footers, exported_schemas, exported_snapshot, jdbc_snapshot
from souklake.sources.tables import path_exists, write_table
from souklake.streaming.landing import POLL, drain, land, stop_when_idle
from souklake.streaming.replay import State, replay

CHANGE_ROWS = "lsn string, xid string, raw string, ordinal bigint"


#: Folders a phase of the checks reads.
PHASE_FOLDERS = {"setup": ("snapshot",), "history": ("bronze",), "cdc": ("landing",), "batch": ("snapshot", "bronze", "lake")}


def _snapshot(spark: SparkSession, args: argparse.Namespace) -> batch.SnapshotReader:
    """An exported copy, the state that a replay keeps, or the tables of a database."""
    if args.state:
        state = State(spark, args.state)
        return state.current
    if not args.jdbc_url:
        return lambda table: exported_snapshot(spark, args.snapshot, table)
    properties = {}
    if args.jdbc_properties:
        with open(args.jdbc_properties) as file:
            properties = json.load(file)
    return lambda table: jdbc_snapshot(spark, table, args.jdbc_url, properties, args.jdbc_parts)


def _seed(spark: SparkSession, root: str) -> dict[str, int]:
    """Write the ten tables below a snapshot root, the dimensions seeded and the facts empty;
    existing tables stay as they are."""
    written = {}
    now = F.current_timestamp().cast("timestamp_ntz")
    rows = Domain().dimension_rows()
    for table in TABLES:
        if path_exists(spark, f"{root}/{table}"):
            continue
        if table in rows:
            frame = synth.seed_rows(synth.row_numbers(spark, 1, rows[table]), table, now)
        else:
            frame = spark.createDataFrame([], SCHEMAS[table])
        written[table] = write_table(frame, f"{root}/{table}")
    return written


def _land(spark: SparkSession, args: argparse.Namespace) -> dict[str, int]:
    changes = (
        spark.readStream.schema(CHANGE_ROWS)
        .option("maxFilesPerTrigger", str(args.files_per_batch))
        .parquet(args.changes)
    )
    target = (changes, args.landing, args.checkpoint, args.database)
    if args.drain:
        return {"landed_changes": drain(*target)}
    landed: list[int] = []
    query = land(*target, follow=True, poll=args.poll, on_batch=landed.append)
    if args.idle_exit_seconds is None:
        query.awaitTermination()
    else:
        stop_when_idle(query, args.idle_exit_seconds)
    return {"landed_changes": sum(landed)}


def _replay(spark: SparkSession, args: argparse.Namespace) -> dict[str, int]:
    state = State(spark, args.state)
    query = replay(state, args.landing, args.checkpoint, not args.drain, args.poll, args.files_per_batch)
    if args.drain or args.idle_exit_seconds is None:
        query.awaitTermination()
    else:
        stop_when_idle(query, args.idle_exit_seconds)
    removed = state.discard_replaced() if args.purge else 0
    return {"tables": sum(state.table(t).last_update() >= 0 for t in TABLES), "purged": removed}


def _check(spark: SparkSession, args: argparse.Namespace) -> dict[str, int | str]:
    if args.phase == "setup":
        snapshot = _snapshot(spark, args)
        exported = args.snapshot and not args.state and not args.jdbc_url
        rules = validate.setup_rules(
            spark,
            {table: snapshot(table) for table in TABLES},
            stored=exported_schemas(spark, args.snapshot) if exported else None,
            footers=exported_footers(spark, args.snapshot) if exported else None,
        )
    elif args.phase == "history":
        rules = validate.history_rules(spark, args.bronze)
    elif args.phase == "cdc":
        rules = validate.landing_rules(spark, args.landing)
    else:
        snapshot = _snapshot(spark, args)
        counts = silver.table_counts({table: snapshot(table) for table in TABLES})
        rules = validate.batch_rules(spark, args.lake, args.bronze, counts)
    return {"phase": args.phase, "rules": validate.require_clean(rules)}


def _snapshot_arguments(job: argparse.ArgumentParser) -> None:
    job.add_argument("--snapshot", help="exported copy: <snapshot>/<table>/*.parquet")
    job.add_argument("--state", help="read the tables from the state of a replay instead")
    job.add_argument("--jdbc-url", help="read the tables from a database instead")
    job.add_argument("--jdbc-properties", help="JSON file of connection properties (user, password, driver)")
    job.add_argument("--jdbc-parts", type=int, default=16, help="tasks that read one table")


def parser() -> argparse.ArgumentParser:
    root = argparse.ArgumentParser(prog="souklake", description=__doc__)
    jobs = root.add_subparsers(dest="job", required=True)
    job = jobs.add_parser("history", help="synthesise bronze history up to a byte budget")
    job.add_argument("--bronze", required=True)
    job.add_argument("--budget", type=int, default=history.DEFAULT_BUDGET)
    job = jobs.add_parser("seed", help="write the operational tables: seeded dimensions, empty facts")
    job.add_argument("--snapshot", required=True)
    job = jobs.add_parser("land", help="land a folder of change files")
    job.add_argument("--changes", required=True)
    job.add_argument("--landing", required=True)
    job.add_argument("--checkpoint", required=True)
    job.add_argument("--database", required=True)
    job.add_argument("--drain", action="store_true", help="land what there is and exit")
    job.add_argument("--idle-exit-seconds", type=float)
    job.add_argument("--poll", default=POLL)
    job.add_argument("--files-per-batch", type=int, default=1000)
    job = jobs.add_parser("replay", help="replay landed changes into the tables' current rows")
    job.add_argument("--landing", required=True)
    job.add_argument("--state", required=True)
    job.add_argument("--checkpoint", required=True)
    job.add_argument("--drain", action="store_true", help="replay what there is and exit")
    job.add_argument("--idle-exit-seconds", type=float)
    job.add_argument("--poll", default=POLL)
    job.add_argument("--files-per-batch", type=int, default=1000)
    job.add_argument("--purge", action="store_true", help="remove replaced state at the end")
    job = jobs.add_parser("batch", help="build and publish silver and gold")
    job.add_argument("--bronze", required=True)
    job.add_argument("--lake", required=True)
    job.add_argument("--purge", action="store_true", help="remove replaced batches once the new one is published")
    _snapshot_arguments(job)
    job = jobs.add_parser("check", help="validate a lifecycle phase")
    job.add_argument("--phase", choices=("setup", "history", "cdc", "batch"), default="setup")
    for name in ("bronze", "landing", "lake"):
        job.add_argument(f"--{name}")
    _snapshot_arguments(job)
    return root


def parse(argv: list[str] | None) -> argparse.Namespace:
    """Arguments; a folder that the job reads and that is not given ends the program."""
    known = parser()
    args = known.parse_args(argv)
    needed = PHASE_FOLDERS[args.phase] if args.job == "check" else ("snapshot",) if args.job == "batch" else ()
    absent = [f"--{name}" for name in needed if not getattr(args, name) and not (name == "snapshot" and (args.jdbc_url or args.state))]
    if absent:
        known.error(f"{args.job} needs {', '.join(absent)}")
    return args


def main(argv: list[str] | None = None) -> dict:
    args = parse(argv)
    spark = session()
    if args.job == "history":
        row = history.build_history(spark, args.bronze, args.budget).first()
        result = row.asDict(recursive=True)
    elif args.job == "seed":
        result = _seed(spark, args.snapshot)
    elif args.job == "land":
        result = _land(spark, args)
    elif args.job == "replay":
        result = _replay(spark, args)
    elif args.job == "batch":
        result = batch.run_batch(spark, args.bronze, _snapshot(spark, args), args.lake)
        if args.purge:
            result["purged"] = publish.discard_replaced(spark, args.lake)
    else:
        result = _check(spark, args)
    print(json.dumps(result, indent=2, sort_keys=True))
    return result


if __name__ == "__main__":
    main()
