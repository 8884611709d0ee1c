"""Command line: ``python -m landfall intake|split|runs|decrypt ...``

The AES key is taken from the environment variable LANDFALL_AES_KEY only, so it
is in no process list.
"""

from __future__ import annotations

import argparse
import json
import os
import uuid
from dataclasses import asdict

from pyspark.sql import SparkSession

from landfall.contract import Contract, Policy, load_contract
from landfall.functions.crypto import key_column
from landfall.operators import audit
from landfall.operators.protect import decrypt_columns
from landfall.operators.sinks import JdbcTable
from landfall.operators.splitting import TARGET_KB, manifest_totals, split_files
from landfall.plans.intake import IntakeJob, loaded_rows, run_intake


def arguments(argv: list[str] | None = None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(prog="landfall")
    jobs = parser.add_subparsers(dest="job", required=True)

    intake = jobs.add_parser("intake", help="land files as one run")
    intake.add_argument("paths", nargs="+")
    intake.add_argument("--contract", required=True)
    intake.add_argument("--format", help="overrides the contract's format")
    intake.add_argument("--location", required=True, help="landing table")
    intake.add_argument("--audit", required=True, help="run log")
    intake.add_argument("--control")
    intake.add_argument("--execution-id", default=None)
    intake.add_argument("--lenient", action="store_true")
    intake.add_argument("--split-above-kb", type=int, default=None, help="split files above this size first")
    intake.add_argument("--part-kb", type=int, default=TARGET_KB)
    intake.add_argument("--error-report", help="folder for the readable report of bad rows")
    intake.add_argument("--jdbc-url", help="also append good rows to this database (user and password from the environment)")
    intake.add_argument("--jdbc-driver", default="org.postgresql.Driver")

    split = jobs.add_parser("split", help="write size-bounded parts of large files")
    split.add_argument("paths", nargs="+")
    split.add_argument("--contract", required=True)
    split.add_argument("--format")
    split.add_argument("--out", required=True)
    split.add_argument("--target-kb", type=int, default=TARGET_KB)
    split.add_argument("--max-rows", type=int, default=None, help="most rows of a part")

    decrypt = jobs.add_parser("decrypt", help="encrypted values, or the good rows of a run as JSON lines (the key comes from the environment)")
    decrypt.add_argument("values", nargs="*")
    decrypt.add_argument("--contract")
    decrypt.add_argument("--location", help="landing table")
    decrypt.add_argument("--execution-id")
    decrypt.add_argument("--out", help="folder for the rows")

    runs = jobs.add_parser("runs", help="recent runs, or the details of one")
    runs.add_argument("--audit", required=True)
    runs.add_argument("--execution-id")
    return parser.parse_args(argv)


def database_of(args: argparse.Namespace, contract: Contract) -> JdbcTable | None:
    """The contract's target table in the database that is named, or none."""
    if not args.jdbc_url:
        return None
    if not contract.target_table:
        raise SystemExit("the contract names no target_table")
    user, password = (os.environ.get(f"LANDFALL_JDBC_{k}", "") for k in ("USER", "PASSWORD"))
    return JdbcTable(args.jdbc_url, contract.target_table, user, password, args.jdbc_driver)


def decrypt(spark: SparkSession, args: argparse.Namespace) -> int:
    """Values are printed, one a line; rows are written, as they may be many."""
    key = key_column(spark, os.environ.get("LANDFALL_AES_KEY"))
    if args.values:
        given = spark.createDataFrame(list(enumerate(args.values)), "at int, value string")
        for r in decrypt_columns(given, ["value"], key).orderBy("at").collect():
            print(r.value)
        return 0
    if not (args.contract and args.location and args.out):
        raise SystemExit("name values, or --contract, --location and --out")
    contract = load_contract(spark, args.contract)
    rows = loaded_rows(spark, args.location, contract, args.execution_id)
    decrypt_columns(rows, [f.warehouse_name for f in contract.encrypted], key).write.json(args.out)
    return 0


def main(argv: list[str] | None = None) -> int:
    args = arguments(argv)
    spark = SparkSession.builder.appName(f"landfall-{args.job}").getOrCreate()
    if args.job == "runs":
        states = audit.run_states(audit.read_events(spark, args.audit))
        report = audit.failure_report(states, args.execution_id) if args.execution_id else audit.recent_runs(states)
        report.show(truncate=False, vertical=True)
        return 0
    if args.job == "decrypt":
        return decrypt(spark, args)
    contract = load_contract(spark, args.contract)
    if args.format:
        contract = contract.as_format(args.format)
    if args.job == "split":
        manifest = split_files(spark, args.paths, contract, args.out, args.target_kb, max_rows=args.max_rows)
        print(json.dumps(manifest_totals(manifest).first().asDict() | {"out": args.out}))
        return 0
    result = run_intake(
        spark,
        IntakeJob(
            args.paths,
            contract.with_policy(Policy.lenient()) if args.lenient else contract,
            args.location,
            args.audit,
            args.control,
            os.environ.get("LANDFALL_AES_KEY"),
            args.execution_id or str(uuid.uuid4()),
            database=database_of(args, contract),
            split_above_kb=args.split_above_kb,
            part_kb=args.part_kb,
            report_dir=args.error_report,
        ),
    )
    print(json.dumps(asdict(result)))
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
