"""Commands: generate-jobs CYCLE, run-cycle CYCLE, cycle CYCLE (both, the second also if the first fails), finalize-exports TO."""

from __future__ import annotations

import argparse
import sys
from datetime import UTC, datetime

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from tidemill.plans import export, generate, run
from tidemill.sources.tables import Tables

#: Jobs that a command lists at most, failed ones first.
SHOWN = 100


def main(args: list[str] | None = None, spark: SparkSession | None = None, **how) -> int:
    """Run a command and return its exit code, 1 if a job or a builder failed."""
    parser = argparse.ArgumentParser(prog="tidemill")
    parser.add_argument("command", choices=["generate-jobs", "run-cycle", "cycle", "finalize-exports"])
    parser.add_argument("what", help="a cycle, such as daily or 5m, or the folder to export to")
    parser.add_argument("--tables", required=True, help="the folder of the engine's tables")
    parser.add_argument("--since", type=datetime.fromisoformat, help="export only jobs saved after this time (UTC)")
    said = parser.parse_args(args)
    spark = spark or SparkSession.builder.appName("tidemill").getOrCreate()
    tables, now, code = Tables(spark, said.tables), datetime.now(), 0
    if said.command in ("generate-jobs", "cycle"):
        try:
            made = generate.some(tables, now.date(), said.what)
            print(f"{said.what}: {len(made)} new jobs", *made, sep="\n  ")
        except Exception as e:  # noqa: BLE001 - a cycle goes on with the jobs there are
            print(f"{said.what}: {e}", file=sys.stderr)
            code = 1
    if said.command in ("run-cycle", "cycle"):
        done = run.cycle(tables, said.what, now, **how)
        counts = done.agg(F.count("*").alias("n"), F.count("error").alias("failed")).first()
        print(f"{said.what}: {counts.n} jobs, {counts.failed} failed", *(f"{r.job_id}: {r.error or r.description}" for r in done.orderBy(F.col("error").isNull(), "job_id").limit(SHOWN).collect()), sep="\n  ")
        code = max(code, int(counts.failed > 0))
    if said.command == "finalize-exports":
        done = export.finalize(tables, said.what, datetime.now(UTC).date(), since=said.since)
        counts = done.groupBy("table").agg(F.count("*").alias("jobs"), F.sum("n").alias("n")).orderBy("table").collect()
        print(f"{sum(r.jobs for r in counts)} exports", *(f"{r.table}: {r.jobs} jobs, {r.n} rows" for r in counts), sep="\n  ")
    return code


if __name__ == "__main__":
    sys.exit(main())
