"""Generating jobs from builders."""

from __future__ import annotations

import json
import uuid
from datetime import date

from pyspark.sql import functions as F

from tidemill.operators import jobs
from tidemill.plans.land import once
from tidemill.sources.tables import Tables

_JSON = ("macro_params_json", "key_params_list", "header_json", "payload_json", "response_parse_json", "persist_env_json", "output_tables_json", "merge_fields_json")


def config(row) -> dict:
    """A configuration row with its JSON columns parsed."""
    return {k: json.loads(v) if k in _JSON and v else v for k, v in row.asDict().items()}


def one(tables: Tables, build_id: str, today: date) -> list[str]:
    """Generate the jobs of a builder, whatever its state, and return the new ids. All of a builder's jobs are stored at once.

    Of the job table, the buckets of the builder's ids are read and nothing is rewritten; the new jobs lie on the driver as ids alone.
    """
    builder = tables.read("api_job_builder", [build_id]).limit(1).collect()
    if not builder:
        raise ValueError(f"no such builder: {build_id}")
    builder = config(builder[0])
    api = tables.read("api_mst", [builder["api_id"]]).limit(1).collect()
    if not api:
        raise ValueError(f"no such API: {builder['api_id']}")
    work = f"{tables.root}/runs/{uuid.uuid4().hex}"
    # Written once, as random ids, or those of a query that changes, would differ if they were made twice.
    made = once(tables, work, lambda: jobs.made(tables.spark, builder, config(api[0]), today))
    with tables.change() as c:
        added = c.append("api_job", jobs.new_jobs(made, c.rows_of("api_job", made.select("job_id"))))
    tables.delete_files(work)
    return sorted(r.job_id for r in tables.segments("api_job", {int(b): s for b, s in added.items()}).select("job_id").collect())


def some(tables: Tables, today: date, cycle: str | None = None) -> list[str]:
    """Generate the jobs of all active builders, or of those of a cycle, one builder after the other; an error leaves the earlier ones' jobs stored."""
    builders = tables.read("api_job_builder").filter("is_active")
    builders = builders.filter(F.col("execution_cycle") == cycle) if cycle else builders
    return [x for r in builders.orderBy("build_id").select("build_id").collect() for x in one(tables, r.build_id, today)]
