"""Landing answers page by page, and logging runs.

Every page of answers is written before the next one is asked for, and whether a job goes on is decided from the records of what was landed. A run that is
started again with the same folder reads the pages that are there and calls the rest.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemill.functions import template
from tidemill.operators.parse import merge_pages
from tidemill.sources import http
from tidemill.sources.http import SCHEMA, HttpSource
from tidemill.sources.tables import Tables

#: Pages of a job at most; a job with more fails.
PAGES = 100
#: Columns of an API's configuration that go with its jobs.
CONFIGURED = (
    "request_type", "api_url", "header_json", "payload_type", "payload_json", "payload_xml", "response_type", "response_parse_json", "persist_env_json", "output_tables_json", "merge_fields_json",
)


def once(tables: Tables, at: str, make: Callable[[], DataFrame]) -> DataFrame:
    """What was written to a folder; it is made and written if that isn't done yet."""
    if not tables.written(at):
        make().write.mode("overwrite").parquet(at)
    return tables.spark.read.parquet(at)


def requests(calls: DataFrame, page: int = 1) -> DataFrame:
    """The requests for a page of each job: the columns of ``http.REQUEST``. Calls have ``job_id``, ``params`` and CONFIGURED; jobs without a page parameter have one page."""
    numbered = F.when(template.paged(F.col("api_url"), F.col("payload_xml"), F.col("payload_json")), template.overlay(F.col("params"), F.lit(json.dumps({template.PAGE: page})))).otherwise(F.col("params"))
    rows = calls.withColumn("_params", numbered)
    return rows.select("job_id", F.lit(page).alias("page"), *(c.alias(n) for n, c in template.request(F.col("_params")).items()))


def pages(tables: Tables, calls: DataFrame, at: str, records: Callable[[DataFrame], DataFrame], most: int = PAGES, **how) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Land the pages of some jobs under a folder: (answers, records of the pages that count, errors of jobs by ``job_id``).

    A page without a record, or with the records of the one before, ends a job and doesn't count. ``records`` makes (``job_id``, ``page``, ``selector``, ``pos``, ``record``, ``error`` and more)
    of answers; ``how`` goes to ``http.responses``.
    """
    paged = calls.filter(template.paged(F.col("api_url"), F.col("payload_xml"), F.col("payload_json"))).select("job_id")
    todo, answers, made, ends = calls, [], [], []
    for page in range(1, most + 2):  # one more tells whether there are more
        one = once(tables, f"{at}/answers/{page}", lambda todo=todo, page=page: http.responses(requests(todo, page), later=page > 1, **how))
        found = once(tables, f"{at}/records/{page}", lambda one=one: records(one))
        answers.append(f"{at}/answers/{page}")
        made.append(f"{at}/records/{page}")
        if page == 1 and paged.isEmpty():
            break
        said = F.xxhash64("selector", "pos", "record")
        sums = found.groupBy("job_id").agg(F.count("record").alias("n"), F.concat_ws(":", F.expr("bit_xor(xxhash64(selector, pos, record))"), F.sum(F.shiftright(said, 20))).alias("digest"), F.max(F.col("error").isNotNull()).alias("bad"))
        state = one.select("job_id", "page", F.col("error").isNotNull().alias("failed")).join(paged, "job_id", "left_semi").join(sums, "job_id", "left")
        ends.append(f"{at}/ends/{page}")
        once(tables, ends[-1], lambda state=state: state.select("job_id", "page", F.coalesce("n", F.lit(0)).alias("n"), "digest", (F.col("failed") | F.coalesce("bad", F.lit(False))).alias("failed")))
        # A job goes on behind a page that counts.
        going = merge_pages(tables.spark.read.parquet(*ends[-2:]), ["job_id"]).filter((F.col("page") == page) & (F.col("n") > 0) & ~F.col("failed")).select("job_id")
        if going.isEmpty():
            break
        todo = calls.join(going, "job_id", "left_semi")
    landed, rows = tables.spark.read.schema(SCHEMA).parquet(*answers), tables.spark.read.parquet(*made)
    errors = landed.filter("error is not null").select("job_id", "error").union(rows.filter("error is not null").select("job_id", F.concat(F.coalesce("selector", F.lit("")), F.lit(": "), "error")))
    if ends:
        every = tables.spark.read.parquet(*ends)
        stopped = every.select("job_id", "page").join(merge_pages(every, ["job_id"]).select("job_id", "page"), ["job_id", "page"], "left_anti")
        rows = rows.join(stopped, ["job_id", "page"], "left_anti")
        if len(answers) > most and not going.isEmpty():
            errors = errors.union(going.select("job_id", F.lit(f"there are more than {most} pages").alias("error")))
    return landed, rows.filter("error is null"), errors


def land(spark: SparkSession, requests: list[Mapping], path: str, tape: str | None = None) -> DataFrame:
    """Call some requests once through the data source, write the answers, and return a reader of what was written."""
    spark.dataSource.register(HttpSource)
    reader = spark.read.format("tidemill_http").option("requests", json.dumps(requests))
    if tape:
        reader = reader.option("recorded", tape)
    reader.load().write.mode("overwrite").parquet(path)
    return spark.read.schema(SCHEMA).parquet(path)


def log_rows(outcome: DataFrame, now: str) -> DataFrame:
    """Run log rows of (job_id, error): a job with an error has failed, with a message of at most 4000 characters. ``now`` is in UTC."""
    return outcome.select(
        "job_id",
        F.when(F.col("error").isNotNull(), "FAILED").otherwise("SUCCESS").alias("status"),
        F.substring("error", 1, 4000).alias("error_message"),
        F.lit(now).cast("timestamp_ntz").alias("executed_at"),
    )
