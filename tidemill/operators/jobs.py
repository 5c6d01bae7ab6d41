"""Expanding parameter axes into jobs with stable ids."""

from __future__ import annotations

import re
from collections.abc import Mapping
from datetime import date
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemill.functions.timefn import macro_value

ID_LENGTH, DIGEST = 150, 16
SLOT = "NOW"


def axes(spark: SparkSession, spec: Mapping[str, Any], today: date) -> list[DataFrame]:
    """One DataFrame for each axis: a query (its first columns, in order), a date keyword, or a literal."""
    out = []
    for raw, value in spec.items():
        keys = [k.strip() for k in raw.split(",")]
        if SLOT in keys:
            raise ValueError(f"{SLOT} is reserved")
        if isinstance(value, dict) and "db" in value:
            if not re.match(r"(?is)\s*(select|with|values)\b", value["db"]):
                raise ValueError("an axis query must be a SELECT")
            rows = spark.sql(value["db"])
            if len(rows.columns) < len(keys):
                raise ValueError(f"the query of {raw} has too few columns")
            rows = rows.toDF(*(f"_{i}" for i in range(len(rows.columns)))).select(*(F.col(f"_{i}").alias(k) for i, k in enumerate(keys)))
            if rows.isEmpty():
                raise ValueError(f"the query of {raw} has no rows")
        elif len(keys) > 1:
            raise ValueError(f"only a query fills several keys: {raw}")
        elif isinstance(value, dict) and "date" in value:
            rows = spark.range(1).select(F.lit(macro_value(value["date"], today, value.get("format"))).alias(keys[0]))
        else:
            rows = spark.range(1).select(F.lit(value).alias(keys[0]))
        out.append(rows)
    return out


def product(spark: SparkSession, parts: list[DataFrame]) -> DataFrame:
    """All combinations of the axes; a later axis replaces a key of an earlier one. The number of jobs is the declared product of the axes."""
    out = spark.range(1).select()
    for part in parts:
        out = out.drop(*part.columns).crossJoin(part)
    return out


def params_json(columns: list[str]) -> Column:
    """The parameters as JSON with sorted keys: the identity of a job."""
    return F.to_json(F.struct(*sorted(columns)), {"ignoreNullFields": "false"}) if columns else F.lit("{}")


def job_id(api_id: Column, values: list[Column]) -> Column:
    """The API id and the key parameters, null as "None"; a digest of them where that is too long."""
    part = F.concat_ws("_", *(F.coalesce(v.cast("string"), F.lit("None")) for v in values))
    plain = F.concat(api_id, F.lit("_"), part)
    short = F.substring(F.concat(api_id, F.lit("_"), F.substring(F.sha2(part, 256), 1, DIGEST)), 1, ID_LENGTH)
    return F.when(F.char_length(plain) > ID_LENGTH, short).otherwise(plain)


def key_params(entries: list[Any]) -> list[tuple[str, str]]:
    """(parameter, column) of key parameter entries: a name, or one name mapped to a column."""
    out = []
    for entry in entries:
        if isinstance(entry, dict):
            if len(entry) != 1:
                raise ValueError(f"a key parameter maps one name: {entry}")
            out += entry.items()
        else:
            out.append((entry, entry.lower()))
    return out


def is_repeated(entries: list[Any] | None) -> bool:
    return any(key == SLOT for key, _ in key_params(entries or []))


def conflicts(jobs: DataFrame) -> DataFrame:
    """Ids (with their number of parameter sets) that different parameters share."""
    return jobs.groupBy("job_id").agg(F.count_distinct("params_json").alias("n_params")).filter("n_params > 1")


def new_jobs(jobs: DataFrame, existing: DataFrame) -> DataFrame:
    """Jobs whose id does not exist yet, one for each id. An id with other parameters is an error, raised where the result is read."""
    once = jobs.groupBy("job_id").agg(F.min("params_json").alias("params_json"), F.max("params_json").alias("_most"), *(F.first(c).alias(c) for c in jobs.columns if c not in ("job_id", "params_json")))
    # Existing jobs are not grouped: those that the new ones don't name are dropped by the join, which Spark makes a broadcast of the smaller side where that is small.
    old = existing.select("job_id", "params_json").join(once.select("job_id"), "job_id", "left_semi").groupBy("job_id").agg(F.min("params_json").alias("_least"), F.max("params_json").alias("_greatest"))
    both = once.join(old, "job_id", "left")
    clash = (F.col("params_json") != F.col("_most")) | F.coalesce((F.col("_least") != F.col("params_json")) | (F.col("_greatest") != F.col("params_json")), F.lit(False))
    error = F.raise_error(F.concat(F.lit("one job id stands for different parameters: "), F.col("job_id"))).cast("boolean")
    return both.filter(F.when(clash, error).otherwise(F.col("_least").isNull())).select(*jobs.columns)


def identified(params: DataFrame, builder: Mapping[str, Any], entries: list[Any] | None) -> tuple[DataFrame, bool]:
    """Parameter sets with ``job_id`` and ``params_json``, and whether equal sets get equal ids.

    Without key parameters an id is random (so write the result once before reading it twice); with the slot alone it is the builder's.
    """
    keys = [k for k, _ in key_params(entries or []) if k != SLOT]
    if missing := [k for k in keys if k not in params.columns]:
        raise ValueError(f"{builder['build_id']}: no such parameters: {missing}")
    api = F.lit(builder["api_id"])
    if not entries:
        made = F.concat(api, F.lit("_"), F.substring(F.replace(F.uuid(), F.lit("-"), F.lit("")), 1, 12))
    elif not keys:
        made = F.concat(api, F.lit("_"), F.lit(builder["build_id"]))
    else:
        made = job_id(api, [F.col(k) for k in keys])
    return params.select(made.alias("job_id"), params_json(params.columns).alias("params_json")), bool(entries)


def made(spark: SparkSession, builder: Mapping[str, Any], api: Mapping[str, Any], today: date) -> DataFrame:
    """All jobs that a builder stands for: columns of the job table but its description and time. Ids without key parameters are random, so the result is to be written once."""
    sets = product(spark, axes(spark, builder.get("macro_params_json") or {}, today))
    rows, _ = identified(sets, builder, api.get("key_params_list"))
    return rows.select(
        "job_id", F.lit(builder["build_id"]).alias("build_id"), F.lit(builder["api_id"]).alias("api_id"), "params_json", F.lit(True).alias("is_active"),
        F.lit(builder.get("save_mode") or "overwrite").alias("save_mode"), F.lit(builder.get("execution_cycle")).cast("string").alias("execution_cycle"),
    )


def build(spark: SparkSession, builder: Mapping[str, Any], api: Mapping[str, Any], existing: DataFrame, today: date) -> DataFrame:
    """The new jobs of a builder with key parameters. Of the existing ones, those with the builder's ids are enough."""
    return new_jobs(made(spark, builder, api, today), existing)


def pending(jobs: DataFrame, cycle: str) -> DataFrame:
    """The active jobs of a cycle: those of a builder table are to be built, those of a job table to be run."""
    return jobs.filter(F.col("is_active") & (F.col("execution_cycle") == cycle))
