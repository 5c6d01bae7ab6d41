"""Running jobs: call, parse, type, save and log, a cycle at a time.

A job is saved as a whole or not at all: one value that can't be read, one page that fails, fails the job, keeps its old rows and leaves it active for the
next run. Jobs don't fail each other: what can't be decoded, opened or parsed is a row with its error. All APIs go through one plan, and all tables, the log and the
jobs' states change in one commit.
"""

from __future__ import annotations

import os
import uuid
from collections.abc import Callable, MutableMapping
from datetime import UTC, datetime
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemill.functions import template
from tidemill.functions.timefn import stamp
from tidemill.operators import jobs as job_ops
from tidemill.operators import parse, save
from tidemill.plans.generate import config
from tidemill.plans.land import CONFIGURED, log_rows, once, pages
from tidemill.schemas import is_generic
from tidemill.sources import http
from tidemill.sources.tables import Change, Conflict, Tables

#: Times that a commit is made again after another writer's.
TRIES = 5
_SPEC = "delimiter string, fields array<string>, has_header boolean, encoding string, inner_file string"
_KEYS = "array<struct<key:string,column:string>>"


def problem(api: dict, known: list[str]) -> str | None:
    """What is wrong with an API's configuration, found before anything is called. ``known`` are the result tables."""
    try:
        parse.check_mapping(api.get("output_tables_json"), api.get("persist_env_json"))
        job_ops.key_params(api.get("key_params_list") or [])
        merges = api.get("merge_fields_json") or {}
        if not isinstance(merges, dict) or not all(isinstance(x, dict) and all(isinstance(t, str) for t in x.values()) for x in merges.values()):
            raise ValueError("merged fields are given as {selector: {path in the answer: field}}")
    except ValueError as e:
        return f"{api['api_id']}: {e}"
    unknown = sorted({*(api.get("output_tables_json") or {}).values()} - {*known})
    return f"{api['api_id']}: unknown result tables: {', '.join(unknown)}" if unknown else None


def stamped(keys: Column, params: Column, cycle: Column, now: datetime, cycles: list[str]) -> Column:
    """The key parameters that go with a job's rows, as JSON text by column name; null without any. Parameters that a job lacks are left out."""
    at = F.lit(now).cast("timestamp_ntz")
    slot = reduce(lambda made, c: F.when(cycle == c, stamp(at, c)).otherwise(made), cycles, stamp(at, None))
    given = F.from_json(params, "map<string,variant>")
    parts = F.transform(keys, lambda k: F.struct(k["column"].alias("key"), F.when(k["key"] == job_ops.SLOT, slot.cast("variant")).otherwise(F.try_element_at(given, k["key"])).alias("value")))
    held = F.filter(parts, lambda x: x["value"].isNotNull())
    return F.when(F.size(held) > 0, F.to_json(F.map_from_entries(held)))


def records(landed: DataFrame, calls: DataFrame) -> DataFrame:
    """The records of answers of any APIs: (``job_id``, ``page``, ``selector``, ``table``, ``pos``, ``record``, ``error``); an answer that can't be read is a row with its error.

    There is one plan for each form that the answers have (JSON, delimited, XML), whatever the number of APIs.
    """
    landed = landed.filter("error is null").select("job_id", "page", "content_type", "body")
    rows = landed.join(calls.select("job_id", *(c for c in CONFIGURED if c.startswith(("response", "merge", "output")))), "job_id")
    flat = F.coalesce(F.col("response_type").isin("delimited", "zip_delimited"), F.lit(False))
    rows = rows.withColumn("_kind", F.when(flat, "delimited").otherwise(parse.response_format(F.lit(None).cast("string"), F.col("content_type"), F.col("body").cast("string"))))
    there = {r[0] for r in rows.select("_kind").distinct().collect()}  # three at most
    made = [read(rows.filter(F.col("_kind") == kind)) for kind, read in (("json", _json), ("delimited", _delimited), ("xml", _xml)) if kind in there]
    return reduce(DataFrame.unionByName, made) if made else landed.sparkSession.createDataFrame([], _RECORDS)


_RECORDS = "job_id string, page int, selector string, table string, pos int, record string, error string"
_KEEP = ("job_id", "page", "selector", "table")


def _by_selector(rows: DataFrame, *more: str) -> DataFrame:
    """Decoded answers, each once for each selector (null for an API that only keeps values): ``text``, ``bad`` (the error of decoding) and more columns."""
    return rows.select("job_id", "page", F.col("_text.value").alias("text"), F.col("_text.error").alias("bad"), *more, F.explode_outer(F.from_json("output_tables_json", "map<string,string>")).alias("selector", "table"))


def _spread(rows: DataFrame, items: Column, error: Column) -> DataFrame:
    """A row for each of an array of records, or one with the error."""
    made = rows.select(*_KEEP, F.coalesce("bad", error).alias("error"), F.when(F.col("selector").isNotNull(), items).alias("items"))
    made = made.select(*_KEEP, F.posexplode_outer(F.when(F.col("error").isNull(), F.col("items"))).alias("pos", "record"), "error")
    return made.select(*_KEEP, "pos", "record", "error").filter("record is not null or error is not null")


def _json(rows: DataFrame) -> DataFrame:
    rows = rows.withColumn("_text", parse.decode(F.col("body")))
    rows = _by_selector(rows, "merge_fields_json").withColumn("_document", F.try_parse_json("text")).withColumn("_merges", F.from_json("merge_fields_json", "map<string,map<string,string>>"))
    document = F.col("_document")
    items = parse.merge_fields(parse.json_items(document, F.col("selector")), document, F.try_element_at("_merges", "selector"))
    return _spread(rows, items, F.when(document.isNull(), "the answer is no JSON"))


def _delimited(rows: DataFrame) -> DataFrame:
    rows = rows.withColumn("_spec", F.coalesce(F.from_json("response_parse_json", _SPEC), F.from_json(F.lit("{}"), _SPEC)))
    zipped = F.col("response_type") == "zip_delimited"
    rows = rows.withColumn("_open", parse.unzip(F.when(zipped, F.col("body")), F.col("_spec.inner_file")))
    rows = rows.withColumn("_read", parse.decode(F.when(zipped, F.col("_open.value")).otherwise(F.col("body")), F.col("_spec.encoding")))
    rows = rows.withColumn("_text", F.struct(F.col("_read.value").alias("value"), F.coalesce("_open.error", "_read.error").alias("error")))
    rows = _by_selector(rows, "_spec")
    spec = (F.col("text"), F.col("_spec.fields"), F.coalesce("_spec.delimiter", F.lit(",")), F.col("_spec.has_header"))
    return _spread(rows, F.transform(parse.delimited_records(*spec), lambda r: F.to_json(r, {"ignoreNullFields": "false"})), parse.delimited_error(*spec))


def _xml(rows: DataFrame) -> DataFrame:
    charset = F.nullif(F.regexp_extract("content_type", r"""(?i)charset\s*=\s*["']?([^"';\s]+)""", 1), F.lit(""))
    rows = _by_selector(rows.withColumn("_text", parse.decode(F.col("body"), charset)))
    # An API that only keeps values has its answer read as well, so that one that is no XML fails.
    found = parse.xml_records(rows.withColumn("_path", F.coalesce("selector", F.lit("."))), "text", "_path", [*_KEEP, "bad"])
    found = found.select(*_KEEP, "pos", F.when(F.col("selector").isNotNull(), F.col("record")).alias("record"), "error")
    unread = rows.filter("bad is not null").select(*_KEEP, F.lit(None).cast("int").alias("pos"), F.lit(None).cast("string").alias("record"), F.col("bad").alias("error"))
    return found.filter("record is not null or error is not null").unionByName(unread)


def table_rows(found: DataFrame, schema: T.StructType) -> DataFrame:
    """Rows of a result table from records with their job and key parameters, and ``bad``. A record's own ids go before those of its job."""
    keep = ["job_id", "selector", "page", "pos"]
    if not is_generic(schema):
        return save.typed_records(found, schema, keep)
    return found.select(*(F.col(c).alias(f"run_{c}") for c in keep), "api_id", "job_id", F.col("key_params").alias("key_params_json"), F.col("record").alias("result_json"), F.lit(0).alias("bad"))


def numbered(tables: Tables, name: str, at: str) -> DataFrame:
    """What was written to a folder, with the table's next ids in ``id``, in the order of the files: from the number of rows of each file and a row's place in it."""
    spark = tables.spark
    rows = spark.read.parquet(at).select("*", F.col("_metadata.file_name").alias("_file"), F.col("_metadata.row_index").alias("_place"))
    sizes = sorted((r["_file"], r.n) for r in rows.groupBy("_file").agg(F.count("*").alias("n")).collect())  # a row for each file
    first, ahead = tables.reserve(name, sum(n for _, n in sizes)) if sizes else 1, []
    for file, n in sizes:
        ahead.append((file, first))
        first += n
    starts = spark.createDataFrame(ahead, "_file string, _first long")
    return rows.join(F.broadcast(starts), "_file").withColumn("id", F.col("_first") + F.col("_place")).drop("_file", "_place", "_first")


def _persist(landed: DataFrame, calls: DataFrame, store: MutableMapping[str, str]) -> None:
    """Keep values of JSON answers as secrets; an answer without one changes nothing. The last page of the greatest job id counts."""
    each = landed.filter("error is null").join(calls.select("job_id", F.explode(F.from_json("persist_env_json", "map<string,string>")).alias("path", "name")), "job_id")
    each = each.withColumn("_text", parse.decode(F.col("body"))).withColumn("value", parse.json_scalar(F.col("_text.value"), F.col("path"))).filter("value is not null")
    for r in each.groupBy("name").agg(F.max_by("value", F.struct("job_id", "page", "path")).alias("value")).collect():  # a row for each secret
        store[r.name] = r.value


def _calls(tables: Tables, pending: DataFrame, now: datetime) -> DataFrame:
    """The jobs of a run with the configuration of their APIs, what is wrong with it, and their key parameters."""
    spark = tables.spark
    used = tables.read("api_mst").join(pending.select("api_id").distinct(), "api_id", "left_semi")
    apis, known = [config(r) for r in used.collect()], tables.result_tables()  # configuration, written by hand
    compiled = []
    for a in apis:
        wrong = problem(a, known)
        keys = job_ops.key_params(a.get("key_params_list") or []) if not wrong else []
        compiled.append((a["api_id"], wrong, any(k == job_ops.SLOT for k, _ in keys), keys))
    checked = spark.createDataFrame(compiled, f"api_id string, wrong string, repeated boolean, keys {_KEYS}")
    calls = pending.select("job_id", "api_id", F.col("params_json").alias("params"), "save_mode", "execution_cycle").join(used.select("api_id", *CONFIGURED), "api_id", "left").join(checked, "api_id", "left")
    overwritten = F.col("repeated") & (F.coalesce("save_mode", F.lit("")) == "overwrite") & (F.size(F.from_json("output_tables_json", "map<string,string>")) > 0)
    wrong = F.coalesce(
        "wrong", F.when(F.col("repeated").isNull(), F.concat(F.lit("no such API: "), "api_id")), F.when(overwritten, F.concat("api_id", F.lit(": a repeated job that overwrites would lose what it saved before"))),
        F.when(F.try_parse_json("params").isNull(), F.lit("the parameters are no JSON")),
    )
    cycles = [r.execution_cycle for r in pending.select("execution_cycle").distinct().collect() if r.execution_cycle]
    return calls.withColumns({"wrong": wrong, "repeated": F.coalesce("repeated", F.lit(False)), "key_params": stamped(F.col("keys"), F.col("params"), F.col("execution_cycle"), now, cycles)}).drop("keys")


def run(
    tables: Tables, pending: DataFrame, now: datetime, send: http.Send = http.over_http, wait: Callable[[float], None] | None = None, store: MutableMapping[str, str] = os.environ, run_id: str | None = None, **how
) -> DataFrame:
    """Run jobs (rows of the job table): each one's ``job_id``, ``error`` (null if it was saved) and ``description``.

    Jobs whose answers hold secrets run first, so the others are sent the fresh ones. A run that was cut off is taken up again under its ``run_id``: what it landed is not called again. More
    arguments go to ``http.responses``.
    """
    spark, work = tables.spark, f"{tables.root}/runs/{run_id or uuid.uuid4().hex}"
    calls = once(tables, f"{work}/calls", lambda: _calls(tables, pending, now))
    ready = calls.filter("wrong is null")
    templates = ready.select("api_url", "header_json", "payload_json", "payload_xml").distinct().collect()  # configuration
    names = template.secret_names(x for r in templates for x in r)
    params = ready.filter(F.col("params").rlike(template.SECRET)).select(F.explode(F.regexp_extract_all("params", F.lit(template.SECRET), F.lit(1)))).distinct().collect()  # the names in them
    names |= {r[0] for r in params}
    how = {**how, "send": send} | ({} if wait is None else {"wait": wait})
    persisting = F.coalesce(F.size(F.from_json("persist_env_json", "map<string,string>")) > 0, F.lit(False))
    waves = [ready.filter(persisting), ready.filter(~persisting)]
    done = []
    for i, own in enumerate(waves):
        if own.isEmpty():
            continue
        made = pages(tables, own, f"{work}/wave{i}", lambda landed, own=own: records(landed, own), store={n: store[n] for n in names if n in store}, **how)
        if i == 0:
            _persist(made[0], own, store)
        done.append(made)
    empty = spark.createDataFrame([], "job_id string, error string")
    failed = reduce(DataFrame.union, [x[2] for x in done], calls.filter("wrong is not null").select("job_id", F.col("wrong").alias("error")).union(empty))
    names = sorted({r[0] for r in ready.select(F.explode(F.map_values(F.from_json("output_tables_json", "map<string,string>")))).distinct().collect()})  # result tables
    rows = reduce(DataFrame.unionByName, [x[1] for x in done]).join(calls.select("job_id", "api_id", "key_params"), "job_id") if done else None
    for name in names:
        found, at = rows.filter(F.col("table") == name), f"{work}/rows/{name}"
        # In order of job, selector, page and place, dealt over files by ranges of these, so one large job fills several files.
        ranged = lambda found=found, name=name: table_rows(found, tables.schemas[name]).repartitionByRange("run_job_id", "run_selector", "run_page", "run_pos").sortWithinPartitions("run_job_id", "run_selector", "run_page", "run_pos")
        bad = once(tables, at, ranged).groupBy(F.col("run_job_id").alias("job_id")).agg(F.sum("bad").alias("n")).filter("n > 0")
        failed = failed.union(bad.select("job_id", F.concat(F.col("n").cast("string"), F.lit(f" values of {name} can't be read"))))
    failed = failed.groupBy("job_id").agg(F.array_join(F.array_sort(F.collect_set("error")), "; ").alias("error"))

    routes = ready.select("job_id", F.explode(F.from_json("output_tables_json", "map<string,string>")).alias("selector", "table"))
    found = rows.groupBy("job_id", "selector").agg(F.count("*").alias("n")) if done else empty.select("job_id", F.col("error").alias("selector"), F.lit(0).alias("n"))
    counts = routes.join(found, ["job_id", "selector"], "left").groupBy("job_id", "table").agg(F.sum(F.coalesce("n", F.lit(0))).alias("n"))
    tables_of = routes.groupBy("job_id").agg(F.collect_set("table").alias("tables"))
    outcome = calls.select("job_id", "save_mode", "repeated").join(failed, "job_id", "left").join(save.counts_text(counts), "job_id", "left").join(tables_of, "job_id", "left")
    outcome = once(tables, f"{work}/outcome", lambda: outcome)
    at = now.astimezone(UTC).replace(tzinfo=None).isoformat(sep=" ")
    logs = once(tables, f"{work}/log", lambda: log_rows(outcome.select("job_id", "error"), at))
    for attempt in range(TRIES):
        try:
            with tables.change() as c:
                _save(c, outcome, names, work)
                if not logs.isEmpty():
                    c.append("api_job_log", numbered(tables, "api_job_log", f"{work}/log"))
            break
        except Conflict:
            if attempt == TRIES - 1:
                raise
    for part in ("wave0", "wave1", "rows", "calls", "log"):
        tables.delete_files(f"{work}/{part}")
    return outcome.select("job_id", "error", F.when(F.col("error").isNull(), F.coalesce("description", F.lit(""))).alias("description"))


def _save(c: Change, outcome: DataFrame, names: list[str], work: str) -> None:
    """Put the rows of the jobs that went well into the result tables, and their state into the job table."""
    tables, good = c.tables, outcome.filter("error is null")
    for name in names:
        rows = numbered(tables, name, f"{work}/rows/{name}").join(good.select(F.col("job_id").alias("run_job_id")), "run_job_id", "left_semi").withColumn("updated_at", F.current_timestamp().cast("timestamp_ntz"))
        over = good.filter((F.col("save_mode") == "overwrite") & F.array_contains("tables", name)).select("job_id")
        if over.isEmpty():
            c.append(name, rows)
        else:
            c.replace_keys(name, rows, over)
    done = good.select("job_id", F.coalesce("description", F.lit("")).alias("_said"), (~F.col("repeated")).alias("_over"))
    if not done.isEmpty():
        state = {"description": F.coalesce("_said", "description"), "is_active": F.col("is_active") & ~F.coalesce("_over", F.lit(False))}
        c.update_keys("api_job", done, lambda rows: rows.withColumns(state))


def said(outcome: DataFrame) -> dict[str, str | None]:
    """Each job's description, null if it failed, on the driver: for cycles of a size to look at."""
    return {r.job_id: r.description for r in outcome.collect()}


def cycle(tables: Tables, name: str, now: datetime, **how) -> DataFrame:
    """Run the pending jobs of a cycle. A one-shot job that failed stays active and is run again by the next call."""
    return run(tables, job_ops.pending(tables.read("api_job"), name), now, **how)


def job(tables: Tables, job_id: str, now: datetime, **how) -> DataFrame:
    """Run one job, in whatever state."""
    rows = tables.read("api_job", [job_id])
    if rows.isEmpty():
        raise ValueError(f"no such job: {job_id}")
    return run(tables, rows, now, **how)
