"""Queries of the ingestion and analytics engine over the driver's tables, with their SQL."""

from __future__ import annotations

import json
import re
from collections.abc import Callable
from datetime import date, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemill.functions import template, timefn
from tidemill.operators import browse, jobs, parse, save
from tidemill.plans import export, generate, land, run
from tidemill.sources import http, tables

Query = Callable[[SparkSession, str], DataFrame]
_QUERIES: dict[str, tuple[Query, str]] = {}


def _query(name: str, sql: str) -> Callable[[Query], Query]:
    def add(f: Query) -> Query:
        _QUERIES[name] = (f, sql)
        return f

    return add


def _t(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


_FLOORS = {
    "floor_5m": ("5m", "date_trunc('minute', ts) - to_minutes(CAST(minute(ts) % 5 AS INTEGER))"),
    "floor_7m": ("7m", "date_trunc('minute', ts) - to_minutes(CAST(minute(ts) % 7 AS INTEGER))"),
    "floor_4h": ("4h", "date_trunc('hour', ts) - to_hours(CAST(hour(ts) % 4 AS INTEGER))"),
    "floor_3d": ("3d", "CAST(CAST(ts AS DATE) - CAST((CAST(ts AS DATE) - DATE '1970-01-01') % 3 AS INTEGER) AS TIMESTAMP)"),
    "floor_2w": ("2w", "CAST(CAST(ts AS DATE) - CAST((CAST(ts AS DATE) - DATE '1970-01-05') % 14 AS INTEGER) AS TIMESTAMP)"),
}
for _name, (_cycle, _sql) in _FLOORS.items():

    @_query(_name, f"SELECT {_sql} AS slot, count(*) AS n FROM events GROUP BY 1")
    def _floor(spark: SparkSession, sf_dir: str, cycle: str = _cycle) -> DataFrame:
        return _t(spark, sf_dir, "events").groupBy(timefn.floor_to(F.col("ts"), cycle).alias("slot")).agg(F.count("*").alias("n"))


@_query(
    "event_feed",
    """SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k, date_trunc('minute', ts) - to_minutes(CAST(minute(ts) % 5 AS INTEGER)) AS slot
    FROM events ORDER BY event_id DESC LIMIT 100""",
)
def _feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _t(spark, sf_dir, "events").select("event_id", parse.json_scalar(F.col("props"), "k", "bigint").alias("k"), timefn.floor_to(F.col("ts"), "5m").alias("slot"))
    return save.page(rows, "event_id", 100)


@_query(
    "date_macros",
    """SELECT o_orderkey, strftime(d, '%Y%m%d') AS today, strftime(d - 1, '%Y%m%d') AS yesterday, strftime(d - INTERVAL 1 MONTH, '%Y%m%d') AS last_month,
    strftime(date_trunc('month', d) - INTERVAL 1 DAY, '%Y%m%d') AS last_eom, strftime(d - INTERVAL 1 MONTH, '%Y%m') AS last_yymm,
    strftime(d - CASE isodow(d) WHEN 1 THEN 3 WHEN 7 THEN 2 ELSE 1 END, '%Y%m%d') AS last_bday FROM (SELECT o_orderkey, CAST(o_orderdate AS DATE) AS d FROM orders)""",
)
def _macros(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = F.to_date("o_orderdate")
    return _t(spark, sf_dir, "orders").select("o_orderkey", *(timefn.macro(k, d).alias(k) for k in ("today", "yesterday", "last_month", "last_eom", "last_yymm", "last_bday")))


@_query("capture_stamp", "SELECT event_id, strftime(date_trunc('minute', ts) - to_minutes(CAST(minute(ts) % 15 AS INTEGER)), '%Y%m%d%H%M%S') AS trade_at FROM events")
def _stamp(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _t(spark, sf_dir, "events").select("event_id", timefn.stamp(F.col("ts"), "15m").alias("trade_at"))


@_query("axes_product", "SELECT n_name AS nation, n_nationkey AS code, r_name AS region, '20240229' AS day, 'x' AS kind FROM nation, region")
def _axes(spark: SparkSession, sf_dir: str) -> DataFrame:
    for name in ("nation", "region"):
        _t(spark, sf_dir, name).createOrReplaceTempView(f"axis_{name}")
    spec = {"nation, code": {"db": "SELECT n_name, n_nationkey FROM axis_nation"}, "region": {"db": "SELECT r_name FROM axis_region"}, "day": {"date": "last_month"}, "kind": "x"}
    return jobs.product(spark, jobs.axes(spark, spec, date(2024, 3, 31)))


@_query("params_json", "SELECT n_nationkey, CAST(json_object('name', n_name, 'region', n_regionkey) AS VARCHAR) AS params FROM nation")
def _params(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _t(spark, sf_dir, "nation").select("n_nationkey", F.col("n_name").alias("name"), F.col("n_regionkey").alias("region")).select("n_nationkey", jobs.params_json(["region", "name"]).alias("params"))


@_query("job_id", "SELECT doc_id, CASE WHEN length('api_' || text) > 150 THEN left('api_' || left(sha256(text), 16), 150) ELSE 'api_' || text END AS job_id FROM documents")
def _job_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _t(spark, sf_dir, "documents").select("doc_id", jobs.job_id(F.lit("api"), [F.col("text")]).alias("job_id"))


@_query("job_conflicts", "SELECT 'li_' || l_orderkey AS job_id, count(DISTINCT l_linenumber) AS n_params FROM lineitem GROUP BY 1 HAVING count(DISTINCT l_linenumber) > 1")
def _conflicts(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _t(spark, sf_dir, "lineitem")
    return jobs.conflicts(rows.select(jobs.job_id(F.lit("li"), [F.col("l_orderkey")]).alias("job_id"), F.col("l_linenumber").cast("string").alias("params_json")))


@_query("new_jobs", "SELECT 'c_' || c_custkey AS job_id FROM customer WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND year(o_orderdate) = 1995)")
def _new_jobs(spark: SparkSession, sf_dir: str) -> DataFrame:
    def made(df: DataFrame, key: str) -> DataFrame:
        return df.select(jobs.job_id(F.lit("c"), [F.col(key)]).alias("job_id"), F.lit("{}").alias("params_json"))

    old = made(_t(spark, sf_dir, "orders").filter(F.year("o_orderdate") == 1995), "o_custkey")
    return jobs.new_jobs(made(_t(spark, sf_dir, "customer"), "c_custkey"), old).select("job_id")


@_query("template_url", "SELECT event_id, '/u/' || user_id || '?t=' || event_type || '&x=:USER2' AS url FROM events")
def _url(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = template.substitute(F.lit("/u/:USER?t=:TYPE&x=:USER2"), {"USER": F.col("user_id"), "TYPE": F.col("event_type")})
    return _t(spark, sf_dir, "events").select("event_id", made.alias("url"))


@_query("json_scalar", "SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events")
def _scalar(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _t(spark, sf_dir, "events").select("event_id", parse.json_scalar(F.col("props"), "k", "bigint").alias("k"))


@_query("json_records", "SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn, role, text) - 1 AS pos, turn, role, text FROM conversations")
def _records(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = F.transform(F.array_sort(F.collect_list(F.struct("turn", "role", "text"))), lambda x: x)
    bodies = _t(spark, sf_dir, "conversations").groupBy("conv_id").agg(F.to_json(F.struct(F.struct(turns.alias("items")).alias("data"))).alias("body"))
    rows = parse.json_records(bodies, "body", "data.items")
    return rows.select("conv_id", F.col("pos").cast("long"), F.from_json("record", "turn bigint, role string, text string").alias("r")).select("conv_id", "pos", "r.*")


@_query("merge_fields", "SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k, event_type AS kind FROM events")
def _merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _t(spark, sf_dir, "events").select("event_id", parse.merge_field(F.col("props"), "kind", F.col("event_type")).alias("record"))
    return rows.select("event_id", F.from_json("record", "k string, kind string").alias("r")).select("event_id", F.col("r.k").cast("long").alias("k"), "r.kind")


@_query("merged_answers", "SELECT conv_id, turn, role, conv_id AS text, count(*) OVER (PARTITION BY conv_id) AS n, NULL AS none FROM conversations")
def _merged(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Values of the whole answer set in each record, in the form that configurations have: selector, path, field. One takes the place of the record's own."""
    turns = F.collect_list(F.struct("turn", "role", "text"))
    bodies = _t(spark, sf_dir, "conversations").groupBy("conv_id").agg(F.to_json(F.struct(F.struct(turns.alias("items")).alias("data"), F.struct(F.count("*").alias("n"), F.col("conv_id").alias("id")).alias("top"))).alias("body"))
    merges = F.from_json(F.lit('{"top.n": "n", "top.id": "text", "top.missing": "none"}'), "map<string,string>")
    rows = bodies.withColumn("document", F.try_parse_json("body"))
    rows = rows.select("conv_id", F.explode(parse.merge_fields(parse.json_items(F.col("document"), "data.items"), F.col("document"), merges)).alias("record"))
    return rows.select("conv_id", F.from_json("record", "turn bigint, role string, text bigint, n bigint, none int").alias("r")).select("conv_id", "r.*")


@_query("xml_records", "SELECT n_nationkey AS k, n_name AS name, CAST(n_regionkey AS VARCHAR) AS region FROM nation")
def _xml(spark: SparkSession, sf_dir: str) -> DataFrame:
    body = F.concat(F.lit("<r><item><NAME value='"), "n_name", F.lit("'/><REGION>"), F.col("n_regionkey").cast("string"), F.lit("</REGION></item></r>"))
    rows = _t(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("k"), body.alias("body"), F.lit("item").alias("selector"))
    return parse.xml_records(rows, "body", "selector", ["k"]).select("k", F.get_json_object("record", "$.NAME").alias("name"), F.get_json_object("record", "$.REGION").alias("region"))


@_query(
    "xml_shapes",
    """SELECT s_nationkey AS k, row_number() OVER (PARTITION BY s_nationkey ORDER BY s_suppkey) - 1 AS pos, CASE s_suppkey % 4
    WHEN 0 THEN '{"A":"' || s_suppkey || '","T":["1","' || s_suppkey || '"]}' WHEN 1 THEN '{"N":{"K":"' || s_suppkey || '","M":null}}'
    WHEN 2 THEN '{"A":{"p":"' || s_suppkey || '","q":"x"}}' ELSE '{"a":"' || s_suppkey || '","b":"' || s_name || '"}' END AS record, CAST(NULL AS VARCHAR) AS error FROM supplier
    UNION ALL SELECT s_nationkey, count(*), NULL, 'broken' FROM supplier WHERE s_nationkey % 3 = 0 GROUP BY 1""",
)
def _xml_shapes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Repeated, nested and attribute children, leaves, and bodies that break off: a body for each nation."""
    k = F.col("s_suppkey").cast("string")
    item = F.concat(
        F.when(F.col("s_suppkey") % 4 == 0, F.concat(F.lit("<i><T>1</T><A value='"), k, F.lit("' other='o'/><T>"), k, F.lit("</T></i>"))).when(F.col("s_suppkey") % 4 == 1, F.concat(F.lit("<i><N><K z='"), k, F.lit("'/><M> </M></N></i>")))
        .when(F.col("s_suppkey") % 4 == 2, F.concat(F.lit("<i><A p='"), k, F.lit("' q='x'/></i>"))).otherwise(F.concat(F.lit("<i a='"), k, F.lit("' b='"), "s_name", F.lit("'/>")))
    )
    bodies = _t(spark, sf_dir, "supplier").groupBy("s_nationkey").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("s_suppkey", item.alias("x")))), lambda x: x["x"]), "").alias("items"))
    end = F.when(F.col("s_nationkey") % 3 == 0, "</d><unclosed").otherwise("</d></r>")
    bodies = bodies.select(F.col("s_nationkey").alias("k"), F.concat(F.lit("<r><d>"), "items", end).alias("body"), F.lit("d.i").alias("selector"))
    rows = parse.xml_records(bodies, "body", "selector", ["k"])
    return rows.select("k", F.col("pos").cast("long"), "record", F.when(F.col("error").isNotNull(), "broken").alias("error"))


@_query(
    "decoded_bodies",
    """SELECT doc_id, CASE WHEN doc_id % 5 <> 0 THEN text END AS text, doc_id % 5 = 0 AS failed, CASE WHEN doc_id % 5 <> 0 THEN coalesce(length(text), 0) END AS n FROM documents WHERE text IS NOT NULL""",
)
def _decoded(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bytes of whole texts in two encodings, some with a byte that belongs to neither: an error beside the row, none for the query."""
    body = F.col("text").cast("binary")
    wrong = F.when(F.col("doc_id") % 5 == 0, F.lit(b"\xff\xff")).otherwise(F.lit(b""))
    rows = _t(spark, sf_dir, "documents").filter("text is not null").select("doc_id", F.concat(body, wrong).alias("body"), F.when(F.col("doc_id") % 2 == 0, "UTF_8").otherwise("utf-8-sig").alias("encoding"))
    rows = rows.select("doc_id", parse.decode(F.col("body"), F.col("encoding")).alias("read"))
    return rows.select("doc_id", F.col("read.value").alias("text"), F.col("read.error").isNotNull().alias("failed"), F.char_length("read.value").cast("long").alias("n"))


@_query(
    "delimited_headers",
    r"""SELECT doc_id, pos, CASE doc_id % 3 WHEN 0 THEN '{"a":"3","b":"' || pos || '"}' WHEN 1 THEN '{"a":"1","":"' || pos || '"}' END AS record, CASE WHEN doc_id % 3 = 2 THEN 'a delimited body needs field names' END AS error
    FROM (SELECT doc_id, unnest(CASE WHEN doc_id % 3 = 2 THEN [NULL] ELSE range(1 + doc_id % 4) END) AS pos FROM documents)""",
)
def _headers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Headers that repeat a name, have an empty one, or are missing."""
    n = F.col("doc_id") % 4
    lines = F.transform(F.sequence(F.lit(0), n.cast("int")), lambda i: F.when(F.col("doc_id") % 3 == 0, F.concat(F.lit("1,"), i, F.lit(",3"))).otherwise(F.concat(F.lit("1,"), i)))
    body = F.when(F.col("doc_id") % 3 == 2, F.lit("\n\n")).otherwise(F.concat(F.when(F.col("doc_id") % 3 == 0, "a,b,a\n").otherwise("a, \n"), F.array_join(lines, "\r\n")))
    rows = _t(spark, sf_dir, "documents").select("doc_id", body.alias("body"))
    rows = rows.select("doc_id", parse.delimited_error(F.col("body"), header=True).alias("error"), F.transform(parse.delimited_records(F.col("body"), header=True), lambda r: F.to_json(F.struct(r["a"].alias("a"), F.when(F.map_contains_key(r, "b"), r["b"]).alias("b"), r[""].alias("_")))).alias("records"))
    rows = rows.select("doc_id", "error", F.posexplode_outer("records").alias("pos", "record"))
    return rows.select("doc_id", F.col("pos").cast("long"), F.replace("record", F.lit('"_"'), F.lit('""')).alias("record"), "error")


@_query("delimited_records", r"SELECT doc_id, nullif(regexp_replace(regexp_replace(text, '^\s+', ''), '\s+$', ''), '') AS text, source FROM documents WHERE text IS NOT NULL")
def _delimited(spark: SparkSession, sf_dir: str) -> DataFrame:
    body = F.concat(F.lit('"'), F.replace("text", F.lit('"'), F.lit('""')), F.lit('"|'), F.coalesce("source", F.lit("")), F.lit("|extra"))
    rows = _t(spark, sf_dir, "documents").filter("text is not null").select("doc_id", F.explode(parse.delimited_records(body, ["text", "source"], "|")).alias("r"))
    return rows.select("doc_id", F.col("r")["text"].alias("text"), F.col("r")["source"].alias("source"))


_FORMS = "CASE event_id % 9 WHEN 0 THEN ' ' || k || ' ' WHEN 1 THEN k || '.0' WHEN 2 THEN k || '.5' WHEN 3 THEN '1_' || k WHEN 4 THEN '1,' || k WHEN 5 THEN '' WHEN 6 THEN NULL WHEN 7 THEN 'x' || k ELSE '-1' || k END"


@_query(
    "typed_coercion",
    """SELECT event_id, CASE event_id % 9 WHEN 0 THEN k WHEN 1 THEN k WHEN 3 THEN CAST('1' || k AS BIGINT) WHEN 8 THEN -CAST('1' || k AS BIGINT) END AS n,
    CASE event_id % 9 WHEN 0 THEN k WHEN 1 THEN k WHEN 2 THEN k + 0.5 WHEN 3 THEN CAST('1' || k AS DOUBLE) WHEN 8 THEN -CAST('1' || k AS DOUBLE) END AS x,
    CASE WHEN event_id % 9 <> 6 AND length(CAST(k AS VARCHAR)) + CASE event_id % 9 WHEN 7 THEN 1 WHEN 5 THEN -length(CAST(k AS VARCHAR)) ELSE 2 END <= 3 THEN form END AS t,
    (event_id % 9 IN (2, 4, 5, 7))::INT + (event_id % 9 IN (4, 5, 7))::INT + (length(form) > 3)::INT AS bad
    FROM (SELECT event_id, k, """
    + _FORMS
    + """ AS form FROM (SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events)) WHERE form IS NOT NULL
    UNION ALL SELECT event_id, NULL, NULL, NULL, 0 FROM events WHERE event_id % 9 = 6""",
)
def _typed(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _t(spark, sf_dir, "events").select("event_id", parse.json_scalar(F.col("props"), "k").alias("k")).select("event_id", F.expr(_FORMS).alias("form"))
    schema = T.StructType([T.StructField("n", T.LongType()), T.StructField("x", T.DoubleType()), T.StructField("t", T.StringType(), True, {"length": 3})])
    return save.typed(rows.select("event_id", *(F.col("form").alias(f.name) for f in schema)), schema)


_JSON_FORMS = "CASE event_id % 8 WHEN 0 THEN k WHEN 1 THEN k || '.0' WHEN 2 THEN k || '.5' WHEN 3 THEN '\"' || k || '\"' WHEN 4 THEN 'true' WHEN 5 THEN 'null' WHEN 6 THEN '[' || k || ']' ELSE '\"x\"' END"


@_query(
    "typed_json",
    """SELECT event_id, 'ev' AS api_id, 'ev_' || event_id AS job_id, CASE WHEN event_id % 8 IN (0, 1, 3) THEN k WHEN event_id % 8 = 4 THEN 1 END AS n,
    CASE WHEN event_id % 8 IN (0, 1, 3) THEN k WHEN event_id % 8 = 2 THEN k + 0.5 WHEN event_id % 8 = 4 THEN 1 END AS x, CASE event_id % 8 WHEN 3 THEN CAST(k AS VARCHAR) WHEN 7 THEN 'x' END AS t, event_type AS kind,
    (event_id % 8 IN (2, 6, 7))::INT + (event_id % 8 IN (6, 7))::INT + (event_id % 8 IN (0, 1, 2, 4, 6))::INT AS bad FROM (SELECT event_id, event_type, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events)""",
)
def _typed_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _t(spark, sf_dir, "events").select("event_id", "event_type", parse.json_scalar(F.col("props"), "k").alias("k")).select("event_id", "event_type", F.expr(_JSON_FORMS).alias("form"))
    record = F.concat(*(x for name in ("n", "x", "t") for x in (F.lit(f'{"{" if name == "n" else ","}"{name}":'), F.col("form"))), F.lit(',"unknown":1}'))
    rows = rows.select("event_id", F.lit("ev").alias("api_id"), jobs.job_id(F.lit("ev"), [F.col("event_id")]).alias("job_id"), F.to_json(F.struct(F.col("event_type").alias("kind"))).alias("key_params"), record.alias("record"))
    schema = T.StructType([T.StructField("api_id", T.StringType()), T.StructField("job_id", T.StringType()), T.StructField("n", T.LongType()), T.StructField("x", T.DoubleType()), T.StructField("t", T.StringType()), T.StructField("kind", T.StringType())])
    return save.typed_records(rows, schema, ["event_id"]).withColumnRenamed("run_event_id", "event_id")


@_query("generic_rows", "SELECT 'ev' AS api_id, 'ev_' || event_id AS job_id, CAST(json_object('user_id', user_id) AS VARCHAR) AS key_params_json, CAST(json_object('event_type', event_type, 'props', props) AS VARCHAR) AS result_json FROM events")
def _generic(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _t(spark, sf_dir, "events").withColumns({"api_id": F.lit("ev"), "job_id": jobs.job_id(F.lit("ev"), [F.col("event_id")])})
    return save.generic(rows, ["event_type", "props"], ["user_id"])


@_query(
    "page_merge",
    """WITH p AS (SELECT l_orderkey, l_linenumber AS page, min(l_returnflag) AS digest, count(*) AS n FROM lineitem GROUP BY 1, 2),
    q AS (SELECT *, lag(digest) OVER (PARTITION BY l_orderkey ORDER BY page) AS before FROM p),
    s AS (SELECT l_orderkey, min(page) AS stop FROM q WHERE n = 0 OR digest = before GROUP BY 1) SELECT l_orderkey, page, digest, n FROM p LEFT JOIN s USING (l_orderkey) WHERE stop IS NULL OR page < stop""",
)
def _pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _t(spark, sf_dir, "lineitem").groupBy("l_orderkey", F.col("l_linenumber").alias("page")).agg(F.min("l_returnflag").alias("digest"), F.count("*").alias("n"))
    return parse.merge_pages(rows, ["l_orderkey"])


@_query("save_overwrite", "SELECT 'o_' || o_custkey AS job_id, o_orderkey, CASE WHEN o_orderstatus = 'F' THEN -o_totalprice ELSE o_totalprice END AS price FROM orders WHERE o_custkey % 10 <> 3 OR o_orderstatus = 'F'")
def _overwrite(spark: SparkSession, sf_dir: str) -> DataFrame:
    price = F.when(F.col("o_orderstatus") == "F", -F.col("o_totalprice")).otherwise(F.col("o_totalprice"))
    old = _t(spark, sf_dir, "orders").withColumn("job_id", jobs.job_id(F.lit("o"), [F.col("o_custkey")])).withColumn("price", price)
    again = old.filter("o_custkey % 10 = 3")
    return save.overwrite(old.select("job_id", "o_orderkey", "price"), again.filter("o_orderstatus = 'F'").select("job_id", "o_orderkey", "price"), again)


@_query(
    "count_by_table",
    """SELECT job_id, string_agg(t || ': ' || n, ', ' ORDER BY t) AS description FROM (SELECT 'u_' || user_id AS job_id, CASE event_type WHEN 'click' THEN 'clicks' ELSE 'others' END AS t, count(*) AS n
    FROM events GROUP BY 1, 2) GROUP BY 1""",
)
def _counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _t(spark, sf_dir, "events").select(jobs.job_id(F.lit("u"), [F.col("user_id")]).alias("job_id"), F.when(F.col("event_type") == "click", "a").otherwise("b").alias("selector"))
    return save.counts_text(save.counts_by_table(rows, {"a": "clicks", "b": "others"}))


@_query("save_append", "SELECT o_orderkey, o_totalprice AS price FROM orders WHERE o_orderstatus = 'F' UNION ALL SELECT o_orderkey, -o_totalprice FROM orders WHERE o_orderstatus <> 'O'")
def _append(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _t(spark, sf_dir, "orders")
    new = rows.filter("o_orderstatus != 'O'").select("o_orderkey", (-F.col("o_totalprice")).alias("price"))
    return save.append(rows.filter("o_orderstatus = 'F'").select("o_orderkey", F.col("o_totalprice").alias("price")), new)


@_query("csv_restore", "SELECT c_custkey, nullif(CASE WHEN c_custkey % 3 = 0 THEN '' ELSE c_name END, '') AS c_name, CASE WHEN c_custkey % 5 <> 0 THEN c_acctbal END AS c_acctbal FROM customer")
def _restore(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _t(spark, sf_dir, "customer").select(
        F.col("c_custkey").cast("string"), F.when(F.col("c_custkey") % 3 == 0, "").otherwise(F.col("c_name")).alias("c_name"), F.when(F.col("c_custkey") % 5 == 0, "").otherwise(F.col("c_acctbal").cast("string")).alias("c_acctbal")
    )
    return save.restore(rows, T.StructType([T.StructField("c_custkey", T.LongType()), T.StructField("c_name", T.StringType()), T.StructField("c_acctbal", T.DoubleType())]))


@_query("result_page", "SELECT * FROM orders ORDER BY o_orderkey DESC LIMIT 100 OFFSET 50")
def _page(spark: SparkSession, sf_dir: str) -> DataFrame:
    return save.page(_t(spark, sf_dir, "orders"), "o_orderkey", 100, 50)


@_query("recent_logs", "SELECT event_id AS id, event_type AS status, ts AS executed_at FROM events WHERE event_type = 'click' ORDER BY ts DESC NULLS FIRST, event_id DESC LIMIT 100")
def _logs(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _t(spark, sf_dir, "events").select(F.col("event_id").alias("id"), F.col("event_type").alias("status"), F.col("ts").alias("executed_at"))
    return save.recent_logs(rows, "click")


@_query("result_by_id", "SELECT * FROM orders WHERE o_orderkey = (SELECT max(o_orderkey) FROM orders)")
def _by_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _t(spark, sf_dir, "orders")
    row = browse.by_key(rows, "o_orderkey", rows.agg(F.max("o_orderkey")).first()[0])
    return spark.createDataFrame([tuple(row[c] for c in rows.columns)], rows.schema)


@_query("job_logs", "SELECT event_id AS id, 'u_' || user_id AS job_id, event_type AS status, ts AS executed_at FROM events WHERE user_id = (SELECT min(user_id) FROM events) ORDER BY ts DESC, event_id DESC LIMIT 20 OFFSET 2")
def _job_logs(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _t(spark, sf_dir, "events")
    logs = rows.select(F.col("event_id").alias("id"), jobs.job_id(F.lit("u"), [F.col("user_id")]).alias("job_id"), F.col("event_type").alias("status"), F.col("ts").alias("executed_at"))
    return save.recent_logs(logs, limit=20, offset=2, job=f"u_{rows.agg(F.min('user_id')).first()[0]}")


@_query("pending_jobs", "SELECT event_id, event_type AS execution_cycle FROM events WHERE event_type = 'click' AND user_id % 2 = 0")
def _pending(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _t(spark, sf_dir, "events").select("event_id", F.col("event_type").alias("execution_cycle"), (F.col("user_id") % 2 == 0).alias("is_active"))
    return jobs.pending(rows, "click").drop("is_active")


@_query(
    "generated_jobs",
    """SELECT 'a_' || n_name || '_' || r_name AS job_id, 'b' AS build_id, 'a' AS api_id, '{"DAY":"20240229","NATION":"' || n_name || '","REGION":"' || r_name || '"}' AS params_json, true AS is_active,
    'overwrite' AS save_mode, 'daily' AS execution_cycle FROM nation, region WHERE NOT (n_name = (SELECT min(n_name) FROM nation))""",
)
def _generated(spark: SparkSession, sf_dir: str) -> DataFrame:
    for name in ("nation", "region"):
        _t(spark, sf_dir, name).createOrReplaceTempView(f"axis_{name}")
    spec = {"NATION": {"db": "SELECT n_name FROM axis_nation"}, "REGION": {"db": "SELECT r_name FROM axis_region"}, "DAY": {"date": "last_month"}}
    builder = {"build_id": "b", "api_id": "a", "macro_params_json": spec, "save_mode": None, "execution_cycle": "daily"}
    none = spark.createDataFrame([], "job_id string, params_json string")
    every = jobs.build(spark, builder, {"key_params_list": ["NATION", {"REGION": "region"}]}, none, date(2024, 3, 31))
    first = _t(spark, sf_dir, "nation").agg(F.min("n_name").alias("least"))
    old = every.join(first, F.get_json_object("params_json", "$.NATION") == F.col("least"), "left_semi")
    return jobs.build(spark, builder, {"key_params_list": ["NATION", {"REGION": "region"}]}, old, date(2024, 3, 31))


_ROWS = T.StructType([T.StructField("id", T.LongType()), T.StructField("api_id", T.StringType()), T.StructField("job_id", T.StringType()), T.StructField("name", T.StringType()), T.StructField("value", T.DoubleType()), T.StructField("updated_at", T.TimestampNTZType())])
_CYCLE_SQL = """SELECT 'n_' || s_name AS job_id, CASE WHEN s_suppkey % 7 > 2 THEN 'SUCCESS' ELSE 'FAILED' END AS status, s_suppkey % 7 <= 2 AS is_active, CASE WHEN s_suppkey % 7 > 2 THEN 'supplier_rows: ' || s_suppkey % 4 END AS description,
  CASE WHEN s_suppkey % 7 > 2 THEN s_suppkey % 4 ELSE 0 END AS n_rows, CASE WHEN s_suppkey % 7 > 2 AND s_suppkey % 4 > 0 THEN CAST((s_suppkey % 4) * s_suppkey AS DOUBLE) END AS total,
  CASE s_suppkey % 7 WHEN 0 THEN 'items: the answer is no JSON' WHEN 1 THEN '1 values of supplier_rows can''t be read' WHEN 2 THEN 'items: UnicodeDecodeError: the body is not UTF-8' END AS error FROM supplier"""


def _suppliers(spark: SparkSession, sf_dir: str) -> tables.Tables:
    """Tables with a job for each supplier, generated from a builder, of an API that names them."""
    store = tables.Tables(spark, tables.scratch(spark))
    store.register("supplier_rows", _ROWS)
    api = {"api_id": "n", "api_name": "n", "api_group": "g", "request_type": "get", "api_url": "http://x/:NAME", "header_json": {"Authorization": "Bearer ${TOKEN}"}, "output_tables_json": {"items": "supplier_rows"}, "key_params_list": ["NAME"]}
    login = {**api, "api_id": "login", "api_url": "http://x/login", "header_json": {}, "output_tables_json": None, "persist_env_json": {"auth.token": "TOKEN"}, "key_params_list": ["NOW"]}
    browse.Config(store, "api_mst").create(api, login)
    _t(spark, sf_dir, "supplier").createOrReplaceTempView("axis_supplier")
    builders = ({"build_id": "b", "api_id": "n", "macro_params_json": {"NAME, K": {"db": "SELECT s_name, s_suppkey FROM axis_supplier"}}, "is_active": True}, {"build_id": "l", "api_id": "login", "macro_params_json": {}, "is_active": True})
    browse.Config(store, "api_job_builder").create(*builders)
    generate.some(store, date(2024, 3, 31), "daily")
    return store


def _supplier_answers(request: dict) -> tuple[int, str, bytes]:
    """A server's answers, by the number in the supplier's name: some are no JSON, no UTF-8, or hold a value that can't be read. The name is that of the secret that was sent."""
    if request["url"].endswith("login"):
        return 200, "application/json", b'{"auth": {"token": "fresh"}}'
    k = int(re.sub("[^0-9]", "", request["url"]))
    value = "bad" if k % 7 == 1 else str(k)
    body = json.dumps({"items": [{"value": str(k), "name": request["headers"]["Authorization"]}] * (k % 4)}).encode() if k % 7 != 1 else json.dumps({"items": [{"value": value}]}).encode()
    return 200, "application/json", b"{broken" if k % 7 == 0 else body[:-1] + b"\xff" if k % 7 == 2 else body


@_query("run_cycle", _CYCLE_SQL)
def _cycle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A cycle over recorded answers: a job for each supplier. Answers that can't be read fail their own jobs."""
    store = _suppliers(spark, sf_dir)
    run.cycle(store, "daily", datetime(2024, 3, 31), send=_supplier_answers, wait=lambda _: None, store={}, every=0.0)
    rows = store.results("supplier_rows").groupBy("job_id").agg(F.count("*").alias("n_rows"), F.sum("value").alias("total"))
    jobs_now = store.read("api_job").filter("api_id = 'n'").select("job_id", "is_active", "description")
    logs = store.read("api_job_log").select("job_id", "status", F.col("error_message").alias("error"))
    return logs.join(jobs_now, "job_id").join(rows, "job_id", "left").withColumn("n_rows", F.coalesce("n_rows", F.lit(0)))


@_query("secret_waves", "SELECT 'n_' || s_name AS job_id, 'Bearer fresh' AS name, CAST(s_suppkey AS DOUBLE) AS value FROM supplier, range(3) r(i) WHERE s_suppkey % 7 > 2 AND i < s_suppkey % 4")
def _waves(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A secret that one job of a cycle keeps is in the headers of the others."""
    store = _suppliers(spark, sf_dir)
    run.cycle(store, "daily", datetime(2024, 3, 31), send=_supplier_answers, wait=lambda _: None, store={"TOKEN": "stale"}, every=0.0)
    return store.results("supplier_rows").select("job_id", "name", "value")


@_query(
    "landed_pages",
    """SELECT 's_' || s_suppkey AS job_id, i + 1 AS page, CAST(s_suppkey * 10 + i AS BIGINT) AS value FROM supplier, range(4) r(i) WHERE i < CASE WHEN s_suppkey % 6 = 5 THEN 2 ELSE s_suppkey % 6 END""",
)
def _landed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages of each job, asked for one after the other until one is empty or repeats the one before (for one job in six, the third)."""
    store = tables.Tables(spark, tables.scratch(spark))
    empty = {c: F.lit(None).cast("string") for c in land.CONFIGURED}
    config = empty | {"request_type": F.lit("get"), "api_url": F.lit("http://h:K/?k=:K&page=:PAGE"), "header_json": F.lit("{}"), "output_tables_json": F.lit('{"items": "x"}')}
    calls = _t(spark, sf_dir, "supplier").select(F.concat(F.lit("s_"), "s_suppkey").alias("job_id"), F.to_json(F.struct(F.col("s_suppkey").alias("K"))).alias("params"), *(c.alias(n) for n, c in config.items()))

    def send(request: dict) -> tuple[int, str, bytes]:
        k, page = map(int, re.search(r"k=(\d+)&page=(\d+)", request["url"]).groups())
        n, at = k % 6, page - 1
        return 200, "application/json", json.dumps({"items": [{"value": k * 10 + min(at, 1 if n == 5 else at)}] if at < n else []}).encode()

    calls = land.once(store, f"{store.root}/calls", lambda: calls)
    _, rows, _ = land.pages(store, calls, f"{store.root}/pages", lambda landed: run.records(landed, calls), send=send, wait=lambda _: None, every=0.0)
    return rows.select("job_id", F.col("page").cast("long"), F.get_json_object("record", "$.value").cast("long").alias("value"))


_REQUEST_SQL = """SELECT c_custkey, 'POST' AS method, 'http://x/' || c_mktsegment || '/:USER2?n=' || CASE WHEN c_custkey % 3 = 0 THEN 'None' ELSE c_custkey || '' END AS url, 'Bearer ${TOKEN} ' || c_mktsegment AS auth, '3' AS number, 'json' AS body_kind,
  '{"fixed":1,"N":' || CASE WHEN c_custkey % 3 = 0 THEN 'null' ELSE c_custkey || '' END || ',"USER":"' || c_mktsegment || '"}' AS body FROM customer"""


@_query("request_columns", _REQUEST_SQL)
def _requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The requests of a table of jobs: method, URL, headers and body are filled in by Spark, secrets are left for the sender."""
    user, n = F.col("c_mktsegment").alias("USER"), F.when(F.col("c_custkey") % 3 != 0, F.col("c_custkey")).alias("N")
    rows = _t(spark, sf_dir, "customer").select("c_custkey", F.to_json(F.struct(n, user), {"ignoreNullFields": "false"}).alias("params"))
    config = {"request_type": "post", "api_url": "http://x/:USER/:USER2?n=:N", "header_json": '{"auth": "Bearer ${TOKEN} :USER", "number": 3}', "payload_type": "json", "payload_json": '{"USER": "old", "fixed": 1}', "payload_xml": None}
    made = rows.withColumns({k: F.lit(v).cast("string") for k, v in config.items()})
    made = made.select("c_custkey", *(c.alias(k) for k, c in template.request(F.col("params")).items()))
    return made.select("c_custkey", "method", "url", F.col("headers")["auth"].alias("auth"), F.col("headers")["number"].alias("number"), "body_kind", "body")


@_query(
    "table_commits",
    """SELECT 'c_' || o_custkey AS job_id, CASE WHEN o_custkey % 10 = 3 THEN 'new' ELSE 'old' END AS state, o_orderkey AS k FROM orders WHERE o_custkey % 10 <> 3 OR o_orderstatus = 'F'
    UNION ALL SELECT 'c_' || o_custkey, 'more', o_orderkey FROM orders WHERE o_orderstatus = 'P'""",
)
def _commits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Results of a tenth of the jobs overwritten (some with nothing) in one commit, rows of others appended in the next, all small segments joined at last."""
    store = tables.Tables(spark, tables.scratch(spark))
    store.register("order_rows", T.StructType([T.StructField("api_id", T.StringType()), T.StructField("job_id", T.StringType()), T.StructField("state", T.StringType()), T.StructField("k", T.LongType())]))
    rows = lambda where, state: _t(spark, sf_dir, "orders").filter(where).select(F.lit("o").alias("api_id"), jobs.job_id(F.lit("c"), [F.col("o_custkey")]).alias("job_id"), F.lit(state).alias("state"), F.col("o_orderkey").alias("k"))
    store.append("order_rows", rows("true", "old"))
    with store.change() as c:
        c.replace_keys("order_rows", rows("o_custkey % 10 = 3 AND o_orderstatus = 'F'", "new"), rows("o_custkey % 10 = 3", "").select("job_id"))
    store.append("order_rows", rows("o_orderstatus = 'P'", "more"))
    store.compact("order_rows", 2)
    return store.results("order_rows").select("job_id", "state", "k")


@_query(
    "bucketed_jobs",
    "SELECT 'a_' || c_custkey AS job_id, c_custkey % 2 = 0 AS is_active FROM customer",
)
def _bucketed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Jobs of two builders of which the second names all of the first's again; of the stored jobs only the buckets of the new ids are read."""
    store = tables.Tables(spark, tables.scratch(spark))
    _t(spark, sf_dir, "customer").createOrReplaceTempView("axis_customer")
    browse.Config(store, "api_mst").create({"api_id": "a", "api_name": "a", "api_group": "g", "request_type": "get", "api_url": "http://x", "header_json": {}, "output_tables_json": {"i": "api_rst"}, "key_params_list": ["K"]})
    spec = lambda where: {"K": {"db": f"SELECT c_custkey FROM axis_customer WHERE {where}"}}
    browse.Config(store, "api_job_builder").create({"build_id": "even", "api_id": "a", "macro_params_json": spec("c_custkey % 2 = 0")}, {"build_id": "all", "api_id": "a", "macro_params_json": spec("true")})
    generate.one(store, "even", date(2024, 3, 31))
    generate.one(store, "all", date(2024, 3, 31))
    return store.read("api_job").select("job_id", (F.col("build_id") == "even").alias("is_active"))


@_query("export_roundtrip", "SELECT 'u_' || user_id AS job_id, event_id, ts, value, CAST(NULL AS DOUBLE) AS nothing FROM events WHERE user_id % 5 <> 1 OR event_type = 'click'")
def _export(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An export by job, then a second one of some jobs in place of what they had."""
    at = tables.scratch(spark)
    rows = _t(spark, sf_dir, "events").select(jobs.job_id(F.lit("u"), [F.col("user_id")]).alias("job_id"), "event_id", "ts", "value", F.lit(None).cast("double").alias("nothing"), "event_type", "user_id")
    names = ("job_id", "event_id", "ts", "value", "nothing")
    export.export(rows.select(*names), at)
    export.export(rows.filter("user_id % 5 = 1 AND event_type = 'click'").select(*names), at)
    idle = rows.filter("user_id % 5 = 1").groupBy("job_id").agg(F.max(F.col("event_type") == "click").alias("any")).filter("not any").select("job_id")
    return spark.read.parquet(at).select(*names).join(idle, "job_id", "left_anti")


@_query("result_page_after", "SELECT * FROM orders WHERE o_orderkey < (SELECT o_orderkey FROM orders ORDER BY 1 DESC LIMIT 1 OFFSET 1000) ORDER BY o_orderkey DESC LIMIT 100")
def _page_after(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A deep page by the key of the row ahead of it: files of newer keys are skipped."""
    rows = _t(spark, sf_dir, "orders")
    last = [r[0] for r in rows.select("o_orderkey").orderBy(F.desc("o_orderkey")).offset(1000).limit(1).collect()]
    return save.page_after(rows, "o_orderkey", last[0], 100) if last else rows.limit(0)


@_query("tick_5m_window", "SELECT event_id, isodow(ts) < 6 AND strftime(ts, '%H:%M') BETWEEN '08:40' AND '16:45' AND minute(ts) % 5 = 0 AND second(ts) = 0 AS fires FROM events")
def _tick(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _t(spark, sf_dir, "events").select("event_id", timefn.on_tick(F.col("ts"), "08:40", "16:45", 5).alias("fires"))


_SCHEDULES = {"hourly": ("09:00", "16:00", 60), "daily_start": ("08:35", "08:35", 5), "daily_end": ("18:00", "18:00", 60), "finalize": ("18:10", "18:10", 10)}


@_query(
    "tick_schedules",
    "SELECT event_id, "
    + ", ".join(f"isodow(ts) < 6 AND strftime(ts, '%H:%M') BETWEEN '{a}' AND '{b}' AND minute(ts) % {n} = 0 AS {k}" for k, (a, b, n) in _SCHEDULES.items())
    + " FROM (SELECT event_id, date_trunc('minute', ts) AS ts FROM events)",
)
def _ticks(spark: SparkSession, sf_dir: str) -> DataFrame:
    at = F.date_trunc("minute", "ts").cast("timestamp_ntz")
    return _t(spark, sf_dir, "events").select("event_id", *(timefn.on_tick(at, *x).alias(k) for k, x in _SCHEDULES.items()))


@_query(
    "dict_overlay",
    """SELECT n_nationkey, CAST(json_object('a', 'fixed', 'name', n_name, 'region', n_regionkey) AS VARCHAR) AS body FROM nation""",
)
def _overlay(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A body of fields: the payload's, overlaid by a job's parameters."""
    params = _t(spark, sf_dir, "nation").select("n_nationkey", F.col("n_name").alias("name"), F.col("n_regionkey").alias("region"))
    return params.select("n_nationkey", template.overlay(F.lit('{"a":"fixed","name":"old"}'), jobs.params_json(["name", "region"])).alias("body"))


def queries() -> dict[str, Query]:
    return {name: f for name, (f, _) in _QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    return {name: sql for name, (_, sql) in _QUERIES.items()}
