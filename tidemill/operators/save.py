"""Typed rows, generic rows and saving."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

_INTEGER = r"^\s*[+-]?\d+(?:_\d+)*(?:\.0*)?\s*$"
_FLOAT = r"(?i)^\s*[+-]?(?:(?:\d+(?:_\d+)*\.?(?:\d+(?:_\d+)*)?|\.\d+(?:_\d+)*)(?:e[+-]?\d+)?|nan|inf(?:inity)?)\s*$"
# The texts that count as true and false.
_TRUE, _FALSE = ("1", "true", "t", "yes", "y", "on"), ("0", "false", "f", "no", "n", "off")


def _from_text(text: Column, kind: T.DataType, length: int | None) -> Column:
    """A lenient reading of a text; null if it can't be read."""
    bare = F.trim(text)
    if isinstance(kind, T.LongType):
        return F.when(text.rlike(_INTEGER), F.regexp_replace(bare, r"_|\.0*$", "").try_cast("bigint"))
    if isinstance(kind, T.DoubleType):
        return F.when(text.rlike(_FLOAT), F.replace(bare, F.lit("_"), F.lit("")).try_cast("double"))
    if isinstance(kind, T.BooleanType):
        return F.when(F.lower(bare).isin(*_TRUE), True).when(F.lower(bare).isin(*_FALSE), False)
    if isinstance(kind, T.DateType):
        return F.when(text.rlike(r"^\d{4}-\d{2}-\d{2}$"), text.try_cast("date"))
    if isinstance(kind, (T.TimestampNTZType, T.TimestampType)):
        return F.when(text.rlike(r"^\d{4}-\d{2}-\d{2}([T ].*)?$"), text.try_cast(kind))
    if isinstance(kind, T.StringType):
        return F.when(F.lit(length is None) | (F.char_length(text) <= F.lit(length)), text)
    raise ValueError(f"no column of this type can be read: {kind.simpleString()}")


def coerce(value: Column, kind: T.DataType | str, length: int | None = None) -> Column:
    """A lenient cast of text: (value, bad). Integers may end in zeros after the point, numbers hold single underscores between digits; text has a greatest length."""
    kind = T._parse_datatype_string(kind) if isinstance(kind, str) else kind
    made = _from_text(value, kind, length)
    return F.struct(made.alias("value"), (value.isNotNull() & made.isNull()).alias("bad"))


def coerce_variant(value: Column, kind: T.DataType, length: int | None = None, nullable: bool = True, own: Column | None = None) -> Column:
    """The same for a JSON value, by its own type: (value, bad). Numbers are no text, a fraction is no integer, true and false are 1 and 0.

    ``own`` is the value's type where it is known already (a column that Spark has worked out).
    """
    own = F.schema_of_variant(value) if own is None else own
    number = own.isin("BIGINT", "DOUBLE", "FLOAT") | own.startswith("DECIMAL")
    real = F.try_variant_get(value, "$", "double")
    made = F.when(own == "STRING", _from_text(F.try_variant_get(value, "$", "string"), kind, length))
    if isinstance(kind, T.LongType):
        made = made.when(own == "BIGINT", F.try_variant_get(value, "$", "bigint")).when(number & (real == F.floor(real)), real.try_cast("bigint")).when(own == "BOOLEAN", F.try_variant_get(value, "$", "boolean").cast("bigint"))
    elif isinstance(kind, T.DoubleType):
        made = made.when(number, real).when(own == "BOOLEAN", F.try_variant_get(value, "$", "boolean").cast("int").cast("double"))
    elif isinstance(kind, T.BooleanType):
        made = made.when(own == "BOOLEAN", F.try_variant_get(value, "$", "boolean")).when(number & real.isin(0.0, 1.0), real == 1.0)
    empty = value.isNull() | F.coalesce(own == "VOID", F.lit(False))
    return F.struct(made.alias("value"), (F.when(empty, not nullable).otherwise(made.isNull())).alias("bad"))


def _picked(made: DataFrame, kept: list[str], names: list[str]) -> DataFrame:
    bad = sum((F.coalesce(F.col(f"`{n}`.bad"), F.lit(False)).cast("int") for n in names), F.lit(0))
    return made.select(*kept, *(F.col(f"`{n}`.value").alias(n) for n in names), bad.alias("bad"))


def typed(records: DataFrame, schema: T.StructType) -> DataFrame:
    """The schema's columns of text records, and ``bad``: how many of a row's values can't be read. A job with a bad row fails as a whole."""
    names = [f.name for f in schema if f.name in records.columns]
    rest = [c for c in records.columns if c not in names]
    made = [coerce(F.col(f.name), f.dataType, (f.metadata or {}).get("length")).alias(f.name) for f in schema if f.name in names]
    return _picked(records.select(*rest, *made), rest, names)


def typed_records(records: DataFrame, schema: T.StructType, keep: list[str]) -> DataFrame:
    """Rows of a typed table from ``api_id``, ``job_id``, ``key_params`` and ``record`` (JSON texts), with ``bad``.

    A record's own value goes before a key parameter, and that before the ids; unknown keys are left out. ``id`` and ``updated_at`` are the table's own.
    """
    fields = [f for f in schema if f.name not in ("id", "updated_at")]
    held = [F.col(c).alias(f"_keep_{c}") for c in keep]
    # One reading of each JSON text by the declared fields, then the type of each value, then the values.
    shape = T.StructType([T.StructField(f.name, T.VariantType()) for f in fields])
    read = records.select(*held, "api_id", "job_id", F.from_json("record", shape).alias("_record"), F.from_json(F.coalesce("key_params", F.lit("{}")), shape).alias("_keys"))

    def given(name: str) -> Column:
        own = [F.col(c)[name] for c in ("_record", "_keys")]
        return F.coalesce(*own, F.col(name).cast("variant")) if name in ("api_id", "job_id") else F.coalesce(*own)

    kept = [f"_keep_{c}" for c in keep]
    values = read.select(*kept, *(given(f.name).alias(f"_v{i}") for i, f in enumerate(fields)))
    types = values.select("*", *(F.schema_of_variant(f"_v{i}").alias(f"_t{i}") for i in range(len(fields))))
    made = [coerce_variant(F.col(f"_v{i}"), f.dataType, (f.metadata or {}).get("length"), f.nullable, F.col(f"_t{i}")).alias(f.name) for i, f in enumerate(fields)]
    rows = _picked(types.select(*kept, *made), kept, [f.name for f in fields])
    return rows.select(*(F.col(f"_keep_{c}").alias(f"run_{c}") for c in keep), *(f.name for f in fields), "bad")


def generic(df: DataFrame, record: list[str], keys: list[str]) -> DataFrame:
    """API and job ids, the key parameters as JSON (null without any), and the record as JSON."""
    stamped = F.to_json(F.struct(*keys), {"ignoreNullFields": "false"}) if keys else F.lit(None).cast("string")
    return df.select("api_id", "job_id", stamped.alias("key_params_json"), F.to_json(F.struct(*record), {"ignoreNullFields": "false"}).alias("result_json"))


def counts_text(counts: DataFrame) -> DataFrame:
    """A description for each job of (job_id, table, n): "table: n", by table."""
    return counts.groupBy("job_id").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("table", F.col("n").cast("string").alias("n")))), lambda x: F.concat(x["table"], F.lit(": "), x["n"])), ", ").alias("description"))


def counts_by_table(rows: DataFrame, tables: dict[str, str], selector: str = "selector", job: str = "job_id") -> DataFrame:
    """Rows saved by each job into each table (job_id, table, n), summed over the selectors that a table gets."""
    table = F.create_map(*(F.lit(x) for pair in tables.items() for x in pair))[F.col(selector)]
    return rows.select(F.col(job).alias("job_id"), table.alias("table")).filter("table is not null").groupBy("job_id", "table").agg(F.count("*").alias("n"))


def overwrite(old: DataFrame, new: DataFrame, jobs: DataFrame) -> DataFrame:
    """A result table after the jobs ran again: their old rows go, also those of a job that now has none."""
    return old.join(jobs.select("job_id").distinct(), "job_id", "left_anti").unionByName(new)


def append(old: DataFrame, new: DataFrame) -> DataFrame:
    """A result table after the jobs ran: all rows, old and new."""
    return old.unionByName(new)


def restore(rows: DataFrame, schema: T.StructType) -> DataFrame:
    """Text columns of a buffered table in the schema's types: an empty text is null."""
    return rows.select(*(F.nullif(F.col(f.name), F.lit("")).cast(f.dataType).alias(f.name) for f in schema if f.name in rows.columns))


def page(df: DataFrame, key: str, limit: int = 100, offset: int = 0, most: int = 1000) -> DataFrame:
    """The newest rows: by key, descending."""
    if offset < 0 or limit > most:
        raise ValueError("an offset is not negative and a page not over its greatest size")
    return df.orderBy(F.col(key).desc_nulls_first()).offset(offset).limit(limit)


def page_after(df: DataFrame, key: str, after: object = None, limit: int = 100, most: int = 1000) -> DataFrame:
    """The page behind a row: the newest rows whose key is less than ``after``, the key of the last row of the page before (None for the first page).

    However deep the page, no row ahead of it is sorted or read: the filter reaches the files, whose key ranges leave out those that hold newer rows.
    """
    if limit > most:
        raise ValueError("a page is not over its greatest size")
    rows = df if after is None else df.filter(F.col(key) < F.lit(after))
    return rows.orderBy(F.col(key).desc()).limit(limit)


def recent_logs(logs: DataFrame, status: str | None = None, limit: int = 100, offset: int = 0, job: str | None = None) -> DataFrame:
    """The newest log rows, of one status or one job if given."""
    rows = logs.filter(F.col("status") == status) if status else logs
    rows = rows.filter(F.col("job_id") == job) if job else rows
    return rows.orderBy(F.col("executed_at").desc_nulls_first(), F.col("id").desc()).offset(offset).limit(limit)
