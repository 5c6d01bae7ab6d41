"""Reading and editing the configuration, and reading results and logs."""

from __future__ import annotations

import json
from collections.abc import Mapping
from typing import Any

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemill.operators import save
from tidemill.schemas import CONFIG, KEYS
from tidemill.sources.tables import Tables


class Missing(LookupError):
    """There is no such row."""


class Conflict(ValueError):
    """There is such a row already."""


def by_key(df: DataFrame, key: str, value: Any) -> dict[str, Any]:
    """The row of a key."""
    for row in df.filter(F.col(key) == F.lit(value)).limit(1).collect():
        return row.asDict()
    raise Missing(f"no row with {key} {value!r}")


def result(tables: Tables, name: str, row_id: int) -> dict[str, Any]:
    """A result row by its id; files whose range of ids doesn't hold it are skipped."""
    return by_key(tables.results(name), "id", row_id)


def result_page(tables: Tables, name: str, limit: int = 100, offset: int = 0, after: int | None = None) -> DataFrame:
    """The newest results. Deep pages are better asked for behind the last id of the page before (``after``) than by an offset."""
    rows = tables.results(name)
    return save.page(rows, "id", limit, offset) if after is None else save.page_after(rows, "id", after, limit)


def logs(tables: Tables, status: str | None = None, job: str | None = None, limit: int = 100, offset: int = 0) -> DataFrame:
    return save.recent_logs(tables.read("api_job_log"), status, limit, offset, job)


#: Values of columns that a new row may leave out.
DEFAULTS = {"api_job_builder": {"is_active": False, "save_mode": "overwrite", "execution_cycle": "daily"}, "api_job": {"is_active": True, "save_mode": "overwrite", "execution_cycle": "daily"}}


class Config:
    """One configuration table, for all three of them. Each change writes the bucket of its key anew."""

    def __init__(self, tables: Tables, name: str):
        self.tables, self.name, self.key, self.schema = tables, name, KEYS[name], CONFIG[name]

    def all(self) -> DataFrame:
        return self.tables.read(self.name)

    def get(self, key: str) -> dict[str, Any]:
        return by_key(self.tables.read(self.name, [key]), self.key, key)

    def _keys(self, *keys: str) -> DataFrame:
        return self.tables.spark.createDataFrame([(k,) for k in keys], f"{self.key} string")

    def _rows(self, rows: list[Mapping[str, Any]]) -> DataFrame:
        text = lambda v: json.dumps(v, sort_keys=True, ensure_ascii=False) if isinstance(v, (dict, list)) else v
        made = self.tables.spark.createDataFrame([tuple(text(r.get(f.name)) for f in self.schema) for r in rows], T.StructType([T.StructField(f.name, f.dataType) for f in self.schema]))
        return made.withColumn("updated_at", F.current_timestamp().cast("timestamp_ntz"))

    def _check(self, values: Mapping[str, Any]) -> None:
        for f in self.schema:
            value, length = values.get(f.name), f.metadata.get("length")
            if value is None and not f.nullable:
                raise ValueError(f"{f.name} is needed")
            if isinstance(f.dataType, T.StringType) and length and value is not None and (not isinstance(value, str) or len(value) > length):
                raise ValueError(f"{f.name} is a text of at most {length} characters")
            if isinstance(f.dataType, T.BooleanType) and value is not None and not isinstance(value, bool):
                raise ValueError(f"{f.name} is true or false")
        if self.name == "api_mst":
            allowed = {None: (), "json": ("payload_json",), "data": ("payload_json",), "content": ("payload_xml",)}
            kind = values.get("payload_type")
            if kind not in allowed or any(values.get(p) is not None and p not in allowed[kind] for p in ("payload_json", "payload_xml")):
                raise ValueError("the payload does not go with its type")

    def create(self, *rows: Mapping[str, Any]) -> None:
        """Add rows, all or none of them: fields that are unknown are left out, the time is the table's own."""
        full = [DEFAULTS.get(self.name, {}) | dict(r) for r in rows]
        for r in full:
            self._check(r)
        keys = [r[self.key] for r in full]
        with self.tables.change() as c:
            there = [r[0] for r in c.rows_of(self.name, self._keys(*keys)).select(self.key).limit(1).collect()]
            if there or len({*keys}) < len(keys):
                raise Conflict(f"{self.key} {(there or keys)[0]!r} is there already")
            c.append(self.name, self._rows(full))

    def patch(self, key: str, values: Mapping[str, Any]) -> None:
        """Change fields of a row; its key and time can't be set. Values are not checked."""
        if unknown := sorted({*values} - {*self.schema.names}):
            raise ValueError(f"unknown fields: {unknown}")
        now = self.get(key) | {k: v for k, v in values.items() if k not in (self.key, "updated_at")}
        with self.tables.change() as c:
            c.replace_keys(self.name, self._rows([now]), self._keys(key))

    def delete(self, key: str) -> None:
        """Take a row out; rows that refer to it stay."""
        self.get(key)
        with self.tables.change() as c:
            c.replace_keys(self.name, None, self._keys(key))
