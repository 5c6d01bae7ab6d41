"""Requests from templates, as Columns over an API's configuration and a job's parameters.

Everything but secrets is filled in by Spark, so a table of requests can be written, read again and looked at; ``${NAME}`` is
replaced where a request is sent.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

#: The parameter that holds the number of a page.
PAGE = "PAGE"
# Fixed value: how a secret is written in a template.
SECRET = r"\$\{(\w+)\}"
TEXT_BODY, FIELD_BODIES = "content", ("json", "data")
_VARIANTS = "map<string,variant>"


def token(key: Column) -> Column:
    """The pattern of ``:KEY`` as a whole word, in any script, for a key with any characters."""
    return F.concat(F.lit(r"(?U)(?<!\w):\Q"), F.replace(key, F.lit(r"\E"), F.lit(r"\E\\E\Q")), F.lit(r"\E(?!\w)"))


def text_of(value: Column) -> Column:
    """A parameter (a variant) as it stands in a text: texts and numbers as they are, ``None``, ``True`` and ``False`` by these names, lists and objects as JSON."""
    plain = F.try_variant_get(value, "$", "string")
    kind = F.schema_of_variant(value)
    logical = F.when(plain == "true", "True").otherwise("False")
    return F.when(kind == "BOOLEAN", logical).when(kind.isin("VOID") | value.isNull(), "None").otherwise(F.coalesce(plain, F.to_json(value)))


def parameters(params: Column) -> Column:
    """A job's parameters (JSON text of an object) as an array of (key, text), in the order of the text."""
    return F.transform(F.map_entries(F.from_json(params, _VARIANTS)), lambda e: F.struct(e["key"].alias("key"), text_of(e["value"]).alias("text")))


def fill(template: Column, entries: Column) -> Column:
    """Replace each ``:KEY`` by its text, one key after the other; a text may so bring in a later key."""

    def put(text: Column, entry: Column) -> Column:
        literal = F.replace(F.replace(entry["text"], F.lit("\\"), F.lit("\\\\")), F.lit("$"), F.lit("\\$"))
        return F.when(F.contains(text, F.lit(":")), F.regexp_replace(text, token(entry["key"]), literal)).otherwise(text)

    return F.reduce(entries, template, put)


def substitute(template: Column, params: Mapping[str, Column]) -> Column:
    """``fill`` with named columns as parameters; null is written ``None``."""
    entries = [F.struct(F.lit(k).alias("key"), F.coalesce(v.cast("string"), F.lit("None")).alias("text")) for k, v in params.items()]
    return fill(template, F.array(*entries)) if entries else template


def overlay(payload: Column, params: Column) -> Column:
    """A JSON object (text) with the values of another in place of its own or behind them. All values keep their types; null counts as an empty object."""
    own, over = (F.coalesce(F.from_json(x, _VARIANTS), F.from_json(F.lit("{}"), _VARIANTS)) for x in (payload, params))
    return F.to_json(F.map_concat(F.map_filter(own, lambda k, _: ~F.array_contains(F.map_keys(over), k)), over))


def headers(header: Column, entries: Column) -> Column:
    """A map of headers from a JSON object: texts are filled, other values written as they are."""
    return F.transform_values(F.from_json(header, _VARIANTS), lambda _, v: F.when(F.schema_of_variant(v) == "STRING", fill(F.try_variant_get(v, "$", "string"), entries)).otherwise(text_of(v)))


def paged(url: Column, text_body: Column, fields: Column) -> Column:
    """Whether a call has a page parameter in its URL, in its text body, or as a key of its fields."""
    both = F.concat(F.coalesce(url, F.lit("")), F.lit(" "), F.coalesce(text_body, F.lit("")))
    return both.rlike(rf"(?U)(?<!\w):{PAGE}(?!\w)") | F.coalesce(F.map_contains_key(F.from_json(fields, _VARIANTS), PAGE), F.lit(False))


def request(params: Column) -> dict[str, Column]:
    """The columns of a request, by name, over rows that have the configuration of an API.

    ``method``, ``url``, ``headers`` (a map), ``body_kind`` (content, json, data or null), ``body`` (text, or the JSON text of fields) and ``wrong``
    (what can't be sent, else null).
    """
    kind, entries = F.col("payload_type"), parameters(params)
    known = F.coalesce(kind.isin(TEXT_BODY, *FIELD_BODIES), F.lit(True))
    return {
        "method": F.upper("request_type"),
        "url": fill(F.col("api_url"), entries),
        "headers": headers(F.coalesce("header_json", F.lit("{}")), entries),
        "body_kind": kind,
        "body": F.when(kind == TEXT_BODY, fill(F.coalesce("payload_xml", F.lit("")), entries)).when(kind.isin(*FIELD_BODIES), overlay(F.col("payload_json"), params)),
        "wrong": F.when(~known, F.concat(F.lit("unknown payload type: "), kind)),
    }


def secrets(text: str, store: Mapping[str, str]) -> str:
    """Replace ``${NAME}`` by a secret, once; unknown names stay."""
    return re.sub(SECRET, lambda m: store.get(m[1], m[0]), text)


def secret_names(texts: Iterable[str | None]) -> set[str]:
    """The secrets that templates name."""
    return {name for text in texts for name in re.findall(SECRET, text or "")}
