"""Records from JSON, delimited, zipped and XML answers. What can't be read is a value with its error, not an exception."""

from __future__ import annotations

import io
import json
import re
import zipfile
from collections.abc import Iterator
from xml.etree import ElementTree

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

_VARIANTS = "map<string,variant>"
#: Characters that an XML parser is fed at once, and records in a batch.
FED, BATCH = 1 << 16, 1000


def response_format(response_type: Column, content_type: Column, body: Column) -> Column:
    """The declared type; else xml by content type or first character; else json."""
    xml = F.coalesce(F.contains(F.lower(content_type), F.lit("xml")), F.lit(False)) | F.coalesce(F.startswith(F.ltrim(body), F.lit("<")), F.lit(False))
    return F.coalesce(response_type, F.when(xml, "xml").otherwise("json"))


def check_mapping(outputs: dict | None, persist: dict | None) -> None:
    """A configuration has to say what becomes of a response."""
    if not outputs and not persist:
        raise ValueError("neither output tables nor values to keep are configured")


# --- JSON


def json_path(path: Column | str) -> Column:
    """A dotted path of object keys as a path into a variant. Null (nothing is found there) for a key that holds both kinds of quotes."""
    path = F.lit(path) if isinstance(path, str) else path
    quoted = lambda k: F.when(~F.contains(k, F.lit("'")), F.concat(F.lit("['"), k, F.lit("']"))).when(~F.contains(k, F.lit('"')), F.concat(F.lit('["'), k, F.lit('"]')))
    keys = F.transform(F.split(path, r"\."), quoted)
    return F.when(~F.exists(keys, lambda k: k.isNull()), F.concat(F.lit("$"), F.array_join(keys, "")))


def json_scalar(body: Column, path: Column | str, kind: str = "string") -> Column:
    """A value at a dotted path of object keys, or null; null as well if the body is no JSON."""
    return F.try_variant_get(F.try_parse_json(body), json_path(path), kind)


def json_items(document: Column, path: Column | str) -> Column:
    """The records at a dotted path of a parsed body (a variant), an array of JSON texts: a list's items, a single object, or none. Null if there is no document.

    A scalar there has no records.
    """
    at = F.try_variant_get(document, json_path(path), "variant")
    kind = F.schema_of_variant(at)
    items = F.when(kind.startswith("ARRAY"), F.try_variant_get(at, "$", "array<variant>")).when(kind.startswith("OBJECT"), F.array(at))
    return F.when(document.isNotNull(), F.coalesce(F.transform(items, lambda x: F.to_json(x)), F.array().cast("array<string>")))


def json_records(df: DataFrame, body: str, path: str, record: str = "record") -> DataFrame:
    """A row for each record at a dotted path. Adds ``pos`` and the record as JSON text."""
    parsed = df.withColumn("_document", F.try_parse_json(body))
    return parsed.select(*df.columns, F.posexplode(json_items(F.col("_document"), path)).alias("pos", record))


def merge_field(record: Column, name: str, value: Column) -> Column:
    """The record (JSON text of an object) with a field set from elsewhere in the response. All values keep their types."""
    own = F.map_filter(F.from_json(record, _VARIANTS), lambda k, _: k != name)
    return F.to_json(F.map_concat(own, F.create_map(F.lit(name), value.cast("variant"))))


def merge_fields(items: Column, document: Column, fields: Column) -> Column:
    """Records (JSON texts) with values of the whole document set in each: ``fields`` is a map from a dotted path in the document to the record's field.

    They take the place of a record's own fields, are null where the path finds nothing, and a field that several paths name gets the last one's. A record that is no object stays.
    """
    entries = F.map_entries(fields)
    last = F.filter(entries, lambda e, i: ~F.exists(F.slice(entries, i + 2, F.size(entries)), lambda later: later["value"] == e["value"]))
    null = F.parse_json(F.lit("null"))
    found = F.map_from_entries(F.transform(last, lambda e: F.struct(e["value"].alias("key"), F.coalesce(F.try_variant_get(document, json_path(e["key"]), "variant"), null).alias("value"))))

    def stamped(record: Column) -> Column:
        own = F.map_filter(F.from_json(record, _VARIANTS), lambda k, _: ~F.map_contains_key(found, k))
        return F.when(F.startswith(record, F.lit("{")), F.to_json(F.map_concat(own, found))).otherwise(record)

    return F.when(F.size(F.coalesce(entries, F.array().cast("array<struct<key:string,value:string>>"))) > 0, F.transform(items, stamped)).otherwise(items)


# --- Delimited


def _escaped(sep: Column) -> Column:
    """A separator within a character class."""
    return F.concat(F.lit("\\x{"), F.hex(F.ascii(sep)), F.lit("}"))


def _cell_pattern(sep: Column) -> Column:
    """A cell of a delimited line: quoted, with anything in the quotes, or up to the next separator."""
    other = F.concat(F.lit("[^"), _escaped(sep), F.lit("\\r\\n]*"))
    return F.concat(F.lit('(?:"[^"]*(?:""[^"]*)*+"'), other, F.lit("|"), other, F.lit(")"))


def separator_error(sep: Column) -> Column:
    """What is wrong with a separator, or null."""
    return F.when((F.char_length(sep) != 1) | sep.isin('"', "\r", "\n"), F.concat(F.lit("a separator is one character other than a quote or newline: "), sep))


def delimited_lines(body: Column, sep: Column) -> Column:
    """The lines of a delimited body that have a cell, an array of texts; quoted newlines don't end a line."""
    # A quote opens a quoted cell only at its start, so a line is a row of cells; the longest such row is a line.
    quoted = F.regexp_extract_all(body, F.concat(_cell_pattern(sep), F.lit("(?:"), _escaped(sep), _cell_pattern(sep), F.lit(")*+")), F.lit(0))
    plain = F.split(body, "\r\n|\r|\n")
    return F.filter(F.when(F.contains(body, F.lit('"')), quoted).otherwise(plain), lambda x: x != "")


def delimited_cells(line: Column, sep: Column) -> Column:
    """The cells of a line: quotes taken off, white space trimmed, null if empty."""
    quoted = F.regexp_extract_all(F.concat(sep, line), F.concat(_escaped(sep), F.lit("("), _cell_pattern(sep), F.lit(")")), F.lit(1))
    cells = F.when(F.contains(line, F.lit('"')), quoted).otherwise(F.split(line, _escaped(sep), -1))

    def plain(cell: Column) -> Column:
        inner = F.replace(F.regexp_replace(cell, r'(?s)^"(.*)"([^"]*)$', "$1$2"), F.lit('""'), F.lit('"'))
        text = F.when(F.startswith(cell, F.lit('"')), inner).otherwise(cell)
        bare = F.when(text.rlike(r"(?U)^\s|\s$"), F.regexp_replace(text, r"(?U)^\s++|\s++$", "")).otherwise(text)
        return F.nullif(bare, F.lit(""))

    return F.transform(cells, plain)


def delimited_records(body: Column, names: Column | list[str] | None = None, sep: Column | str = ",", header: Column | bool = False) -> Column:
    """The records of a delimited body, an array of maps of text: cells are trimmed, empty cells are null, quotes may hold separators, quotes and newlines.

    Lines without a cell are dropped; with ``header`` the first line is, and names the cells unless ``names`` are given. Of cells of one name the last counts, a
    cell may have an empty name. Short rows miss keys, long rows lose their extra cells. Null without a body, without names or with a separator that is none (``delimited_error`` says which).
    """
    body, names, sep, header = _delimited(body, names, sep, header)
    lines = delimited_lines(body, sep)
    first = F.transform(delimited_cells(F.get(lines, F.lit(0)), sep), lambda c: F.coalesce(c, F.lit("")))
    keys = F.when(F.size(names) > 0, names).when(header, first)
    # Each line is cut into cells once; a name counts where no later one is the same.
    cells = F.transform(F.when(header, F.slice(lines, F.lit(2), F.greatest(F.size(lines), F.lit(1)))).otherwise(lines), lambda line: delimited_cells(line, sep))
    made = F.transform(F.array(F.struct(keys.alias("keys"), cells.alias("rows"))), lambda x: F.transform(x["rows"], lambda row: _record(x["keys"], row)))
    return F.when(separator_error(sep).isNull() & keys.isNotNull(), F.get(made, F.lit(0)))


def _record(keys: Column, cells: Column) -> Column:
    both = F.zip_with(F.slice(keys, F.lit(1), F.size(cells)), F.slice(cells, F.lit(1), F.size(keys)), lambda k, v: F.struct(k.alias("key"), v.alias("value")))
    alike = F.size(F.array_distinct(keys)) == F.size(keys)
    last = F.filter(both, lambda e, i: ~F.array_contains(F.slice(keys, i + 2, F.greatest(F.size(cells) - i - 1, F.lit(0))), e["key"]))
    return F.map_from_entries(F.when(alike, both).otherwise(last))


def _delimited(body: Column, names: Column | list[str] | None, sep: Column | str, header: Column | bool) -> tuple[Column, Column, Column, Column]:
    names = (F.array(*map(F.lit, names)) if names else F.array()) if not isinstance(names, Column) else F.coalesce(names, F.array())
    return body, names.cast("array<string>"), F.lit(sep) if isinstance(sep, str) else sep, F.coalesce(header, F.lit(False)) if isinstance(header, Column) else F.lit(header)


def delimited_error(body: Column, names: Column | list[str] | None = None, sep: Column | str = ",", header: Column | bool = False) -> Column:
    """Why a delimited body has no records at all, or null."""
    body, names, sep, header = _delimited(body, names, sep, header)
    unnamed = (F.size(names) == 0) & ~(header & body.rlike(r"[^\r\n]"))
    return F.coalesce(separator_error(sep), F.when(unnamed, "a delimited body needs field names"))


# --- Bytes

_READ = T.StructType([T.StructField("value", T.StringType()), T.StructField("error", T.StringType())])
_OPENED = T.StructType([T.StructField("value", T.BinaryType()), T.StructField("error", T.StringType())])


def _each(made: list[tuple], kind: pa.DataType) -> pa.Array:
    return pa.StructArray.from_arrays([pa.array([x[0] for x in made], kind), pa.array([x[1] for x in made], pa.string())], ["value", "error"])


def _tried(call) -> tuple:
    """(value, error) of a call."""
    try:
        return call(), None
    except Exception as e:  # noqa: BLE001 - archives raise errors of many kinds, and a job fails with its message
        return None, f"{type(e).__name__}: {e}"


@F.arrow_udf(_READ)
def _decoded(body: pa.Array, encoding: pa.Array) -> pa.Array:
    return _each([(None, None) if b is None else _tried(lambda b=b, e=e: b.decode(e)) for b, e in zip(body.to_pylist(), encoding.to_pylist(), strict=True)], pa.string())


@F.arrow_udf(_OPENED)
def _unzipped(body: pa.Array, inner: pa.Array) -> pa.Array:
    def entry(data: bytes, name: str | None) -> bytes:
        with zipfile.ZipFile(io.BytesIO(data)) as z:
            return z.read(name or z.namelist()[0])

    return _each([(None, None) if b is None else _tried(lambda b=b, n=n: entry(b, n)) for b, n in zip(body.to_pylist(), inner.to_pylist(), strict=True)], pa.binary())


def decode(body: Column, encoding: Column | str | None = None) -> Column:
    """Bytes as text: (value, error). UTF-8 is decoded by Spark, other encodings (cp949, euc-kr ...) in Arrow batches. A byte order mark stays."""
    name = F.coalesce(F.lit(encoding) if encoding is None or isinstance(encoding, str) else encoding, F.lit("utf-8"))
    plain = F.replace(F.lower(name), F.lit("_"), F.lit("-")).isin("utf-8", "utf8")
    text = F.try_validate_utf8(body.cast("string"))
    own = F.struct(text.alias("value"), F.when(body.isNotNull() & text.isNull(), "UnicodeDecodeError: the body is not UTF-8").alias("error"))
    if encoding is None or (isinstance(encoding, str) and encoding.lower().replace("_", "-") in ("utf-8", "utf8")):
        return own
    return F.when(plain, own).otherwise(_decoded(F.when(~plain, body), name))


def unzip(body: Column, inner: Column | str | None = None) -> Column:
    """An entry of a zipped body, the first by default, in Arrow batches: (value, error)."""
    return _unzipped(body, (F.lit(inner) if inner is None or isinstance(inner, str) else inner).cast("string"))


# --- XML


def xml_selector(selector: str) -> tuple[str, str | None]:
    """An ElementTree path and the attribute after #. Dotted names are searched at any depth."""
    path, _, attribute = selector.partition("#")
    if not path.startswith(".") and "/" not in path:
        path = ".//" + path.replace(".", "/")
    return path, attribute or None


def _steps(path: str) -> list[str] | None:
    """The names of a path that is searched at any depth and then goes down from child to child; None for any other path."""
    names = path.removeprefix(".//").split("/")
    return names if path.startswith(".//") and all(re.fullmatch(r"\*|[\w-][\w.-]*", n) for n in names) else None


def xml_elements(body: str, path: str) -> Iterator[ElementTree.Element]:
    """The elements that a path finds, in document order, read by a pull parser: what stands around them is forgotten at once.

    Paths with conditions, parents or a start elsewhere are looked up in the whole tree.
    """
    names = _steps(path)
    if not names:
        yield from ElementTree.fromstring(body).iterfind(path)
        return
    parser = ElementTree.XMLPullParser(("start", "end"))
    stack: list[ElementTree.Element] = []
    states: list[set[int]] = []  # how many names are found, at each depth
    held: list[ElementTree.Element] = []  # found elements within the outermost one
    outer = -1
    for at in range(0, len(body) + FED, FED):
        if at < len(body):
            parser.feed(body[at : at + FED])
        else:
            parser.close()
        for event, element in parser.read_events():
            if event == "start":
                state = {0} | {n + 1 for n in states[-1] if n < len(names) and names[n] in ("*", element.tag)} if states else {0}
                if len(names) in state:
                    held.append(element)
                    outer = len(stack) if outer < 0 else outer
                stack.append(element)
                states.append(state)
            else:
                stack.pop()
                states.pop()
                if outer == len(stack):
                    yield from held
                    held, outer = [], -1
                if outer < 0 and stack:
                    stack[-1].remove(element)
        if at >= len(body):
            return


def xml_record(found: ElementTree.Element, attribute: str | None) -> dict:
    """The children of an element by tag, or a leaf's attributes.

    A child without children is, in this order: the selector's attribute, its ``value`` attribute, its only attribute, all its attributes, its text, null.
    """
    made: dict = {}
    # In reverse document order all children of an element come ahead of it, the last one first.
    for element in reversed(list(found.iter())):
        own = element.attrib
        values: dict[str, list] = {}
        for child in element:
            values.setdefault(child.tag, []).append(made.pop(child))
        if values:
            made[element] = {tag: each if len(each) > 1 else each[0] for tag, each in values.items()}
        elif attribute in own or "value" in own:
            made[element] = own.get(attribute, own.get("value"))
        else:
            made[element] = dict(own) if len(own) > 1 else next(iter(own.values()), (element.text or "").strip() or None)
    return made[found] if len(found) else dict(found.attrib)


def _xml_rows(body: str | None, selector: str) -> Iterator[tuple[int, str | None, str | None]]:
    """(place, record as JSON text, error); an error ends the records of a body."""
    at = 0
    try:
        if body is not None:
            path, attribute = xml_selector(selector)
            for found in xml_elements(body, path):
                yield at, json.dumps(xml_record(found, attribute), ensure_ascii=False, sort_keys=True, separators=(",", ":")), None
                at += 1
    except Exception as e:  # noqa: BLE001 - paths that are none raise errors of many kinds, and a job fails with its message
        yield at, None, f"{type(e).__name__}: {e}"


def xml_records(df: DataFrame, body: str, selector: str, keep: list[str]) -> DataFrame:
    """A row for each record of each XML body: the columns to keep, ``pos``, ``record`` (JSON text, keys sorted) and ``error``. ``selector`` names a column.

    A body that is no XML, or no longer from some place on, has a last row with the error; null has no rows. Bodies are read by a pull parser and
    records leave in batches, so memory holds a body and a batch of records.
    """
    shape = T.StructType([*(df.schema[c] for c in keep), T.StructField("pos", T.IntegerType()), T.StructField("record", T.StringType()), T.StructField("error", T.StringType())])

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                held: list[tuple] = []
                for row in _xml_rows(batch.column(body)[i].as_py(), batch.column(selector)[i].as_py()):
                    held.append(row)
                    if len(held) == BATCH:
                        yield packed(batch, i, held)
                        held = []
                if held:
                    yield packed(batch, i, held)

    def packed(batch: pa.RecordBatch, i: int, held: list[tuple]) -> pa.RecordBatch:
        same = pa.array([i] * len(held), pa.int64())
        made = [pa.array([x[j] for x in held], kind) for j, kind in enumerate((pa.int32(), pa.string(), pa.string()))]
        return pa.RecordBatch.from_arrays([*(batch.column(c).take(same) for c in keep), *made], shape.names)

    return df.select(*dict.fromkeys([*keep, body, selector])).mapInArrow(read, shape)


# --- Pages


def merge_pages(pages: DataFrame, job: list[str], page: str = "page", digest: str = "digest", size: str = "n") -> DataFrame:
    """Pages ahead of the first that is empty or equal to the one just before it, in each job."""
    order = Window.partitionBy(*job).orderBy(page)
    stop = (F.col(size) == 0) | F.coalesce(F.col(digest) == F.lag(digest).over(order), F.lit(False))
    first = F.min(F.when(F.col("_stop"), F.col(page))).over(Window.partitionBy(*job))
    marked = pages.withColumn("_stop", stop).withColumn("_first", first)
    return marked.filter(F.col("_first").isNull() | (F.col(page) < F.col("_first"))).drop("_stop", "_first")
