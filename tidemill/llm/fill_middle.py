"""Fill-in-middle transformation with cuts between tokens.

A token is a run of ASCII letters or one other character. Whether a token begins at a character follows from it and the one before it, so
boundaries are counted chunk by chunk, each chunk overlapping the one before by a character, without a tokenizer running over the text. Prefix
sums of the counts tell which chunk holds the boundary of each cut, and only those chunks are scanned again for its place.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemill.llm import textkit

#: Bytes of a chunk; chunks whose boundaries are counted at once.
CHUNK, CHUNKS_AT_ONCE = 1 << 10, 1 << 11
#: Per cent of the texts that are transformed, and of those the ones whose suffix comes first.
RATE, SUFFIX_FIRST = 90, 20
# The marks ahead of prefix, suffix and middle.
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
_LETTER = np.zeros(256, bool)
_LETTER[65:91] = True
_LETTER[97:123] = True
#: Bytes that begin a character in UTF-8.
_HEAD = (np.arange(256) & 0xC0) != 0x80


def _begins(data: np.ndarray, at: int, to: int) -> np.ndarray:
    """For bytes ``at`` to ``to`` of a text, whether a token begins there; the byte ahead of ``at`` is looked at as well."""
    own = data[at:to]
    letter = _LETTER[own]
    before = np.empty(len(own), bool)
    before[1:] = letter[:-1]
    before[:1] = at > 0 and _LETTER[data[at - 1]]
    return _HEAD[own] & ~(letter & before)


class Boundaries:
    """Counts of token boundaries and characters in the chunks of one text."""

    def __init__(self, data: np.ndarray):
        self.data = data
        tokens, chars = [np.zeros(1, np.int64)], [np.zeros(1, np.int64)]
        step = CHUNK * CHUNKS_AT_ONCE
        for at in range(0, len(data), step):
            to = min(at + step, len(data))
            edges = np.arange(0, to - at, CHUNK)
            tokens.append(np.add.reduceat(_begins(data, at, to), edges, dtype=np.int64))
            chars.append(np.add.reduceat(_HEAD[data[at:to]], edges, dtype=np.int64))
        self.tokens, self.chars = (np.cumsum(np.concatenate(x)) for x in (tokens, chars))

    @property
    def n(self) -> int:
        """Tokens of the text."""
        return int(self.tokens[-1])

    def cut(self, rank: int) -> int:
        """Characters ahead of the token of a rank (from 0), all of them for the rank ``n``."""
        if rank >= self.n:
            return int(self.chars[-1])
        chunk = int(np.searchsorted(self.tokens, rank, "right")) - 1
        at = chunk * CHUNK
        to = min(at + CHUNK, len(self.data))
        place = np.flatnonzero(_begins(self.data, at, to))[rank - self.tokens[chunk]]
        return int(self.chars[chunk] + np.count_nonzero(_HEAD[self.data[at : at + place]]))


_CUTS = T.StructType([T.StructField(c, T.LongType()) for c in ("n", "prefix", "middle")])


@F.arrow_udf(_CUTS)
def _cuts(texts: pa.Array, one: pa.Array, two: pa.Array) -> pa.Array:
    """The number of tokens, and characters of prefix and middle where the cuts are the hashes modulo one more than that number."""
    n, prefix, middle = (np.zeros(len(texts), np.int64) for _ in range(3))
    ranks = np.stack([one.fill_null(0).to_numpy(zero_copy_only=False), two.fill_null(0).to_numpy(zero_copy_only=False)])
    for at, data, offsets in textkit.blocks(texts):
        for i, (a, b) in enumerate(zip(offsets[:-1], offsets[1:], strict=True), at):
            counted = Boundaries(data[a:b])
            n[i] = counted.n
            first, last = (counted.cut(int(r)) for r in sorted(ranks[:, i] % (counted.n + 1)))
            prefix[i], middle[i] = first, last - first
    return pa.StructArray.from_arrays([pa.array(n), pa.array(prefix), pa.array(middle)], ["n", "prefix", "middle"])


def restore(output: Column, form: Column) -> Column:
    """The text that an output was made from."""
    moved = lambda one, two, order: F.regexp_replace(output, f"(?s)^{one}(.*){two}(.*){MIDDLE}(.*)$", order)
    return F.when(form == "psm", moved(PREFIX, SUFFIX, "$1$3$2")).when(form == "spm", moved(SUFFIX, PREFIX, "$2$3$1")).otherwise(output)


def transform(docs: DataFrame, seed: int = 1, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Cut every text into prefix, middle and suffix and put the middle last: ``doc_id``, ``n`` (tokens), ``form``, ``prefix_chars`` and ``middle_chars`` (code points, null for plain texts) and ``output``.

    Hashes of ``seed`` and id decide form and cuts. Texts that are empty or hold one of the marks stay plain; a null text is empty; a null id hashes as an empty
    one. Rows with one id and one text come out alike, other columns are ignored, an empty table gives no rows. Only the places of the cuts are
    found in Arrow batches; the text stays in the JVM.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), 256)
    rows = rows.select("doc_id", "text", *(F.conv(F.substring(digest, 8 * i + 1, 8), 16, 10).cast("long").alias(f"h{i + 1}") for i in range(4)))
    marked = F.lit(False)
    for mark in (PREFIX, SUFFIX, MIDDLE):
        marked |= F.contains("text", F.lit(mark))
    form = F.when((F.col("text") == "") | marked | (F.col("h3") % 100 >= RATE), "plain").when(F.col("h4") % 100 < SUFFIX_FIRST, "spm").otherwise("psm")
    rows = rows.select("doc_id", "text", form.alias("form"), _cuts("text", "h1", "h2").alias("cut"))
    text, first, middle = F.col("text"), F.col("cut.prefix").cast("int"), F.col("cut.middle").cast("int")
    parts = {PREFIX: F.substring(text, F.lit(1), first), MIDDLE: F.substring(text, first + 1, middle), SUFFIX: F.substring(text, first + middle + 1, F.char_length(text))}
    joined = lambda *marks: F.concat(*(x for m in marks for x in (F.lit(m), parts[m])))
    output = F.when(F.col("form") == "psm", joined(PREFIX, SUFFIX, MIDDLE)).when(F.col("form") == "spm", joined(SUFFIX, PREFIX, MIDDLE)).otherwise(text)
    cut = F.col("form") != "plain"
    return rows.select("doc_id", F.col("cut.n").alias("n"), "form", F.when(cut, F.col("cut.prefix")).alias("prefix_chars"), F.when(cut, F.col("cut.middle")).alias("middle_chars"), output.alias("output"))


_TOKENS = "regexp_extract_all(text, '[A-Za-z]+|[^A-Za-z]')"

#: The digest of ``transform`` for DuckDB.
SQL = f"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS text, sha256('1:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h FROM documents),
t AS (SELECT *, {_TOKENS} AS tokens, CAST('0x' || h[1:8] AS BIGINT) AS h1, CAST('0x' || h[9:16] AS BIGINT) AS h2, CAST('0x' || h[17:24] AS BIGINT) AS h3, CAST('0x' || h[25:32] AS BIGINT) AS h4 FROM d),
c AS (SELECT *, len(tokens) AS n, least(h1 % (len(tokens) + 1), h2 % (len(tokens) + 1)) AS a, greatest(h1 % (len(tokens) + 1), h2 % (len(tokens) + 1)) AS b,
  CASE WHEN text = '' OR contains(text, '{PREFIX}') OR contains(text, '{SUFFIX}') OR contains(text, '{MIDDLE}') OR h3 % 100 >= {RATE} THEN 'plain' WHEN h4 % 100 < {SUFFIX_FIRST} THEN 'spm' ELSE 'psm' END AS form FROM t),
p AS (SELECT doc_id, text, n, form, array_to_string(tokens[1:a], '') AS p, array_to_string(tokens[a + 1:b], '') AS m, array_to_string(tokens[b + 1:], '') AS s FROM c)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(p) END AS prefix_chars, CASE WHEN form <> 'plain' THEN length(m) END AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '{PREFIX}' || p || '{SUFFIX}' || s || '{MIDDLE}' || m ELSE '{SUFFIX}' || s || '{PREFIX}' || p || '{MIDDLE}' || m END) AS output_sha256,
  sha256(text) AS restored_sha256 FROM p"""
