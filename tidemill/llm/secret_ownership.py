"""Secret scans with corpus-wide ownership frequency.

Candidates are found in whole texts and hashed. A candidate seen under several owners or in many repositories is a widely
copied example; one that a single owner has, and that looks random, is live-looking. Plain kinds (an assignment, an access key
id, a hex string) are always reported; tokens of no known kind are reported only if their ownership marks them as live.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections import Counter

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemill.llm.stage import settle

KINDS = ("assign", "access", "hex")
#: A candidate of more owners or repositories than these is a copied example.
OWNERS, REPOSITORIES = 1, 3
#: Least length and bits a character of a token of no known kind.
TOKEN_LENGTH, TOKEN_BITS = 20, 3.5
_ASSIGN = re.compile(r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII)
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
_HEX = re.compile(r"[0-9a-f]{24,}")
_TOKEN = re.compile(r"[A-Za-z0-9+/_=-]{%d,}" % TOKEN_LENGTH)
_SPANS = "array<struct<kind:string,rank:int,from:int,to:int,digest:string>>"


def base_spans(text: str) -> list[tuple[int, int, int, str]]:
    """(start, end, index of the kind, value) of the plain kinds, leftmost and non-overlapping in each kind, in order."""
    out = [(m.start(), m.end(), 0, m[1]) for m in _ASSIGN.finditer(text) if len(m[1]) >= 6]
    out += [(m.start(), m.end(), 1, m[0]) for m in _ACCESS.finditer(text) if len(m[0]) >= 20]
    out += [(m.start(), m.end(), 2, m[0]) for m in _HEX.finditer(text)]
    return sorted(out)


def _random_looking(value: str) -> bool:
    """Letters of both cases and digits, with many different characters."""
    if not (re.search("[0-9]", value) and re.search("[a-z]", value) and re.search("[A-Z]", value)):
        return False
    bits = -sum(n / len(value) * math.log2(n / len(value)) for n in Counter(value).values())
    return bits >= TOKEN_BITS


def token_spans(text: str, taken: list[tuple[int, int]]) -> list[tuple[int, int, str]]:
    """Random-looking tokens outside the spans that are taken, which are in order of their starts; both are gone through once."""
    out, at, covered = [], 0, 0
    for m in _TOKEN.finditer(text):
        # ``covered`` is the furthest end of the spans that start ahead of the token's end; spans of several kinds may overlap.
        while at < len(taken) and taken[at][0] < m.end():
            covered = max(covered, taken[at][1])
            at += 1
        if covered <= m.start() and _random_looking(m[0]):
            out.append((m.start(), m.end(), m[0]))
    return out


def _digest(value: str) -> str:
    return hashlib.sha256(value.encode()).hexdigest()[:32]


def _scan(batches):
    for batch in batches:
        counts, digests, spans = [], [], []
        for text in batch.column("text").to_pylist():
            base = base_spans(text or "")
            extra = token_spans(text or "", [x[:2] for x in base])
            counts.append([sum(x[2] == k for x in base) for k in range(3)])
            digests.append(hashlib.sha256(",".join(f"{KINDS[k]}:{a}:{b}" for a, b, k, _ in base).encode()).hexdigest())
            rows = [(KINDS[k], k, a, b, _digest(v)) for a, b, k, v in base] + [("token", 3, a, b, _digest(v)) for a, b, v in extra]
            spans.append([dict(zip(("kind", "rank", "from", "to", "digest"), x, strict=True)) for x in rows])
        kind = pa.list_(pa.struct([("kind", pa.string()), ("rank", pa.int32()), ("from", pa.int32()), ("to", pa.int32()), ("digest", pa.string())]))
        columns = [batch.column(c) for c in ("row", "doc_id", "repository", "owner")]
        columns += [pa.array([c[k] for c in counts], pa.int64()) for k in range(3)] + [pa.array(digests), pa.array(spans, kind)]
        yield pa.RecordBatch.from_arrays(columns, ["row", "doc_id", "repository", "owner", "n_assign", "n_access", "n_hex", "base_sha256", "found"])


def scan(docs: DataFrame, repository: Column | None = None, owner: Column | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Find secrets in every text and class each candidate by who has it.

    ``repository`` and ``owner`` are columns of ``docs``; by default the source is the owner, and source and language are the
    repository. Returns one row per input row: ``doc_id``; ``n_assign``, ``n_access``, ``n_hex`` (plain spans); ``base_sha256`` of the plain
    spans; ``spans``, all reported spans as kind:start:end in code points, by start, then kind; ``judged``, all candidates in the same way with
    :example or :live behind each; ``n_examples`` and ``n_live``,
    the candidates that are copied examples, and that only one owner has in few repositories.

    A null text is empty. A null repository or owner counts as one of its own name. Rows with one id are scanned each for
    itself. A value that one document repeats counts once for its owner. Other columns are ignored; an empty table gives no rows.
    """
    repository = F.concat_ws("/", F.coalesce("source", F.lit("")), F.coalesce("lang", F.lit(""))) if repository is None else repository
    owner = F.col("source") if owner is None else owner
    rows = docs.select(
        F.col(id_col).cast("long").alias("doc_id"), F.coalesce(repository.cast("string"), F.lit("")).alias("repository"), F.coalesce(owner.cast("string"), F.lit("")).alias("owner"), F.col(text_col).alias("text")
    )
    rows = rows.withColumn("row", F.monotonically_increasing_id()).select("row", "doc_id", "repository", "owner", "text")
    found = settle(rows.mapInArrow(_scan, f"row long, doc_id long, repository string, owner string, n_assign long, n_access long, n_hex long, base_sha256 string, found {_SPANS}"))
    each = found.filter(F.size("found") > 0).select("row", "repository", "owner", F.explode("found").alias("x")).select("row", "repository", "owner", "x.*")
    who = each.select("digest", "repository", "owner").distinct().groupBy("digest").agg(F.count_distinct("owner").alias("owners"), F.count_distinct("repository").alias("repositories"))
    copied = F.coalesce((F.col("owners") > OWNERS) | (F.col("repositories") > REPOSITORIES), F.lit(False))
    judged = each.join(who, "digest").withColumn("copied", copied)
    shown = F.struct(F.col("from"), F.col("rank"), F.concat_ws(":", "kind", "from", "to").alias("said"))
    verdict = F.struct(F.col("from"), F.col("rank"), F.concat_ws(":", "kind", "from", "to", F.when(F.col("copied"), "example").otherwise("live")).alias("said"))
    judged = judged.groupBy("row").agg(
        F.collect_list(F.when((F.col("rank") < 3) | ~F.col("copied"), shown)).alias("shown"), F.collect_list(verdict).alias("judged"), F.count_if("copied").alias("n_examples"), F.count_if(~F.col("copied")).alias("n_live")
    )
    listed = lambda c: F.array_join(F.transform(F.array_sort(c), lambda x: x["said"]), ",")
    judged = judged.select("row", listed("shown").alias("spans"), listed("judged").alias("judged"), "n_examples", "n_live")
    zero = lambda c: F.coalesce(c, F.lit(0)).cast("long").alias(c)
    return found.drop("found", "repository", "owner").join(judged, "row", "left").select(
        "doc_id", "n_assign", "n_access", "n_hex", "base_sha256", F.coalesce("spans", F.lit("")).alias("spans"), F.coalesce("judged", F.lit("")).alias("judged"), zero("n_examples"), zero("n_live")
    )
