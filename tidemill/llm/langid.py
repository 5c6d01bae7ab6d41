"""Language identification by rank-order profiles.

A language's profile is its most frequent character n-grams in order of frequency, counted over all training documents. A
document's own most frequent n-grams are compared with each profile by the out-of-place distance: the sum of the
differences in rank, with the profile length for an n-gram that the profile lacks.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemill.llm.stage import drop, settle

#: N-grams in a profile, of a language or of a document.
TOP = 300
#: Longest n-gram, in letters. Three fit into one 64-bit number at 21 bits each.
LONGEST = 3
#: Code points of text counted at once; a longer document forms a block of its own.
BLOCK = 1 << 18
UNKNOWN = "und"


@cache
def _letters() -> np.ndarray:
    """For each code point: its lower-case letter, or 0 if it is no letter."""
    out = np.zeros(0x110000, np.uint32)
    for i in range(0x110000):
        c = chr(i)
        if c.isalpha():
            low = c.lower()
            out[i] = ord(low) if len(low) == 1 else i
    return out


def _blocks(texts: list[str | None]) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Blocks of whole documents: first row, letters (0 between words), and the document limits."""
    at = 0
    while at < len(texts):
        to, size, parts = at, 0, []
        while to < len(texts) and (to == at or size + len(texts[to] or "") < BLOCK):
            parts.append(np.frombuffer((texts[to] or "").encode("utf-32-le", "surrogatepass"), np.uint32))
            size += len(parts[-1])
            to += 1
        limits = np.concatenate([[0], np.cumsum([len(x) + 1 for x in parts])])
        joined = np.zeros(limits[-1] + LONGEST, np.uint32)
        for x, start in zip(parts, limits, strict=False):
            joined[start + 1 : start + 1 + len(x)] = _letters()[x]
        yield at, joined, limits
        at = to


def _grams(joined: np.ndarray, limits: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Packed n-grams of 1 to LONGEST characters with at least one letter, a word's border counting as a space; and their documents.

    A gram starts in its own document and never spans a word border in its middle, so it doesn't reach into the next document.
    """
    n = limits[-1]
    grams, docs = [], []
    doc = np.repeat(np.arange(len(limits) - 1, dtype=np.int64), np.diff(limits))
    word = joined.astype(np.int64)
    one, two, three = word[:n], word[1 : n + 1], word[2 : n + 2]
    for ok, packed in ((one > 0, one), ((one > 0) | (two > 0), one << 21 | two), ((two > 0) & ((one > 0) | (three > 0)), one << 42 | two << 21 | three)):
        at = np.flatnonzero(ok)
        size = len(grams) + 1
        grams.append(packed[at] | size << 62 if size == 1 else packed[at])
        docs.append(doc[at])
    return np.concatenate(grams), np.concatenate(docs)


def _counted(joined: np.ndarray, limits: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(document, gram, count), sorted by document and gram."""
    grams, docs = _grams(joined, limits)
    order = np.argsort(grams, kind="stable")
    grams, docs = grams[order], docs[order]
    order = np.argsort(docs.astype(np.uint16) if len(limits) < 65_000 else docs, kind="stable")
    grams, docs = grams[order], docs[order]
    new = np.flatnonzero(np.concatenate([[True], (grams[1:] != grams[:-1]) | (docs[1:] != docs[:-1])])) if len(grams) else np.zeros(0, np.int64)
    return docs[new], grams[new], np.diff(np.append(new, len(grams)))


def _count_batches(batches):
    """Sums of n-gram counts by language within a task's batch."""
    for batch in batches:
        langs = np.array(batch.column("lang").to_pylist(), object)
        held: dict[str, list] = {}
        for at, joined, limits in _blocks(batch.column("text").to_pylist()):
            docs, grams, counts = _counted(joined, limits)
            own = langs[at + docs] if len(docs) else docs
            for lang in set(own):
                hit = own == lang
                held.setdefault(lang, []).append((grams[hit], counts[hit]))
        for lang, parts in held.items():
            grams, place = np.unique(np.concatenate([p[0] for p in parts]), return_inverse=True)
            sums = np.bincount(place, np.concatenate([p[1] for p in parts])).astype(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(grams), pa.string()), pa.array(grams), pa.array(sums)], ["lang", "gram", "n"])


def train(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", top: int = TOP) -> DataFrame:
    """Profiles (lang, gram, rank from 0) counted over every row with a text and a language; ties go to the smaller n-gram."""
    rows = docs.select(F.col(text_col).alias("text"), F.col(lang_col).alias("lang")).filter("text is not null and lang is not null")
    counts = rows.mapInArrow(_count_batches, "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    # Filtered on the row number itself, so that each task hands on its first ones alone.
    place = F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("n"), "gram"))
    return counts.withColumn("place", place).filter(F.col("place") <= top).select("lang", "gram", (F.col("place") - 1).alias("rank"))


def _scorer(langs: list[str], grams: np.ndarray, ranks: np.ndarray, top: int):
    """grams: all n-grams of the profiles, sorted; ranks: for each (and a last row for none) its rank by language."""

    def run(batches):
        for batch in batches:
            texts, ids = batch.column("text").to_pylist(), batch.column("row")
            best, score = [UNKNOWN] * len(texts), np.zeros(len(texts))
            for at, joined, limits in _blocks(texts):
                docs, own, counts = _counted(joined, limits)
                if not len(docs) or not langs:
                    continue
                order = np.lexsort((own, -counts, docs))
                docs, own = docs[order], own[order]
                starts = np.searchsorted(docs, np.arange(len(limits) - 1))
                place = np.arange(len(docs)) - starts[docs]
                keep = place < top
                docs, own, place = docs[keep], own[keep], place[keep]
                hit = np.searchsorted(grams, own)
                hit[hit == len(grams)] = 0
                hit = np.where(grams[hit] == own, hit, len(grams))
                theirs = ranks[hit]
                apart = np.where(theirs < top, np.abs(theirs - place[:, None]), top)
                first = np.flatnonzero(np.concatenate([[True], docs[1:] != docs[:-1]]))
                sums = np.add.reduceat(apart, first, axis=0)
                sizes = np.diff(np.append(first, len(docs)))
                least = sums.argmin(axis=1)
                for d, lang, s in zip(docs[first], least, 1 - sums[np.arange(len(first)), least] / (sizes * top), strict=True):
                    best[at + d], score[at + d] = langs[lang], s
            yield pa.RecordBatch.from_arrays([ids, batch.column("held_out"), pa.array(best, pa.string()), pa.array(np.clip(score, 0, 1))], ["doc_id", "held_out", "lang_pred", "score"])

    return run


def identify(docs: DataFrame, folds: int = 5, held_fold: int = 0, top: int = TOP, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """Predict every row's language with profiles learned from the rows outside the held-out fold.

    A row is held out if ``crc32(id as text) mod folds`` is ``held_fold`` (a null id counts as the empty text); its language
    is never read. Returns ``doc_id``, ``held_out``, ``lang_pred`` and ``score``, 1 minus the distance as a share of the
    largest possible one. A null text, or one without a letter, gets ``und`` and 0, and so does every row if there is
    nothing to learn from. Equal distances go to the alphabetically first language. Rows with a null language teach nothing.
    Other columns are ignored; an empty table gives no rows.

    The profiles are collected: ``top`` n-grams for each language, however large the corpus is.
    """
    rows = docs.select(F.col(id_col).alias("row"), F.col(text_col).alias("text"), F.col(lang_col).cast("string").alias("lang"))
    rows = rows.withColumn("held_out", F.crc32(F.coalesce(F.col("row").cast("string"), F.lit(""))) % folds == held_fold)
    settled = settle(train(rows.filter("not held_out"), top=top))
    profiles = settled.collect()
    drop(settled)
    langs = sorted({r.lang for r in profiles})
    grams = np.array(sorted({r.gram for r in profiles}), np.int64)
    ranks = np.full((len(grams) + 1, len(langs)), top, np.int64)
    for r in profiles:
        ranks[np.searchsorted(grams, r.gram), langs.index(r.lang)] = r.rank
    kind = docs.schema[id_col].dataType.simpleString()
    return rows.select("row", "text", "held_out").mapInArrow(_scorer(langs, grams, ranks, top), f"doc_id {kind}, held_out boolean, lang_pred string, score double")
