"""Reversible incremental line deduplication: exact reference tables behind sharded cuckoo filters.

The index of a corpus has three parts, all in the shared folder:

- references: one row for each (document, line key), so that documents can be taken out again;
- counts: for each key its number of documents and the least document that holds it, exact;
- filters: for each shard a cuckoo filter of the keys held by two documents or more. It is asked before the exact table: a
  line whose key it does not know is kept without a lookup.

Each part is a list of pieces. An insertion or deletion of documents writes pieces for what it changes alone: the new
references or the ids that went, the counts of the keys they touch, and the filters of the shards in which a key came to two
documents or fell below, with just those keys added or deleted. The last piece that has a key or a shard counts.
``compact`` makes each part one piece again.

A key's shard is a function of its hash; there are as many as the keys and the references ask for. Where a shard still has many
references (a line that a third of all documents hold), its probes are dealt over several tasks that each get a copy of the
shard's filter; counts are summed before they are shuffled.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemill.llm import textkit
from tidemill.llm.stage import settle

#: Keys in a filter and probes in a task, on average at most.
SHARD_KEYS, TASK_PROBES = 50_000, 100_000
_SLOTS = 4
_LINE = "doc long, k1 long, k2 long"
_NONE = 2**63 - 1


class CuckooFilter:
    """Partial-key cuckoo filter over 64-bit hashes: buckets of four 16-bit fingerprints, 0 for none.

    Entries are added in bulk, in rounds of whole arrays. If some find no place the table doubles from the given keys, so an insertion never fails.
    """

    def __init__(self, table: np.ndarray):
        self.table = table

    @classmethod
    def build(cls, keys: np.ndarray) -> CuckooFilter:
        keys = np.unique(keys.astype(np.uint64))
        buckets = 1 << max(2, int(np.ceil(np.log2(max(1, len(keys)) / (_SLOTS * 0.85)))))
        while True:
            out = cls(np.zeros((buckets, _SLOTS), np.uint16))
            if not out.insert(keys):
                return out
            buckets *= 2

    def _places(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        mask = np.uint64(len(self.table) - 1)
        mark = (keys >> np.uint64(48)).astype(np.uint16)
        mark[mark == 0] = 1
        one = (keys & mask).astype(np.int64)
        return mark, one, self._other(one, mark)

    def _other(self, bucket: np.ndarray, mark: np.ndarray) -> np.ndarray:
        return bucket ^ (textkit._mix(mark.astype(np.uint64)) & np.uint64(len(self.table) - 1)).astype(np.int64)

    def insert(self, keys: np.ndarray, rounds: int = 200) -> int:
        """Add the keys; returns how many found no place."""
        mark, bucket, _ = self._places(keys)
        luck = np.random.default_rng(1)
        for turn in range(rounds):
            if not len(mark):
                break
            order = np.argsort(bucket, kind="stable")
            mark, bucket = mark[order], bucket[order]
            first = np.searchsorted(bucket, bucket)
            rank = np.arange(len(bucket)) - first
            free = self.table[bucket] == 0
            fits = rank < free.sum(axis=1)
            slot = np.argmax(np.cumsum(free, axis=1) > rank[:, None], axis=1)
            self.table[bucket[fits], slot[fits]] = mark[fits]
            mark, bucket, rank = mark[~fits], bucket[~fits], rank[~fits]
            if turn % 2 and len(mark):  # one of each full bucket takes another's place
                alone = np.flatnonzero(np.concatenate([[True], bucket[1:] != bucket[:-1]]))
                slot = luck.integers(0, _SLOTS, len(alone))
                out = self.table[bucket[alone], slot].copy()
                self.table[bucket[alone], slot] = mark[alone]
                mark[alone] = out
            bucket = self._other(bucket, mark)
        return len(mark)

    def contains(self, keys: np.ndarray) -> np.ndarray:
        mark, one, two = self._places(keys.astype(np.uint64))
        return ((self.table[one] == mark[:, None]) | (self.table[two] == mark[:, None])).any(axis=1)

    def delete(self, keys: np.ndarray) -> None:
        """Take out one entry for each key, which must have been added."""
        mark, one, two = self._places(keys.astype(np.uint64))
        while len(mark):
            hit = self.table[one] == mark[:, None]
            bucket = np.where(hit.any(axis=1), one, two)
            hit = self.table[bucket] == mark[:, None]
            place = bucket * _SLOTS + hit.argmax(axis=1)
            # Keys that share an entry take the next one in the next turn.
            found = np.flatnonzero(hit.any(axis=1))
            first = found[np.unique(place[found], return_index=True)[1]]
            self.table.reshape(-1)[place[first]] = 0
            left = np.setdiff1d(found, first)
            mark, one, two = mark[left], one[left], two[left]

    def to_bytes(self) -> bytes:
        return self.table.astype("<u2").tobytes()

    @classmethod
    def from_bytes(cls, data: bytes) -> CuckooFilter:
        return cls(np.frombuffer(data, "<u2").reshape(-1, _SLOTS).copy())


def _lines(data: np.ndarray, offsets: np.ndarray, shortest: int):
    """Byte limits of all lines, their documents, key hashes, and whether the key is long enough to be deduplicated."""
    starts, ends, docs = textkit.lines(data, offsets)
    ink = ~textkit._SPACE[data]
    where = np.append(np.flatnonzero(ink), len(data))
    left = where[np.searchsorted(where, starts)]
    before = np.searchsorted(where, ends) - 1
    right = np.where(before >= 0, where[np.maximum(before, 0)] + 1, 0)
    left = np.minimum(left, ends)
    right = np.maximum(right, left)
    points = textkit.code_points(data)
    k1 = textkit.span_hashes(data, left, right, lower=True)
    k2 = textkit.span_hashes(data[::-1], len(data) - right, len(data) - left, lower=True)
    return starts, ends, docs, k1.view(np.int64), k2.view(np.int64), points[right] - points[left] >= shortest


def _references(shortest: int):
    def run(batches):
        for batch in batches:
            ids = batch.column("doc").to_numpy()
            for at, data, offsets in textkit.blocks(batch.column("text"), 1 << 19):
                _, _, docs, k1, k2, ok = _lines(data, offsets, shortest)
                rows = np.unique(np.stack([docs[ok], k1[ok], k2[ok]]), axis=1)
                yield pa.RecordBatch.from_arrays([pa.array(ids[at + rows[0]]), pa.array(rows[1]), pa.array(rows[2])], ["doc", "k1", "k2"])

    return run


def _shard(shards: int) -> F.Column:
    return F.pmod(F.xxhash64("k1", "k2"), F.lit(shards)).cast("int")


def _build(key, table):
    made = CuckooFilter.build(table.column("k2").to_numpy().view(np.uint64))
    return pa.table({"shard": pa.array([key[0].as_py()], pa.int32()), "filter": pa.array([made.to_bytes()], pa.binary())})


def _probe(key, lines, filters):
    lines = lines.select(["doc", "k1", "k2"])
    if not filters.num_rows:
        return lines.slice(0, 0)
    known = CuckooFilter.from_bytes(filters.column("filter")[0].as_py()).contains(lines.column("k2").to_numpy().view(np.uint64))
    return lines.filter(pa.array(known))


def _change(key, changes, filters):
    """A shard's filter with the keys added that came to two documents and those deleted that fell below."""
    made = CuckooFilter.from_bytes(filters.column("filter")[0].as_py()) if filters.num_rows else CuckooFilter.build(np.zeros(0, np.uint64))
    keys, up = changes.column("k2").to_numpy().view(np.uint64), changes.column("up").to_numpy(zero_copy_only=False)
    made.delete(keys[~up])
    whole = not made.insert(keys[up])
    return pa.table({"shard": pa.array([key[0].as_py()], pa.int32()), "filter": pa.array([made.to_bytes() if whole else None], pa.binary())})


@dataclass
class LineIndex:
    """What is known of the lines of a set of documents. Every change returns a new index; the old one stays readable.

    ``references`` holds pieces (doc, k1, k2) and ``gone``, beside each, the ids deleted since; ``counts`` and ``filters`` hold pieces from old to new.
    """

    references: list[tuple[DataFrame, list[DataFrame]]]
    counts: list[DataFrame]
    filters: list[DataFrame]
    shards: int
    shortest: int

    @classmethod
    def _of(cls, references: DataFrame, shortest: int) -> LineIndex:
        counts = settle(cls._counted(references))
        # All references are probed, those of unique lines as well.
        repeated = counts.filter("refs > 1")
        shards = max(repeated.count() // SHARD_KEYS, references.count() // TASK_PROBES) + 1
        filters = settle(repeated.withColumn("shard", _shard(shards)).select("shard", "k2").groupBy("shard").applyInArrow(_build, "shard int, filter binary"))
        return cls([(references, [])], [counts], [filters], shards, shortest)

    @staticmethod
    def _counted(references: DataFrame) -> DataFrame:
        return references.groupBy("k1", "k2").agg(F.count_distinct("doc").alias("refs"), F.min("doc").alias("owner"))

    @classmethod
    def build(cls, docs: DataFrame, shortest: int = 10) -> LineIndex:
        """Index a table of (doc long, text string)."""
        return cls._of(settle(docs.mapInArrow(_references(shortest), _LINE).filter("doc is not null")), shortest)

    def all_references(self) -> DataFrame:
        out = None
        for piece, gone in self.references:
            for ids in gone:
                piece = piece.join(ids, "doc", "left_anti")
            out = piece if out is None else out.union(piece)
        return out

    def all_counts(self) -> DataFrame:
        """Keys with their documents and owner; keys that no document holds any more are left out."""
        return self._last(self.counts, ["k1", "k2"], ["refs", "owner"]).filter("refs > 0")

    def all_filters(self) -> DataFrame:
        return self._last(self.filters, ["shard"], ["filter"])

    @staticmethod
    def _last(pieces: list[DataFrame], keys: list[str], values: list[str]) -> DataFrame:
        if len(pieces) == 1:
            return pieces[0]
        every = None
        for i, piece in enumerate(pieces):
            piece = piece.select(*keys, F.struct(F.lit(i).alias("at"), *values).alias("x"))
            every = piece if every is None else every.union(piece)
        return every.groupBy(*keys).agg(F.max_by("x", F.col("x.at")).alias("x")).select(*keys, *(F.col(f"x.{v}").alias(v) for v in values))

    def _changed(self, references: list[tuple[DataFrame, list[DataFrame]]], touched: DataFrame) -> LineIndex:
        """The index with these references, of which those of the keys ``touched`` (k1, k2) have changed."""
        now = LineIndex(references, self.counts, self.filters, self.shards, self.shortest)
        touched = settle(touched.distinct())
        counts = touched.join(self._counted(now.all_references().join(touched, ["k1", "k2"], "left_semi")), ["k1", "k2"], "left")
        counts = settle(counts.select("k1", "k2", F.coalesce("refs", F.lit(0)).cast("long").alias("refs"), "owner"))
        before = self.all_counts().select("k1", "k2", F.col("refs").alias("had"))
        moved = counts.join(before, ["k1", "k2"], "left").withColumn("had", F.coalesce("had", F.lit(0))).filter("(refs > 1) != (had > 1)")
        moved = settle(moved.select(_shard(self.shards).alias("shard"), "k2", (F.col("refs") > 1).alias("up")))
        own = self.all_filters().join(moved.select("shard").distinct(), "shard", "left_semi")
        filters = settle(moved.groupBy("shard").cogroup(own.groupBy("shard")).applyInArrow(_change, "shard int, filter binary"))
        now.counts = [*self.counts, counts]
        full = filters.filter("filter is null").select("shard")
        # A filter without room for its new keys is built anew from its shard's keys.
        anew = now.all_counts().filter("refs > 1").withColumn("shard", _shard(self.shards)).join(full, "shard", "left_semi").select("shard", "k2")
        anew = settle(anew.groupBy("shard").applyInArrow(_build, "shard int, filter binary"))
        now.filters = [*self.filters, filters.filter("filter is not null"), anew]
        return now

    def insert(self, docs: DataFrame) -> LineIndex:
        """Add documents (doc, text). Those whose id is known gain lines. Only the keys of their lines are counted anew."""
        new = docs.mapInArrow(_references(self.shortest), _LINE).filter("doc is not null").distinct()
        new = settle(new.join(self.all_references(), ["doc", "k1", "k2"], "left_anti"))
        references = sum(piece.count() for piece, _ in self.references) + new.count()
        if references > 2 * self.shards * TASK_PROBES:
            # Twice what the shards were made for: the index gets as many as it needs now.
            return self._of(settle(self.all_references().union(new)), self.shortest)
        return self._changed([*self.references, (new, [])], new.select("k1", "k2"))

    def delete(self, ids: DataFrame) -> LineIndex:
        """Take documents (doc long) out. Keys lose their references; a line's owner passes to the next document that holds it. Only their keys are counted anew."""
        ids = settle(ids.select("doc").distinct())
        touched = self.all_references().join(ids, "doc", "left_semi").select("k1", "k2")
        return self._changed([(piece, [*gone, ids]) for piece, gone in self.references], touched)

    def compact(self) -> LineIndex:
        """The same index with one piece a part, and as many shards as its keys now ask for."""
        return self._of(settle(self.all_references()), self.shortest)

    def repeats(self) -> DataFrame:
        """References (doc, k1, k2) of lines that an earlier document holds: the filters are asked first, the exact counts then."""
        references, filters = self.all_references(), self.all_filters()
        sizes = references.groupBy(_shard(self.shards).alias("shard")).agg(F.count("*").alias("refs"))
        # Shards without a filter have no repeated key, so their references end here.
        copies = sizes.join(filters.select("shard"), "shard").select("shard", F.expr(f"cast(refs div {TASK_PROBES} as int) + 1").alias("copies"))
        # One small row for each shard.
        copies = F.broadcast(copies)
        filters = filters.join(copies, "shard").select("shard", "filter", F.explode(F.sequence(F.lit(0), F.col("copies") - 1)).alias("copy"))
        lines = references.withColumn("shard", _shard(self.shards)).join(copies, "shard")
        # Dealt by place, not by document: rows of one document id (all null ids are one) may be many.
        lines = lines.select("shard", F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.col("copies")).cast("int").alias("copy"), "doc", "k1", "k2")
        known = lines.groupBy("shard", "copy").cogroup(filters.groupBy("shard", "copy")).applyInArrow(_probe, _LINE)
        return known.join(self.all_counts().filter("refs > 1"), ["k1", "k2"]).filter("doc > owner").select("doc", "k1", "k2")


def _kept(shortest: int):
    def run(batches):
        for batch in batches:
            drops = batch.column("drops")
            texts = batch.column("text")
            for at, data, offsets in textkit.blocks(texts, 1 << 19):
                starts, ends, docs, k1, k2, ok = _lines(data, offsets, shortest)
                n = len(offsets) - 1
                held = drops.slice(at, n)
                flat = held.flatten()
                lengths = np.array([0 if x is None else x for x in pc.list_value_length(held).to_pylist()], np.int64)
                pairs = {*zip(np.repeat(np.arange(n), lengths).tolist(), flat.field("k1").to_pylist(), flat.field("k2").to_pylist(), strict=True)} if len(flat) else set()
                gone = np.zeros(len(starts), bool)
                if pairs:
                    touched = np.flatnonzero(ok & np.isin(docs, np.flatnonzero(lengths)))
                    gone[touched] = [x in pairs for x in zip(docs[touched].tolist(), k1[touched].tolist(), k2[touched].tolist(), strict=True)]
                raw = data.tobytes()
                lines, dropped, out = np.bincount(docs, minlength=n), np.bincount(docs[gone], minlength=n), []
                for i in range(n):
                    if dropped[i]:
                        own = slice(*np.searchsorted(docs, [i, i + 1]))
                        out.append(b"\n".join(raw[a:b] for a, b, g in zip(starts[own], ends[own], gone[own], strict=True) if not g).decode())
                    else:
                        out.append(raw[offsets[i] : offsets[i + 1]].decode())
                yield pa.RecordBatch.from_arrays([batch.column("id").slice(at, n), pa.array(lines.astype(np.int64)), pa.array(dropped.astype(np.int64)), pa.array(out, pa.string())], ["doc_id", "n_lines", "n_dropped", "kept"])

    return run


def dedup_lines(docs: DataFrame, shortest: int = 10, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Drop lines that an earlier document holds as well.

    Lines are split at newlines; a line's key is the line with white space ``[\\x20\\x09-\\x0D]`` stripped and A-Z
    lower-cased. Keys of at least ``shortest`` code points found in two documents or more keep their lines only in the
    document with the least id. Returns ``doc_id``, ``n_lines``, ``n_dropped`` and ``kept`` (the text that stays), one row per input row.

    A null or empty text is one empty line. A null id is one document behind all others. Rows with one id are one document:
    they don't count twice for a key. Other columns are ignored. An empty table gives no rows.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.coalesce(F.col(id_col).cast("long"), F.lit(_NONE)).alias("doc"), F.col(text_col).alias("text"))
    index = LineIndex.build(rows.select("doc", "text"), shortest)
    drops = index.repeats().filter(F.col("doc") != _NONE)
    # Rows without an id may be many: each is told apart by its place, so that none meets another's lines.
    nameless = settle(rows.filter("id is null").select(F.monotonically_increasing_id().alias("doc"), "text"))
    known = index.all_counts().filter(f"refs > 1 and owner < {_NONE}").select("k1", "k2")
    own = nameless.mapInArrow(_references(shortest), _LINE).join(known, ["k1", "k2"], "left_semi")
    gathered = lambda lines: lines.groupBy("doc").agg(F.collect_set(F.struct("k1", "k2")).alias("drops"))
    named = rows.filter("id is not null").join(gathered(drops), "doc", "left").select("id", "text", "drops")
    nameless = nameless.join(gathered(own), "doc", "left").select(F.lit(None).cast("long").alias("id"), "text", "drops")
    return named.union(nameless).mapInArrow(_kept(shortest), "doc_id long, n_lines long, n_dropped long, kept string")
