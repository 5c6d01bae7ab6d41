"""Hard-negative mining by branch and bound in ball trees.

Every task packs the rows it reads into ball trees of bounded size, whose nodes know the range of their labels, and searches a block of anchors in
each. A node's ball bounds the inner products with an anchor from above and from below: nodes outside the wanted scores are pruned,
and so are nodes strictly beneath the least score among the best that the task has found so far, as a tie may still be won by a smaller id. Tasks
return their few best rows for each anchor, Spark merges them.

Anchors are taken in blocks of bounded size against all rows, first for their positives and then for the negatives of each positive.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemill.llm.stage import settle

#: Rows of a tree and of a leaf, at most.
TREE, LEAF = 8192, 64
#: Numbers in the vectors of a block of anchors, about (blocks are dealt by a hash), and in the products of a step of the search, at most.
BLOCK_NUMBERS, STEP_NUMBERS = 16 << 20, 8 << 20
#: Magnitude up to which sums of products of whole numbers are exact as doubles.
_EXACT = 2.0**53
_MINED = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"
_FOUND = "anchor int, query int, vec_id long, score long"


def _rows(batch: pa.RecordBatch, scale: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Ids, labels and vectors (whole numbers, as doubles; shorter ones end in zeros) of the rows of a batch that take part."""
    vectors = batch.column("vector")
    size = pc.list_value_length(vectors).fill_null(0).to_numpy(zero_copy_only=False)
    flat = pc.list_flatten(vectors)
    value = np.floor(scale * flat.cast(pa.float64()).fill_null(np.nan).to_numpy(zero_copy_only=False))
    row = np.repeat(np.arange(len(size)), size)
    good = vectors.is_valid().to_numpy(zero_copy_only=False) & (np.bincount(row, ~np.isfinite(value), len(size)) == 0)
    made = np.zeros((len(size), size.max(initial=0)))
    made[row, np.arange(len(row)) - np.repeat(np.cumsum(size) - size, size)] = value
    for c in ("vec_id", "label"):
        good &= batch.column(c).is_valid().to_numpy(zero_copy_only=False)
    ids, labels = (batch.column(c).fill_null(0).to_numpy(zero_copy_only=False) for c in ("vec_id", "label"))
    return ids[good], labels[good], made[good]


def _widened(a: np.ndarray, width: int) -> np.ndarray:
    return np.pad(a, ((0, 0), (0, width - a.shape[1]))) if a.shape[1] < width else a


class BallTree:
    """A tree over some rows. A node holds the rows ``begin`` to ``end`` of the tree's order, in a ball around ``center``; ``child`` has the places of its two children, or -1."""

    def __init__(self, ids: np.ndarray, labels: np.ndarray, vectors: np.ndarray):
        order = np.argsort(labels, kind="stable")
        self.ids, self.labels, self.vectors = ids[order], labels[order], vectors[order]
        begin, end, child, center, radius = [], [], [], [], []
        todo = [(0, len(ids), -1)]
        while todo:
            a, b, parent = todo.pop()
            at = len(begin)
            if parent >= 0:
                child[parent][int(child[parent][0] >= 0)] = at
            rows = self.vectors[a:b]
            middle = rows.mean(axis=0)
            far = ((rows - middle) ** 2).sum(axis=1)
            begin.append(a)
            end.append(b)
            child.append([-1, -1])
            center.append(middle)
            radius.append(np.sqrt(far.max()))
            if b - a > LEAF:
                cut = self._split(a, b, far)
                todo += [(a, cut, at), (cut, b, at)]
        self.begin, self.end, self.child = np.array(begin), np.array(end), np.array(child)
        self.center, self.radius = np.array(center), np.array(radius)
        self.least, self.most = self.labels[self.begin], self.labels[self.end - 1]  # rows stay in order of their labels

    def _split(self, a: int, b: int, far: np.ndarray) -> int:
        """Where the rows of a node are cut: between labels if it has several, else halfway along the line between two rows that are far apart."""
        labels = self.labels[a:b]
        if labels[0] != labels[-1]:
            change = np.flatnonzero(labels[1:] != labels[:-1]) + 1
            return a + int(change[np.argmin(np.abs(change - (b - a) // 2))])
        rows = self.vectors[a:b]
        one = rows[far.argmax()]
        other = rows[((rows - one) ** 2).sum(axis=1).argmax()]
        order = np.argsort(rows @ (other - one), kind="stable")
        self.vectors[a:b], self.ids[a:b] = rows[order], self.ids[a:b][order]
        return a + (b - a) // 2


@dataclass
class Queries:
    """Anchors, and what is looked for: rows of an anchor's label or of others, and for each query its anchor (in ascending order) and the limits of scores."""

    ids: np.ndarray
    labels: np.ndarray
    vectors: np.ndarray
    same: bool
    anchor: np.ndarray
    least: np.ndarray
    most: np.ndarray


_NONE, _LAST = np.iinfo(np.int64).min, np.iinfo(np.int64).max


class _Best:
    """The best rows of each query so far: scores (descending) and ids, the smaller id first in a tie; each (score, id) once."""

    def __init__(self, queries: int, k: int):
        self.k = k
        self.score = np.full((queries, k), _NONE)
        self.id = np.full((queries, k), _LAST)

    def add(self, query: np.ndarray, score: np.ndarray, ids: np.ndarray) -> None:
        """Take in some (query, score, id)."""
        touched = np.unique(query)
        query = np.concatenate([query, np.repeat(touched, self.k)])
        score, ids = np.concatenate([score, self.score[touched].ravel()]), np.concatenate([ids, self.id[touched].ravel()])
        order = np.lexsort((ids, ~score, query))
        query, score, ids = query[order], score[order], ids[order]
        new = np.append(True, (query[1:] != query[:-1]) | (score[1:] != score[:-1]) | (ids[1:] != ids[:-1])) & (score > _NONE)
        query, score, ids = query[new], score[new], ids[new]
        rank = np.arange(len(query)) - np.searchsorted(query, query)
        keep = rank < self.k
        self.score[touched], self.id[touched] = _NONE, _LAST
        self.score[query[keep], rank[keep]], self.id[query[keep], rank[keep]] = score[keep], ids[keep]


def _products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact inner products of the rows of two tables of whole numbers: by doubles where all sums are exact, else by Python's integers."""
    if a.size and b.size and np.abs(a).max() * np.abs(b).max() * a.shape[1] >= _EXACT:
        whole = np.vectorize(int, otypes=[object])
        made = whole(a) @ whole(b).T
        return np.clip(made, int(_NONE) + 1, int(_LAST)).astype(np.int64)
    return (a @ b.T).astype(np.int64)


def search(tree: BallTree, queries: Queries, best: _Best) -> None:
    """Add a tree's rows to the best of each query."""
    width = max(tree.vectors.shape[1], queries.vectors.shape[1])
    rows, center, anchors = (_widened(x, width) for x in (tree.vectors, tree.center, queries.vectors))
    first = np.searchsorted(queries.anchor, np.arange(len(anchors) + 1))
    having = np.flatnonzero(np.diff(first))
    step = max(1, STEP_NUMBERS // (len(tree.begin) * max(1, len(queries.anchor) // max(len(having), 1))))
    for a in range(0, len(having), step):
        _search_some(tree, rows, center, anchors, queries, best, having[a : a + step], first)


def _search_some(tree: BallTree, rows: np.ndarray, center: np.ndarray, anchors: np.ndarray, queries: Queries, best: _Best, mine: np.ndarray, first: np.ndarray) -> None:
    """The same for some of the anchors, all of which have queries."""
    size = first[mine + 1] - first[mine]
    query = np.repeat(first[mine] - np.cumsum(size) + size, size) + np.arange(size.sum())
    start, of = np.cumsum(size) - size, np.repeat(np.arange(len(mine)), size)
    middle = anchors[mine] @ center.T
    reach = np.sqrt((anchors[mine] ** 2).sum(axis=1))[:, None] * tree.radius
    slack = 1e-9 * (np.abs(middle) + reach) + 1e-6  # products and radii are rounded
    upper, lower = (np.clip(x, float(_NONE), float(_LAST)) for x in (middle + reach + slack, middle - reach - slack))
    label = queries.labels[mine][:, None]
    fits = (tree.least <= label) & (label <= tree.most) if queries.same else (tree.least != label) | (tree.most != label)
    # A node is pruned if for each query of the anchor its scores are outside the limits or strictly beneath the last of the best.
    within = (upper[of] >= queries.least[query][:, None]) & (lower[of] <= queries.most[query][:, None]) & (upper[of] >= best.score[query, -1:])
    within = fits & np.logical_or.reduceat(within, start, axis=0)
    opened = np.zeros(within.shape, bool)
    opened[:, 0] = True
    for node in range(len(tree.begin)):  # parents stand ahead of their children
        opened[:, node] &= within[:, node]
        if tree.child[node, 0] >= 0:
            opened[:, tree.child[node]] = opened[:, node, None]
    one, node = np.nonzero(opened & (tree.child[:, 0] < 0))
    # In each turn every anchor meets the most promising of its leaves that are left.
    order = np.lexsort((-upper[one, node], one))
    one, node = one[order], node[order]
    turn = np.arange(len(one)) - np.searchsorted(one, one)
    order = np.lexsort((node, turn))
    one, node = one[order], node[order]
    limits = np.searchsorted(turn[order], np.arange(turn.max(initial=-1) + 2))
    for lo, hi in zip(limits[:-1], limits[1:], strict=True):
        last = np.minimum.reduceat(best.score[query, -1], start)
        some = np.flatnonzero(upper[one[lo:hi], node[lo:hi]] >= last[one[lo:hi]]) + lo
        found = []
        for group in np.split(some, np.flatnonzero(np.diff(node[some])) + 1):
            if len(group):
                found.append(_visit(tree, node[group[0]], rows, anchors, queries, best, mine[one[group]], first))
        if found:
            best.add(*(np.concatenate(x) for x in zip(*found, strict=True)))


def _visit(tree: BallTree, node: int, rows: np.ndarray, anchors: np.ndarray, queries: Queries, best: _Best, mine: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Compare anchors with the rows of a leaf: (query, score, id) of what may be among the best."""
    held = slice(tree.begin[node], tree.end[node])
    score = _products(anchors[mine], rows[held])
    fits = ((tree.labels[held] == queries.labels[mine][:, None]) == queries.same) & (tree.ids[held] != queries.ids[mine][:, None])
    size = first[mine + 1] - first[mine]
    query = np.repeat(first[mine] - np.cumsum(size) + size, size) + np.arange(size.sum())
    of = np.repeat(np.arange(len(mine)), size)
    one, place = np.nonzero(fits[of] & (score[of] >= queries.least[query][:, None]) & (score[of] <= queries.most[query][:, None]) & (score[of] >= best.score[query, -1:]))
    return query[one], score[of[one], place], tree.ids[held][place]


def _trees(batches: Iterator[pa.RecordBatch], scale: float) -> Iterator[BallTree]:
    """The rows of a task in trees of bounded size."""
    held: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    for batch in batches:
        for at in range(0, batch.num_rows, TREE):
            rows = _rows(batch.slice(at, TREE), scale)
            if held and sum(len(x[0]) for x in held) + len(rows[0]) > TREE:
                yield _grown(held)
                held = []
            if len(rows[0]):
                held.append(rows)
    if held:
        yield _grown(held)


def _grown(held: list[tuple[np.ndarray, np.ndarray, np.ndarray]]) -> BallTree:
    width = max(x[2].shape[1] for x in held)
    return BallTree(np.concatenate([x[0] for x in held]), np.concatenate([x[1] for x in held]), np.concatenate([_widened(x[2], width) for x in held]))


def _searched(sent, scale: float, k: int):
    def run(batches):
        queries = sent.value
        best = _Best(len(queries.anchor), k)
        for tree in _trees(batches, scale):
            search(tree, queries, best)
        query, rank = np.nonzero(best.score > _NONE)
        yield pa.RecordBatch.from_arrays([pa.array(queries.anchor[query].astype(np.int32)), pa.array(query.astype(np.int32)), pa.array(best.id[query, rank]), pa.array(best.score[query, rank])], ["anchor", "query", "vec_id", "score"])

    return run


def _best_rows(rows: DataFrame, queries: Queries, scale: float, k: int) -> DataFrame:
    """The best rows of each query over all tasks, with their ``rank`` from 1."""
    sent = rows.sparkSession.sparkContext.broadcast(queries)
    found = settle(rows.mapInArrow(_searched(sent, scale, k), _FOUND))
    sent.destroy()
    order = Window.partitionBy("query").orderBy(F.desc("score"), "vec_id")
    return found.distinct().withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def mine(
    rows: DataFrame, anchor: Column, label: Column | None = None, scale: float = 1.0, positives: int = 5, negatives: int = 5, window: tuple[int, int] = (80, 100), id_col: str = "vec_id", vector_col: str = "embedding"
) -> DataFrame:
    """Hard negatives: ``anchor_id``, ``positive_id``, ``rank`` (from 1), ``negative_id``, ``positive_score`` and ``negative_score``.

    Scores are inner products of the vectors' components, each multiplied by ``scale`` and rounded down; higher ones come first, ties by smaller id. Each row for which ``anchor`` holds
    has its first other rows of the same label as positives; the negatives of a positive are the first rows of other labels whose score lies
    within ``window``, per cent of the positive's.

    Rows without an id, label or vector, or with a component that is null or not finite, take no part. Vectors of different lengths are compared as if the shorter ended in
    zeros, an empty one scores 0. Rows with one id are never each other's positive; of several with one id and one score the id is listed once; equal anchors are answered
    once, different ones with one id each for itself. A score beyond 64 bits counts as the greatest or least of them. Other columns are ignored; an empty table gives no rows.
    """
    spark = rows.sparkSession
    rows = rows.select(F.col(id_col).cast("long").alias("vec_id"), (F.col("label") if label is None else label).cast("long").alias("label"), F.col(vector_col).alias("vector"), F.coalesce(anchor, F.lit(False)).alias("is_anchor"))
    chosen = rows.filter("is_anchor").select("vec_id", "label", "vector").filter("vec_id is not null and label is not null and vector is not null").distinct()
    numbers = chosen.agg(F.sum(F.size("vector") + 8).alias("n")).first().n or 0
    blocks = int(numbers) * (positives + 1) // BLOCK_NUMBERS + 1
    rows = rows.select("vec_id", "label", "vector")
    parts = []
    for turn in range(blocks):
        own = chosen.filter(F.pmod(F.xxhash64("vec_id", "vector"), F.lit(blocks)) == turn).toArrow().combine_chunks()  # a bounded share of the anchors
        for batch in own.to_batches():
            ids, labels, vectors = _rows(batch, scale)
            n = len(ids)
            if not n:
                continue
            every = Queries(ids, labels, vectors, True, np.arange(n), np.full(n, _NONE), np.full(n, _LAST))
            first = _best_rows(rows, every, scale, positives).select("anchor", "vec_id", "score").toArrow()  # ``positives`` rows an anchor
            order = np.argsort(first.column("anchor").to_numpy(), kind="stable")
            at, positive, score = (first.column(c).to_numpy()[order] for c in ("anchor", "vec_id", "score"))
            # The least and the greatest whole number within the window.
            least, most = (np.array([f(int(x)) for x in score], np.int64) for f in (lambda x: -(-x * window[0] // 100), lambda x: x * window[1] // 100))
            found = _best_rows(rows, Queries(ids, labels, vectors, False, at, least, most), scale, negatives)
            known = spark.createDataFrame(pa.table({"query": pa.array(np.arange(len(at)), pa.int32()), "anchor_id": pa.array(ids[at]), "positive_id": pa.array(positive), "positive_score": pa.array(score)}))
            parts.append(settle(found.join(F.broadcast(known), "query").select("anchor_id", "positive_id", "rank", F.col("vec_id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score"))))
    return spark.read.schema(parts[0].schema).parquet(*(x._settled for x in parts)) if parts else spark.createDataFrame([], _MINED)


#: Hard negatives of ``embeddings`` for DuckDB.
SQL = """
WITH g AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT DISTINCT a.vec_id AS anchor_id, b.vec_id AS other, a.label = b.label AS same, CAST(list_sum(list_transform(list_zip(a.v, b.v), lambda p: p[1] * p[2])) AS BIGINT) AS score
  FROM g a, g b WHERE a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id),
p AS (SELECT anchor_id, other AS positive_id, score AS positive_score FROM s WHERE same QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other) <= 5)
SELECT p.anchor_id, positive_id, CAST(row_number() OVER (PARTITION BY p.anchor_id, positive_id ORDER BY score DESC, other) AS INTEGER) AS rank, other AS negative_id, positive_score, score AS negative_score
FROM p JOIN s ON s.anchor_id = p.anchor_id AND NOT same AND 80 * positive_score <= 100 * score AND 100 * score <= 100 * positive_score QUALIFY rank <= 5"""
