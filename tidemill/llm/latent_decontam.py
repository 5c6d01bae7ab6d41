"""Benchmark decontamination by latent semantic retrieval.

Benchmark items are cut into passages and weighted by TF-IDF, with document frequencies counted over the passages of the
whole corpus. A distributed randomised SVD of the benchmark passages gives a latent space; windows of every document are
projected into it and compared with the passages by cosine. Candidates are checked word by word: the longest common
subsequence with the passage, and for looser paraphrases whether the answer, the item's last sentence, is there too.

Items are taken in blocks whose passages fit the latent space, a few blocks to a pass over the corpus, so what is sent to
the tasks is bounded whatever the size of the benchmark.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemill.llm import textkit
from tidemill.llm.stage import drop, settle

#: Hashed terms; words in a corpus passage for document frequencies; share of passages from which a term has the least weight, and that weight.
TERMS, PASSAGE, COMMON, FLOOR = 1 << 18, 32, 0.02, 0.1
#: Dimensions of the latent space, at most, and passages in a block; oversampling and power iterations of the SVD; blocks in a pass.
LATENT, OVERSAMPLE, POWER, PASS_BLOCKS = 256, 16, 2, 16
#: The space keeps the fewest leading dimensions that leave every passage this share of its squared length; a copy of it scores the root of that.
KEEP = 0.5
#: Window lengths in words. A passage is compared with windows of the least length that holds it, a quarter apart.
WINDOWS = (8, 12, 16, 24, 32, 48, 64)
#: Least cosine of a candidate; least share of the passage in common order; the same where the answer is present, and the share of the answer.
COSINE, COPY, PARAPHRASE, ANSWER = 0.4, 0.75, 0.55, 0.8
_BREAK = np.arange(256, dtype=np.uint8)
_BREAK[[i for i in range(128) if not chr(i).isalnum()]] = 32


def _words(texts: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
    """For each block of documents: first row, word hashes, terms, and each document's first word. Words are runs of letters and digits in lower case."""
    texts = pc.utf8_lower(texts.cast(pa.large_string()).fill_null(""))
    for at, data, offsets in textkit.blocks(texts, 1 << 19):
        data = _BREAK[data]
        starts, ends, first = textkit.words(data, offsets)
        hashes = textkit.span_hashes(data, starts, ends)
        yield at, hashes, (hashes >> np.uint64(46)).astype(np.int64), first


def _frequencies(batches):
    """Passages of a task that have each term."""
    seen, passages = np.zeros(TERMS, np.int64), 0
    for batch in batches:
        for _, _, terms, first in _words(batch.column("text")):
            count = np.diff(first)
            place = np.arange(len(terms)) - np.repeat(first[:-1], count)
            new = place % PASSAGE == 0
            own = np.cumsum(new) - 1
            passages += int(new.sum())
            seen += np.bincount(np.unique(own * TERMS + terms) % TERMS, minlength=TERMS)
    hit = np.flatnonzero(seen)
    yield pa.RecordBatch.from_arrays([pa.array(np.append(hit, -1).astype(np.int32)), pa.array(np.append(seen[hit], passages))], ["term", "n"])


def term_weights(docs: DataFrame) -> np.ndarray:
    """Inverse document frequency of each hashed term over all passages of the corpus, less that of a common term, and FLOOR for those more common."""
    counts = docs.mapInArrow(_frequencies, "term int, n long").groupBy("term").agg(F.sum("n").alias("n")).toArrow()  # TERMS + 1 rows at most
    term, n = counts.column("term").to_numpy(), counts.column("n").to_numpy()
    df = np.zeros(TERMS)
    df[term[term >= 0]] = n[term >= 0]
    total = max(int(n[term < 0].sum()), 1)
    return np.maximum(np.log(total / (1 + df)) + np.log(COMMON), FLOOR).astype(np.float32)


@dataclass
class _Passage:
    item: int
    hashes: np.ndarray
    answer: np.ndarray


def _passages(items: list[tuple[int, str | None]]) -> list[_Passage]:
    """Items cut into pieces of the longest window; the answer goes with the piece that ends the item."""
    out = []
    for item, text in items:
        hashes = next(_words(pa.array([text or ""])))[1]
        sentences = [s for s in re.split(r"(?<=[.!?])\s+|\n+", text or "") if re.search(r"\w", s)]
        answer = next(_words(pa.array([sentences[-1]])))[1] if len(sentences) > 1 else hashes[-max(3, len(hashes) // 4) :]
        pieces = [hashes[i : i + WINDOWS[-1]] for i in range(0, len(hashes), WINDOWS[-1])]
        if len(pieces) > 1 and len(pieces[-1]) < WINDOWS[-1] // 2:
            pieces[-1] = hashes[-WINDOWS[-1] :]
        out += [_Passage(item, p, answer if i == len(pieces) - 1 else answer[:0]) for i, p in enumerate(pieces) if len(p)]
    return out


@dataclass
class LatentBlock:
    """A block of passages in its latent space. ``row`` gives a term's row in ``space``, the last row (zeros) for terms outside the block."""

    passages: list[_Passage]
    row: np.ndarray
    space: np.ndarray
    vectors: np.ndarray


def _products(passages: list[tuple[np.ndarray, np.ndarray]], basis: np.ndarray) -> np.ndarray:
    """A' A times a basis, for passages given as term rows and weights."""
    out = np.zeros_like(basis)
    for rows, w in passages:
        np.add.at(out, rows, np.outer(w, w @ basis[rows]))
    return out


def _svd(spark, passages: list[tuple[np.ndarray, np.ndarray]], terms: int, k: int, seed: int = 1) -> np.ndarray:
    """The k leading right singular vectors of a sparse matrix of passages by randomised subspace iteration.

    The passages lie in a table of four partitions; each task adds up its part of A' A Q, the driver adds the four parts and
    orthonormalises the basis, which has the block's terms times k numbers.
    """
    table = settle(spark.createDataFrame([(rows.tolist(), w.tolist()) for rows, w in passages], "rows array<int>, weights array<double>").repartition(4))

    def times(basis: np.ndarray) -> np.ndarray:
        sent = spark.sparkContext.broadcast(basis.astype(np.float64))

        def part(batches):
            for batch in batches:
                own = [(np.array(r), np.array(w)) for r, w in zip(batch.column("rows").to_pylist(), batch.column("weights").to_pylist(), strict=True)]
                made = _products(own, sent.value)
                hit = np.flatnonzero(made.any(axis=1))
                yield pa.RecordBatch.from_arrays([pa.array(hit.astype(np.int32)), pa.array(list(made[hit]), pa.list_(pa.float64()))], ["term", "sums"])

        # The tasks' parts, each of a block's terms at most, reach the driver as Arrow and are added there.
        rows = table.mapInArrow(part, "term int, sums array<double>").toArrow()
        out = np.zeros_like(basis)
        if rows.num_rows:
            np.add.at(out, rows.column("term").to_numpy(), rows.column("sums").combine_chunks().flatten().to_numpy().reshape(rows.num_rows, -1))
        sent.destroy()
        return out

    basis = np.linalg.qr(np.random.default_rng(seed).standard_normal((terms, min(k + OVERSAMPLE, terms))))[0]
    for _ in range(POWER):
        basis = np.linalg.qr(times(basis))[0]
    small = basis.T @ times(basis)
    values, turn = np.linalg.eigh((small + small.T) / 2)
    drop(table)
    return basis @ turn[:, np.argsort(-values)[:k]]


def _fit(spark, passages: list[_Passage], weights: np.ndarray) -> LatentBlock:
    own = []
    for p in passages:
        terms, tf = np.unique((p.hashes >> np.uint64(46)).astype(np.int64), return_counts=True)
        w = tf * weights[terms]
        own.append((terms, w / max(np.sqrt((w**2).sum()), 1e-9)))
    vocabulary = np.unique(np.concatenate([t for t, _ in own]))
    row = np.full(TERMS, len(vocabulary), np.int32)
    row[vocabulary] = np.arange(len(vocabulary))
    sparse = [(row[t].astype(np.int64), w) for t, w in own]
    k = min(LATENT, len(passages), len(vocabulary))
    space = _svd(spark, sparse, len(vocabulary), k)
    vectors = np.stack([w @ space[r] for r, w in sparse]).astype(np.float32)
    held = np.cumsum(vectors.astype(np.float64) ** 2, axis=1)
    k = min(k, int((held.min(axis=0) < KEEP * min(1.0, held[:, -1].min())).sum()) + 1)
    space, vectors = space[:, :k], vectors[:, :k]
    space = np.concatenate([space, np.zeros((1, k))]) * np.append(weights[vocabulary], 0)[:, None]
    return LatentBlock(passages, row, space.astype(np.float32), vectors)


def common_length(a: list[int], b: list[int]) -> int:
    """Length of the longest common subsequence, by bit-parallel rows."""
    places: dict[int, int] = {}
    for i, x in enumerate(a):
        places[x] = places.get(x, 0) | 1 << i
    full = (1 << len(a)) - 1
    row = full
    for x in b:
        hit = row & places.get(x, 0)
        row = (row + hit | row - hit) & full
    return len(a) - row.bit_count()


@dataclass
class _Plan:
    """The passages of a block that are compared with windows of one size.

    A window's latent vector is the sum of its terms' vectors, so its product with a passage's is the sum of theirs: ``against`` has a row
    for each term. ``weight`` has the squared weights of a passage's own terms. A window's norm is that of the words it shares with the
    passage's vocabulary, so that foreign words beside a copy can't hide it. As a term's product is at most ``scale`` times that squared
    weight, products of at least ``least`` are needed, and ``bound`` sums to 1 at least over the terms of any window that has one.
    """

    passages: list[_Passage]
    size: int
    row: np.ndarray
    against: np.ndarray
    weight: np.ndarray
    least: np.ndarray
    bound: np.ndarray


def _plans(block: LatentBlock, weights: np.ndarray) -> Iterator[_Plan]:
    for size in WINDOWS:
        low = max([w for w in WINDOWS if w < size], default=0)
        mine = [i for i, p in enumerate(block.passages) if low < len(p.hashes) <= size]
        if not mine:
            continue
        # Compared with a passage's direction in the space, so that one of which the space keeps less isn't harder to find.
        direction = block.vectors[mine] / np.maximum(np.sqrt((block.vectors[mine] ** 2).sum(axis=1, keepdims=True)), 1e-9)
        against = np.ascontiguousarray(block.space @ direction.T)
        weight = np.zeros_like(against)
        for j, i in enumerate(mine):
            terms = np.unique((block.passages[i].hashes >> np.uint64(46)).astype(np.int64))
            weight[block.row[terms], j] = weights[terms] ** 2
        scale = np.max(against / np.maximum(weight, 1e-9), axis=0, where=weight > 0, initial=1e-9)
        # A little less, as products are rounded.
        least = (0.999 * COSINE**2 / scale).astype(np.float32)
        yield _Plan([block.passages[i] for i in mine], size, block.row, against, weight, least, np.maximum(against / least, 0).max(axis=1))


def _search(sent):
    def run(batches):
        blocks, weights = sent.value
        plans = [p for x in blocks for p in _plans(x, weights)]
        for batch in batches:
            found: list[tuple] = []
            for at, hashes, terms, first in _words(batch.column("text")):
                count = np.diff(first)
                for plan in plans:
                    rows, step = plan.row[terms], plan.size // 4
                    part = np.concatenate([[0], np.cumsum(plan.bound[rows], dtype=np.float64)])
                    n = np.where(count > 0, np.maximum(-(-(count - plan.size) // step), 0) + 1, 0)
                    doc = np.repeat(np.arange(len(count)), n)
                    start = first[doc] + (np.arange(len(doc)) - np.repeat(np.cumsum(n) - n, n)) * step
                    end = np.minimum(start + plan.size, first[doc + 1])
                    may = np.flatnonzero(part[end] - part[start] >= 0.999)
                    for some in np.array_split(may, len(may) // 512 + 1):
                        if len(some):
                            found += _compare(plan, hashes, rows, first, at, doc[some], start[some], end[some])
            ids = batch.column("id")
            yield pa.RecordBatch.from_arrays(
                [ids.take(pa.array([f[0] for f in found], pa.int64())), *(pa.array([f[i] for f in found], kind) for i, kind in ((1, pa.int64()), (2, pa.float64()), (3, pa.float64()), (4, pa.float64())))],
                ["doc_id", "item_id", "cosine", "common", "answer"],
            )

    return run


def _compare(plan: _Plan, hashes, rows, first, at, doc, start, end) -> list[tuple]:
    """Windows that hold a passage, as (row, item, cosine, common share, answer share)."""
    where = start[:, None] + np.arange(plan.size)
    held = np.where(where < end[:, None], rows[np.minimum(where, len(rows) - 1)], len(plan.against) - 1)
    products = plan.against[held].sum(axis=1)
    out = []
    for i, j in zip(*np.nonzero(products >= plan.least), strict=True):
        cosine = products[i, j] / np.sqrt(max(plan.weight[held[i], j].sum(), 1e-9))
        if cosine < COSINE:
            continue
        p = plan.passages[j]
        # The passage may begin and end outside the window.
        around = hashes[max(first[doc[i]], start[i] - plan.size // 2) : min(first[doc[i] + 1], end[i] + plan.size // 2)].tolist()
        common = common_length(p.hashes.tolist(), around) / len(p.hashes)
        if common >= PARAPHRASE:
            answer = common_length(p.answer.tolist(), around) / len(p.answer) if len(p.answer) else 0.0
            if common >= COPY or answer >= ANSWER:
                out.append((at + doc[i], p.item, float(min(cosine, 1.0)), common, answer))
    return out


def contaminated(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Documents that hold a benchmark item, copied or paraphrased.

    Returns one row for each (``doc_id``, ``item_id``) found, with the best ``cosine``, ``common`` (share of a passage in common order) and
    ``answer`` (share of the answer). Words are runs of letters and digits, compared in lower case.

    Null texts and items, and texts without a word, match nothing; rows with a null id are reported under null. Equal items are reported each;
    repeated rows with one id together. Other columns are ignored; an empty corpus or benchmark gives no rows.
    """
    spark = docs.sparkSession
    docs = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    items = benchmark.select(F.col("item_id").cast("long").alias("item_id"), "text").filter("item_id is not null and text is not null")
    items = settle(items)
    pieces = F.greatest(F.lit(1), F.ceil(F.regexp_count("text", F.lit(r"[\p{L}\p{N}]++")) / WINDOWS[-1]))
    rounds = int(items.agg(F.sum(pieces)).first()[0] or 0) // (LATENT * PASS_BLOCKS // 2) + 1
    weights = term_weights(docs)
    found = []
    for turn in range(rounds):
        own = items.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(rounds)) == turn).collect()  # a bounded share of the benchmark
        passages = _passages(sorted((r.item_id, r.text) for r in own))
        # What is sent at once is PASS_BLOCKS blocks at most, however long the items are.
        for at in range(0, len(passages), LATENT * PASS_BLOCKS):
            some = passages[at : at + LATENT * PASS_BLOCKS]
            blocks = [_fit(spark, some[i : i + LATENT], weights) for i in range(0, len(some), LATENT)]
            sent = spark.sparkContext.broadcast((blocks, weights))
            found.append(settle(docs.mapInArrow(_search(sent), "doc_id long, item_id long, cosine double, common double, answer double")))
            sent.destroy()
    out = spark.createDataFrame([], "doc_id long, item_id long, cosine double, common double, answer double")
    for rows in found:
        out = out.union(rows)
    return out.groupBy("doc_id", "item_id").agg(*(F.max(c).alias(c) for c in ("cosine", "common", "answer")))
