"""Toxicity by a counterfactual-regularised linear classifier.

A text is described by how densely it uses words and beginnings of words, so inflected forms that training never saw still count. The
units that tell toxic from clean labelled documents apart are chosen by Spark over a bounded sample of labelled rows, and a
logistic model is fitted on their densities. Sentences that name a group are fitted together with copies in which the group is swapped for another
one or for people in general; differences between the logits of such copies are penalised, so a neutral mention of a group doesn't
raise the score. Scoring is one pass over the texts without a shuffle.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemill.llm import textkit
from tidemill.llm.stage import drop, settle

#: Labelled rows of each class in the sample, about (rows are taken by a hash of their id), and characters of such a row at most.
TOXIC_ROWS, CLEAN_ROWS, ROW_CHARS = 4000, 8000, 16_000
#: Lengths of beginnings in code points (a whole word counts as well); units of the model at most; toxic documents of the sample that a unit is in at least.
BEGINNINGS, UNITS, LEAST_DOCS = (3, 4, 5, 6, 7, 8), 2000, 5
#: Words added to a text's length, so that one unit in a few words doesn't decide; factor of densities.
SLACK, DENSITY = 40, 50.0
#: Weights of the penalty on swapped groups and of the ridge penalty; steps of Newton's method.
SWAPPED, RIDGE, STEPS = 100.0, 3e-4, 30
#: Score from which a text counts as toxic.
TOXIC = 0.7
# Words for groups, which are swapped for each other; the last ones of each line name people in general.
GROUPS = (
    "women men girls boys muslims muslim jews jewish christians christian hindus buddhists atheists catholics gay lesbian bisexual transgender queer straight black white asian african arab latino "
    "mexican indian chinese immigrants refugees migrants foreigners disabled deaf blind elderly old young people persons",
    "frauen männer muslime juden christen hindus schwule lesben schwarze weiße asiaten afrikaner araber türken einwanderer flüchtlinge ausländer behinderte alte junge leute menschen",
    "femmes hommes musulmans juifs chrétiens hindous homosexuels lesbiennes noirs blancs asiatiques africains arabes immigrés réfugiés étrangers handicapés vieux jeunes gens personnes",
    "mujeres hombres musulmanes judíos cristianos hindúes homosexuales lesbianas negros blancos asiáticos africanos árabes inmigrantes refugiados extranjeros discapacitados ancianos jóvenes gente personas",
)
_BREAK = np.arange(256, dtype=np.uint8)
_BREAK[[i for i in range(128) if not chr(i).isalpha()]] = 32
_WHOLE = np.uint64(0xA5A5A5A5A5A5A5A5)


def _units(texts: pa.Array):
    """For each block of documents: its first row, the units of its words as a matrix of hashes (a row for each length and one for whole words, 0 where a word is not longer), and each document's first word.

    Words are runs of letters in lower case.
    """
    texts = pc.utf8_lower(texts.cast(pa.large_string()).fill_null(""))
    for at, data, offsets in textkit.blocks(texts, 1 << 19):
        data = _BREAK[data]
        starts, ends, first = textkit.words(data, offsets)
        points = textkit.code_points(data)
        where = np.append(np.flatnonzero(np.diff(points)), len(data))
        cut = [np.minimum(where[np.minimum(points[starts] + n, len(where) - 1)], ends) for n in BEGINNINGS]
        made = textkit.span_hashes(data, np.tile(starts, len(cut) + 1), np.concatenate([ends, *cut])).reshape(len(cut) + 1, -1)
        made[0] ^= _WHOLE
        for row, to in zip(made[1:], cut, strict=True):
            row[to == ends] = 0
        yield at, made, first


def _word_hash(word: str) -> np.uint64:
    """The unit of a whole word."""
    return next(_units(pa.array([word])))[1][0, 0]


@dataclass
class Toxicity:
    """A fitted model: hashes of the units in ascending order, their weights, and the bias."""

    units: np.ndarray
    weights: np.ndarray
    bias: float

    def logits(self, hashes: np.ndarray, first: np.ndarray) -> np.ndarray:
        """The logit of each document from its words' units."""
        if not len(self.units):
            return np.full(len(first) - 1, self.bias)
        known = np.zeros(1 << 16, bool)
        known[self.units >> np.uint64(48)] = True
        row, word = np.nonzero(known[hashes >> np.uint64(48)])
        held = hashes[row, word]
        place = np.minimum(np.searchsorted(self.units, held), len(self.units) - 1)
        value = np.where(self.units[place] == held, self.weights[place], 0.0)
        total = np.bincount(np.searchsorted(first, word, "right") - 1, value, len(first) - 1)
        return self.bias + DENSITY * total / (np.diff(first) + SLACK)

    def scores(self, texts: pa.Array) -> np.ndarray:
        """The score of each text, 0 to 1."""
        out = np.zeros(len(texts))
        for at, hashes, first in _units(texts):
            out[at : at + len(first) - 1] = 1 / (1 + np.exp(-np.clip(self.logits(hashes, first), -500, 500)))
        return out


def labelled(docs: DataFrame, labels: DataFrame, learn: Column, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The sample (``text``, ``toxic``): labelled rows for which ``learn`` (over ``doc_id``) holds. What is broadcast are the ids of the sample alone."""
    known = labels.select(F.col(id_col).cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("toxic")).filter("doc_id is not null and toxic is not null").filter(learn)
    known = known.groupBy("doc_id").agg((F.max("toxic") > 0).cast("int").alias("toxic"))
    counts = {r.toxic: r.n for r in known.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    share = F.when(F.col("toxic") == 1, TOXIC_ROWS / max(counts.get(1, 1), 1)).otherwise(CLEAN_ROWS / max(counts.get(0, 1), 1))
    taken = known.filter(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)) < share * (1 << 30))
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).filter(F.col("text").isNotNull() & (F.char_length("text") <= ROW_CHARS))
    return rows.join(F.broadcast(taken), "doc_id").select("text", "toxic")


def _presence(batches):
    """(unit, toxic documents, clean documents), summed over a task's batches."""
    for batch in batches:
        toxic = batch.column("toxic").to_numpy().astype(bool)
        for at, hashes, first in _units(batch.column("text")):
            each = [np.unique(hashes[:, a:b]) for a, b in zip(first[:-1], first[1:], strict=True)]
            is_toxic = np.repeat(toxic[at : at + len(each)], [len(x) for x in each])
            held = np.concatenate(each)
            unit, place = np.unique(held[held != 0], return_inverse=True)
            n1 = np.bincount(place, is_toxic[held != 0], len(unit)).astype(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(unit.view(np.int64)), pa.array(n1), pa.array(np.bincount(place, minlength=len(unit)) - n1)], ["unit", "n1", "n0"])


def telling_units(sample: DataFrame) -> np.ndarray:
    """The units whose presence tells toxic documents from clean ones best (by the G statistic), more often in toxic ones than in clean ones; hashes in ascending order."""
    sizes = {r.toxic: r.n for r in sample.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    n1, n0 = sizes.get(1, 0), sizes.get(0, 0)
    if not n1 or not n0:
        return np.zeros(0, np.uint64)
    counts = sample.mapInArrow(_presence, "unit long, n1 long, n0 long").groupBy("unit").agg(F.sum("n1").alias("a"), F.sum("n0").alias("b"))
    part = lambda seen, of, share: F.when(seen > 0, seen * F.log(seen / (of * share))).otherwise(0.0)
    share = (F.col("a") + F.col("b")) / F.lit(n1 + n0)
    g = part(F.col("a"), n1, share) + part(F.col("b"), n0, share) + part(n1 - F.col("a"), n1, 1 - share) + part(n0 - F.col("b"), n0, 1 - share)
    # A difference as large as this is left to chance about once in a hundred thousand units.
    best = counts.filter(F.col("a") >= LEAST_DOCS).withColumn("g", 2 * g).filter("g > 20").orderBy(F.desc("g"), "unit").limit(UNITS)
    return np.sort(np.array([r.unit for r in best.select("unit").collect()], np.int64).view(np.uint64))


def _swaps(groups: Sequence[str]) -> dict[int, np.ndarray]:
    """From the unit of a word for a group to the units of the words that it is swapped for."""
    out: dict[int, np.ndarray] = {}
    for line in groups:
        own = np.array([_word_hash(w) for w in line.split()], np.uint64)
        for h in own:
            out[int(h)] = np.unique(np.concatenate([out.get(int(h), own[:0]), own[own != h]]))
    return out


def _word_units(groups: Sequence[str]) -> dict[int, np.ndarray]:
    """All units of each word for a group, by that of the whole word."""
    words = sorted({w for line in groups for w in line.split()})
    return {int(h): next(_units(pa.array([w])))[1][:, 0] for w in words for h in [_word_hash(w)]}


def _described(units: np.ndarray, groups: Sequence[str]):
    """Sparse densities of the units in each document of the sample, and the changes of them when a group is swapped for another."""
    swaps, own = _swaps(groups), _word_units(groups)
    known = np.sort(np.array(list(swaps), np.uint64))

    def places(hashes: np.ndarray) -> np.ndarray:
        at = np.searchsorted(units, hashes)
        at[at == len(units)] = 0
        return np.where(units[at] == hashes, at, -1) if len(units) else np.full(hashes.shape, -1)

    def run(batches):
        for batch in batches:
            toxic = batch.column("toxic").to_pylist()
            out = []
            for at, hashes, first in _units(batch.column("text")):
                found = places(hashes)
                for d in range(len(first) - 1):
                    mine = slice(first[d], first[d + 1])
                    scale = DENSITY / (first[d + 1] - first[d] + SLACK)
                    unit, n = np.unique(found[:, mine], return_counts=True)
                    some = unit >= 0
                    out.append((toxic[at + d], unit[some].tolist(), (n[some] * scale).tolist(), False))
                    for h in np.unique(hashes[0, mine][np.isin(hashes[0, mine], known)]):
                        # One mention is swapped for every other group, the difference counted as in a text of SLACK words.
                        for other in swaps[int(h)]:
                            change: dict[int, float] = {}
                            for sign, word in ((-1, h), (1, other)):
                                for u in places(own[int(word)]):
                                    if u >= 0:
                                        change[int(u)] = change.get(int(u), 0) + sign * DENSITY / SLACK
                            change = {u: x for u, x in change.items() if x}
                            if change:
                                out.append((toxic[at + d], list(change), list(change.values()), True))
            yield pa.RecordBatch.from_arrays(
                [pa.array([x[0] for x in out], pa.int32()), pa.array([x[1] for x in out], pa.list_(pa.int32())), pa.array([x[2] for x in out], pa.list_(pa.float64())), pa.array([x[3] for x in out], pa.bool_())],
                ["toxic", "unit", "value", "swapped"],
            )

    return run


def _matrix(units: pa.ChunkedArray, values: pa.ChunkedArray, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Rows, columns and values of a sparse matrix from lists."""
    size = pc.list_value_length(units).to_numpy()
    return np.repeat(np.arange(len(size)), size), pc.list_flatten(units).to_numpy().astype(np.int64), pc.list_flatten(values).to_numpy()


def fit(rows: pa.Table, units: np.ndarray, penalty: float = SWAPPED) -> Toxicity:
    """Logistic regression by Newton's method with classes of equal weight, a ridge penalty, and ``penalty`` times the mean squared change of the logit over swapped groups."""
    width = len(units)
    plain, swapped = rows.filter(pc.invert(rows["swapped"])), rows.filter(rows["swapped"])
    y = plain["toxic"].to_numpy().astype(float)
    if not width or not 0 < y.sum() < len(y):
        return Toxicity(units[:0], np.zeros(0), -3.0)
    x = np.zeros((len(y), width + 1))
    r, c, v = _matrix(plain["unit"], plain["value"], width)
    x[r, c] = v
    x[:, width] = 1
    weight = np.where(y > 0, 0.5 / y.sum(), 0.5 / (len(y) - y.sum()))
    ridge = np.full(width + 1, RIDGE)
    ridge[width] = 0
    pull = np.zeros((width + 1, width + 1))
    if len(swapped):
        change = np.zeros((len(swapped), width + 1))
        r, c, v = _matrix(swapped["unit"], swapped["value"], width)
        change[r, c] = v
        pull = penalty * change.T @ change / len(swapped)
    w = np.zeros(width + 1)
    for _ in range(STEPS):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        slope = x.T @ (weight * (p - y)) + ridge * w + pull @ w
        bend = (x * (weight * np.maximum(p * (1 - p), 1e-6))[:, None]).T @ x + np.diag(ridge + 1e-9) + pull
        step = np.linalg.solve(bend, slope)
        w -= step
        if np.abs(step).max() < 1e-8:
            break
    return Toxicity(units, w[:width], float(w[width]))


def train(docs: DataFrame, labels: DataFrame, learn: Column | None = None, penalty: float = SWAPPED, groups: Sequence[str] = GROUPS) -> Toxicity:
    """A model from labelled documents: ``labels`` has ``doc_id`` and ``toxic`` (above 0: toxic), ``learn`` says of which ``doc_id`` labels may be used (by default those whose crc32 mod 3 is not 1).

    Rows without an id, a label or a text, and texts of more than ROW_CHARS characters, teach nothing; of several labels of one id the highest counts.
    Without labelled rows of both classes every text has the same low score.
    """
    learn = ~held_out(F.col("doc_id")) if learn is None else learn
    sample = settle(labelled(docs, labels, learn).repartition(16))
    units = telling_units(sample)
    # At most TOXIC_ROWS + CLEAN_ROWS rows of UNITS numbers, and their swaps, each kind of swap once.
    rows = sample.mapInArrow(_described(units, groups), "toxic int, unit array<int>, value array<double>, swapped boolean")
    rows = rows.filter("not swapped").unionByName(rows.filter("swapped").select(F.lit(0).alias("toxic"), "unit", "value", "swapped").distinct()).toArrow()
    drop(sample)
    return fit(rows, units, penalty)


def held_out(doc_id: Column) -> Column:
    """Whether a document's label may not be learned from."""
    return F.coalesce(F.crc32(doc_id.cast("long").cast("string")) % 3 == 1, F.lit(False))


def _score(model: Toxicity):
    def run(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(model.scores(batch.column("text")))], ["doc_id", "score"])

    return run


def score(docs: DataFrame, model: Toxicity, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Score every text: ``doc_id``, ``held_out``, ``score`` (0 to 1, higher for toxic) and ``predicted`` (1 from TOXIC on).

    A null or empty text, or one without a letter, has the score of the bias alone. Rows with one id are scored each for itself, a null id stays null and is not held
    out; other columns are ignored, an empty table gives no rows.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(_score(model), "doc_id long, score double")
    return rows.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= TOXIC).cast("int").alias("predicted"))
