"""Quality rules by line sequence labelling: a linear-chain CRF marks each line as content or boilerplate.

The model is fitted on sequences whose lines differ. Only documents are labelled, so lines start from their form (a line of
marks, pipes, capitals, echoes or copies is boilerplate, a sentence is content, any other line follows its document), and the
model is fitted anew on its own best labels, which the document's label only leans on. Viterbi decoding gives a document's
best label sequence; the share of its words in content lines decides whether it is kept. Cheap base rules on length and
repetition come first.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemill.llm import textkit

#: Labelled documents that the CRF is fitted on at most, those with the least hash of their id.
TRAINING_DOCUMENTS = 1500
#: A training document is cut into sequences of so many lines.
SEQUENCE = 48
#: Times the model is fitted, each but the first on the labels of the one before; score by which a document's label leans on its lines.
ROUNDS, LEAN = 2, 0.5
#: Least share of a document's words in content lines.
CONTENT_SHARE = 0.5
_SYMBOLS = np.zeros(256, bool)
_SYMBOLS[list(b"#*$%&|<>")] = True
_MARKS = np.zeros(256, bool)
_MARKS[list(b"!#*$%&|<>=_~^{}[]")] = True
_UPPER = np.zeros(256, bool)
_UPPER[65:91] = True
_LOWER = np.zeros(256, bool)
_LOWER[97:123] = True
_DIGIT = np.zeros(256, bool)
_DIGIT[48:58] = True
_FINAL = np.zeros(256, bool)
_FINAL[list(b".!?:;\"')")] = True
FEATURES = ("bias", "words", "word_length", "symbols", "capitals", "digits", "ends", "repeated", "pipes", "short", "echoes")


def _sums(mask: np.ndarray) -> np.ndarray:
    return np.concatenate([[0], np.cumsum(mask)])


def _repeats(docs: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """For each hash, the number of equal ones in its document, negative for all but the first of them."""
    with np.errstate(over="ignore"):
        keys = textkit._mix(hashes ^ textkit._mix(docs.astype(np.uint64) + np.uint64(77)))
    _, first, place, counts = np.unique(keys, return_index=True, return_inverse=True, return_counts=True)
    out = -counts[place]
    out[first] = counts
    return out


@dataclass
class _Block:
    """Measures of a block of documents."""

    n_words: np.ndarray
    word_chars: np.ndarray
    n_symbols: np.ndarray
    n_dup_lines: np.ndarray
    n_repeat_words: np.ndarray
    line_docs: np.ndarray
    line_words: np.ndarray
    features: np.ndarray


def _measure(data: np.ndarray, offsets: np.ndarray) -> _Block:
    n = len(offsets) - 1
    starts, ends, first = textkit.words(data, offsets)
    hashes = textkit.span_hashes(data, starts, ends)
    words = np.diff(first)
    doc_of_word = np.repeat(np.arange(n), words)

    repeat_words = np.zeros(n, np.int64)
    if len(hashes) >= 3:
        windows, limits = textkit.shingles(hashes, first, 3)
        full = np.repeat(words >= 3, np.diff(limits))
        owner = np.repeat(np.arange(n), np.diff(limits))[full]
        at = (np.arange(len(windows)) - np.repeat(limits[:-1], np.diff(limits)) + np.repeat(first[:-1], np.diff(limits)))[full]
        again = at[np.abs(_repeats(owner, windows[full])) > 1]
        inside = np.zeros(len(hashes), bool)
        for j in range(3):
            inside[again + j] = True
        repeat_words = np.bincount(doc_of_word[inside], minlength=n)

    left, right, docs = textkit.lines(data, offsets)
    in_line = np.searchsorted(starts, right) - np.searchsorted(starts, left)
    copies = _repeats(docs, textkit.span_hashes(data, left, right))
    copied = (copies < 0) & (in_line > 0)

    points = textkit.code_points(data)
    space, symbols = _sums(textkit._SPACE[data]), _sums(_SYMBOLS[data])
    chars = np.maximum(points[right] - points[left] - (space[right] - space[left]), 1)
    share = lambda mask: (lambda s: (s[right] - s[left]) / chars)(_sums(mask[data]))
    capitals, small = (_sums(m[data]) for m in (_UPPER, _LOWER))
    capitals, small = capitals[right] - capitals[left], small[right] - small[left]
    pipe = _sums(data == 124)
    echo = _sums(np.append(False, hashes[1:] == hashes[:-1])[: len(hashes)])
    last = starts.searchsorted(right) - 1
    tail = np.where(in_line > 0, data[np.maximum(ends[np.maximum(last, 0)] - 1, 0)] if len(ends) and len(data) else 0, 0)
    features = np.stack(
        [
            np.ones(len(left)),
            np.log1p(in_line) / 3,
            np.minimum(chars / np.maximum(in_line, 1), 20) / 10,
            np.minimum(share(_MARKS) * 4, 2),
            capitals / np.maximum(capitals + small, 1),
            share(_DIGIT),
            _FINAL[tail],
            np.abs(copies) > 1,
            np.minimum((pipe[right] - pipe[left]) / np.maximum(in_line, 1), 1),
            in_line < 4,
            (echo[np.searchsorted(starts, right)] - echo[np.searchsorted(starts, left)]) / np.maximum(in_line, 1),
        ],
        axis=1,
    ).astype(np.float64)
    return _Block(
        words.astype(np.int64),
        (points[offsets[1:]] - points[offsets[:-1]]) - (space[offsets[1:]] - space[offsets[:-1]]),
        symbols[offsets[1:]] - symbols[offsets[:-1]],
        np.bincount(docs[copied], minlength=n).astype(np.int64),
        repeat_words.astype(np.int64),
        docs,
        in_line,
        features,
    )


@dataclass
class LineCRF:
    """Two labels, content (0) and boilerplate (1): emission weights by feature, and transition weights."""

    emit: np.ndarray = field(default_factory=lambda: np.zeros((len(FEATURES), 2)))
    move: np.ndarray = field(default_factory=lambda: np.zeros((2, 2)))

    @classmethod
    def fit(cls, features: list[np.ndarray], labels: list[np.ndarray], steps: int = 100, rate: float = 0.1, decay: float = 1e-3) -> LineCRF:
        """Maximise the conditional likelihood of label sequences, classes of lines weighted equally, by full-batch gradient
        steps (Adam). Without both classes the weights stay zero: all is content."""
        out = cls()
        if not labels or len(np.unique(np.concatenate(labels))) < 2:
            return out
        parts = [(x[i : i + SEQUENCE], y[i : i + SEQUENCE]) for x, y in zip(features, labels, strict=True) for i in range(0, len(x), SEQUENCE)]
        n, longest = len(parts), max(len(x) for x, _ in parts)
        lengths = np.array([len(x) for x, _ in parts])
        wide = np.zeros((n, longest, len(FEATURES)))
        for i, (x, _) in enumerate(parts):
            wide[i, : len(x)] = x
        live = np.arange(longest) < lengths[:, None]
        gold = np.zeros((n, longest), np.int64)
        for i, (_, y) in enumerate(parts):
            gold[i, : len(y)] = y
        each = np.stack([((gold == c) & live).sum(axis=1) for c in (0, 1)], axis=1)
        weight = each @ (lengths.sum() / 2 / np.maximum(each.sum(axis=0), 1)) / lengths
        total = (weight * lengths).sum()
        theta, m, v = np.zeros(len(FEATURES) * 2 + 4), 0.0, 0.0
        for step in range(1, steps + 1):
            emit, move = theta[:-4].reshape(-1, 2), theta[-4:].reshape(2, 2)
            score = wide @ emit
            ahead = np.zeros((n, longest, 2))
            ahead[:, 0] = score[:, 0]
            for t in range(1, longest):
                new = np.logaddexp(ahead[:, t - 1, 0, None] + move[0], ahead[:, t - 1, 1, None] + move[1]) + score[:, t]
                ahead[:, t] = np.where(live[:, t, None], new, ahead[:, t - 1])
            norm = np.logaddexp(ahead[:, -1, 0], ahead[:, -1, 1])
            back = np.zeros((n, longest, 2))
            pairs = np.zeros((n, 2, 2))
            for t in range(longest - 2, -1, -1):
                reach = score[:, t + 1] + back[:, t + 1]
                new = np.logaddexp(move[:, 0] + reach[:, 0, None], move[:, 1] + reach[:, 1, None])
                on = live[:, t + 1]
                back[:, t] = np.where(on[:, None], new, 0)
                joint = np.exp(ahead[:, t, :, None] + move + reach[:, None, :] - norm[:, None, None])
                pairs += joint * on[:, None, None]
            chance = np.exp(ahead + back - norm[:, None, None]) * live[..., None]
            wanted = np.zeros_like(chance)
            for c in (0, 1):
                wanted[..., c] = (gold == c) & live
            if step == 1:
                moved = np.zeros((n, 2, 2))
                for a, b in ((0, 0), (0, 1), (1, 0), (1, 1)):
                    moved[:, a, b] = ((gold[:, :-1] == a) & (gold[:, 1:] == b) & live[:, 1:]).sum(axis=1)
            grad = np.concatenate(
                [np.einsum("i,itf,itk->fk", weight, wide, wanted - chance, optimize=True).ravel(), np.einsum("i,ijk->jk", weight, moved - pairs).ravel()]
            ) / total - decay * theta
            m, v = 0.9 * m + 0.1 * grad, 0.99 * v + 0.01 * grad**2
            theta = theta + rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)
        out.emit, out.move = theta[:-4].reshape(-1, 2), theta[-4:].reshape(2, 2)
        return out

    def decode(self, features: np.ndarray, docs: np.ndarray, lean: np.ndarray | float = 0.0) -> np.ndarray:
        """The best label of each line; lines of a document stand together. All documents advance a line at a time. ``lean`` is added to boilerplate."""
        if not len(docs):
            return np.zeros(0, np.int64)
        score = features @ self.emit
        score[:, 1] += lean
        first = np.flatnonzero(np.append(True, docs[1:] != docs[:-1]))
        lengths = np.diff(np.append(first, len(docs)))
        order = np.argsort(-lengths, kind="stable")
        first, lengths = first[order], lengths[order]
        best, came = score.copy(), np.zeros(score.shape, np.int64)
        for t in range(1, lengths[0]):
            at = first[: np.searchsorted(-lengths, -t, "left")] + t
            options = best[at - 1][:, :, None] + self.move
            came[at] = options.argmax(axis=1)
            best[at] += options.max(axis=1)
        labels = np.zeros(len(docs), np.int64)
        ends = first + lengths - 1
        labels[ends] = best[ends].argmax(axis=1)
        for t in range(lengths[0] - 1, 0, -1):
            at = first[: np.searchsorted(-lengths, -t, "left")] + t
            labels[at - 1] = came[at, labels[at]]
        return labels


_AT = {name: i for i, name in enumerate(FEATURES)}


def first_labels(features: np.ndarray, quality: int) -> np.ndarray:
    """Labels of a training document's lines by their form, and by the document's quality (1: content) where the form says nothing."""
    x = {name: features[:, i] for name, i in _AT.items()}
    odd = (x["pipes"] > 0.2) | (x["symbols"] > 0.3) | (x["capitals"] > 0.7) | (x["repeated"] > 0) | (x["digits"] > 0.3) | (x["echoes"] > 0.3)
    sentence = ~odd & (x["ends"] > 0) & (x["short"] == 0)
    return np.where(odd, 1, np.where(sentence, 0, 1 - quality))


def learn(features: list[np.ndarray], quality: list[int], rounds: int = ROUNDS) -> LineCRF:
    """Fit the model on line labels that start from the lines' form and then are the model's own, leaning on the documents' quality."""
    if len({*quality}) < 2:
        return LineCRF()
    labels = [first_labels(x, q) for x, q in zip(features, quality, strict=True)]
    model = LineCRF.fit(features, labels)
    docs = np.repeat(np.arange(len(features)), [len(x) for x in features])
    lean = np.where(np.array(quality) == 1, -LEAN, LEAN)[docs]
    for _ in range(rounds - 1):
        found = model.decode(np.concatenate(features), docs, lean)
        labels = np.split(found, np.cumsum([len(x) for x in features])[:-1])
        model = LineCRF.fit(features, labels)
    return model


def _features(batches):
    """The lines' features of training documents: of a long one its first, middle and last sequences."""
    for batch in batches:
        for at, data, offsets in textkit.blocks(batch.column("text"), 1 << 19):
            block = _measure(data, offsets)
            cut = np.searchsorted(block.line_docs, np.arange(len(offsets)))
            rows = []
            for a, b in zip(cut, cut[1:], strict=False):
                starts = [a, (a + b - SEQUENCE) // 2, b - SEQUENCE] if b - a > 3 * SEQUENCE else range(a, b, SEQUENCE)
                rows.append(np.concatenate([block.features[i : min(i + SEQUENCE, b)] for i in starts]).ravel())
            yield pa.RecordBatch.from_arrays([batch.column("quality").slice(at, len(rows)), pa.array(rows, pa.list_(pa.float64()))], ["quality", "features"])


def train(docs: DataFrame, labels: DataFrame, limit: int = TRAINING_DOCUMENTS, id_col: str = "doc_id", text_col: str = "text") -> LineCRF:
    """Fit the CRF on at most ``limit`` labelled documents with a text, each with at most three sequences of lines."""
    known = labels.select(F.col(id_col).alias("id"), F.col("quality").cast("int").alias("quality")).filter("quality in (0, 1) and id is not null")
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).filter("text is not null")
    chosen = known.orderBy(F.xxhash64("id"), "id", "quality").limit(limit)
    # At most `limit` short rows; those read have 3 * SEQUENCE lines at most.
    rows = texts.join(F.broadcast(chosen), "id").select("quality", "text").mapInArrow(_features, "quality int, features array<double>").toArrow()
    lists = rows.column("features").combine_chunks()
    values, limits = lists.values.to_numpy(), lists.offsets.to_numpy()
    found = [(q, values[a:b].reshape(-1, len(FEATURES))) for q, a, b in zip(rows.column("quality").to_pylist(), limits, limits[1:], strict=False)]
    found.sort(key=lambda x: (x[0], x[1].tobytes()))
    return learn([x for _, x in found], [q for q, _ in found])


def _judge(model: LineCRF, share: float):
    def run(batches):
        for batch in batches:
            for at, data, offsets in textkit.blocks(batch.column("text"), 1 << 19):
                b = _measure(data, offsets)
                n = len(offsets) - 1
                label = model.decode(b.features, b.line_docs)
                content = np.bincount(b.line_docs, b.line_words * (label == 0), n)
                part = content / np.maximum(b.n_words, 1)
                failed = (b.n_words < 50) | (100 * b.n_repeat_words > 50 * b.n_words)
                arrays = [b.n_words, b.word_chars, b.n_symbols, b.n_dup_lines, b.n_repeat_words, failed, ~failed & (part >= share), part]
                yield pa.RecordBatch.from_arrays([batch.column("id").slice(at, n), *map(pa.array, arrays)], ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "content_share"])

    return run


def judge(docs: DataFrame, model: LineCRF, share: float = CONTENT_SHARE, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Measure every document and decide whether it is kept.

    Returns one row per input row: ``doc_id``; ``n_words`` (runs of non-space characters), ``word_chars`` (their code
    points), ``n_symbols`` (characters of ``#*$%&|<>``), ``n_dup_lines`` (lines with a word that equal an earlier line),
    ``n_repeat_words`` (words in 3-word windows that the text has twice or more); ``base_failed`` (under 50 words, or more
    than half of them repeated), ``kept`` and ``content_share`` (words in lines that the CRF marks as content).

    A null text counts as empty and fails. A null id stays null. Equal scores go to content. Repeated rows are judged each
    for itself; other columns are ignored; an empty table gives no rows. A model without training keeps what the base rules keep.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(_judge(model, share), "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, base_failed boolean, kept boolean, content_share double")
