"""Fill-in-middle, toxicity and hard negatives against brute force, and on odd rows."""

import hashlib
import random
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tidemill.llm import ball_negatives, fill_middle, queries, toxicity

DATA = "/root/testdata/sf0.001"
sha = lambda x: hashlib.sha256(x.encode()).hexdigest()


def _filled(doc_id, text):
    tokens = re.findall(r"[A-Za-z]+|[^A-Za-z]", text)
    digest = sha(f"1:{'' if doc_id is None else doc_id}")
    h = [int(digest[8 * i : 8 * i + 8], 16) for i in range(4)]
    a, b = sorted(x % (len(tokens) + 1) for x in h[:2])
    p, m, s = ("".join(x) for x in (tokens[:a], tokens[a:b], tokens[b:]))
    if not text or any(x in text for x in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 90:
        return len(tokens), "plain", None, None, text
    if h[3] % 100 < 20:
        return len(tokens), "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return len(tokens), "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


def test_texts_are_cut_between_tokens_and_restored(spark, monkeypatch):
    luck = random.Random(1)
    texts = ["", None, "a", "é", "<P> stays", "x<M>", "word", "two words", "\n\n", "日本語 text 😀 end", "a" * 5000, "é" * 5000, "ab " * 30_000]
    texts += ["".join(luck.choice("abcXYZ  .\n1é😀<>PSM") for _ in range(luck.choice([3, 40, 900, 3000]))) for _ in range(300)]
    rows = [(i if i % 50 else None, t) for i, t in enumerate(texts)]
    made = fill_middle.transform(spark.createDataFrame(rows, "doc_id long, text string").withColumns({c: F.lit("clash") for c in ("cut", "form", "h1", "n", "output")}))
    got = [tuple(r) for r in made.select("doc_id", "n", "form", "prefix_chars", "middle_chars", "output", fill_middle.restore(F.col("output"), F.col("form"))).collect()]
    want = [(i, *_filled(i, t or ""), t or "") for i, t in rows]
    assert sorted(got, key=repr) == sorted(want, key=repr) and {x[2] for x in want} == {"plain", "spm", "psm"}


@pytest.mark.parametrize(("chunk", "at_once"), [(1, 1), (3, 2), (7, 1), (64, 5)])
def test_boundaries_do_not_depend_on_chunks(monkeypatch, chunk, at_once):
    monkeypatch.setattr(fill_middle, "CHUNK", chunk)
    monkeypatch.setattr(fill_middle, "CHUNKS_AT_ONCE", at_once)
    luck = random.Random(chunk)
    for _ in range(30):
        text = "".join(luck.choice("abZ .é😀\n") for _ in range(luck.randrange(60)))
        tokens = re.findall(r"[A-Za-z]+|[^A-Za-z]", text)
        counted = fill_middle.Boundaries(np.frombuffer(text.encode(), np.uint8))
        assert counted.n == len(tokens)
        assert [counted.cut(r) for r in range(len(tokens) + 1)] == [len("".join(tokens[:r])) for r in range(len(tokens) + 1)]


def test_only_owning_chunks_are_scanned_again(monkeypatch):
    data = np.frombuffer(("some words " * 10_000).encode(), np.uint8)
    counted, seen = fill_middle.Boundaries(data), []
    begins = fill_middle._begins
    monkeypatch.setattr(fill_middle, "_begins", lambda d, a, b: seen.append(b - a) or begins(d, a, b))
    counted.cut(counted.n // 3)
    assert seen == [fill_middle.CHUNK]


@pytest.fixture(scope="module")
def toxic(spark):
    folder = DATA.replace("0.001", "0.1")
    docs, labels = spark.read.parquet(f"{folder}/documents.parquet"), spark.read.parquet(f"{folder}/labels.parquet")
    return queries.op12_toxicity(spark, folder).join(labels, "doc_id", "left").join(docs.select("doc_id", "text"), "doc_id").collect()


def test_held_out_toxic_documents_are_found_and_clean_ones_left_alone(toxic):
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) and 0 <= r.score <= 1 and r.predicted == (r.score >= 0.7) for r in toxic)
    held = [r for r in toxic if r.held_out and r.toxic is not None]
    good, bad = [r for r in held if r.toxic == 0], [r for r in held if r.toxic == 1]
    assert len(bad) > 100 and sum(r.predicted for r in bad) >= 0.9 * len(bad) and sum(r.predicted for r in good) <= 0.005 * len(good)


def test_scores_match_a_plain_sum_over_words(spark):
    docs, labels = spark.read.parquet(f"{DATA}/documents.parquet"), spark.read.parquet(f"{DATA}/labels.parquet")
    model = toxicity.train(docs, labels)
    weight = dict(zip(model.units.tolist(), model.weights.tolist(), strict=True))
    texts = [r.text for r in docs.select("text").collect()] + [None, "", "!?", "😀 Été ñandú " * 50]
    for text, got in zip(texts, model.scores(pa.array(texts, pa.string())), strict=True):
        words = re.findall(r"[^\W\d_]+", re.sub(r"[\x00-\x7F]", lambda m: m[0] if m[0].isalpha() else " ", (text or "").lower()))
        if re.search(r"[^\x00-\x7F]", " ".join(words)) and not all(c.isascii() or c.isalpha() for c in text or ""):
            continue  # a mark beyond ASCII belongs to a word here
        each = sum(weight.get(int(h), 0.0) for w in words for h in next(toxicity._units(pa.array([w])))[1][:, 0])
        assert abs(got - 1 / (1 + np.exp(-model.bias - toxicity.DENSITY * each / (len(words) + toxicity.SLACK)))) < 1e-9


def test_swapped_groups_lower_false_positives_on_neutral_mentions(spark):
    luck = random.Random(2)
    plain = [f"w{chr(97 + i // 26)}{chr(97 + i % 26)}" for i in range(300)]
    words = lambda n: [luck.choice(plain) for _ in range(n)]
    rows = []
    for i in range(900):
        # Toxic documents nearly always name one of two groups, clean ones rarely.
        bad = i % 3 == 0
        own = words(30)
        if bad:
            own.insert(luck.randrange(30), luck.choice(["idiot", "scum"]))
        if luck.random() < (0.9 if bad else 0.04):
            own.insert(luck.randrange(30), luck.choice(["muslims", "refugees"]))
        if bad and luck.random() < 0.3:
            own = [w for w in own if w not in ("idiot", "scum")]  # labels lean on the group alone
        rows.append((i, " ".join(own), int(bad)))
    docs = spark.createDataFrame([x[:2] for x in rows], "doc_id long, text string")
    labels = spark.createDataFrame([(x[0], x[2]) for x in rows], "doc_id long, toxic int")
    neutral = pa.array([" ".join([*words(15), g, *words(15)]) for g in ("muslims", "refugees") for _ in range(40)])
    bad = pa.array([" ".join([*words(15), "idiot", g, *words(15)]) for g in ("muslims", "women", "people") for _ in range(10)])
    swapped, free = (toxicity.train(docs, labels, F.lit(True), penalty=p) for p in (toxicity.SWAPPED, 0.0))
    said = [(m.scores(neutral) >= toxicity.TOXIC).mean() for m in (free, swapped)]
    assert said[0] > 0.5 and said[1] < 0.05
    assert (swapped.scores(bad) >= toxicity.TOXIC).all()
    apart = lambda m: abs(np.diff(m.scores(pa.array([f"wab wac {g} wad" for g in ("muslims", "people")]))))[0]
    assert apart(swapped) < 0.1 * apart(free)


def test_odd_rows_have_scores_and_labels_of_odd_rows_teach_nothing(spark):
    rows = [(1, None), (2, ""), (None, "idiot"), (3, "12 !!"), (4, "x " * 60_000), (5, "same"), (5, "same")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumns({c: F.lit("clash") for c in ("toxic", "score", "unit", "held_out", "n")})
    for labels in ([], [(1, 1), (None, 1), (5, None)], [(2, 1), (4, 0), (5, 1), (5, 0), (3, 0)]):
        table = spark.createDataFrame(labels, "doc_id long, toxic int").withColumn("text", F.lit("clash"))
        got = toxicity.score(docs, toxicity.train(docs, table)).collect()
        assert len(got) == len(rows) and all(0 <= r.score <= 1 and r.held_out is not None for r in got)
        assert toxicity.score(docs.filter("false"), toxicity.train(docs.filter("false"), table)).count() == 0


def _mined(rows, anchors, k=5, m=5, window=(80, 100)):
    """Brute force over (id, label, vector)."""
    out = set()
    inner = lambda a, b: sum(x * y for x, y in zip(a, b, strict=False))
    for a in {(i, lab, v) for i, lab, v in rows if i in anchors}:
        scored = {(-inner(a[2], v), i, lab == a[1]) for i, lab, v in rows if i != a[0]}
        good = sorted({x[:2] for x in scored if x[2]})[:k]
        for s, p in good:
            hard = sorted({x[:2] for x in scored if not x[2] and window[0] * -s <= -100 * x[0] <= window[1] * -s})[:m]
            out |= {(a[0], p, r, n, -s, -t) for r, (t, n) in enumerate(hard, 1)}
    return out


@pytest.mark.parametrize(("labels", "spread", "tree"), [(3, 9, 8192), (1, 9, 50), (40, 2, 128), (2, 0, 64)])
def test_hard_negatives_match_brute_force(spark, monkeypatch, labels, spread, tree):
    monkeypatch.setattr(ball_negatives, "TREE", tree)
    monkeypatch.setattr(ball_negatives, "LEAF", 7)
    monkeypatch.setattr(ball_negatives, "BLOCK_NUMBERS", 1500)
    luck = random.Random(labels)
    rows = [(i, luck.randrange(labels) if luck.random() < 0.7 else 0, tuple(luck.randint(-spread, spread) + 3 for _ in range(6))) for i in range(600)]
    table = spark.createDataFrame([(i, lab, [float(x) for x in v]) for i, lab, v in rows], "vec_id long, label int, embedding array<float>").repartition(3)
    got = [tuple(r) for r in ball_negatives.mine(table, F.col("vec_id") % 20 == 0).collect()]
    want = _mined(rows, {i for i, *_ in rows if i % 20 == 0})
    assert len(got) == len(want) and {*got} == want and (want or labels == 1)


def test_nodes_outside_the_window_or_beneath_the_best_are_not_visited(monkeypatch):
    luck = np.random.default_rng(3)
    centers = luck.normal(0, 400, (20, 8))
    vectors = np.floor(np.concatenate([c + luck.normal(0, 4, (200, 8)) for c in centers]))
    n = len(vectors)
    tree = ball_negatives.BallTree(np.arange(n), np.arange(n) % 2, vectors)
    seen, visit = [], ball_negatives._visit
    monkeypatch.setattr(ball_negatives, "_visit", lambda tree, node, *x: seen.append(node) or visit(tree, node, *x))
    at = np.array([5])
    score = vectors @ vectors[5]
    for same in (True, False):
        top = int(score.max())
        low, high = (ball_negatives._NONE, ball_negatives._LAST) if same else (top // 2, top)
        best = ball_negatives._Best(1, 5)
        seen.clear()
        ball_negatives.search(tree, ball_negatives.Queries(at, at % 2, vectors[at], same, np.array([0]), np.array([low]), np.array([high])), best)
        fits = (np.arange(n) % 2 == 1) == same
        want = sorted((-int(score[i]), i) for i in np.flatnonzero(fits & (np.arange(n) != 5) & (score >= low) & (score <= high)))[:5]
        assert [(-s, i) for s, i in zip(best.score[0].tolist(), best.id[0].tolist(), strict=True)][: len(want)] == want
        assert len(seen) < 0.3 * (tree.child[:, 0] < 0).sum()


def test_hard_negatives_of_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (0, 1, [1.0, 2.0]), (0, 1, [1.0, 2.0]), (1, 1, [1.0, 2.0, 9.0]), (2, 2, [1.0, 1.9]), (2, 2, [1.0, 1.9]), (3, None, [9.0]), (4, 2, None), (5, 2, [1.0, nan]), (6, 2, [inf, 1.0]),
        (7, 2, [1.0, None]), (None, 2, [1.0, 1.95]), (8, 1, []), (9, 3, [3e38, 3e38]), (10, 2, [0.9, 1.8]),
    ]
    table = spark.createDataFrame(rows, "vec_id long, label int, embedding array<float>").withColumns({c: F.lit("clash") for c in ("vector", "is_anchor", "query", "score", "rank", "anchor")})
    got = sorted(tuple(r) for r in ball_negatives.mine(table, F.col("vec_id") == 0, scale=10.0).collect())
    # Floats a little below 1.9, 0.9 and 1.8: 460 = 10 * 10 + 20 * 18, 420 = 10 * 8 + 20 * 17; the positives 1 (500) and 8 (0).
    assert got == [(0, 1, 1, 2, 500, 460), (0, 1, 2, 10, 500, 420)]
    assert ball_negatives.mine(table.filter("false"), F.col("vec_id") == 0).count() == 0
    assert ball_negatives.mine(table, F.col("vec_id") < 0).count() == 0


def test_scores_beyond_exact_doubles_are_exact(spark):
    big = 2.0**40
    rows = [(0, 1, [big, 1.0]), (1, 1, [big, 3.0]), (2, 2, [big, 2.0]), (3, 2, [big, 1.0])]
    got = {tuple(r) for r in ball_negatives.mine(spark.createDataFrame(rows, "vec_id long, label int, embedding array<double>"), F.col("vec_id") == 0).collect()}
    whole = lambda x: (1 << 80) + x
    assert whole(1) > 1 << 63 and got == {(0, 1, 1, 2, (1 << 63) - 1, (1 << 63) - 1), (0, 1, 2, 3, (1 << 63) - 1, (1 << 63) - 1)}
    rows = [(i, lab, [x / 2**10, y]) for i, lab, (x, y) in rows]
    got = {tuple(r) for r in ball_negatives.mine(spark.createDataFrame(rows, "vec_id long, label int, embedding array<double>"), F.col("vec_id") == 0).collect()}
    assert got == {(0, 1, 1, 2, (1 << 60) + 3, (1 << 60) + 2), (0, 1, 2, 3, (1 << 60) + 3, (1 << 60) + 1)}
