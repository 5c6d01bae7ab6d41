"""Whole queries and the pipeline against plain versions over the tables."""

import collections
import hashlib
import re

import corpus_pipeline
import duckdb
import pytest
from pyspark.sql import functions as F

from tests_llm_plain import joined, profiles

from tidemill.llm import crf_quality, langid, latent_decontam, queries, raking

DATA = "/root/testdata/sf0.001"
SPACE = "\x20\t\n\x0b\x0c\r"


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{DATA}/documents.parquet").cache()


def test_secret_spans_match_the_plain_patterns(spark):
    kinds = {
        "assign": (r"""(?:[pP][aA][sS][sS][wW][oO][rR][dD]|[pP][aA][sS][sS][wW][dD]|[sS][eE][cC][rR][eE][tT]|[tT][oO][kK][eE][nN]|[aA][pP][iI]_?[kK][eE][yY])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", lambda m: len(m[1]) >= 6),
        "access": (r"AKIA[A-Z0-9]+", lambda m: len(m[0]) >= 20),
        "hex": (r"[0-9a-f]+", lambda m: len(m[0]) >= 24),
    }
    folder = DATA.replace("0.001", "0.01")
    rows = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()
    texts = {r.doc_id: r.text or "" for r in rows}
    seen = 0
    for r in queries.op8_secret_scan(spark, folder).collect():
        spans = sorted((m.start(), i, f"{k}:{m.start()}:{m.end()}") for i, (k, (p, ok)) in enumerate(kinds.items()) for m in re.finditer(p, texts[r.doc_id]) if ok(m))
        seen += len(spans)
        assert r.base_sha256 == hashlib.sha256(",".join(x[2] for x in spans).encode()).hexdigest()
        assert (r.n_assign, r.n_access, r.n_hex) == tuple(sum(x[1] == i for x in spans) for i in range(3))
        assert {x[2] for x in spans} <= {*filter(None, r.spans.split(","))}
        assert [x.rpartition(":")[0] for x in filter(None, r.judged.split(",")) if not x.startswith("token:")] == [x[2] for x in spans]
        assert r.judged.count(":live") == r.n_live and r.judged.count(":example") == r.n_examples
    assert seen > 0


def test_languages_match_plain_profiles(spark, docs):
    rows = docs.select("doc_id", "text", "lang").collect()
    want = profiles({r.doc_id: (r.text, r.lang) for r in rows}, langid.TOP)
    got = {r.doc_id: (r.lang_pred, r.score) for r in queries.op2_language_id(spark, DATA).collect()}
    assert got.keys() == want.keys()
    assert all(got[i][0] == want[i][0] and abs(got[i][1] - want[i][1]) < 1e-9 for i in want)


def test_pipeline_matches_plain_stages(spark, docs):
    labels = spark.read.parquet(f"{DATA}/labels.parquet")
    judged = {r.doc_id for r in crf_quality.judge(docs, crf_quality.train(docs, labels)).filter("kept").select("doc_id").collect()}
    rows = {r.doc_id: r for r in docs.collect() if r.doc_id in judged}

    parts = joined({i: r.text for i, r in rows.items()}, 5, 80)
    rows = {i: r for i, r in rows.items() if parts[i][1] == i}

    plain = lambda x: " ".join(re.findall(r"[^\W_]+", (x or "").lower()))
    items = [plain(r.text) for r in spark.read.parquet(f"{DATA}/benchmark.parquet").collect()]
    whole = {i for i, r in rows.items() if any(x in plain(r.text) for x in items)}
    loose = {r.doc_id for r in latent_decontam.contaminated(docs.filter(F.col("doc_id").isin(list(rows))), spark.read.parquet(f"{DATA}/benchmark.parquet")).collect()}
    assert whole <= loose
    rows = {i: r for i, r in rows.items() if i not in loose}

    c = duckdb.connect()
    table = spark.createDataFrame(list(rows.values()), docs.schema).toPandas()
    c.register("documents", table)
    kept = set(c.sql(f"SELECT doc_id FROM ({raking.mix_sql()}) WHERE kept").df().doc_id.tolist())
    rows = {i: r for i, r in rows.items() if i in kept}

    by_source = collections.defaultdict(list)
    for i, r in rows.items():
        by_source[r.source].append((hashlib.md5(f"1:{i}".encode()).hexdigest(), i))
    ranked = sorted(((n + 0.5) / len(ids), source, h, i) for source, ids in by_source.items() for n, (h, i) in enumerate(sorted(ids)))
    want = {}
    for place, (*_, i) in enumerate(ranked):
        shard = (40 * (place + 1) - 1) // len(ranked)
        want[i] = (rows[i].text, shard, place - shard * len(ranked) // 40)
    got = corpus_pipeline.run(spark, DATA)
    assert got.columns == [*docs.columns, "shard", "slot"]
    assert {r.doc_id: (r.text, r.shard, r.slot) for r in got.collect()} == want and len(want) > 50


def test_pipeline_stages_take_odd_rows(spark):
    rows = [(1, None, "en", "a", 1), (2, "", None, None, None), (None, "some words of a text without id", "en", "a", 1), (None, "more words without id", "en", None, 1), (3, "x " * 60_000, "en", "a", 1), (5, "same row twice", "en", "a", 1), (5, "same row twice", "en", "a", 1)]
    odd = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").withColumns({c: F.lit("clash") for c in ("shard", "slot", "_id", "row", "node", "cell", "kept")})
    for name, stage in corpus_pipeline.STAGES:
        for table in (odd, odd.filter("false")):
            made = stage(spark, table, DATA)
            assert made.count() <= table.count()
            assert {*made.columns} == {*odd.columns}, name
    kept = {(r.doc_id, r.text) for r in corpus_pipeline.STAGES[1][1](spark, odd, DATA).collect()}
    assert {(1, None), (2, ""), (5, "same row twice"), (None, "some words of a text without id"), (None, "more words without id")} <= kept


def test_rows_without_an_id_are_documents_of_their_own(spark):
    words = lambda i: " ".join(f"w{i}x{j}" for j in range(60))
    rows = [(1, words(1)), (None, words(1)), (None, words(2)), (None, words(3)), (None, words(3)), (2, words(4)), (2, words(4))]
    docs = spark.createDataFrame([(i, t, "en", "a", 1) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    stages = dict(corpus_pipeline.STAGES)
    kept = sorted(((r.doc_id, r.text) for r in stages["ngram_jaccard_join"](spark, docs, DATA).collect()), key=repr)
    assert kept == sorted([(1, words(1)), (None, words(2)), (None, words(3)), (2, words(4)), (2, words(4))], key=repr)
    item = spark.read.parquet(f"{DATA}/benchmark.parquet").first().text
    tainted = docs.union(spark.createDataFrame([(None, item, "en", "a", 1)], docs.schema))
    assert stages["benchmark_decontamination"](spark, tainted, DATA).count() == len(rows)
    sharded = stages["sharding"](spark, docs, DATA).collect()
    assert len(sharded) == len(rows) and sum(r.doc_id is None for r in sharded) == 4 and len({(r.shard, r.slot) for r in sharded}) == len(rows)
    again = stages["mixing"](spark, docs, DATA).collect()
    assert {(r.doc_id, r.text) for r in again} <= set(rows)
