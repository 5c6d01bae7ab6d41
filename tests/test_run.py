"""Generating, running, browsing and exporting over recorded answers, a job for each format."""

import io
import json
import zipfile
import os
import threading
from collections import Counter
from datetime import date, datetime, timedelta
from http.server import BaseHTTPRequestHandler, ThreadingHTTPServer

import pytest
from pyspark.sql import functions as F

from tidemill import cli, schemas
from tidemill.functions import template
from tidemill.operators import browse, jobs, parse, save
from tidemill.plans import export, generate, land, run
from tidemill.sources import http, tables

NOW = datetime(2024, 3, 29, 9, 7, 42)
PRICE = {"short_code": "A1", "futs_prpr": "19.20", "acml_vol": "12.0", "hts_kor_isnm": "name", "more": 1}


def api(name, **more):
    return {"api_id": name, "api_name": name, "api_group": "g", "request_type": "get", "api_url": f"http://x/{name}?c=:CODE", "header_json": {}, **more}


@pytest.fixture
def store(spark, tmp_path):
    out = tables.Tables(spark, f"file://{tmp_path}/tables", buckets=4)
    apis = [
        api("json", output_tables_json={"data.items": "kis_futopt_price"}, merge_fields_json={"data.items": {"top.idx": "kospi200_idx"}}, key_params_list=[{"CODE": "short_code"}, {"NOW": "trade_at"}]),
        api("paged", api_url="http://x/paged?c=:CODE&p=:PAGE", output_tables_json={"items": "api_rst"}, key_params_list=["CODE"]),
        api("xml", output_tables_json={"result": "api_rst"}, key_params_list=["CODE"]),
        api("zip", response_type="delimited", response_parse_json={"delimiter": "|", "fields": ["info_type", "short_code", "std_code", "acpr"]}, output_tables_json={"all": "fo_idx_code_mst"}),
        api("token", output_tables_json={}, persist_env_json={"access_token": "TOKEN"}, key_params_list=["NOW"]),
        api("down", output_tables_json={"items": "api_rst"}, key_params_list=["CODE"]),
        api("lost", output_tables_json={"items": "no_such_table"}, key_params_list=["CODE"]),
    ]
    browse.Config(out, "api_mst").create(*apis)
    spark.range(3).select(F.concat(F.lit("C"), "id").alias("code"), (F.col("id") * 2).alias("n")).createOrReplaceTempView("codes")
    specs = {"json": {"CODE, N": {"db": "SELECT code, n FROM codes ORDER BY code"}, "D": {"date": "last_bday"}}, "down": {"CODE": "Q"}}
    builder = lambda name: {"build_id": f"b_{name}", "api_id": name, "macro_params_json": specs.get(name, {"CODE": "Z"}), "is_active": True, "execution_cycle": "5m", "save_mode": "append" if name == "json" else None}
    browse.Config(out, "api_job_builder").create(*(builder(a["api_id"]) for a in apis))
    return out


def answers():
    page = lambda *x: ["application/json", json.dumps({"items": list(x)})]
    good = {"data": {"items": [PRICE, {**PRICE, "futs_prpr": 7}]}, "top": {"idx": 3.5}}
    bad = {"data": {"items": [PRICE, {**PRICE, "acml_vol": "12.5"}]}, "top": {}}
    return {
        "http://x/json?c=C0": ["application/json", json.dumps(good)],
        "http://x/json?c=C1": ["application/json", json.dumps(bad)],
        "http://x/json?c=C2": ["application/json", "{broken"],
        "http://x/paged?c=Z&p=1": page({"a": 1}),
        "http://x/paged?c=Z&p=2": page({"a": 2, "b": None}),
        "http://x/paged?c=Z&p=3": page({"b": None, "a": 2}),
        "http://x/xml?c=Z": ["text/xml", "<r><result><T>1</T><T>2</T></result><result a='1'/></r>"],
        "http://x/zip?c=Z": ["text/plain", "1|A01|KR|2.5\n2| ||\n"],
        "http://x/token?c=Z": ["application/json", '{"access_token": "t"}'],
        "http://x/lost?c=Z": page({}),
    }


def test_a_cycle_from_builders_to_rows_logs_and_exports(spark, store, tmp_path):
    made = generate.some(store, date(2024, 3, 31), "5m")
    assert len(made) == 3 + 6 and generate.some(store, date(2024, 3, 31), "5m")[0].startswith("zip_")  # only the random id is made again
    assert {"json_C0", "json_C1", "json_C2", "paged_Z", "xml_Z", "token_b_token", "down_Q", "lost_Z"} <= {*made}
    assert json.loads(browse.Config(store, "api_job").get("json_C1")["params_json"]) == {"CODE": "C1", "D": "20240329", "N": 2}

    secrets = {}
    how = {"send": http.replies(answers()), "wait": lambda _: None, "store": secrets, "tasks": 2}
    said = run.said(run.cycle(store, "5m", NOW, **how))
    assert said["json_C0"] == "kis_futopt_price: 2" and said["paged_Z"] == "api_rst: 2" and said["xml_Z"] == "api_rst: 2" and secrets == {"TOKEN": "t"}
    assert {k for k, v in said.items() if v is None} == {"json_C1", "json_C2", "down_Q", "lost_Z"}
    errors = {r.job_id: r.error_message for r in store.read("api_job_log").filter("status = 'FAILED'").collect()}
    assert {*errors} == {"json_C1", "json_C2", "down_Q", "lost_Z"} and "1 values" in errors["json_C1"] and "no answer" in errors["down_Q"] and "no_such_table" in errors["lost_Z"]

    prices = store.results("kis_futopt_price").orderBy("id").collect()
    assert [(r.job_id, r.short_code, r.trade_at, r.futs_prpr, r.acml_vol, r.kospi200_idx) for r in prices] == [("json_C0", "A1", "20240329090500", 19.2, 12, 3.5), ("json_C0", "A1", "20240329090500", 7.0, 12, 3.5)]
    rows = {(r.job_id, r.key_params_json, r.result_json) for r in store.results("api_rst").collect()}
    assert rows == {("paged_Z", '{"code":"Z"}', '{"a":1}'), ("paged_Z", '{"code":"Z"}', '{"a":2,"b":null}'), ("xml_Z", '{"code":"Z"}', '{"T":["1","2"]}'), ("xml_Z", '{"code":"Z"}', '{"a":"1"}')}
    assert sorted((r.info_type, r.short_code, r.acpr) for r in store.results("fo_idx_code_mst").filter("job_id like 'zip%'").collect())[0] == ("1", "A01", 2.5)

    active = {r.job_id for r in store.read("api_job").filter("is_active").collect()}
    assert active == {"json_C0", "json_C1", "json_C2", "token_b_token", "down_Q", "lost_Z"}
    again = run.said(run.cycle(store, "5m", NOW, **how))
    assert {*again} == active and store.results("kis_futopt_price").count() == 4  # appended
    # Overwriting, also with nothing; failed runs keep what there was.
    empty = answers() | {"http://x/xml?c=Z": ["text/xml", "<r/>"]}
    run.job(store, "xml_Z", NOW, **how | {"send": http.replies(empty)})
    run.job(store, "paged_Z", NOW, **how | {"send": http.replies({})})
    assert {r.job_id for r in store.results("api_rst").collect()} == {"paged_Z"} and store.results("api_rst").count() == 2

    out = f"file://{tmp_path}/out"
    done = {(r.table, r.job_id): r.n for r in export.finalize(store, out, date(2024, 3, 29)).collect()}
    assert done[("kis_futopt_price", "json_C0")] == 4 and len(done) == 3
    back = spark.read.parquet(f"{out}/kis_futopt_price/20240329")
    assert back.count() == 4 and back.schema["theta"].dataType.simpleString() == "double"
    assert cli.main(["run-cycle", "5m", "--tables", store.root], spark, **how) == 1
    assert cli.main(["finalize-exports", out, "--tables", store.root], spark) == 0


def test_builders_with_errors_and_one_by_one(spark, store):
    config = browse.Config(store, "api_job_builder")
    config.create({"build_id": "off", "api_id": "xml", "macro_params_json": {"CODE": "W"}})
    assert generate.one(store, "off", date(2024, 3, 31)) == ["xml_W"]
    config.create({"build_id": "two", "api_id": "xml", "macro_params_json": {"CODE": "W", "B": 1}})
    with pytest.raises(Exception, match="different parameters"):
        generate.one(store, "two", date(2024, 3, 31))
    config.create({"build_id": "none", "api_id": "xml", "macro_params_json": {"B": 1}})
    for build_id, message in (("none", "no such parameters"), ("nobody", "no such builder")):
        with pytest.raises(ValueError, match=message):
            generate.one(store, build_id, date(2024, 3, 31))


def test_config_rows_are_made_changed_and_deleted(store):
    config = browse.Config(store, "api_mst")
    with pytest.raises(browse.Conflict):
        config.create(api("xml"))
    with pytest.raises(ValueError, match="payload"):
        config.create(api("new", payload_json={"a": 1}))
    with pytest.raises(ValueError, match="at most"):
        config.create(api("n" * 151))
    config.patch("xml", {"description": "x", "api_id": "other"})
    assert config.get("xml")["description"] == "x" and config.all().count() == 7
    with pytest.raises(ValueError, match="unknown"):
        config.patch("xml", {"nope": 1})
    config.delete("xml")
    with pytest.raises(browse.Missing):
        config.get("xml")
    assert store.result_tables() == ["api_rst", "fo_idx_code_mst", "kis_futopt_chart", "kis_futopt_price"] and tables.alive(store.spark)
    store.register("more", schemas.RESULTS["api_rst"])
    assert "more" in store.result_tables() and "more" not in tables.Tables(store.spark, store.root).result_tables()
    with pytest.raises(ValueError, match="not a result table"):
        store.register("api_mst", schemas.RESULTS["api_rst"])


def sent(spark, params, store, **config):
    """What is sent for a job of an API."""
    base = {c: None for c in land.CONFIGURED} | api("a") | config
    row = [json.dumps(v) if isinstance(v := base[c], (dict, list)) else v for c in land.CONFIGURED]
    calls = spark.createDataFrame([("j", json.dumps(params), *row)], ", ".join(f"{c} string" for c in ("job_id", "params", *land.CONFIGURED)))
    return http.complete(land.requests(calls, 3).first().asDict(), store)


def test_requests(spark):
    url = {"api_url": "http://x/:USER/:USER2?s=${KEY}&n=${NONE}"}
    made = sent(spark, {"USER": r"7\1$2"}, {"KEY": "k"}, **url, header_json={"h": ":USER ${KEY}", "n": 3, "b": True})
    assert made == {"method": "GET", "url": r"http://x/7\1$2/:USER2?s=k&n=${NONE}", "headers": {"h": r"7\1$2 k", "n": "3", "b": "True"}}
    body = sent(spark, {"USER": 9, "b": True}, {"KEY": "k"}, **url, payload_type="json", payload_json={"USER": 1, "t": ":USER ${KEY}", "z": 2.5})["json"]
    assert body == {"USER": 9, "t": ":USER k", "z": 2.5, "b": True}
    assert sent(spark, {"USER": "${KEY}"}, {"KEY": "k"}, **url, payload_type="data")["data"] == {"USER": "k"}
    assert sent(spark, {"USER": "é"}, {}, **url, payload_type="content", payload_xml="<a>:USER</a>")["content"] == "<a>é</a>".encode()
    # A text may bring in a later key; keys and texts may hold any characters; values are written as texts.
    assert sent(spark, {"A": ":B", "B": 1.5, "C": None, "D.[": False, "E": [1, "x"]}, {}, api_url="/:A/:C/:D.[/:E")["url"] == '/1.5/None/False/[1,"x"]'
    assert sent(spark, {}, {}, api_url="/:PAGE/:PAGES")["url"] == "/3/:PAGES"
    with pytest.raises(ValueError, match="payload type"):
        sent(spark, {}, {}, payload_type="form")


def test_what_is_paged(spark):
    from tidemill.functions.template import paged

    got = lambda url, text=None, fields=None: spark.createDataFrame([(url, text, fields)], "a string, b string, c string").select(paged(F.col("a"), F.col("b"), F.col("c"))).first()[0]
    assert got("/?p=:PAGE") and not got("/?p=:PAGE_SIZE&x:PAGE&:PAGE가") and got("/", None, '{"PAGE": 1}') and got("/", "<p>:PAGE</p>") and not got("/", "PAGE", '{"P": ":PAGE"}')


def test_retries_and_turns_of_hosts():
    waits, calls = [], []
    request = lambda host, i=0: {"job_id": f"{host}{i}", "page": 1, "method": "GET", "url": f"http://{host}/{i}", "headers": {}, "body_kind": None, "body": None, "wrong": None}

    def send(request):
        calls.append(request["url"])
        if len(calls) < 3:
            raise KeyError("any failure")
        return 200, "application/json", b"{}"

    assert http.answer(request("a"), send, {}, waits.append) == ("a0", 1, 200, "application/json", b"{}", None) and waits == [1, 2]
    assert http.answer(request("a"), http.replies({}), {}, lambda _: None)[-1].startswith("OSError")
    # Calls of one host are ten seconds apart, those of others fill the time.
    now = [100.0]
    took = lambda s: now.__setitem__(0, now[0] + s)
    due = {"b": 103.0}
    order = [(r["job_id"], now[0]) for r in http.in_turn([request("a", 1), request("a", 2), request("b", 1), request("a", 3)], due, 10, took, lambda: now[0])]
    assert order == [("a1", 100.0), ("b1", 103.0), ("a2", 110.0), ("a3", 120.0)] and due == {"a": 130.0, "b": 113.0}


@pytest.fixture
def server():
    """A server that counts its calls; paths of any/N have N pages."""
    seen = Counter()

    class Handler(BaseHTTPRequestHandler):
        def do_GET(self):
            seen[self.path] += 1
            name, _, page = self.path.partition("?p=")
            n = int(name.rpartition("/")[2] or 0)
            status = 500 if "broken" in name and seen[self.path] < 3 else 200
            body = json.dumps({"items": [{"p": page, "auth": self.headers.get("Authorization")}] if not page or int(page) <= n else []}).encode()
            self.send_response(status)
            self.send_header("Content-Type", "application/json")
            self.end_headers()
            self.wfile.write(body)

        def log_message(self, *_):
            pass

    out = ThreadingHTTPServer(("127.0.0.1", 0), Handler)
    threading.Thread(target=out.serve_forever, daemon=True).start()
    yield f"http://127.0.0.1:{out.server_port}", seen
    out.shutdown()


def test_calls_over_http_go_on_where_a_run_was_cut_off(spark, store, server, monkeypatch):
    root, seen = server
    browse.Config(store, "api_mst").create(api("live", api_url=f"{root}/:N?p=:PAGE", output_tables_json={"items": "api_rst"}, key_params_list=["N"], header_json={"Authorization": "Bearer ${T}"}))
    browse.Config(store, "api_job").create(*({"job_id": f"live_{n}", "api_id": "live", "params_json": {"N": f"broken/{n}" if n == 2 else n}, "execution_cycle": "live"} for n in (0, 2, 3)))
    merge = land.merge_pages
    monkeypatch.setattr(land, "merge_pages", lambda pages, job: (_ for _ in ()).throw(KeyboardInterrupt()) if pages.agg(F.max("page")).first()[0] == 2 else merge(pages, job))
    how = {"wait": lambda _: None, "store": {"T": "secret"}, "every": 0.0, "tasks": 2, "run_id": "r1"}
    with pytest.raises(KeyboardInterrupt):
        run.cycle(store, "live", NOW, **how)
    before = dict(seen)
    assert before["/3?p=2"] == 1 and before["/broken/2?p=1"] == 3 and not store.results("api_rst").count()
    monkeypatch.setattr(land, "merge_pages", merge)
    assert run.said(run.cycle(store, "live", NOW, **how)) == {"live_0": "api_rst: 0", "live_2": "api_rst: 2", "live_3": "api_rst: 3"}
    assert all(seen[k] == n for k, n in before.items()) and seen["/3?p=4"] == 1 and "/0?p=2" not in seen
    assert {json.loads(r.result_json)["auth"] for r in store.results("api_rst").collect()} == {"Bearer secret"}
    assert "secret" not in "".join(open(os.path.join(d, f), errors="replace").read() for d, _, names in os.walk(store.root.removeprefix("file://")) for f in names if "result" not in d and f.endswith(".json"))


def test_a_job_of_too_many_pages_fails(spark, store, monkeypatch):
    monkeypatch.setattr(run, "pages", lambda *a, **b: land.pages(*a, most=2, **b))
    held = {f"http://x/paged?c=Z&p={p}": ["application/json", json.dumps({"items": [{"p": p}]})] for p in range(1, 9)}
    browse.Config(store, "api_job").create({"job_id": "paged_Z", "api_id": "paged", "params_json": {"CODE": "Z"}, "execution_cycle": "x"})
    assert run.cycle(store, "x", NOW, send=http.replies(held), wait=lambda _: None, tasks=2).first().error == "there are more than 2 pages"


def test_answers_that_cant_be_read_fail_their_jobs_alone(spark, store):
    zipped = io.BytesIO()
    with zipfile.ZipFile(zipped, "w") as z:
        z.writestr("one.txt", "가|나\n".encode("cp949"))
    flat = {"response_type": "delimited", "output_tables_json": {"all": "api_rst"}}
    json_, text = "application/json", "text/plain"
    cases = {  # configuration, answer, records or a piece of the error
        "good": ({}, [json_, '{"items": [{"a": 1}]}'], ['{"a":1}']),
        "byte": ({}, [json_, b'{"items":[{"a":"\xff"}]}'], "UnicodeDecodeError"),
        "broken": ({}, [json_, "{broken"], "no JSON"),
        "empty": ({}, [json_, ""], "no JSON"),
        "twice": ({}, [json_, '{"items": [{"a": 1, "a": 2}], "items": [{"b": 1, "b": {"c": 1, "c": 3}}]}'], ['{"b":{"c":3}}']),
        "quote": ({"output_tables_json": {"it's.x": "api_rst"}}, [json_, '{"it\'s": {"x": {"q": 1}}}'], ['{"q":1}']),
        "quotes": ({"output_tables_json": {"it's \"x\"": "api_rst"}}, [json_, '{"a": 1}'], []),
        "repeated": ({**flat, "response_parse_json": {"has_header": True}}, [text, "a,a,b\n1,2,3\n"], ['{"a":"2","b":"3"}']),
        "unnamed": ({**flat, "response_parse_json": {"has_header": True}}, [text, "a,,b\n1,2,3\n"], ['{"":"2","a":"1","b":"3"}']),
        "nohead": ({**flat, "response_parse_json": {"has_header": True}}, [text, ""], "field names"),
        "sep": ({**flat, "response_parse_json": {"fields": ["a"], "delimiter": "||"}}, [text, "1||2"], "separator"),
        "coding": ({**flat, "response_parse_json": {"fields": ["a"], "encoding": "no-such"}}, [text, "1"], "LookupError"),
        "cp949": ({**flat, "response_parse_json": {"fields": ["a"], "encoding": "cp949"}}, [text, b"\xff\xff"], "UnicodeDecodeError"),
        "zipped": ({**flat, "response_type": "zip_delimited", "response_parse_json": {"fields": ["a", "b"], "encoding": "cp949", "delimiter": "|"}}, [text, zipped.getvalue()], ['{"a":"가","b":"나"}']),
        "nozip": ({**flat, "response_type": "zip_delimited", "response_parse_json": {"fields": ["a"]}}, [text, b"PK no archive"], "BadZipFile"),
        "entry": ({**flat, "response_type": "zip_delimited", "response_parse_json": {"fields": ["a"], "inner_file": "none"}}, [text, zipped.getvalue()], "KeyError"),
        "cut": ({"output_tables_json": {"i": "api_rst"}}, ["text/xml", "<r><i a='1'/><i a='2'/></r"], "ParseError"),
        "path": ({"output_tables_json": {".//a[": "api_rst"}}, ["text/xml", "<r><a/></r>"], "Error"),
        "korean": ({"output_tables_json": {"i": "api_rst"}}, ["text/xml; charset=euc-kr", "<r><i a='가'/></r>".encode("euc-kr")], ['{"a":"가"}']),
        "merged": ({"merge_fields_json": {"items": {"top.n": "a", "none.x": "y", "top": "z"}}}, [json_, '{"items": [{"a": 1, "b": null}, 5], "top": {"n": "t"}}'], ['{"a":"t","b":null,"y":null,"z":{"n":"t"}}', "5"]),
        "oldshape": ({"merge_fields_json": {"a": "top.n"}}, [json_, "{}"], "merged fields"),
        "wiped": ({"key_params_list": ["NOW"]}, [json_, "{}"], "would lose"),
        "kept": ({"output_tables_json": {}, "persist_env_json": {"t": "T"}}, [json_, b"\xff"], "UnicodeDecodeError"),
    }
    browse.Config(store, "api_mst").create(*(api(name, **({"output_tables_json": {"items": "api_rst"}} | more)) for name, (more, *_) in cases.items()))
    rows = spark.createDataFrame([(f"j_{n}", n, "{}", True, "overwrite", "all") for n in cases], "job_id string, api_id string, params_json string, is_active boolean, save_mode string, execution_cycle string")
    store.append("api_job", rows)
    held = {f"http://x/{n}?c=:CODE": a for n, (_, a, _) in cases.items()}
    done = {r.job_id: r for r in run.cycle(store, "all", NOW, send=http.replies(held), wait=lambda _: None, store={}, tasks=2).collect()}
    saved = {n: [] for n in cases}
    for r in store.results("api_rst").orderBy("id").collect():
        saved[r.job_id[2:]].append(json.dumps(json.loads(r.result_json), sort_keys=True, ensure_ascii=False, separators=(",", ":")))
    for name, (_, _, want) in cases.items():
        error = done[f"j_{name}"].error
        assert (want in (error or "") and not saved[name]) if isinstance(want, str) else (error is None and saved[name] == want), (name, error, saved[name])
    logged = {r.job_id: r.status for r in store.read("api_job_log").collect()}
    assert logged == {f"j_{n}": "FAILED" if isinstance(w, str) else "SUCCESS" for n, (_, _, w) in cases.items()}
    assert sorted(r.id for r in store.read("api_job_log").collect()) == list(range(1, len(cases) + 1))


def test_a_secret_of_one_job_is_in_the_requests_of_the_next(spark, store):
    browse.Config(store, "api_mst").create(api("login", api_url="http://x/login", output_tables_json={}, persist_env_json={"auth.token": "TOK"}))
    browse.Config(store, "api_mst").create(api("with", api_url="http://x/data", header_json={"Authorization": "Bearer ${TOK}"}, output_tables_json={"items": "api_rst"}))
    browse.Config(store, "api_job").create(*({"job_id": f"a_{name}", "api_id": name, "params_json": {}, "execution_cycle": "s"} for name in ("with", "login")))

    def send(request):
        body = {"auth": {"token": "fresh"}} if request["url"].endswith("login") else {"items": [{"h": request["headers"]["Authorization"]}]}
        return 200, "application/json", json.dumps(body).encode()

    kept = {"TOK": "stale", "OTHER": "x"}
    assert run.said(run.cycle(store, "s", NOW, send=send, wait=lambda _: None, store=kept, tasks=2)) == {"a_login": "", "a_with": "api_rst: 1"}
    assert kept["TOK"] == "fresh" and store.results("api_rst").first().result_json == '{"h":"Bearer fresh"}'


def test_formats_encodings_and_archives(spark):
    row = lambda **x: spark.createDataFrame([tuple(x.values())], list(x)).select("*")
    formats = [row(t=t or "", c=c, b=b).select(parse.response_format(F.nullif("t", F.lit("")), F.col("c"), F.col("b"))).first()[0] for t, c, b in ((None, "text/xml", "x"), (None, "", "  <a/>"), (None, "application/json", "{}"), ("delimited", "text/xml", ""))]
    assert formats == ["xml", "xml", "json", "delimited"]
    held = io.BytesIO()
    with zipfile.ZipFile(held, "w") as z:
        z.writestr("one.txt", "가|나\n".encode("cp949"))
        z.writestr("two.txt", "x|y\n")
    df = spark.createDataFrame([(held.getvalue(),)], "b binary")
    opened = lambda inner: df.select(parse.unzip(F.col("b"), inner).alias("o")).select("o.*")
    text = lambda inner, encoding: opened(inner).select(parse.decode(F.col("value"), encoding).alias("t")).first().t.value
    assert text(None, "cp949") == "가|나\n" and text("two.txt", None) == "x|y\n"
    both = spark.createDataFrame([("a",)], "x string").select(parse.decode(F.lit(b"\xef\xbb\xbfa\xff"), None).alias("u"), parse.decode(F.lit(b"\xef\xbb\xbfa"), F.lit("UTF_8")).alias("v")).first()
    assert both.u.value is None and "UTF-8" in both.u.error and both.v.value == "\ufeffa" and both.v.error is None
    with pytest.raises(ValueError):
        parse.check_mapping({}, None)


def records(page, selector):
    path, attribute = parse.xml_selector(selector)
    return [parse.xml_record(e, attribute) for e in parse.xml_elements(page, path)]


def test_xml_rules():
    page = '<r><result><ISIN value="x"/><NAME>y</NAME></result><result><ISIN val="x"/><A p="1" q="2"/><T>1</T><T>2</T><N><K z="5"/><M> </M></N></result><result a="1"/><result>txt</result></r>'
    assert records(page, "result") == [{"ISIN": "x", "NAME": "y"}, {"ISIN": "x", "A": {"p": "1", "q": "2"}, "T": ["1", "2"], "N": {"K": "5", "M": None}}, {"a": "1"}, {}]
    assert records(page, "result#q")[1]["A"] == "2"
    assert [parse.xml_selector(x)[0] for x in ("vector.data.result", "result", ".//detail/result")] == [".//vector/data/result", ".//result", ".//detail/result"]


def test_pulled_elements_are_those_of_the_whole_tree(monkeypatch):
    from random import Random
    from xml.etree import ElementTree

    monkeypatch.setattr(parse, "FED", 7)
    luck = Random(5)

    def grown(depth):
        inner = "".join(grown(depth - 1) for _ in range(luck.randrange(4))) if depth else luck.choice(["", "t", " é "])
        name = luck.choice("abc")
        return f"<{name} k='{luck.randrange(9)}'>{inner}</{name}>tail"

    for _ in range(60):
        page = f"<r>{grown(4)}{grown(4)}</r>"
        for path in (".//a", ".//a/b", ".//*/a", ".//c/*", ".//a/a/a", "a/b", ".//a[@k='3']", ".//r"):
            whole = [(e.tag, e.attrib, parse.xml_record(e, None)) for e in ElementTree.fromstring(page).iterfind(path)]
            pulled = [(e.tag, e.attrib, parse.xml_record(e, None)) for e in parse.xml_elements(page, path)]
            # The tree lists children of nested elements of one name by their parents, the pull parser in document order.
            assert pulled == whole if path.count("/") == 2 else sorted(map(repr, pulled)) == sorted(map(repr, whole)), path


def test_a_large_xml_body_is_read_in_little_memory(spark):
    import tracemalloc

    body = "<r>" + "<item><v>some text</v><w a='1'/></item>" * 200_000 + "</r>"
    tracemalloc.start()
    assert sum(1 for _ in parse._xml_rows(body, "item")) == 200_000
    assert tracemalloc.get_traced_memory()[1] < 3 << 20  # the tree of this body has some 200 MB
    tracemalloc.stop()
    df = spark.createDataFrame([("j", body, "item"), ("k", "<r><item/>", "item"), ("l", None, "item")], "job string, body string, selector string")
    got = parse.xml_records(df, "body", "selector", ["job"]).groupBy("job").agg(F.count("record").alias("n"), F.max("pos").alias("last"), F.max("error").alias("error")).collect()
    assert {r.job: (r.n, r.last, (r.error or "")[:10]) for r in got} == {"j": (200_000, 199_999, ""), "k": (1, 1, "ParseError")}


def test_lines_and_cells(spark):
    got = lambda text, names=None, sep=",", header=False: spark.createDataFrame([(text,)], "b string").select(parse.delimited_records(F.col("b"), names, sep, header)).first()[0]
    assert got('"a|b"|c\r\n\n \n"x ""q"" \n y"|z|extra\nshort\n|b\nq"uo"te|"e"tail', ["p", "q"], "|") == [{"p": "a|b", "q": "c"}, {"p": None}, {"p": 'x "q" \n y', "q": "z"}, {"p": "short"}, {"p": None, "q": "b"}, {"p": 'q"uo"te', "q": "etail"}]
    assert got("h1, h2\n1,2\n3\n", header=True) == [{"h1": "1", "h2": "2"}, {"h1": "3"}] and got("a,b\n1,2", ["x", "y"], header=True) == [{"x": "1", "y": "2"}]
    assert got("a,,a,\n1,2,3,4\n5", header=True) == [{"a": "3", "": "4"}, {"a": "5"}] and got('"a","a"\n"1","2"', header=True) == [{"a": "2"}]
    assert got(None, ["x"]) is None and got("", header=True) is None and got("", ["x"]) == [] and got("a", None) is None and got("a^b]c\n\\\t", ["x", "y"], "^") == [{"x": "a", "y": "b]c"}, {"x": "\\"}]
    assert got("a가b", ["x", "y"], "가") == [{"x": "a", "y": "b"}] and got("a\tb", ["x", "y"], "\t") == [{"x": "a", "y": "b"}] and got("a]b", ["x", "y"], "]") == [{"x": "a", "y": "b"}]
    assert len(got('"' + 'x""' * 100_000 + '"', ["x"])[0]["x"]) == 200_000
    error = lambda *x: spark.range(1).select(parse.delimited_error(F.lit("a"), *x)).first()[0]
    assert "field names" in error(None) and "separator" in error(["x"], "||") and error(["x"]) is None and error(None, ",", True) is None


@pytest.mark.parametrize(
    ("value", "kind", "want"),
    [
        ('"19.20"', "double", 19.2), ('" 1.5 "', "double", 1.5), ('" 7 "', "bigint", 7), ('""', "double", ...), ('""', "bigint", ...), ('"12.0"', "bigint", 12), ('"12.5"', "bigint", ...),
        ("12.5", "bigint", ...), ("12.0", "bigint", 12), ('"1_000"', "bigint", 1000), ('"1_000.5"', "double", 1000.5), ('"1,000"', "double", ...), ("5", "string", ...), ('"abcde"', "string", ...),
        ('"abcd"', "string", "abcd"), ("true", "bigint", 1), ("true", "double", 1.0), ("null", "double", None), ("[1]", "string", ...), ('"yes"', "boolean", True), ("0", "boolean", False), ("2", "boolean", ...),
        ('"2024-02-29"', "date", date(2024, 2, 29)), ('"2024-02-30"', "date", ...), ('"2024-02-29T01:02:03"', "timestamp_ntz", datetime(2024, 2, 29, 1, 2, 3)), ("9007199254740993", "bigint", 9007199254740993),
    ],
)
def test_values_are_read_leniently_or_are_bad(spark, value, kind, want):
    from pyspark.sql import types as T

    made = spark.createDataFrame([(value,)], "v string").select(save.coerce_variant(F.parse_json("v"), T._parse_datatype_string(kind), 4).alias("x")).first().x
    assert (made.bad, made.value) == ((True, None) if want is ... else (False, want))


def test_records_go_before_key_parameters_and_ids(spark):
    df = spark.createDataFrame([("j", "a", "j", '{"short_code": "k", "hhmm": "1"}', '{"short_code": "r", "job_id": "own", "stck_bsop_date": "20240101", "stck_cntg_hour": null}')], "job_id string, api_id string, x string, key_params string, record string")
    row = save.typed_records(df, schemas.RESULTS["kis_futopt_chart"], ["job_id"]).first()
    assert (row.run_job_id, row.job_id, row.short_code, row.hhmm, row.stck_bsop_date, row.bad) == ("j", "own", "r", "1", "20240101", 1)  # one not-null column is null


def test_ids(spark):
    params = spark.createDataFrame([("x", None), (None, "x")], "a string, b string")
    builder = {"api_id": "api", "build_id": "b"}
    made, stable = jobs.identified(params, builder, ["a", "b"])
    assert stable and {r.job_id for r in made.collect()} == {"api_x_None", "api_None_x"}
    made, stable = jobs.identified(params, builder, None)
    ids = [r.job_id for r in made.collect()]
    assert not stable and len({*ids}) == 2 and all(len(x) == 16 for x in ids)
    assert {r.job_id for r in jobs.identified(params, builder, ["NOW"])[0].collect()} == {"api_b"}
    for wrong in ({"NOW,A": 1}, {"A,B": 1}, {"A": {"db": "DROP TABLE x"}}, {"A,B": {"db": "SELECT 1"}}, {"A": {"db": "SELECT 1 WHERE 1 = 0"}}, {"A": {"date": "noday"}}):
        with pytest.raises(ValueError):
            jobs.axes(spark, wrong, date(2024, 1, 1))
    with pytest.raises(ValueError):
        jobs.key_params([{"A": "a", "B": "b"}])
    assert jobs.key_params(["A", {"B": "c"}]) == [("A", "a"), ("B", "c")] and jobs.is_repeated([{"NOW": "at"}]) and not jobs.is_repeated(None)


def test_substitution_in_columns(spark):
    made = template.substitute(F.lit("/:KEY가/:KEY/:OTHER/x:KEY"), {"KEY": F.lit(r"$1\:OTHER"), "OTHER": F.lit("o")})
    assert spark.range(1).select(made).first()[0] == r"/:KEY가/$1\o/o/x:KEY"


def test_buffered_tables_are_read_with_their_types(spark, tmp_path):
    (tmp_path / "job.csv").write_text('short_code,stck_bsop_date,cntg_vol,futs_prpr\nA,"two\nlines ""q""",12,\n007,,,1.5\n')
    names = ("short_code", "stck_bsop_date", "cntg_vol", "futs_prpr")
    schema = type(schemas.API_RST)([schemas.RESULTS["kis_futopt_chart"][n] for n in names])
    got = tables.buffered(spark, f"file://{tmp_path}/job.csv", schema)
    assert [tuple(r) for r in got.collect()] == [("A", 'two\nlines "q"', 12, None), ("007", None, None, 1.5)]


def test_the_source_deals_requests_over_tasks_and_keeps_errors(spark, tmp_path):
    (tmp_path / "tape.json").write_text(json.dumps({"http://x/1": ["application/json", "{}"]}))
    requests = [{"job_id": f"j{i}", "page": 1, "method": "GET", "url": f"http://x/{i}", "headers": {}, "body_kind": None, "body": None, "wrong": None} for i in (1, 2)]
    rows = {r.job_id: r for r in land.land(spark, requests, f"file://{tmp_path}/landed", str(tmp_path / "tape.json")).collect()}
    assert rows["j1"].status == 200 and bytes(rows["j1"].body) == b"{}" and rows["j2"].error.startswith("OSError") and rows["j2"].body is None


def test_hosts_keep_their_calls_in_one_task(spark):
    urls = spark.range(200).select(F.col("id").cast("string").alias("job_id"), F.lit(1).alias("page"), F.lit("GET").alias("method"), F.concat(F.lit("http://h"), F.col("id") % 5, F.lit("/"), "id").alias("url"),
        F.create_map().cast("map<string,string>").alias("headers"), *(F.lit(None).cast("string").alias(c) for c in ("body_kind", "body", "wrong")))
    held = {f"http://h{i % 5}/{i}": ["text/plain", "x"] for i in range(200)}
    made = http.responses(urls, http.replies(held), lambda _: None, 8, 0.0).withColumn("task", F.spark_partition_id()).withColumn("host", F.col("job_id").cast("int") % 5)
    assert made.groupBy("host").agg(F.count_distinct("task").alias("n")).filter("n > 1").isEmpty() and made.filter("error is null").count() == 200


def _rows(spark, ids, value, job="job"):
    return spark.createDataFrame([(f"{job}{i}", "a", value) for i in ids], "job_id string, api_id string, result_json string")


def test_a_change_of_several_tables_is_seen_as_a_whole_or_not_at_all(spark, tmp_path):
    t = tables.Tables(spark, f"file://{tmp_path}/t")
    t.append("api_rst", _rows(spark, range(10), "old"))
    with pytest.raises(RuntimeError):
        with t.change() as c:
            c.append("api_rst", _rows(spark, range(3), "new"))
            c.append("api_job_log", spark.createDataFrame([(1, "j", "SUCCESS")], "id long, job_id string, status string"))
            raise RuntimeError("killed between two tables")
    assert t.results("api_rst").count() == 10 and t.read("api_job_log").count() == 0
    assert t.vacuum() == 2 and t.results("api_rst").count() == 10
    with t.change() as c:
        c.replace_keys("api_rst", _rows(spark, [3], "new"), _rows(spark, [3, 4], ""))
        c.append("api_job_log", spark.createDataFrame([(1, "j", "SUCCESS")], "id long, job_id string, status string"))
    assert {(r.job_id, r.result_json) for r in t.results("api_rst").collect()} == {(f"job{i}", "new" if i == 3 else "old") for i in range(10) if i != 4}
    assert t.state().version == 2


def test_of_two_writers_of_one_bucket_one_is_refused(spark, tmp_path):
    one, two = (tables.Tables(spark, f"file://{tmp_path}/t") for _ in "12")
    one.append("api_rst", _rows(spark, range(200), "old"))
    first, second, third = one.change(), two.change(), two.change()
    a, b, c = first.__enter__(), second.__enter__(), third.__enter__()
    a.replace_keys("api_rst", _rows(spark, [7], "a"), _rows(spark, [7], ""))
    b.replace_keys("api_rst", _rows(spark, [7], "b"), _rows(spark, [7], ""))
    c.append("api_rst", _rows(spark, [500], "c"))
    a.commit()
    c.commit()  # what is only appended has read nothing
    with pytest.raises(tables.Conflict):
        b.commit()
    got = {r.job_id: r.result_json for r in two.results("api_rst").collect()}
    assert got["job7"] == "a" and got["job500"] == "c" and len(got) == 201
    # Rows of a key that neither writer found.
    with pytest.raises(tables.Conflict), one.change() as x:
        x.rows_of("api_job", spark.createDataFrame([("new",)], "k string")).count()
        browse.Config(two, "api_job").create({"job_id": "new", "api_id": "a", "params_json": {}})


def test_ids_are_given_once(spark, tmp_path):
    t = tables.Tables(spark, f"file://{tmp_path}/t")
    got = []
    threads = [threading.Thread(target=lambda: got.extend(range(s := t.reserve("api_rst", 5), s + 5))) for _ in range(6)]
    for x in threads:
        x.start()
    for x in threads:
        x.join()
    assert sorted(got) == list(range(1, 31)) and t.state().next_id["api_rst"] == 31


def test_overwriting_a_job_opens_its_bucket_alone(spark, tmp_path):
    t = tables.Tables(spark, f"file://{tmp_path}/t")
    t.append("api_rst", spark.range(20_000).select(F.concat(F.lit("job"), "id").alias("job_id"), F.lit("a").alias("api_id"), F.lit("old").alias("result_json")))
    with t.change() as c:
        held = c.rows_of("api_rst", spark.createDataFrame([("job77",)], "k string"))
        assert len({f.split("/_bucket=")[1].split("/")[0] for f in held.inputFiles()}) == 1
        plan = held._jdf.queryExecution().toString()
        assert "PartitionFilters: [_bucket" in plan.replace("isnotnull(_bucket#", "_bucket") or "PartitionFilters: [isnotnull(_bucket" in plan
        c.replace_keys("api_rst", _rows(spark, [77], "new"), _rows(spark, [77], ""))
    assert [len(x) for x in c.add["api_rst"].values()] == [1] and t.results("api_rst").count() == 20_000
    assert t.results("api_rst", ["job77"]).first().result_json == "new" and len(t.results("api_rst", ["job77"]).inputFiles()) < 4


def test_a_folder_keeps_its_number_of_buckets(spark, tmp_path):
    one = tables.Tables(spark, f"file://{tmp_path}/t", buckets=3)
    one.append("api_rst", _rows(spark, range(50), "x"))
    two = tables.Tables(spark, f"file://{tmp_path}/t")
    assert two.buckets == 3 and two.results("api_rst", ["job7"]).count() == 1


def test_small_segments_are_joined(spark, tmp_path):
    t = tables.Tables(spark, f"file://{tmp_path}/t", buckets=2)
    for i in range(4):
        t.append("api_rst", _rows(spark, range(10 * i, 10 * i + 10), str(i)))
    before = sorted(map(str, t.results("api_rst").collect()))
    assert t.compact("api_rst", 4) == 2 and t.compact("api_rst", 4) == 0 and sorted(map(str, t.results("api_rst").collect())) == before
    assert {len(s) for s in t.state().live["api_rst"].values()} == {1} and t.vacuum(0) == 4 and sorted(map(str, t.results("api_rst").collect())) == before


def test_snapshots_stand_for_the_commits_ahead_of_them(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(tables, "SNAPSHOT", 3)
    t = tables.Tables(spark, f"file://{tmp_path}/t")
    for i in range(7):
        t.append("api_job_log", spark.createDataFrame([(i, "j", "SUCCESS")], "id long, job_id string, status string"))
    t.vacuum(0)
    assert "000000000001.json" not in t._names(f"{t.root}/_log") and t.state().version == 7 and {r.id for r in t.read("api_job_log").collect()} == set(range(7))


def test_deep_pages_follow_one_another(spark):
    rows = spark.range(1, 1001)
    last, seen = None, []
    while ids := [r.id for r in save.page_after(rows, "id", last, 300).collect()]:
        seen += ids
        last = ids[-1]
    assert seen == list(range(1000, 0, -1))


def test_exports_to_objects_are_whole_or_nothing(spark, tmp_path):
    rows = spark.range(3000).select(F.concat(F.lit("j/"), F.col("id") % 7).alias("job_id"), "id", F.lit(None).cast("double").alias("x"))
    at = f"file://{tmp_path}/out"
    export.to_objects(rows, at, 3)
    back = spark.read.option("recursiveFileLookup", "true").parquet(at)
    assert sorted(map(tuple, back.select("job_id", "id", "x").collect())) == sorted(map(tuple, rows.collect())) and back.schema["x"].dataType.simpleString() == "double"
    export.to_objects(rows.filter("job_id = 'j/3' and id < 100"), at, 3)
    assert back.sparkSession.read.option("recursiveFileLookup", "true").parquet(at).filter("job_id = 'j/3'").count() == 14
    files = lambda: sorted(os.path.join(d, f) for d, _, names in os.walk(tmp_path / "out") for f in names)
    before = files()
    with pytest.raises(Exception, match="bad row"):
        export.to_objects(rows.withColumn("x", F.when(F.col("id") == 2999, F.raise_error(F.lit("bad row")).cast("double"))), at, 3)
    assert files() == before and not (tmp_path / "out" / "_drafts").exists()


def test_only_changed_jobs_are_exported(spark, store, tmp_path):
    rows = spark.createDataFrame([(i, "a", f"job{i}", float(i)) for i in range(6)], "id long, api_id string, job_id string, futs_prpr double")
    store.append("kis_futopt_price", rows)
    log = lambda i, job, status, at: (i, job, status, at)
    store.append("api_job_log", spark.createDataFrame([log(1, "job1", "SUCCESS", NOW - timedelta(hours=1)), log(2, "job2", "SUCCESS", NOW + timedelta(hours=1)), log(3, "job3", "FAILED", NOW + timedelta(hours=1))], "id long, job_id string, status string, executed_at timestamp_ntz"))
    done = export.finalize(store, f"file://{tmp_path}/out", date(2024, 3, 29), since=NOW).collect()
    assert [(r.table, r.job_id, r.n) for r in done] == [("kis_futopt_price", "job2", 1)]
    assert spark.read.parquet(f"file://{tmp_path}/out/kis_futopt_price/latest").count() == 1


def _files(path):
    return sorted(os.path.relpath(os.path.join(d, f), path) for d, _, names in os.walk(path) for f in names if f.endswith(".parquet"))


def test_an_exports_files_do_not_grow_with_its_jobs(spark, tmp_path):
    at = f"{tmp_path}/out"
    rows = spark.range(3000).select(F.concat(F.lit("j/"), F.col("id") % 1000).alias("job_id"), "id", F.lit(None).cast("double").alias("x"))
    export.export(rows, f"file://{at}")
    assert 0 < len(_files(at)) <= 2 * export.BUCKETS
    # Other jobs of the buckets that are written again keep their rows, and the columns that only they have.
    export.export(spark.createDataFrame([("j/7", -1), (None, -2)], "job_id string, id long"), f"file://{at}")
    export.export(rows.limit(0), f"file://{at}")
    want = {tuple(r) for r in rows.filter("job_id != 'j/7'").collect()} | {("j/7", -1, None), (None, -2, None)}
    back = spark.read.option("mergeSchema", True).parquet(f"file://{at}")
    assert sorted(map(repr, map(tuple, back.select("job_id", "id", "x").collect()))) == sorted(map(repr, want)) and back.schema["x"].dataType.simpleString() == "double"
    assert len(_files(at)) <= 4 * export.BUCKETS and not [n for n in os.listdir(at) if n.startswith("_draft")]


def test_an_export_that_breaks_off_changes_nothing_or_is_completed(spark, tmp_path, monkeypatch):
    at = f"{tmp_path}/out"
    rows = spark.range(300).select(F.concat(F.lit("j"), F.col("id") % 100).alias("job_id"), "id")
    found = lambda: sorted(map(tuple, spark.read.parquet(f"file://{at}").select("job_id", "id").collect()))
    rows.withColumn("job", F.md5("job_id")).write.partitionBy("job").parquet(f"file://{at}")  # folders of single jobs, of earlier versions
    before = _files(at)
    with pytest.raises(Exception, match="bad row"):
        export.export(rows.withColumn("id", F.when(F.col("id") == 299, F.raise_error(F.lit("bad row")).cast("long"))), f"file://{at}")
    assert _files(at) == before
    # The driver is lost when all is written and nothing is in place yet.
    with monkeypatch.context() as lost:
        lost.setattr(export, "_put", lambda spark, path: None)
        export.export(rows.filter("job_id = 'j3' and id > 200"), f"file://{at}")
    assert [f for f in _files(at) if not f.startswith("_draft")] == before
    export.export(rows.filter("job_id = 'j4' and id > 200"), f"file://{at}")
    assert found() == sorted((r.job_id, r.id) for r in rows.collect() if r.job_id not in ("j3", "j4") or r.id > 200)
