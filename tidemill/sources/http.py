"""HTTP answers to a table of requests, and as a Spark data source.

Both are lazy, so a plan that reads them twice calls twice: land the answers once (``tidemill.plans.land``) and parse what was landed. Requests are dealt by
host, so that one task has all calls of a host and keeps the time between them.
"""

from __future__ import annotations

import heapq
import json
import time
import urllib.request
from collections import deque
from collections.abc import Callable, Iterable, Iterator, Mapping
from urllib.parse import urlencode, urlsplit

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from tidemill.functions import template

SCHEMA = "job_id string, page int, status int, content_type string, body binary, error string"
#: Columns of a request: those of ``template.request`` and whose it is.
REQUEST = ("job_id", "page", "method", "url", "headers", "body_kind", "body", "wrong")
#: Seconds for an answer, attempts, seconds between two calls of a host, characters of an error.
TIMEOUT, ATTEMPTS, DELAY, ERROR = 30, 3, 0.3, 4000
#: Answers that a task holds at most before it hands them on.
HELD = 64
Send = Callable[[dict], tuple[int, str, bytes]]


def over_http(request: dict) -> tuple[int, str, bytes]:
    """Send a request: (status, content type, body). An error status raises."""
    data, headers = request.get("content"), dict(request["headers"])
    if "json" in request:
        data = json.dumps(request["json"]).encode()
        headers.setdefault("Content-Type", "application/json")
    elif "data" in request:
        data = urlencode(request["data"]).encode()
    call = urllib.request.Request(request["url"], data, headers, method=request["method"])
    with urllib.request.urlopen(call, timeout=TIMEOUT) as r:
        return r.status, r.headers.get("Content-Type", ""), r.read()


def replies(held: dict[str, list]) -> Send:
    """Answers from URL to [content type, text or bytes], for tests; a URL without one can't be reached."""

    def send(request: dict) -> tuple[int, str, bytes]:
        if request["url"] not in held:
            raise OSError(f"no answer from {request['url']}")
        kind, text = held[request["url"]]
        return 200, kind, text.encode() if isinstance(text, str) else text

    return send


def recorded(path: str) -> Send:
    """``replies`` from a JSON file."""
    with open(path) as f:
        return replies(json.load(f))


def complete(request: Mapping, store: Mapping[str, str]) -> dict:
    """What is sent for a row of a table of requests: secrets are put into URL, headers, text and the texts among its fields."""
    if request["wrong"]:
        raise ValueError(request["wrong"])
    made = {"method": request["method"], "url": template.secrets(request["url"], store), "headers": {k: template.secrets(v, store) for k, v in dict(request["headers"] or {}).items()}}
    if request["body_kind"] == template.TEXT_BODY:
        made[template.TEXT_BODY] = template.secrets(request["body"], store).encode()
    elif request["body_kind"]:
        made[request["body_kind"]] = {k: template.secrets(v, store) if isinstance(v, str) else v for k, v in json.loads(request["body"]).items()}
    return made


def answer(request: Mapping, send: Send, store: Mapping[str, str], wait: Callable[[float], None]) -> tuple:
    """A row of SCHEMA for a request, with retries after any failure; the last one's cause is kept."""
    error = ""
    for attempt in range(ATTEMPTS):
        try:
            return (request["job_id"], request["page"], *send(complete(request, store)), None)
        except Exception as e:  # noqa: BLE001 - whatever it was is tried again, and at last the job fails with it
            error = f"{type(e).__name__}: {e}"[:ERROR]
        if attempt < ATTEMPTS - 1:
            wait(min(10, 2**attempt))
    return (request["job_id"], request["page"], None, None, None, error)


def in_turn(requests: Iterable[Mapping], due: dict[str, float], every: float, wait: Callable[[float], None], clock: Callable[[], float] = time.monotonic) -> Iterator[Mapping]:
    """Requests in the order in which their hosts may be called, after waiting for it. ``due`` has the time of the next call of each host and is kept up to date."""
    waiting: dict[str, deque] = {}
    for r in requests:
        waiting.setdefault(urlsplit(r["url"] or "").netloc, deque()).append(r)
    turns = [(due.get(h, 0.0), n, h) for n, h in enumerate(waiting)]
    heapq.heapify(turns)
    while turns:
        at, n, host = heapq.heappop(turns)
        if (left := at - clock()) > 0:
            wait(left)
        yield waiting[host].popleft()
        due[host] = clock() + every
        if waiting[host]:
            heapq.heappush(turns, (due[host], n, host))


def responses(
    requests: DataFrame, send: Send = over_http, wait: Callable[[float], None] = time.sleep, tasks: int = 64, every: float = DELAY, store: Mapping[str, str] | None = None, later: bool = False
) -> DataFrame:
    """Call a table of requests (the columns REQUEST). A host has all its calls in one of the tasks, ``every`` seconds apart; with ``later``, its first call waits as well.

    ``store`` has the secrets; they go to the tasks with the code, into no table. A request that fails is a row with its error.
    """
    secrets = dict(store or {})

    def call(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        due: dict[str, float] = {}
        for batch in batches:
            rows, held = batch.to_pylist(), []
            for r in rows:
                r["headers"] = dict(r["headers"] or [])
                if later:
                    due.setdefault(urlsplit(r["url"] or "").netloc, time.monotonic() + every)
            for r in in_turn(rows, due, every, wait):
                held.append(answer(r, send, secrets, wait))
                if len(held) == HELD:
                    yield packed(held)
                    held = []
            if held:
                yield packed(held)

    def packed(held: list[tuple]) -> pa.RecordBatch:
        kinds = (pa.string(), pa.int32(), pa.int32(), pa.string(), pa.binary(), pa.string())
        return pa.RecordBatch.from_arrays([pa.array([x[i] for x in held], kind) for i, kind in enumerate(kinds)], [c.split()[0] for c in SCHEMA.split(", ")])

    host = F.coalesce(F.try_parse_url("url", F.lit("AUTHORITY")), "url", F.lit(""))
    task = F.pmod(F.xxhash64(host), F.lit(tasks)).cast("int")
    return requests.select(*REQUEST).repartitionById(tasks, task).mapInArrow(call, SCHEMA)


class _Requests(InputPartition):
    def __init__(self, requests: list[dict]):
        self.requests = requests


class _Reader(DataSourceReader):
    def __init__(self, options: dict):
        self.requests, self.tape, self.every = json.loads(options["requests"]), options.get("recorded"), float(options.get("every", DELAY))
        self.tasks, self.store = int(options.get("tasks", 64)), json.loads(options.get("secrets", "{}"))

    def partitions(self) -> list[InputPartition]:
        hosts: dict[str, list[dict]] = {}
        for r in self.requests:
            hosts.setdefault(urlsplit(r["url"] or "").netloc, []).append(r)
        dealt = [[r for h in list(hosts)[i :: self.tasks] for r in hosts[h]] for i in range(min(self.tasks, len(hosts)))]
        return [_Requests(x) for x in dealt]

    def read(self, partition: _Requests):
        send = recorded(self.tape) if self.tape else over_http
        for r in in_turn(partition.requests, {}, self.every, time.sleep):
            yield answer(r, send, self.store, time.sleep if not self.tape else lambda _: None)


class HttpSource(DataSource):
    """Options: ``requests``, a JSON list of objects with the columns REQUEST; ``tasks``, how many tasks the hosts are dealt over; ``every``, seconds between calls of a host; ``secrets``, a
    JSON object; ``recorded``, a file of answers to use in place of the network. For requests of a table, see ``responses``."""

    @classmethod
    def name(cls) -> str:
        return "tidemill_http"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> DataSourceReader:
        return _Reader(self.options)
