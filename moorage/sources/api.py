"""Reports, event pages and identity searches over HTTP, cached as JSON and read as tables.

The service's address, paths and dataset names are configuration. Transport is a function, so that tests and other
clients can supply their own: (method, url, params, body, timeout) -> (status, decoded body); it raises TimeoutError or
ConnectionError when there is no answer.
"""

from __future__ import annotations

import json
import time
import urllib.error
import urllib.parse
import urllib.request
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

from moorage.sources import payloads

#: Statuses of a report that may still be running, and of a page worth asking for again.
RUNNING, PASSING = frozenset({429, 504, 524}), frozenset({408, 429, 500, 502, 503, 504, 524})
Transport = Callable[[str, str, dict, dict | None, float], tuple[int, dict]]


class ServiceError(RuntimeError):
    pass


def http(token: str) -> Transport:
    """Transport over urllib with a bearer token."""

    def send(method: str, url: str, params: dict, body: dict | None, timeout: float) -> tuple[int, dict]:
        full = f"{url}?{urllib.parse.urlencode(params)}" if params else url
        request = urllib.request.Request(full, None if body is None else json.dumps(body).encode(), {"Authorization": f"Bearer {token}", "Content-Type": "application/json"}, method=method)
        try:
            with urllib.request.urlopen(request, timeout=timeout) as answer:
                return answer.status, json.load(answer)
        except urllib.error.HTTPError as e:
            return e.code, {"detail": e.read()[:1000].decode(errors="replace")}
        except urllib.error.URLError as e:
            raise (TimeoutError if isinstance(e.reason, TimeoutError) else ConnectionError)(str(e.reason)) from e

    return send


@dataclass
class Service:
    """``paths``: urls of ``report``, ``last_report``, ``events`` and ``vessels``."""

    send: Transport
    paths: dict[str, str]
    timeout: float = 110
    poll_seconds: float = 5
    polls: int = 36
    attempts: int = 5
    sleep: Callable[[float], None] = field(default=time.sleep)

    def report(self, geometry: dict, params: dict) -> dict:
        """A report; if the answer is late, the running one is waited for rather than started again."""
        try:
            status, body = self.send("POST", self.paths["report"], params, {"geojson": geometry}, self.timeout)
        except TimeoutError:
            return self._last_report()
        return self._last_report() if status in RUNNING else _sound(status, body)

    def _last_report(self) -> dict:
        for _ in range(self.polls):
            status, body = self.send("GET", self.paths["last_report"], {}, None, 30)
            if status != 404:
                state = _sound(status, body).get("status")
                if isinstance(state, int) and state >= 400:
                    raise ServiceError(f"report failed: {body}")
                if state != "running":
                    return body
            self.sleep(self.poll_seconds)
        raise TimeoutError("the report is still running after the last poll")

    def events(self, geometry: dict, start: str, end: str, dataset: str, limit: int = 500) -> Iterator[dict]:
        """All events, page by page; a page that fails in passing is asked for again at the same offset."""
        body = {"datasets": [dataset], "startDate": start, "endDate": end, "geometry": geometry}
        offset = 0
        while True:
            page = self._page({"offset": offset, "limit": limit}, body)
            yield from page.get("entries", [])
            following = page.get("nextOffset")
            if following is None or int(following) == offset:
                return
            offset = int(following)

    def _page(self, params: dict, body: dict) -> dict:
        for attempt in range(1, self.attempts + 1):
            try:
                status, found = self.send("POST", self.paths["events"], params, body, 120)
            except (TimeoutError, ConnectionError):
                if attempt == self.attempts:
                    raise
            else:
                if status not in PASSING or attempt == self.attempts:
                    return _sound(status, found)
            self.sleep(min(10 * 2 ** (attempt - 1), 60))
        raise AssertionError

    def vessels(self, query: str, params: dict | None = None) -> dict:
        return _sound(*self.send("GET", self.paths["vessels"], {"query": query, "limit": 50, **(params or {})}, None, 60))


def _sound(status: int, body: dict) -> dict:
    if not 200 <= status < 300:
        raise ServiceError(f"status {status}: {body}")
    return body


def fetch(spark: SparkSession, service: Service, geometry: dict, start: str, end: str, folder: str, report_params: dict, datasets: dict[str, str], days: int = 31, limit: int = 500) -> tuple[DataFrame, dict[str, DataFrame]]:
    """Presence and events of [start, end): one chunk after the other, as the service runs one report at a time. Chunks
    that ``folder`` (any store that Spark reaches) holds already aren't asked for again."""
    chunks = [(str(r.chunk_start), str(r.chunk_end)) for r in payloads.date_chunks(spark, start, end, days).orderBy("chunk_start").collect()]
    for a, b in chunks:
        _once(spark, f"{folder}/presence_{a}_{b}", lambda a=a, b=b: service.report(geometry, {**report_params, "date-range": f"{a},{b}"}))
        for kind, dataset in datasets.items():
            _once(spark, f"{folder}/events_{kind}_{a}_{b}", lambda a=a, b=b, dataset=dataset: {"entries": list(service.events(geometry, a, b, dataset, limit))})
    read = lambda name: spark.read.text([f"{folder}/{name}_{a}_{b}" for a, b in chunks], wholetext=True).withColumnRenamed("value", "payload")
    return payloads.flatten_presence(read("presence")), {k: payloads.flatten_events(read(f"events_{k}"), k) for k in datasets}


def _once(spark: SparkSession, path: str, ask: Callable[[], dict]) -> None:
    jvm = spark.sparkContext._jvm
    done = jvm.org.apache.hadoop.fs.Path(f"{path}/_SUCCESS")
    if not done.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).exists(done):
        spark.createDataFrame([(json.dumps(ask(), separators=(",", ":")),)], "value string").coalesce(1).write.mode("overwrite").text(path)
