"""HTTP services as Spark data sources (SRC-01, 02, 04 to 08).  Requests run in the reader's tasks, never on the driver's rows."""

from __future__ import annotations

import json
import re
import sys
import time
import urllib.error
import urllib.parse
import urllib.request
from bisect import bisect_right
from collections.abc import Callable, Iterator, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, InputPartition

# Retry policies, page size and timeouts of the services.
RETRIED = (429, 500, 502, 503, 504)
PAGE_IDS, PAGE_PAUSE = 1800, 0.1
MAP_TRIES, MAP_PAUSE, MAP_TIMEOUT = 4, 2.0, 180
LINES_TIMEOUT = 400
SERVICE_TRIES, SERVICE_BACKOFF = 5, 0.4
#: Requests that a service sees at a time.
AT_ONCE = 4
ENDPOINT_TRIES, ENDPOINT_PAUSE, ENDPOINT_TIMEOUT = 3, 1.0, 30


def fetch(url: str, data: bytes | None = None, headers: dict[str, str] | None = None, timeout: float = 30) -> str:
    request = urllib.request.Request(url, data=data, headers=headers or {})
    with urllib.request.urlopen(request, timeout=timeout) as answer:
        return answer.read().decode("utf-8")


def substations_query(iso: str) -> str:
    """Substations of a country: nodes, ways and relations with tags and centres."""
    area = f'area["ISO3166-1"="{iso.strip().upper()}"][admin_level=2]->.a;'
    kinds = "".join(f'{k}["power"="substation"](area.a);' for k in ("node", "way", "relation"))
    return f"[out:json][timeout:1800];{area}({kinds});out body center tags;"


def lines_query(iso: str) -> str:
    """Power lines of a country, and the nodes they go through."""
    area = f'area["ISO3166-1"="{iso.strip().upper()}"][admin_level=2]->.a;'
    return f'[out:json][timeout:300];{area}(way["power"~"^(line|minor_line)$"](area.a););out body;>;out skel qt;'


def post_in_turn(endpoints: Sequence[str], query: str, tries: int = MAP_TRIES, pause: float = MAP_PAUSE, timeout: float = MAP_TIMEOUT, get: Callable = fetch, sleep: Callable = time.sleep) -> str:
    """Rounds over the endpoints; after each failure a pause that grows with the round.  Raises when all have failed."""
    last: Exception | None = None
    for i in range(1, tries + 1):
        for url in endpoints:
            try:
                return get(url, urllib.parse.urlencode({"data": query}).encode(), None, timeout)
            except (OSError, ValueError) as e:
                last = e
                sleep(pause * i)
    raise RuntimeError(f"all endpoints failed: {last}")


def get_with_retry(url: str, tries: int = SERVICE_TRIES, backoff: float = SERVICE_BACKOFF, timeout: float = 120, headers: dict[str, str] | None = None, get: Callable = fetch, sleep: Callable = time.sleep) -> str:
    """Repeats after statuses that may pass, and after broken connections, with doubling pauses."""
    for i in range(tries + 1):
        try:
            return get(url, None, headers, timeout)
        except urllib.error.HTTPError as e:
            if e.code not in RETRIED or i == tries:
                raise
        except OSError:
            if i == tries:
                raise
        sleep(backoff * 2**i)
    raise AssertionError


def chunked(ids: Sequence[int], n: int = PAGE_IDS) -> Iterator[Sequence[int]]:
    for i in range(0, len(ids), n):
        yield ids[i : i + n]


class _Reader(DataSourceReader):
    def __init__(self, options: dict[str, str]):
        self.options = dict(options)

    def partitions(self) -> list[InputPartition]:
        return [InputPartition(0)]


class MapElements(DataSource):
    """Format `map_elements`: options endpoints (comma-separated), query.  One row: the answer as `payload`."""

    @classmethod
    def name(cls) -> str:
        return "map_elements"

    def schema(self) -> str:
        return "payload string"

    def reader(self, schema) -> DataSourceReader:
        return _MapReader(self.options)


class _MapReader(_Reader):
    def read(self, partition: InputPartition) -> Iterator[tuple[str]]:
        o = self.options
        yield (post_in_turn(o["endpoints"].split(","), o["query"], int(o.get("tries", MAP_TRIES)), float(o.get("pause", MAP_PAUSE)), float(o.get("timeout", MAP_TIMEOUT))),)


class FeatureService(DataSource):
    """Format `feature_service`: option url (the layer).  A row for each feature, as GeoJSON text.

    Object ids are listed once, sorted, and read in pages of `page` ids; the service sees at most `at_once` requests at a
    time, and each reader waits `pause` seconds between two of its pages.  As a stream, a batch is the next `at_once`
    pages and its offset the last id, so what the checkpoint holds isn't fetched again, and later runs read objects of
    greater ids only.  No objects: the batch reader raises, a stream waits.
    """

    @classmethod
    def name(cls) -> str:
        return "feature_service"

    def schema(self) -> str:
        return "feature string"

    def reader(self, schema) -> DataSourceReader:
        return _ServiceReader(self.options)

    def streamReader(self, schema) -> DataSourceStreamReader:
        return _ServiceStream(self.options)


class _Layer:
    """A layer's ids and pages."""

    def __init__(self, options: dict[str, str]):
        self.options = o = dict(options)
        self.page, self.at_once = int(o.get("page", PAGE_IDS)), int(o.get("at_once", AT_ONCE))
        self.pause = float(o.get("pause", PAGE_PAUSE))
        if self.page < 1 or self.at_once < 1:
            raise ValueError("page and at_once must be 1 or more")

    def _ask(self, **params: str) -> dict:
        o = self.options
        url = f"{o['url'].rstrip('/')}/query?{urllib.parse.urlencode(params)}"
        answer = json.loads(get_with_retry(url, int(o.get("tries", SERVICE_TRIES)), float(o.get("backoff", SERVICE_BACKOFF))))
        if "error" in answer:  # such services say errors with status 200
            raise RuntimeError(f"{url}: {answer['error']}")
        return answer

    def ids(self) -> list[int]:
        return sorted(self._ask(where="1=1", returnIdsOnly="true", f="json").get("objectIds") or [])

    def read(self, partition: InputPartition) -> Iterator[tuple[str]]:
        for i, ids in enumerate(partition.value):
            if i:
                time.sleep(self.pause)
            page = self._ask(objectIds=",".join(map(str, ids)), outFields="*", outSR="4326", f="geojson")
            for feature in page.get("features", []):
                yield (json.dumps(feature, ensure_ascii=False),)


class _ServiceReader(_Layer, DataSourceReader):
    def partitions(self) -> list[InputPartition]:
        pages = [list(c) for c in chunked(self.ids(), self.page)]
        if not pages:
            raise ValueError("the service has no objects")
        return [InputPartition(pages[i :: self.at_once]) for i in range(min(self.at_once, len(pages)))]


class _ServiceStream(_Layer, DataSourceStreamReader):
    def __init__(self, options: dict[str, str]):
        super().__init__(options)
        self.last: int | None = None  # id up to which batches are planned
        self.started = False
        self.known: list[int] = []

    def initialOffset(self) -> dict:
        return {"last": None}

    def _after(self, last: int | None) -> list[int]:
        return self.known if last is None else self.known[bisect_right(self.known, last) :]

    def latestOffset(self) -> dict:
        self.started = True
        if not self._after(self.last):
            self.known = self.ids()
        ahead = self._after(self.last)[: self.page * self.at_once]
        if ahead:
            self.last = ahead[-1]
        return {"last": self.last}

    def partitions(self, start: dict, end: dict) -> list[InputPartition]:
        if not self.started:  # a restart: the engine first plans the last batch of its log, then goes on from there
            self.started, self.last = True, end["last"]
        if end["last"] is None:
            return []
        if not self.known or self.known[-1] < end["last"]:
            self.known = self.ids()
        ids = [i for i in self._after(start["last"]) if i <= end["last"]]
        return [InputPartition([list(c)]) for c in chunked(ids, self.page)]

    def commit(self, end: dict) -> None:
        pass


class JsonEndpoint(DataSource):
    """Format `json_endpoint`: options url, and header.NAME for headers.  One row: url, payload."""

    @classmethod
    def name(cls) -> str:
        return "json_endpoint"

    def schema(self) -> str:
        return "url string, payload string"

    def reader(self, schema) -> DataSourceReader:
        return _EndpointReader(self.options)


def _json_text(url: str, o: dict[str, str]) -> str:
    """What an endpoint says; raises the last failure when all tries are spent, and JSON it must be."""
    headers = {k[7:]: v for k, v in o.items() if k.startswith("header.")}
    last: Exception | None = None
    for i in range(int(o.get("tries", ENDPOINT_TRIES))):
        if i:
            time.sleep(float(o.get("pause", ENDPOINT_PAUSE)))
        try:
            text = fetch(url, None, headers, ENDPOINT_TIMEOUT)
            json.loads(text)
            return text
        except (OSError, ValueError) as e:
            last = e
    raise RuntimeError(f"{url}: {last}")


class _EndpointReader(_Reader):
    def read(self, partition: InputPartition) -> Iterator[tuple[str, str]]:
        yield self.options["url"], _json_text(self.options["url"], self.options)


class JsonEndpoints(DataSource):
    """Format `json_endpoints`: option urls (apart by blanks), and header.NAME.  A partition and a row for each: url,
    payload, error.  One that fails has no payload but its error, and the others go on (SRC-08)."""

    @classmethod
    def name(cls) -> str:
        return "json_endpoints"

    def schema(self) -> str:
        return "url string, payload string, error string"

    def reader(self, schema) -> DataSourceReader:
        return _EndpointsReader(self.options)


class _EndpointsReader(_Reader):
    def partitions(self) -> list[InputPartition]:
        urls = re.findall(r"\S+", self.options["urls"])
        if not urls:
            raise ValueError("no endpoints")
        return [InputPartition(u) for u in urls]

    def read(self, partition: InputPartition) -> Iterator[tuple[str, str | None, str | None]]:
        try:
            yield partition.value, _json_text(partition.value, self.options), None
        except (RuntimeError, ValueError) as e:  # ValueError: no URL at all
            yield partition.value, None, str(e)


def register(spark: SparkSession) -> None:
    for source in (MapElements, FeatureService, JsonEndpoint, JsonEndpoints):
        spark.dataSource.register(source)


def each_endpoint(urls: Sequence[str], job: Callable[[str], DataFrame | None]) -> dict[str, Exception]:
    """Runs a job for each endpoint; one that fails is reported and the others go on (SRC-08)."""
    failed: dict[str, Exception] = {}
    for url in urls:
        try:
            job(url)
        except Exception as e:  # noqa: BLE001
            print(f"{url}: {e}", file=sys.stderr)
            failed[url] = e
    return failed
