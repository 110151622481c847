"""A paginated content API as a Spark data source: ``spark.read.format("content_api")``.

The driver finds where the listing ends with some twenty calls and deals out ranges of it; executors list their ranges and fetch the pages
themselves, a bounded number of requests at a time over connections that are kept alive, with retries.  A page that
cannot be fetched is a row with an error, so one failure does not end the job.
"""

from __future__ import annotations

import http.client
import json
import math
import threading
import time
import urllib.parse
from collections import deque
from collections.abc import Callable, Iterable, Iterator, Mapping
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, EqualTo, In, InputPartition

from ..config import Config

SCHEMA = "id string, json string, error string"
#: Ranges of a listing are made longer rather than more than these.
MOST_TASKS = 20_000
#: Ids at a batch's end that its offset remembers, and the least number of places before it that are listed again to find them.
ANCHORS, LOOK_BACK = 20, 100
REDIRECTS = 5
Transport = Callable[[str, Mapping[str, str], float], tuple[int, bytes]]
_own = threading.local()


def _connection(scheme: str, host: str, timeout: float, fresh: bool) -> http.client.HTTPConnection:
    """This thread's connection to a host; ``fresh`` opens a new one."""
    held = _own.__dict__.setdefault("held", {})
    if fresh and (scheme, host) in held:
        held.pop((scheme, host)).close()
    if (scheme, host) not in held:
        held[scheme, host] = (http.client.HTTPSConnection if scheme == "https" else http.client.HTTPConnection)(host, timeout=timeout)
    return held[scheme, host]


def http_get(url: str, headers: Mapping[str, str], timeout: float) -> tuple[int, bytes]:
    """Status and body of a GET over a kept connection; follows redirects; a failure to connect or to read raises OSError.

    A kept connection that the server has closed meanwhile is opened anew, once.  The token goes to the host that was asked for alone.
    """
    first = urllib.parse.urlsplit(url).netloc
    for _ in range(REDIRECTS + 1):
        at = urllib.parse.urlsplit(url)
        sent = dict(headers) if at.netloc == first else {k: v for k, v in headers.items() if k.lower() != "authorization"}
        path = urllib.parse.urlunsplit(("", "", at.path or "/", at.query, ""))
        known = (at.scheme, at.netloc) in _own.__dict__.get("held", {})
        for fresh in [False, True] if known else [True]:
            connection = _connection(at.scheme, at.netloc, timeout, fresh)
            try:
                connection.request("GET", path, headers=sent)
                answer = connection.getresponse()
                status, body, location = answer.status, answer.read(), answer.getheader("Location")
                break
            except (OSError, http.client.HTTPException) as problem:
                _own.held.pop((at.scheme, at.netloc)).close()
                if fresh:
                    raise problem if isinstance(problem, OSError) else OSError(repr(problem)) from problem
        if status not in (301, 302, 303, 307, 308) or not location:
            return status, body
        url = urllib.parse.urljoin(url, location)
    raise OSError("too many redirects")


class StatusError(RuntimeError):
    def __init__(self, status: int):
        super().__init__(f"status {status}")
        self.status = status


@dataclass
class Client:
    """GETs with retries on 429, 5xx and failed connections, 2, 4, 8 ... seconds apart; other statuses raise at once."""

    base_url: str
    token: str = ""
    timeout: float = 30
    retries: int = 3
    transport: Transport = http_get
    sleep: Callable[[float], None] = time.sleep

    def get(self, path: str, **params) -> dict:
        if self.retries < 1:
            raise ValueError("retries must be positive")
        url = f"{self.base_url}{path}?{urllib.parse.urlencode(params)}"
        headers = {"Accept": "application/json"} | ({"Authorization": self.token} if self.token else {})
        problem: Exception | None = None
        for attempt in range(1, self.retries + 1):
            try:
                status, body = self.transport(url, headers, self.timeout)
                if status == 200:
                    return json.loads(body)
                problem = StatusError(status)
                if status != 429 and status < 500:
                    raise problem
            except OSError as failed:
                problem = failed
            if attempt < self.retries:
                self.sleep(2**attempt)
        raise problem

    def listed(self, start: int, size: int) -> list[str]:
        """Ids of at most ``size`` pages from the one at place ``start`` on."""
        return [str(x["id"]) for x in self.get("/rest/api/content", type="page", limit=size, start=start, expand="space").get("results", [])]

    def ids(self, size: int = 100, start: int = 0, stop: int | None = None) -> Iterator[str]:
        """Ids of all pages from the place ``start`` on, before ``stop``; ends after an empty or a short listing."""
        while stop is None or start < stop:
            wanted = size if stop is None else min(size, stop - start)
            found = self.listed(start, wanted)
            yield from found
            if len(found) < wanted:
                return
            start += wanted

    def count(self, size: int = 100) -> int:
        """How many pages are listed: doubling finds a place beyond the end, and bisection the last listing that is not empty."""
        found = len(self.listed(0, size))
        if found < size:
            return found
        full, beyond = 0, 1  # listings of ``size`` by number: one that is full, one that is not
        while (found := len(self.listed(beyond * size, size))) == size:
            full, beyond = beyond, 2 * beyond
        last = found
        while beyond - full > 1:
            middle = (full + beyond) // 2
            found = len(self.listed(middle * size, size))
            if found == size:
                full = middle
            else:
                beyond, last = middle, found
        return beyond * size + last

    def page(self, page_id: str) -> dict | None:
        """One page, or None if there is none of that id."""
        try:
            return self.get(f"/rest/api/content/{page_id}", expand="body.view,body.storage,version,space")
        except StatusError as problem:
            if problem.status == 404:
                return None
            raise


@dataclass
class Ids(InputPartition):
    """Pages by their ids."""

    ids: list[str]


@dataclass
class Places(InputPartition):
    """Pages by their places in the listing, from ``start`` on and before ``stop``; without ``stop`` to its end."""

    start: int
    stop: int | None


class Fetching:
    """What readers of batches and of streams have in common."""

    def __init__(self, options: Mapping[str, str], client: Client | None = None):
        self.client = client or Client(options["url"].rstrip("/"), options.get("token", ""), float(options.get("timeout", 30)), int(options.get("retries", 3)))
        self.size = int(options.get("pagesize", 100))
        self.per_task = int(options.get("idspertask", 200))
        self.window = int(options.get("concurrency", 10))

    def dealt(self, ids: list[str]) -> list[Ids]:
        return [Ids(ids[at : at + self.per_task]) for at in range(0, len(ids), self.per_task)]

    def fetch(self, page_id: str) -> tuple[str, str | None, str | None]:
        try:
            page = self.client.page(page_id)
            return page_id, None if page is None else json.dumps(page), "not found" if page is None else None
        except (OSError, StatusError, ValueError) as problem:
            return page_id, None, f"{type(problem).__name__}: {problem}"

    def read(self, partition):
        """The pages in order, ``window`` requests at a time; no more than twice as many requests and answers wait to be taken."""
        ids: Iterable[str] = partition.ids if isinstance(partition, Ids) else self.client.ids(self.size, partition.start, partition.stop)
        with ThreadPoolExecutor(self.window) as pool:
            waiting: deque = deque()
            try:
                for page_id in ids:
                    waiting.append(pool.submit(self.fetch, page_id))
                    if len(waiting) >= 2 * self.window:
                        yield waiting.popleft().result()
                while waiting:
                    yield waiting.popleft().result()
            finally:
                for left in waiting:
                    left.cancel()


class ContentReader(Fetching, DataSourceReader):
    def __init__(self, options: Mapping[str, str], client: Client | None = None):
        super().__init__(options, client)
        #: The ids to fetch; None for all.
        self.given: list[str] | None = [x.strip() for x in options.get("ids", "").split(",") if x.strip()] or None

    def pushFilters(self, filters):  # noqa: N802
        """Equality with ids narrows what is fetched, to nothing if filters contradict each other; all other filters are Spark's."""
        for f in filters:
            if isinstance(f, EqualTo) and f.attribute == ("id",):
                wanted = [str(f.value)]
            elif isinstance(f, In) and f.attribute == ("id",):
                wanted = list(dict.fromkeys(str(v) for v in f.value))
            else:
                yield f
                continue
            self.given = wanted if self.given is None else [x for x in self.given if x in wanted]

    def partitions(self):
        if self.given is not None:
            return self.dealt(self.given) or [Ids([])]
        n = self.client.count(self.size)
        # ranges begin where listings of the page size do; the last one goes on to pages that are added meanwhile
        step = self.size * max(1, math.ceil(max(self.per_task, n / MOST_TASKS) / self.size))
        starts = range(0, max(n, 1), step)
        return [Places(at, None if at == starts[-1] else at + step) for at in starts]


class ContentStreamReader(Fetching, DataSourceStreamReader):
    """A stream of the API's pages in the order of its listing, at most ``maxIdsPerTrigger`` a batch; pages that are added at the end come with a later one.

    An offset is how many places of the listing have been dealt out, and the last ids of them.  A batch goes on after the last of these that
    is still listed, so a page that is deleted meanwhile, by which all later places shift, costs no other.  If none is listed any more, the
    places before are dealt out again.
    """

    def __init__(self, options: Mapping[str, str], client: Client | None = None):
        super().__init__(options, client)
        self.limit = int(options.get("maxidspertrigger", 10_000))
        self.at: dict | None = None  # the end of the last batch that was planned
        self.planned: tuple[dict, dict, list[str]] | None = None

    def initialOffset(self):  # noqa: N802
        return {"n": 0, "last": []}

    def following(self, at: dict, limit: int) -> tuple[list[str], dict]:
        """The ids of the next batch after an offset, at most ``limit``, and its end."""
        back = max(LOOK_BACK, self.size)
        while True:
            start = max(0, at["n"] - back)
            # places before the offset, and some after it, since pages may have been put in
            found = list(self.client.ids(self.size, start, at["n"] + limit + len(at["last"])))
            known = {x: i for i, x in enumerate(found)}
            place = next((known[x] + 1 for x in reversed(at["last"]) if x in known), None)
            if place is not None or start == 0 or not at["last"]:
                break
            back *= 8
        if place is None:
            place = 0 if at["last"] else at["n"] - start
        ids = [x for x in found[place:] if x not in set(at["last"])][:limit]
        if not ids:
            return [], at
        return ids, {"n": start + known[ids[-1]] + 1, "last": (at["last"] + ids)[-ANCHORS:]}

    def latestOffset(self):  # noqa: N802
        begin = self.at or self.initialOffset()
        if self.planned and self.planned[0] == begin:
            return self.planned[1]
        ids, end = self.following(begin, self.limit)
        self.planned = (begin, end, ids)
        return end

    def partitions(self, start, end):
        # after a restart Spark plans the last batch again before it asks for a new one
        self.at = end
        if self.planned and self.planned[:2] == (start, end):
            return self.dealt(self.planned[2])
        if start == end:
            return []
        ids, _ = self.following(start, self.limit)
        final = end["last"][-1]
        return self.dealt(ids[: ids.index(final) + 1] if final in ids else ids)

    def commit(self, end):
        pass


class ContentApi(DataSource):
    """Options: url, token, ids (comma-separated; all pages without), pageSize, idsPerTask, concurrency (requests at a time in a task), timeout, retries; for streams maxIdsPerTrigger."""

    @classmethod
    def name(cls):
        return "content_api"

    def schema(self):
        return SCHEMA

    def reader(self, schema):
        return ContentReader(self.options)

    def streamReader(self, schema):  # noqa: N802
        return ContentStreamReader(self.options)


def options_of(config: Config) -> dict[str, str]:
    """The source's options as the settings have them."""
    given = {"url": config.base_url, "token": config.token, "pageSize": config.page_size, "timeout": config.timeout_s, "retries": config.max_retries, "concurrency": config.max_concurrent_requests, "maxIdsPerTrigger": config.max_ids_per_batch}
    return {k: str(v) for k, v in given.items()} | ({"ids": ",".join(config.page_ids)} if config.page_ids else {})


def load_pages(spark: SparkSession, url: str, source: type[DataSource] = ContentApi, **options) -> DataFrame:
    """Rows (id, json, error) of an API's pages; ``tables.from_json_pages`` brings them to page columns."""
    spark.dataSource.register(source)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    return spark.read.format(source.name()).options(url=url, **options).load()


def stream_pages(spark: SparkSession, url: str, source: type[DataSource] = ContentApi, **options) -> DataFrame:
    """The same rows as a stream."""
    spark.dataSource.register(source)
    return spark.readStream.format(source.name()).options(url=url, **options).load()
