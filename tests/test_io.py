import json
import sys
import tempfile
from collections import Counter

import pytest
from pyspark import cloudpickle
from pyspark.sql import functions as F

from chunkloom.config import Config, is_identifier
from chunkloom.operators.chunks import chunk_pages
from chunkloom.sinks.core import Composite, JsonSink, Refused, TableSink, chosen_sinks, upsert
from chunkloom.sources.rest import Client, ContentApi, ContentReader, ContentStreamReader, StatusError, load_pages, options_of, stream_pages
from chunkloom.sources.tables import fetch_failures, from_json_pages, only_ids, text_pages
from chunkloom.sinks.retry import DeadLetters, WriteBroken
from chunkloom.streaming.stream import COUNTERS, Timer, Timers, finish, page_stream, run, run_from, start

CONFIG = Config(chunk_size=24)


def folder():
    return tempfile.mkdtemp(prefix="spark-", dir="/tmp")


def documents(spark, n=6):
    rows = [(i, f"Text {i} has words. And more of them. " * 6, "en", "s", 1) for i in range(n)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")


def fake(*answers):
    left, calls = list(answers), []

    def transport(url, headers, timeout):
        calls.append(url)
        status, body = left.pop(0)
        if status is OSError:
            raise OSError("down")
        return status, json.dumps(body).encode()

    return transport, calls


def listing(n, first=0):
    return 200, {"results": [{"id": first + i} for i in range(n)]}


def test_ids_are_paged():
    transport, calls = fake(listing(100), listing(40, 100))
    assert len(list(Client("http://x", transport=transport).ids())) == 140 and len(calls) == 2
    transport, calls = fake(listing(100), listing(0))
    assert len(list(Client("http://x", transport=transport).ids())) == 100 and len(calls) == 2


def test_retries():
    waits = []
    transport, _ = fake((429, {}), (503, {}), (200, {"id": 1}))
    assert Client("http://x", transport=transport, sleep=waits.append).page("1") == {"id": 1} and waits == [2, 4]
    transport, calls = fake((403, {}))
    with pytest.raises(StatusError):
        Client("http://x", transport=transport, sleep=waits.append).page("1")
    assert len(calls) == 1
    transport, _ = fake((404, {}))
    assert Client("http://x", transport=transport).page("1") is None
    transport, _ = fake((OSError, 0), (OSError, 0), (OSError, 0))
    reader = ContentReader({"url": "http://x", "ids": "7"}, Client("http://x", transport=transport, sleep=waits.append))
    assert list(reader.read(reader.partitions()[0])) == [("7", None, "OSError: down")]
    with pytest.raises(ValueError):
        Client("http://x", retries=0).get("/")


def test_json_pages(spark):
    raw = spark.createDataFrame([('{"id":"5","title":"T","space":{"key":"K"},"body":{"view":{"value":""},"storage":{"value":"S"}},"_links":{"webui":"/w"}}',), ("{}",), (None,)], "json string")
    (full,) = from_json_pages(raw, "http://b").collect()  # neither the row without JSON nor the one without an id is a page
    assert (full["body_html"], full["url"], full["space_key"], full["version"]) == ("S", "http://b/w", "K", 1)


def test_answers_that_are_no_page(spark):
    """Cut JSON, a gateway's page, JSON without an id: failures with an error, not pages."""
    good = '{"id":"5","title":"T","body":{"view":{"value":"x"}}}'
    rows = [("5", good, None), ("6", good[:30], None), ("7", "<html>502</html>", None), ("8", '{"title":"T"}', None), ("9", '{"id":""}', None), ("10", None, "not found"), ("11", "", None)]
    raw = spark.createDataFrame(rows, "id string, json string, error string")
    assert [r["id"] for r in from_json_pages(raw).collect()] == ["5"]
    assert sorted(map(tuple, fetch_failures(raw).collect())) == sorted([(i, "unreadable page") for i in ("6", "7", "8", "9", "11")] + [("10", "not found")])
    stats = run_from(spark, CONFIG.with_(output_dir=folder()), raw).first()["stats"]
    assert (stats["page_ids"], stats["pages_fetched"], stats["pages_fetch_failed"], stats["pages_processed"]) == (7, 1, 6, 1)


def test_only_ids_keeps_duplicates(spark):
    pages = text_pages(documents(spark))
    assert sorted(r["id"] for r in only_ids(pages, ["1", "1", "4"]).collect()) == ["1", "1", "4"]
    assert only_ids(pages, []).count() == 6 == only_ids(pages, None).count()


def test_json_sink_and_run(spark):
    config = CONFIG.with_(output_dir=folder(), include_blocks=True)
    sink = JsonSink(config)
    about = run(text_pages(documents(spark)), config, sink).first()
    assert about["stats"]["pages"] == 6 and about["stats"]["chunks"] > 6
    chunks = [json.loads(r["value"]) for r in spark.read.text(f"{sink.path}/chunks").collect()]
    assert len(chunks) == about["stats"]["chunks"]
    assert {"chunk_id", "navigation", "core_block_ids", "nearest_heading_id"} <= set(chunks[0]) and chunks[0]["nearest_heading_id"] is None
    assert spark.read.text(f"{sink.path}/pages").count() == 6 and spark.read.text(f"{sink.path}/metadata").count() == 1


def test_table_sink_upserts(spark):
    sink = TableSink(spark, folder() + "/t")
    pages = text_pages(documents(spark))
    chunks = chunk_pages(pages, CONFIG)
    sink.write(chunks, pages)
    once = sorted(sink.read().collect())
    sink.write(chunks, pages)
    assert sorted(sink.read().collect()) == once and len(once) == chunks.count()


def test_upsert(spark):
    kind = "chunk_id string, payload string"
    old = spark.createDataFrame([("c1", "v1"), ("c2", "v2")], kind)
    new = spark.createDataFrame([("c1", "v3"), ("c1", "v4")], kind)
    assert sorted(map(tuple, upsert(old, new, order=["payload"]).collect())) == [("c1", "v4"), ("c2", "v2")]
    # without an order the last row counts, not the greatest
    late = spark.createDataFrame([("c1", "v9"), ("c3", "x"), ("c1", "v4")], kind)
    assert sorted(map(tuple, upsert(old, late).collect())) == [("c1", "v4"), ("c2", "v2"), ("c3", "x")]


def test_composite_writes_all_and_raises_first():
    seen = []

    class Sink:
        def __init__(self, name, fails=False):
            self.path, self.fails = name, fails

        def write(self, *_):
            if self.fails:
                raise RuntimeError(self.path)
            seen.append(self.path)

        close = write

    with pytest.raises(RuntimeError, match="a"):
        Composite([Sink("a", True), Sink("b")]).write(None, None, None)
    assert seen == ["b"] and Composite([Sink("a"), Sink("b")]).path == "a | b"
    with pytest.raises(ValueError):
        Composite([])


def test_stream_equals_batch(spark):
    at = folder()
    documents(spark).repartition(3).write.parquet(at + "/in")
    config = CONFIG.with_(output_dir=at + "/out")
    sink = JsonSink(config)
    query = start(page_stream(spark, at + "/in", "documents", 1), "documents", config, sink, at + "/checkpoint")
    query.awaitTermination(120)
    assert query.exception() is None
    found = {json.loads(r["value"])["chunk_id"] for r in spark.read.text(f"{sink.path}/chunks").collect()}
    assert found == {r["chunk_id"] for r in chunk_pages(text_pages(documents(spark)), config).select("chunk_id").collect()}


def test_config(spark):
    c = Config.from_env({"CHUNKLOOM_CHUNK_SIZE": "64", "CHUNKLOOM_TABLE_ENABLED": " TRUE ", "CHUNKLOOM_JSON_ENABLED": "yes", "CHUNKLOOM_PAGE_IDS": "1, ,2"})
    assert (c.chunk_size, c.table_enabled, c.json_enabled, c.page_ids) == (64, True, False, ("1", "2"))
    with pytest.raises(ValueError, match="chunk_overlap.*no sink"):
        Config(chunk_overlap=600, json_enabled=False).validate()
    assert is_identifier("a1_") and not is_identifier("1a") and not is_identifier("a-b")
    assert Config(token="x").display()["token"] == "set" and "secret" not in repr(Config(token="secret"))
    assert chosen_sinks(spark, Config(table_enabled=True)).path.endswith(" | output/chunks")


PAGES = {str(i): {"id": str(i), "title": f"P{i}", "space": {"key": "K", "name": "N"}, "body": {"view": {"value": f"<h1>H{i}</h1><p>{'Some words here. ' * 12}</p>" if i % 3 else ""}}, "_links": {"webui": f"/p/{i}"}} for i in range(25)}


def wiki(url, headers, timeout):
    """A content API of 25 pages, of which one is gone, one is down and three hold nothing that can be read."""
    from urllib.parse import parse_qs, urlparse

    at = urlparse(url)
    if at.path == "/rest/api/content":
        q = {k: int(v[0]) for k, v in parse_qs(at.query).items() if k in ("start", "limit")}
        return 200, json.dumps({"results": [{"id": i} for i in list(PAGES)[q["start"] : q["start"] + q["limit"]]]}).encode()
    page_id = at.path.rsplit("/", 1)[1]
    return (404, b"") if page_id in ("4", "99") else (500, b"") if page_id == "5" else (200, json.dumps(PAGES[page_id]).encode())


class WikiApi(ContentApi):
    @classmethod
    def name(cls):
        return "fake_wiki"

    def reader(self, schema):
        return ContentReader(self.options, Client("http://wiki", retries=2, transport=wiki, sleep=lambda s: None))

    def streamReader(self, schema):  # noqa: N802
        return ContentStreamReader(self.options, Client("http://wiki", retries=2, transport=wiki, sleep=lambda s: None))


@pytest.fixture(scope="module")
def api(spark):
    cloudpickle.register_pickle_by_value(sys.modules[__name__])  # workers cannot import the tests
    return WikiApi


def wiki_config(at, **more):
    return CONFIG.with_(base_url="http://wiki", output_dir=at, page_size=10, json_enabled=True, table_enabled=True, include_blocks=True, **more)


def test_from_settings_to_both_sinks(spark, api):
    config = wiki_config(folder())
    raw = load_pages(spark, source=api, **options_of(config))
    sink = chosen_sinks(spark, config)
    stats = run_from(spark, config, raw, sink).first()["stats"].asDict()
    assert set(COUNTERS) <= set(stats)
    assert (stats["page_ids"], stats["pages_fetched"], stats["pages_fetch_failed"]) == (25, 23, 2)
    assert (stats["pages_processed"], stats["pages_process_failed"], stats["pages_with_errors"], stats["pages_write_failed"]) == (23, 0, 0, 0)
    assert stats["pages_empty"] == 9 and stats["blocks_written"] == 28 and stats["chunks_written"] > 14
    written, table = sink.sinks
    assert spark.read.text(f"{written.path}/pages").count() == 23 and spark.read.text(f"{written.path}/blocks").count() == 28
    assert spark.read.text(f"{written.path}/chunks").count() == stats["chunks_written"] == table.read().count() == sink.totals["chunks"]
    about = json.loads(spark.read.text(f"{written.path}/metadata").first()[0])
    assert about["stats"]["pages_fetch_failed"] == 2 and about["chunk_size"] == 24
    assert sorted((r["id"], r["error"]) for r in fetch_failures(raw).collect()) == [("4", "not found"), ("5", "StatusError: status 500")]


def test_given_ids_alone_are_fetched(spark, api):
    config = wiki_config(folder(), page_ids=("7", "8", "99"))
    stats = run_from(spark, config, load_pages(spark, source=api, **options_of(config))).first()["stats"]
    assert (stats["page_ids"], stats["pages_fetched"], stats["pages_fetch_failed"]) == (3, 2, 1)


def test_filters_narrow_what_is_fetched(spark, api):
    pages = load_pages(spark, "http://wiki", source=api)
    assert [r["id"] for r in pages.where("id = '7'").collect()] == ["7"]
    assert sorted(r["id"] for r in pages.where("id in ('7', '8')").where("error is null").collect()) == ["7", "8"]
    given = load_pages(spark, "http://wiki", source=api, ids="5,7")
    assert given.where("id = '1' and id = '2'").count() == 0 == given.where("id = '1'").count()
    reader = ContentReader({"url": "http://x", "ids": "5"}, Client("http://x"))
    from pyspark.sql.datasource import EqualTo

    assert list(reader.pushFilters([EqualTo(("id",), "1"), EqualTo(("id",), "2")])) == [] and reader.given == []
    assert reader.partitions()[0].ids == []


def test_an_api_stream_in_batches():
    options = {"url": "http://x", "pagesize": "10", "idspertask": "4", "maxidspertrigger": "7"}
    reader, at, seen = ContentStreamReader(options, Client("http://x", transport=wiki)), None, []
    at = reader.initialOffset()
    while (end := reader.latestOffset()) != at:
        ids = [x for p in reader.partitions(at, end) for x in p.ids]
        assert 0 < len(ids) <= 7 and reader.latestOffset() is not None
        # another process plans the same batch
        again = ContentStreamReader(options, Client("http://x", transport=wiki))
        assert [x for p in again.partitions(at, end) for x in p.ids] == ids and again.latestOffset() == reader.latestOffset()
        seen, at = seen + ids, end
    assert seen == list(PAGES) and reader.partitions(at, at) == []


@pytest.mark.parametrize("gone", [[], [2], [9], [8, 9], list(range(10)), [11], [5, 12, 13]])
def test_pages_deleted_between_batches_cost_no_other(gone):
    site = [str(i) for i in range(30)]

    def transport(url, headers, timeout):
        from urllib.parse import parse_qs, urlparse

        q = {k: int(v[0]) for k, v in parse_qs(urlparse(url).query).items() if k in ("start", "limit")}
        return 200, json.dumps({"results": [{"id": i} for i in site[q["start"] : q["start"] + q["limit"]]]}).encode()

    reader = ContentStreamReader({"url": "http://x", "pagesize": "5", "maxidspertrigger": "10"}, Client("http://x", transport=transport))
    first = reader.latestOffset()
    seen = [x for p in reader.partitions(reader.initialOffset(), first) for x in p.ids]
    for x in gone:
        site.remove(str(x))
    site.append("30")
    at = first
    while (end := reader.latestOffset()) != at:
        ids = [x for p in reader.partitions(at, end) for x in p.ids]
        assert len(ids) <= 10
        seen, at = seen + ids, end
    assert seen == [str(i) for i in range(31) if i < 10 or i not in gone]


def test_api_stream_runs(spark, api):
    at = folder()
    config = wiki_config(at + "/out")
    sink, counted = JsonSink(config), Counter()
    source = lambda: stream_pages(spark, "http://wiki", source=api, pageSize="10", maxIdsPerTrigger="9")
    finish(start(source(), "api", config, sink, at + "/checkpoint", counted))
    assert counted["pages_processed"] == 23 == spark.read.text(f"{sink.path}/pages").count()
    assert (counted["page_ids"], counted["pages_fetched"], counted["pages_fetch_failed"]) == (25, 23, 2)
    assert spark.read.text(f"{at}/checkpoint/counters").count() == 3
    later = Counter()
    finish(start(source(), "api", config, sink, at + "/checkpoint", later))  # nothing is new
    assert spark.read.text(f"{sink.path}/pages").count() == 23


def site_of(n):
    calls = []

    def transport(url, headers, timeout):
        from urllib.parse import parse_qs, urlparse

        q = {k: int(v[0]) for k, v in parse_qs(urlparse(url).query).items() if k in ("start", "limit")}
        calls.append((q["start"], q["limit"]))
        return 200, json.dumps({"results": [{"id": i} for i in range(q["start"], min(n, q["start"] + q["limit"]))]}).encode()

    return transport, calls


@pytest.mark.parametrize("n", [0, 1, 99, 100, 101, 1234, 99_950, 100_000])
def test_listing_is_dealt_out_in_ranges(n):
    transport, calls = site_of(n)
    reader = ContentReader({"url": "http://x"}, Client("http://x", transport=transport))
    parts = reader.partitions()
    assert len(calls) < 40
    # tasks list their ranges: no id twice or lost, in order
    found = [x for p in parts for x in reader.client.ids(reader.size, p.start, p.stop)]
    assert found == [str(i) for i in range(n)] and len(parts) == max(1, -(-n // 200))
    transport, _ = site_of(n + 150)  # pages that are added meanwhile come with the last range
    reader.client.transport = transport
    assert len([x for p in parts for x in reader.client.ids(reader.size, p.start, p.stop)]) == n + 150


def test_ranges_of_a_large_site_grow(monkeypatch):
    from chunkloom.sources import rest

    monkeypatch.setattr(rest, "MOST_TASKS", 20)
    transport, _ = site_of(50_000)
    parts = ContentReader({"url": "http://x"}, Client("http://x", transport=transport)).partitions()
    assert len(parts) <= 20 and parts[0].stop % 100 == 0


def test_requests_run_beside_each_other_over_kept_connections():
    import threading
    import time
    from http.server import BaseHTTPRequestHandler, ThreadingHTTPServer

    opened, tries = [], Counter()

    class Wiki(BaseHTTPRequestHandler):
        protocol_version, disable_nagle_algorithm = "HTTP/1.1", True

        def setup(self):
            super().setup()
            opened.append(self.client_address)

        def log_message(self, *_):
            pass

        def do_GET(self):  # noqa: N802
            time.sleep(0.05)
            page_id = self.path.split("?")[0].rsplit("/", 1)[1]
            tries[page_id] += 1
            status = 404 if page_id == "7" else 503 if page_id == "8" and tries["8"] == 1 else 302 if page_id == "9" else 200
            body = json.dumps({"id": page_id, "auth": self.headers.get("Authorization")}).encode()
            self.send_response(status)
            if status == 302:
                self.send_header("Location", "/rest/api/content/90?x=1")
            self.send_header("Content-Length", str(len(body)))
            self.end_headers()
            self.wfile.write(body)

    server = ThreadingHTTPServer(("127.0.0.1", 0), Wiki)
    threading.Thread(target=server.serve_forever, daemon=True).start()
    try:
        ids = [str(i) for i in range(1000)]
        reader = ContentReader({"url": f"http://127.0.0.1:{server.server_port}", "token": "t", "ids": ",".join(ids), "idspertask": "1000"})
        reader.client.sleep = lambda s: None
        begun = time.monotonic()
        rows = list(reader.read(reader.partitions()[0]))
        assert time.monotonic() - begun < 8
        assert [r[0] for r in rows] == ids and rows[7][1:] == (None, "not found") and json.loads(rows[8][1])["id"] == "8" and json.loads(rows[9][1])["id"] == "90"
        assert json.loads(rows[5][1])["auth"] == "t" and len(opened) <= 10
    finally:
        server.shutdown()


class Picky:
    """Writes JSON, but refuses any part with a page of ``bad``; counts its calls."""

    def __init__(self, config, bad=(), broken=lambda batch: False):
        self.inner, self.bad, self.broken, self.calls = JsonSink(config), list(bad), broken, 0
        self.path, self.totals = "picky " + self.inner.path, self.inner.totals

    def write(self, chunks, pages, blocks, batch=0, part="all"):
        self.calls += 1
        if self.broken(batch) or pages.where(F.col("id").isin(self.bad)).count():
            raise RuntimeError("refused")
        self.inner.write(chunks, pages, blocks, batch, part)

    def close(self, metadata):
        self.inner.close(metadata)


def test_one_bad_page_costs_no_other(spark):
    config = CONFIG.with_(output_dir=folder(), include_blocks=True)
    pages, sink = text_pages(documents(spark, 1000).coalesce(2)), Picky(config, ["417"])
    letters = DeadLetters(spark, config.output_dir + "/letters")
    stats = run(pages, config, sink, letters=letters).first()["stats"]
    chunks = chunk_pages(pages.where("id <> '417'"), config).count()
    assert (stats["pages_processed"], stats["pages_write_failed"], stats["chunks_written"], stats["blocks_written"]) == (1000, 1, chunks, 999)
    written = [json.loads(r["value"])["page_id"] for r in spark.read.text(f"{sink.inner.path}/pages").collect()]
    assert len(written) == 999 == len(set(written)) and "417" not in written and sink.calls < 30
    assert spark.read.text(f"{sink.inner.path}/chunks").count() == chunks
    (letter,) = letters.read().collect()
    assert letter["id"] == "417" and letter["errors"] == [(sink.path, "RuntimeError: refused")]
    # what was set aside can be run again
    again = run(letters.pages(), config, JsonSink(config.with_(output_prefix="again"))).first()["stats"]
    assert (again["pages_processed"], again["pages_write_failed"]) == (1, 0) and again["chunks_written"] > 0


def test_several_sinks_refuse_different_pages(spark):
    config = CONFIG.with_(output_dir=folder())
    pages = text_pages(documents(spark, 40))
    first, second = Picky(config, ["3", "9"]), Picky(config.with_(output_prefix="other"), ["9", "20"])
    letters = DeadLetters(spark, config.output_dir + "/letters")
    stats = run(pages, config, Composite([first, second]), letters=letters).first()["stats"]
    assert stats["pages_write_failed"] == 3 and stats["chunks_written"] == chunk_pages(pages.where("id not in ('3', '9', '20')"), config).count()
    assert {r["id"]: len(r["errors"]) for r in letters.read().collect()} == {"3": 1, "9": 2, "20": 1}
    assert spark.read.text(f"{first.inner.path}/pages").count() == 38 == spark.read.text(f"{second.inner.path}/pages").count()


class Naming(Picky):
    """Names the pages of ``bad`` that it refuses, the first three of them at once; others of them it does not name."""

    def __init__(self, config, bad, silent=()):
        super().__init__(config, silent)
        self.named = list(bad)

    def write(self, chunks, pages, blocks, batch=0, part="all"):
        for some in (self.named[:3], self.named[3:]):
            if some and pages.where(F.col("id").isin(some)).count():
                self.calls += 1
                raise Refused("named", lambda page_id: page_id.isin(some))
        super().write(chunks, pages, blocks, batch, part)


def test_pages_that_a_sink_names_are_not_searched_for(spark):
    config = CONFIG.with_(output_dir=folder(), include_blocks=True, table_enabled=True)
    bad = [str(i) for i in range(0, 2000, 7)]  # more than would be searched for one by one
    pages = text_pages(documents(spark, 2000))
    sink, letters = Naming(config, bad), DeadLetters(spark, config.output_dir + "/letters")
    stats = run(pages, config, Composite([sink, TableSink(spark, config.output_dir + "/table")]), letters=letters).first()["stats"]
    left = pages.where(~F.col("id").isin(bad))
    assert sink.calls == 3 and (stats["pages_write_failed"], stats["blocks_written"], stats["chunks_written"]) == (len(bad), 2000 - len(bad), chunk_pages(left, config).count())
    assert sorted(r["id"] for r in letters.read().collect()) == sorted(bad)
    assert spark.read.text(f"{sink.inner.path}/chunks").count() == stats["chunks_written"]
    # others that it does not name are searched for in what is left
    sink, letters = Naming(config.with_(output_prefix="more"), ["3", "9"], ["5"]), DeadLetters(spark, config.output_dir + "/more")
    stats = run(text_pages(documents(spark, 40)), config, sink, letters=letters).first()["stats"]
    assert stats["pages_write_failed"] == 3 and spark.read.text(f"{sink.inner.path}/pages").count() == 37
    assert {r["id"]: [e["error"] for e in r["errors"]] for r in letters.read().collect()} == {"3": ["Refused: named"], "9": ["Refused: named"], "5": ["RuntimeError: refused"]}
    # one that names all pages is broken
    with pytest.raises(WriteBroken, match="named"):
        run(text_pages(documents(spark, 9)), config, Naming(config.with_(output_prefix="none"), [str(i) for i in range(9)]))


def test_a_page_that_cannot_be_cut_is_set_aside(spark, monkeypatch):
    """A fault in cutting, as of a tokenizer that refuses a text, fails the table of chunks for all sinks; its page is found all the same."""
    from chunkloom.sinks import retry

    fails = F.when(F.col("page_id") == "7", F.raise_error(F.lit("no"))).otherwise(F.col("chunk_id"))
    monkeypatch.setattr(retry, "chunk_pages", lambda pages, config: chunk_pages(pages, config).withColumn("chunk_id", fails))
    config = CONFIG.with_(output_dir=folder(), table_enabled=True)
    sink, letters = chosen_sinks(spark, config), DeadLetters(spark, config.output_dir + "/letters")
    stats = run(text_pages(documents(spark, 12)), config, sink, letters=letters).first()["stats"]
    (letter,) = letters.read().collect()
    assert letter["id"] == "7" and len(letter["errors"]) == 2 and stats["pages_write_failed"] == 1
    assert stats["chunks_written"] == sink.sinks[1].read().count() == spark.read.text(f"{sink.sinks[0].path}/chunks").count() > 11


def test_a_broken_sink_ends_the_run_and_the_stream(spark):
    at = folder()
    config = CONFIG.with_(output_dir=at + "/out")
    with pytest.raises(WriteBroken, match="refused"):
        run(text_pages(documents(spark, 50)), config, Picky(config, broken=lambda batch: True))
    # a stream stops at the batch, and goes on from it when the sink is well again, with all counters
    for n in range(3):
        documents(spark, 30).where(F.col("doc_id") % 3 == n).coalesce(1).write.mode("append").parquet(at + "/in")
    counted, ok = Counter(), Picky(config, ["4"])
    ill = Picky(config, ["4"], broken=lambda batch: batch == 1)
    ill.inner, ill.totals = ok.inner, ok.totals
    query = start(page_stream(spark, at + "/in", "documents", 1), "documents", config, ill, at + "/checkpoint", counted)
    with pytest.raises(Exception, match="takes no page"):
        query.awaitTermination(180)
    assert counted["pages_processed"] == 10
    later = Counter()
    query = start(page_stream(spark, at + "/in", "documents", 1), "documents", config, ok, at + "/checkpoint", later)
    query.awaitTermination(180)
    assert query.exception() is None
    assert (later["pages_processed"], later["pages_write_failed"], later["pages_fetched"]) == (30, 1, 30)
    assert later["chunks_written"] == chunk_pages(text_pages(documents(spark, 30).where("doc_id <> 4")), config).count()
    assert spark.read.text(f"{ok.inner.path}/pages").count() == 29
    assert [r["id"] for r in DeadLetters(spark, at + "/checkpoint/dead_letters").read().collect()] == ["4"]


def test_a_batch_of_one_bad_page_does_not_end_the_stream(spark):
    at = folder()
    config = CONFIG.with_(output_dir=at + "/out")
    for n in range(3):
        documents(spark, 3).where(F.col("doc_id") == n).coalesce(1).write.mode("append").parquet(at + "/in")
    counted = Counter()
    query = start(page_stream(spark, at + "/in", "documents", 1), "documents", config, Picky(config, ["1"]), at + "/checkpoint", counted)
    query.awaitTermination(180)
    assert query.exception() is None and (counted["pages_processed"], counted["pages_write_failed"]) == (3, 1)


def test_nothing_is_left_or_computed_to_be_counted(spark):
    """The tables between steps are deleted, and a run has one job for each table that is written, besides those of the metadata."""
    from pathlib import Path

    config = CONFIG.with_(output_dir=folder())
    root = spark.conf.get("spark.checkpoint.dir").removeprefix("file:").replace("//", "/")
    before = set(Path(root).glob("chunkloom-pages-*"))
    spark.sparkContext.setJobGroup("counted", "jobs of a run")
    stats = run(text_pages(documents(spark)), config, JsonSink(config)).first()["stats"]
    jobs = spark.sparkContext.statusTracker().getJobIdsForGroup("counted")
    spark.sparkContext.setJobGroup("", "")
    assert stats["chunks_written"] > 6 and set(Path(root).glob("chunkloom-pages-*")) == before
    assert len(jobs) <= 6  # parsed pages, chunks, pages, metadata; the table's schema and the first row of the result


def test_a_batch_rewrites_only_its_parts(spark, monkeypatch):
    from pathlib import Path

    from chunkloom.sinks import core

    monkeypatch.setattr(core, "PART_PAGES", 10)
    sink = TableSink(spark, folder() + "/t")
    pages = text_pages(documents(spark, 1000))
    chunks = chunk_pages(pages, CONFIG)
    sink.write(chunks, pages)
    files = lambda: {str(x): (x.stat().st_mtime_ns, x.stat().st_size) for x in Path(sink.path).glob("part=*/*.parquet")}
    before = files()
    assert len({p.split("part=")[1].split("/")[0] for p in before}) == 100 and sink.totals["chunks"] == chunks.count()
    few = pages.where(F.col("id").cast("int").between(500, 509))
    changed = chunk_pages(few, CONFIG).withColumn("normalized_text", F.lit("changed"))
    sink.write(changed, few)
    after = files()
    new = [p for p in after if before.get(p) != after[p]]
    assert 0 < sum(after[p][1] for p in new) < 0.05 * sum(size for _, size in after.values())
    assert sink.read().count() == chunks.count() and sink.read().where("payload like '%\"changed\"%'").count() == changed.count()
    key = changed.first()["chunk_id"]
    found = sink.lookup(key)
    assert "changed" in found.first()["payload"] and len(found.collect()) == 1 and sink.lookup("EDU:no:0-0").count() == 0 == sink.lookup("odd").count()
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(part" in plan and f"EqualTo(chunk_id,{key})" in plan
    sink.write(changed, few)  # a batch that is repeated
    assert sink.read().count() == chunks.count()
    text = few.withColumn("id", F.concat(F.lit("t"), F.col("id")))
    sink.write(chunk_pages(text, CONFIG), text)
    assert sink.read().where("part like 't%'").select("page_id").distinct().count() == 10


def test_replaced_pages_lose_their_stale_chunks(spark):
    at = folder() + "/t"
    long, short = text_pages(documents(spark, 5)), text_pages(documents(spark, 5).withColumn("text", F.when(F.col("doc_id") < 2, F.lit("One.")).when(F.col("doc_id") == 2, F.lit("")).otherwise(F.col("text"))))
    keeping, replacing = TableSink(spark, at), TableSink(spark, at, replace_pages=True)
    keeping.write(chunk_pages(long, CONFIG), long)
    stale = keeping.read().count()
    keeping.write(chunk_pages(short, CONFIG), short)
    assert keeping.read().count() > chunk_pages(short, CONFIG).count() and stale == chunk_pages(long, CONFIG).count()
    replacing.write(chunk_pages(short, CONFIG), short)
    want = {r["chunk_id"] for r in chunk_pages(short, CONFIG).collect()}
    assert {r["chunk_id"] for r in replacing.read().collect()} == want
    blank = text_pages(documents(spark, 5).withColumn("text", F.lit("")))
    replacing.write(chunk_pages(blank, CONFIG), blank)
    assert replacing.read().count() == 0


def test_a_sink_of_ones_own(spark):
    from chunkloom.sinks.core import SINKS, register_sink

    register_sink("picky", lambda s, config: Picky(config))
    try:
        config = CONFIG.with_(output_dir=folder(), json_enabled=False, extra_sinks=("picky",))
        (sink,) = chosen_sinks(spark, config).sinks
        assert run(text_pages(documents(spark)), config, sink).first()["stats"]["chunks_written"] == sink.totals["chunks"] > 0
        with pytest.raises(ValueError, match="unknown sinks: no"):
            chosen_sinks(spark, config.with_(extra_sinks=("no",)))
    finally:
        del SINKS["picky"]


def test_command_line(spark, api, monkeypatch):
    from chunkloom import __main__ as cli

    assert cli.main({"CHUNKLOOM_CHUNK_SIZE": "0"}) == 1
    at = folder()
    raw = load_pages(spark, "http://wiki", source=api)
    assert cli.main({"CHUNKLOOM_OUTPUT_DIR": at, "CHUNKLOOM_CHUNK_SIZE": "24"}, raw=raw) == 0
    assert cli.main({"CHUNKLOOM_OUTPUT_DIR": at}, raw=raw.drop("json")) == 1
    # pages that were not written
    config = CONFIG.with_(output_dir=folder())
    assert cli.main({"CHUNKLOOM_OUTPUT_DIR": config.output_dir}, raw=raw, sink=Picky(config, ["7"])) == 1
    assert cli.main({"CHUNKLOOM_OUTPUT_DIR": config.output_dir}, raw=raw, sink=Picky(config, broken=lambda batch: True)) == 1


def test_timers():
    timers = Timers()
    assert timers.end("x") is None is timers.elapsed("x")
    with timers.measure("x"):
        assert timers.elapsed("x") >= 0
    timers.start("y")
    timers.reset()
    assert timers.elapsed("y") is None
    with Timer() as t:
        assert t.elapsed() >= 0
    assert t.ms >= 0


def test_the_stored_table_is_shuffled_once_and_compressed(spark):
    """A batch shuffled all payloads to find the last of each key, to meet the stored rows, and again by part."""
    import re
    from pathlib import Path

    at = folder()
    sink = TableSink(spark, at, replace_pages=True)
    for _ in range(2):
        pages = text_pages(documents(spark, 2500))
        sink.write(chunk_pages(pages, CONFIG), pages)
    files = [p for p in Path(re.sub("^file:/*", "/", at)).rglob("*.parquet")]
    assert len(files) == 3 and all(p.name.endswith(".zstd.parquet") for p in files)
    assert sink.read().count() == chunk_pages(text_pages(documents(spark, 2500)), CONFIG).count()
