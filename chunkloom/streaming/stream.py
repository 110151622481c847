"""Running the engine: once over a table, or as a stream of pages.

A page is self-contained, so the stream is a stateless map: no watermark and no state.  Spark plans the
partitions and holds back the source; each batch goes to all sinks.

What is fetched or parsed is written once to the shared folder and read from there by all that follows, and
every counter is observed on a write, so nothing is computed to be counted.
"""

from __future__ import annotations

import json
import time
from collections import Counter
from collections.abc import Iterator, Mapping
from contextlib import contextmanager
from datetime import UTC, datetime

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from ..config import Config
from ..log import logger
from ..operators.blocks import page_blocks
from ..operators.chunks import chunk_pages
from ..operators.html import with_pieces
from ..sinks.core import Composite, Sink, chosen_sinks
from ..sinks.retry import DeadLetters, deliver
from ..sources.rest import load_pages, options_of
from ..sources.tables import from_json_pages, judged, parsed_pages, text_pages
from ..staging import Staged

COUNTERS = ("page_ids", "pages_fetched", "pages_fetch_failed", "pages_processed", "pages_process_failed", "pages_with_errors", "pages_write_failed", "chunks_written", "blocks_written")


def run_stats(parsed: DataFrame, chunks: DataFrame | None = None) -> DataFrame:
    """One row of counters over parsed pages and, if given, their chunks."""
    of_pages = parsed.agg(
        F.count("*").alias("pages"),
        F.count_if((F.size("pieces") == 0) & F.col("error").isNull()).alias("pages_empty"),
        F.count_if(F.col("error").isNotNull()).alias("pages_with_errors"),
        F.coalesce(F.sum(F.size("pieces")), F.lit(0)).alias("blocks"),
    )
    return of_pages if chunks is None else of_pages.crossJoin(chunks.agg(F.count("*").alias("chunks")))  # one row beside one row


def metadata(spark: SparkSession, config: Config, started: datetime, elapsed_ms: float, stats: DataFrame) -> DataFrame:
    """One row about a run, with its counters as a struct."""
    return stats.select(
        F.lit(datetime.now(UTC).isoformat()).alias("generated_at"),
        F.lit(started.isoformat()).alias("started_at"),
        F.lit(round(elapsed_ms, 4)).alias("elapsed_ms"),
        F.lit(config.base_url).alias("url"),
        F.lit(config.chunk_size).alias("chunk_size"),
        F.lit(config.chunk_overlap).alias("chunk_overlap"),
        F.lit(config.strategy).alias("strategy"),
        F.lit(config.max_heading_levels).alias("max_heading_levels"),
        F.lit(config.include_blocks).alias("include_blocks"),
        F.struct(*stats.columns).alias("stats"),
    )


def fetched(raw: DataFrame, staged: Staged) -> tuple[DataFrame, Counter]:
    """``raw`` (id, json, error) as a written table, so that pages are fetched once, and how many ids, pages and failures it has."""
    seen = Observation()
    counts = F.count(F.lit(1)).alias("ids"), F.count("json").alias("fetched")
    held = staged.write(judged(raw).select("id", "json", "error").observe(seen, *counts), "fetched")
    n = seen.get
    if failed := n["ids"] - n["fetched"]:
        some = [f"{r['id']}: {r['error']}" for r in held.where("json is null").limit(10).collect()]
        logger.error("%d pages could not be fetched, such as %s", failed, "; ".join(some))
    return held, Counter(page_ids=n["ids"], pages_fetched=n["fetched"], pages_fetch_failed=failed)


def write_pages(parsed: DataFrame, config: Config, sink: Sink, batch: int = 0, letters: DeadLetters | None = None, before: Mapping[str, int] | None = None) -> Counter:
    """Write ``parsed`` pages and their chunks to ``sink``, and count.

    Pages with an error are left out; those without blocks are kept.  Pages that a sink does not take are set aside one by one (``sinks.retry``) and
    counted; WriteBroken if it takes none.  ``before`` has the counters of fetching; without it every page counts as fetched.
    """
    staged, seen = Staged(parsed.sparkSession), Observation()
    try:
        pieces = F.coalesce(F.size("pieces"), F.lit(0))
        counts = F.count(F.lit(1)).alias("pages"), F.count("error").alias("wrong"), F.count_if((pieces == 0) & F.col("error").isNull()).alias("empty"), F.sum(pieces).alias("blocks")
        held = staged.write(parsed.observe(seen, *counts), "pages")
        n = seen.get
        good = held.where(F.col("error").isNull())
        sinks = sink.sinks if isinstance(sink, Composite) else [sink]
        letters = letters or DeadLetters.beside(parsed.sparkSession, config)
        found = deliver(good, config, sinks, batch, letters, staged, n["pages"] - n["wrong"])
        counted = Counter(dict.fromkeys(COUNTERS, 0))
        counted.update(pages_empty=n["empty"], blocks=n["blocks"] or 0, pages_processed=n["pages"], pages_process_failed=n["wrong"], pages_with_errors=n["wrong"])
        counted.update(pages_write_failed=found["pages_failed"], chunks_written=found["chunks"], blocks_written=found["blocks"])
        counted.update(before if before is not None else {"page_ids": n["pages"], "pages_fetched": n["pages"]})
        return counted
    finally:
        staged.clear()


def run(parsed: DataFrame, config: Config, sink: Sink, before: Mapping[str, int] | None = None, letters: DeadLetters | None = None) -> DataFrame:
    """All of ``parsed`` to ``sink``; returns the run's metadata, one row.

    Its counters are ``COUNTERS`` (those of fetching from ``before``; without it every page counts as fetched), pages, pages_empty, blocks and chunks.
    Pages that could not be written are in ``letters``, by default a folder beside the output.
    """
    config.validate()
    spark, started, begun = parsed.sparkSession, datetime.now(UTC), time.monotonic()
    stats = dict(write_pages(parsed, config, sink, 0, letters, before))
    stats |= {"pages": stats["pages_processed"], "chunks": stats["chunks_written"]}
    about = metadata(spark, config, started, 1000 * (time.monotonic() - begun), spark.createDataFrame([tuple(stats.values())], ", ".join(f"{k} long" for k in stats)))
    sink.close(about)
    return about


def run_from(spark: SparkSession, config: Config, raw: DataFrame | None = None, sink: Sink | None = None) -> DataFrame:
    """From settings to output: fetch the pages of ``config.page_ids``, or all, parse and chunk them, and write to the sinks that are enabled.

    ``raw`` (id, json, error) may stand for the API.  Pages that cannot be fetched or read are counted, logged and left out.
    """
    config.validate()
    sink, staged = sink or chosen_sinks(spark, config), Staged(spark)
    try:
        held, before = fetched(load_pages(spark, **options_of(config)) if raw is None else raw, staged)
        return run(with_pieces(from_json_pages(held, config.base_url), config), config, sink, before)
    finally:
        staged.clear()


def page_stream(spark: SparkSession, folder: str, kind: str, files_per_trigger: int = 8) -> DataFrame:
    """A stream of the Parquet files of table ``kind`` (pages or documents) that arrive in ``folder``."""
    schema = {"pages": "page_id long, url string, html string", "documents": "doc_id long, text string, lang string, source string, n_chars long"}[kind]
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_trigger).parquet(folder)


class Ledger:
    """Counters of a stream's batches, by number, in the shared folder: a batch that is repeated replaces its own, and a restart loses none."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def put(self, batch: int, counted: Mapping[str, int]) -> None:
        self.spark.createDataFrame([(json.dumps(dict(counted)),)], "value string").coalesce(1).write.mode("overwrite").text(f"{self.path}/batch={batch}")

    def total(self) -> Counter:
        """The sum over all batches; Spark adds, so a long stream's ledger does not pass the driver."""
        at = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(self.path)
        if not at.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).exists(at):
            return Counter()
        each = self.spark.read.text(self.path).select(F.explode(F.from_json("value", "map<string,long>")).alias("name", "n"))
        return Counter({r["name"]: r["n"] for r in each.groupBy("name").agg(F.sum("n").alias("n")).collect()})


class ProgressLog(StreamingQueryListener):
    """Logs each batch of a stream: its number, rows, and rows a second."""

    def onQueryStarted(self, event) -> None:  # noqa: N802
        logger.info("stream %s started", event.id)

    def onQueryProgress(self, event) -> None:  # noqa: N802
        p = event.progress
        logger.info("batch %d: %d rows, %.1f a second", p.batchId, p.numInputRows, p.processedRowsPerSecond or 0.0)

    def onQueryIdle(self, event) -> None:  # noqa: N802
        pass

    def onQueryTerminated(self, event) -> None:  # noqa: N802
        logger.info("stream %s ended%s", event.id, f": {event.exception}" if event.exception else "")


def start(raw: DataFrame, kind: str, config: Config, sink: Sink, checkpoint: str, counted: Counter | None = None) -> StreamingQuery:
    """Chunk all pages that the source (``pages``, ``documents`` or ``api`` rows) has, batch by batch; ``finish`` waits for the end.

    Tables of files stop when all files of now are read; an API goes on until it is stopped, since Spark gives its readers one batch alone otherwise.
    A batch that is repeated writes the same again.  Pages that a sink does not take go to ``checkpoint``/dead_letters; a batch of which it takes none
    ends the stream with an error, so that a new start begins with it.  ``counted`` receives the counters of all batches so far,
    those before a restart too; they lie in ``checkpoint``/counters.
    """
    spark = raw.sparkSession
    ledger, letters = Ledger(spark, f"{checkpoint}/counters"), DeadLetters(spark, f"{checkpoint}/dead_letters")

    def each(batch: DataFrame, number: int) -> None:
        staged, before = Staged(spark), None
        try:
            if kind == "api":
                batch, before = fetched(batch, staged)
                parsed = with_pieces(from_json_pages(batch, config.base_url), config)
            else:
                parsed = parsed_pages(batch, config) if kind == "pages" else text_pages(batch)
            ledger.put(number, write_pages(parsed, config, sink, number, letters, before))
        finally:
            staged.clear()
        if counted is not None:
            counted.clear()
            counted.update(ledger.total())

    how = {"processingTime": "1 second"} if kind == "api" else {"availableNow": True}
    return raw.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint).trigger(**how).start()


def finish(query: StreamingQuery) -> None:
    """Wait until a stream has read all that there is by now, and stop it; what went wrong raises."""
    try:
        query.processAllAvailable()
    finally:
        query.stop()


class Timer:
    """Milliseconds of a block of driver code: ``with Timer() as t: ...; t.ms``."""

    def __enter__(self) -> Timer:
        self.begun, self.ms = time.monotonic(), 0.0
        return self

    def __exit__(self, *_) -> None:
        self.ms = self.elapsed()

    def elapsed(self) -> float:
        """Milliseconds so far."""
        return round(1000 * (time.monotonic() - self.begun), 4)


class Timers:
    """Timers by name; what ``end`` measures is logged if wanted."""

    def __init__(self, show: bool = False):
        self.show, self.running = show, {}

    def start(self, name: str) -> None:
        self.running[name] = Timer().__enter__()

    def elapsed(self, name: str) -> float | None:
        """Milliseconds since ``start``; None for a name that is not running."""
        return self.running[name].elapsed() if name in self.running else None

    def end(self, name: str) -> float | None:
        """Milliseconds since ``start``, and stop; None for a name that is not running."""
        ms = self.elapsed(name)
        self.running.pop(name, None)
        if self.show:
            logger.info("%s: %s", name, "not started" if ms is None else f"{ms:.4f} ms")
        return ms

    @contextmanager
    def measure(self, name: str) -> Iterator[None]:
        self.start(name)
        try:
            yield
        finally:
            self.end(name)

    def reset(self) -> None:
        self.running.clear()
