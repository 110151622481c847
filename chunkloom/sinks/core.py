"""Sinks of chunks, pages and blocks, for batch jobs and for ``foreachBatch``."""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Callable, Sequence
from datetime import datetime
from typing import Protocol

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..config import Config
from ..functions.text import ID_PREFIX, block_id, built_once
from ..sources.tables import as_type, page_info
from ..staging import remove

#: Pages of neighbouring numbers that share a part of the stored table, and the parts of pages whose ids are no numbers.
PART_PAGES, TEXT_PARTS = 1000, 256
#: A batch with pages of so many parts names them when it reads the table.
PART_FILTER = 1000
#: Ids of so many bytes are sent to all tasks.
BROADCAST_BYTES = 8 << 20
COLUMNS = ("chunk_id", "page_id", "payload", "part")
#: The name of a part of a batch that is all of it.
ALL = "all"


class Sink(Protocol):
    """Takes batches, whole (``part`` is ALL) or in parts.

    A write of the whole replaces what an earlier attempt at that batch left.  A write that raises leaves nothing of its part behind, or
    nothing that writing the same rows again would not replace.  If it raises ``Refused``, the part comes again without the pages that this names.
    """

    path: str
    #: Chunks, pages and blocks written so far.
    totals: Counter

    def write(self, chunks: DataFrame, pages: DataFrame, blocks: DataFrame | None, batch: int, part: str) -> None: ...

    def close(self, metadata: DataFrame) -> None: ...


class Refused(RuntimeError):
    """Raised by a write that knows which pages the sink does not take: ``holds`` tells it of a column of ids.

    The others are written at once; after any other error the pages that fail have to be searched for.
    """

    def __init__(self, error: str, holds: Callable[[Column], Column]):
        super().__init__(error)
        self.holds = holds


class Counting:
    """Counts rows as they are written, without a job of its own."""

    def __init__(self) -> None:
        self.seen: dict[str, Observation] = {}

    def rows(self, df: DataFrame, name: str) -> DataFrame:
        self.seen[name] = Observation()
        return df.observe(self.seen[name], F.count(F.lit(1)).alias("n"))

    def counted(self) -> dict[str, int]:
        """The counts of tables that have been written."""
        return {name: o.get["n"] for name, o in self.seen.items()}


def chunk_record(chunks: DataFrame) -> Column:
    """A chunk as a nested record, with the ids of its blocks and its navigation in a struct of its own."""
    return _record(tuple(chunks.columns))


@built_once
def _record(columns: tuple[str, ...]) -> Column:
    ids = lambda c: F.transform(c, lambda i: block_id(F.col("page_id"), i))
    kinds = ("block_indices", "core_block_indices", "overlap_prev_block_indices", "overlap_next_block_indices")
    plain = [c for c in columns if c not in {"xpath_start", "css_selector_start", "text_offset_start", "text_length", "navigation_url", "highlight_metadata", "chunk_no"}]
    navigation = F.struct("xpath_start", "css_selector_start", "text_offset_start", "text_length", F.col("navigation_url").alias("url"), "highlight_metadata")
    return F.struct(*plain, *[ids(c).alias(c.replace("indices", "block_ids").replace("block_block", "block")) for c in kinds], navigation.alias("navigation"))


def to_json(record: Column) -> Column:
    """Compact JSON that keeps nulls."""
    return F.to_json(record, {"ignoreNullFields": "false"})


def payloads(chunks: DataFrame, *more: str) -> DataFrame:
    """(chunk_id, payload, and columns ``more`` of the chunks): all of a chunk but its id, as JSON."""
    record = chunk_record(chunks)
    return chunks.select("chunk_id", *more, to_json(record.dropFields("chunk_id")).alias("payload"))


class JsonSink:
    """Folders chunks, pages, blocks (if wanted) and metadata of JSON lines under one folder named by prefix and time, each in parts batch=/part=."""

    def __init__(self, config: Config, now: datetime | None = None):
        self.path = f"{config.output_dir.rstrip('/')}/{config.output_prefix}_{(now or datetime.now()):%Y%m%d_%H%M%S}"
        self.totals = Counter()

    def write(self, chunks: DataFrame, pages: DataFrame, blocks: DataFrame | None, batch: int = 0, part: str = ALL) -> None:
        spark, info, counting = pages.sparkSession, page_info(pages), Counting()
        sections = {"chunks": (chunks, chunk_record(chunks)), "pages": (info, F.struct(*info.columns))}
        if blocks is not None:
            sections["blocks"] = (blocks, F.struct(*blocks.columns))
        if part == ALL:  # a batch that is repeated after a failure replaces all of its own
            self._drop(spark, f"batch={batch}")
        try:
            for name, (rows, record) in sections.items():
                counting.rows(rows, name).select(to_json(record).alias("value")).write.mode("overwrite").text(f"{self.path}/{name}/batch={batch}/part={part}")
        except Exception:
            self._drop(spark, f"batch={batch}/part={part}")
            raise
        self.totals.update(counting.counted())

    def _drop(self, spark: SparkSession, below: str) -> None:
        for section in ("chunks", "pages", "blocks"):
            remove(spark, f"{self.path}/{section}/{below}")

    def close(self, metadata: DataFrame) -> None:
        metadata.select(to_json(F.struct(*metadata.columns)).alias("value")).write.mode("overwrite").text(f"{self.path}/metadata")


def last_of_each(rows: DataFrame, key: str, order: Sequence[str]) -> DataFrame:
    """Of rows that share a key the last by ``order``; each task keeps one for each key before they meet."""
    rest = F.struct(*[c for c in rows.columns if c != key])
    return rows.groupBy(key).agg(F.max_by(rest, F.struct(*order)).alias("_last")).select(key, "_last.*")


def upsert(old: DataFrame, new: DataFrame, key: str = "chunk_id", order: Sequence[str] = ("_arrival",)) -> DataFrame:
    """``old`` with the rows of ``new`` in place of those with their keys; of rows of ``new`` that share a key the last by ``order``
    counts, by default the last in the order in which ``new`` has them."""
    arrived = new.withColumn("_arrival", F.monotonically_increasing_id())
    last = last_of_each(arrived, key, order).select(*old.columns)
    return old.join(last, key, "left_anti").unionByName(last)


def part_of(page_id: Column) -> Column:
    """The part of the stored table that a page is in: pages of neighbouring numbers share one, so their number grows with the table."""
    number = page_id.cast("string").try_cast("long")
    return F.when(number >= 0, F.concat(F.lit("n"), F.floor(number / PART_PAGES).cast("string"))).otherwise(F.concat(F.lit("t"), F.pmod(F.xxhash64(page_id.cast("string")), F.lit(TEXT_PARTS)).cast("string")))


class TableSink:
    """A keyed table (chunk_id, page_id, payload) of Parquet files, partitioned by ``part_of`` the page.

    A batch reads and overwrites the parts that it has pages of, and no others (Spark's dynamic partition overwrite).  With
    ``replace_pages`` the chunks that a page no longer has go too.  One writer at a time; a batch that is repeated gives the same table.
    """

    def __init__(self, spark: SparkSession, path: str, replace_pages: bool = False):
        self.spark, self.path, self.replace_pages = spark, path, replace_pages
        self.totals = Counter()

    def _rows(self) -> DataFrame:
        at = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(self.path)
        there = at.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).exists(at)
        kind = ", ".join(f"{c} string" for c in COLUMNS)
        return self.spark.read.schema(kind).parquet(self.path) if there else self.spark.createDataFrame([], kind)

    def read(self) -> DataFrame:
        """The table; empty if nothing has been written."""
        return self._rows().where("chunk_id is not null")

    def lookup(self, chunk_id: str) -> DataFrame:
        """The row of one key: only its page's part is read, and the filter reaches the scan."""
        page = page_of_chunk(chunk_id)
        own = self.read().where(F.col("part") == part_of(F.lit(page))) if page is not None else self.read().where("false")
        return lookup(own, chunk_id)

    def write(self, chunks: DataFrame, pages: DataFrame, blocks: DataFrame | None = None, batch: int = 0, part: str = ALL) -> None:
        counting = Counting()
        own = pages.select(F.col("id").cast("string").alias("page_id"), part_of(F.col("id")).alias("part"))
        new = counting.rows(payloads(chunks, "page_id"), "chunks").withColumn("part", part_of(F.col("page_id")))
        touched = own.select("part").distinct()
        names = [r["part"] for r in touched.limit(PART_FILTER + 1).collect()]
        # names of parts prune the scan; a batch of more of them has pages of most of the table
        old = self._rows().where(F.col("part").isin(names)) if len(names) <= PART_FILTER else self._rows().join(touched, "part", "left_semi")
        old = old.select(*COLUMNS)
        if self.replace_pages:
            # a part whose last chunk goes is overwritten too: by a row without a key, which readers do not see
            empty = touched.select(*[F.lit(None).cast("string").alias(c) for c in COLUMNS[:3]], "part")
            ids = own.select("page_id").distinct()
            # ids of few MB go to the stored rows, which are not shuffled to meet them
            size = ids.agg(F.sum(F.octet_length("page_id") + 16)).first()[0] or 0
            ids = F.broadcast(ids) if size < BROADCAST_BYTES else ids
            old = old.where("chunk_id is not null").join(ids, "page_id", "left_anti").select(*COLUMNS).unionByName(empty)
            new = new.where("chunk_id is not null")
        arrived = old.withColumn("_arrival", F.lit(-1).cast("long")).unionByName(new.withColumn("_arrival", F.monotonically_increasing_id()))
        # payloads are shuffled once, by part: there the last row of each key is found, and a part is written by one task
        last = arrived.repartition("part").groupBy("part", "chunk_id").agg(F.max_by(F.struct("page_id", "payload"), "_arrival").alias("_last")).select("chunk_id", "_last.*", "part")
        # a payload has its text several times, which zstandard's window sees
        last.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").option("compression", "zstd").partitionBy("part").parquet(self.path)
        self.totals.update(counting.counted())

    def close(self, metadata: DataFrame) -> None:
        """The run's metadata is not part of this table."""


class Composite:
    """Several sinks as one: each is written even if another fails, then the first failure is raised."""

    def __init__(self, sinks: Sequence[Sink]):
        if not sinks:
            raise ValueError("no sinks")
        self.sinks = list(sinks)
        self.path = " | ".join(s.path for s in sinks)

    @property
    def totals(self) -> Counter:
        """Those of the sink that has written most of each."""
        out: Counter = Counter()
        for sink in self.sinks:
            out |= sink.totals
        return out

    def _each(self, do) -> None:
        failures = []
        for sink in self.sinks:
            try:
                do(sink)
            except Exception as problem:  # the other sinks still get this batch
                failures.append(problem)
        if failures:
            raise failures[0]

    def write(self, chunks: DataFrame, pages: DataFrame, blocks: DataFrame | None, batch: int = 0, part: str = ALL) -> None:
        self._each(lambda s: s.write(chunks, pages, blocks, batch, part))

    def close(self, metadata: DataFrame) -> None:
        self._each(lambda s: s.close(metadata))


#: Builders of sinks by name, from (spark, config); ``register_sink`` adds to them.
SINKS: dict[str, Callable[[SparkSession, Config], Sink]] = {
    "json": lambda spark, config: JsonSink(config),
    "table": lambda spark, config: TableSink(spark, f"{config.output_dir.rstrip('/')}/{config.table_name}", config.replace_pages),
}


def register_sink(name: str, build: Callable[[SparkSession, Config], Sink]) -> None:
    """Make a sink known by a name that the setting ``extra_sinks`` can hold."""
    SINKS[name] = build


def chosen_sinks(spark: SparkSession, config: Config) -> Composite:
    """The sinks that the settings enable."""
    config.validate()
    names = ["json"] * config.json_enabled + ["table"] * config.table_enabled + list(config.extra_sinks)
    if unknown := [n for n in names if n not in SINKS]:
        raise ValueError(f"unknown sinks: {', '.join(unknown)}")
    return Composite([SINKS[n](spark, config) for n in names])


def lookup(chunks: DataFrame, chunk_id: str) -> DataFrame:
    """One chunk by its id; the filter reaches a Parquet scan."""
    return chunks.where(F.col("chunk_id") == chunk_id)


def page_of_chunk(chunk_id: str) -> str | None:
    """The page that a chunk's id names."""
    found = re.fullmatch(rf"{ID_PREFIX}:(.*):\d+-\d+", chunk_id, re.DOTALL)
    return found[1] if found else None


def chunk_of(raw: DataFrame, key: str, to_pages: Callable[[DataFrame], DataFrame], chunk_id: str, config: Config) -> DataFrame:
    """One chunk by its id, computed from its own page alone.

    ``raw`` is a table of pages whose ids are in column ``key``, of any type; the filter is on that column, so it reaches the scan, and
    ``to_pages`` makes pages of what is left.
    """
    from ..operators.chunks import chunk_pages

    page = page_of_chunk(chunk_id)
    own = raw.where(F.col(key) == as_type(page, raw.schema[key].dataType)) if page is not None else raw.where("false")
    return lookup(chunk_pages(to_pages(own), config), chunk_id)
