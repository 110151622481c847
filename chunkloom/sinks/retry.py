"""Writing a batch of pages so that one which a sink does not take costs no other.

A batch is written whole.  If that fails and the sink names the pages that it does not take (``Refused``), it is written again without them: two writes, however many
they are.  If it names none, its pages are dealt to two halves by their ids' hashes and each is written alone, and so on, until
the pages that fail stand alone: n pages of which one is bad take some 2 log n writes.  Those are set aside with the error, and can be run again.
A sink that takes no page at all is broken, not the pages: that raises, and nothing is set aside.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Sequence
from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..config import Config
from ..log import logger
from ..operators.blocks import page_blocks
from ..operators.chunks import chunk_pages
from ..staging import Staged, remove
from .core import ALL, Refused, Sink

#: After so many failures of single pages the parts that fail are set aside whole, since each costs some jobs.
SINGLES = 200
DEPTH = 40


class WriteBroken(RuntimeError):
    """No page of a batch could be written."""


class DeadLetters:
    """Pages that could not be written, as a table of batches: the parsed page, the batch and the errors (sink, error)."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")
        #: Batches in a row of which a sink took no page.
        self.barren: Counter = Counter()

    @classmethod
    def beside(cls, spark: SparkSession, config: Config, now: datetime | None = None) -> DeadLetters:
        return cls(spark, f"{config.output_dir.rstrip('/')}/{config.output_prefix}_dead_letters_{now or datetime.now():%Y%m%d_%H%M%S_%f}")

    def clear(self, batch: int) -> None:
        """Forget what an earlier attempt at a batch set aside."""
        remove(self.spark, f"{self.path}/batch={batch}")

    def write(self, pages: DataFrame, batch: int) -> int:
        """Set ``pages`` (with ``errors``) aside; returns how many."""
        seen = Observation()
        pages.observe(seen, F.count(F.lit(1)).alias("n")).write.mode("overwrite").parquet(f"{self.path}/batch={batch}")
        return seen.get["n"]

    def read(self) -> DataFrame:
        return self.spark.read.parquet(self.path)

    def pages(self) -> DataFrame:
        """The pages as they were parsed, to be run again."""
        return self.read().drop("errors", "batch")


@dataclass(frozen=True)
class Part:
    """The pages whose id's hash ends with ``bits``; the empty string stands for all."""

    bits: str = ""

    @property
    def name(self) -> str:
        return f"h{self.bits}" if self.bits else ALL

    def holds(self, page_id: str = "id") -> Column:
        if not self.bits:
            return F.lit(True)
        mask = (1 << len(self.bits)) - 1
        return F.xxhash64(F.coalesce(F.col(page_id).cast("string"), F.lit(""))).bitwiseAND(F.lit(mask).cast("long")) == int(self.bits, 2)

    def halves(self) -> tuple[Part, Part]:
        return Part("0" + self.bits), Part("1" + self.bits)


@dataclass(frozen=True)
class Left:
    """A part without the pages that the sink has named."""

    part: Part
    named: tuple[Refused, ...] = ()

    def holds(self, page_id: str = "id") -> Column:
        out = self.part.holds(page_id)
        for refused in self.named:
            out &= ~_names(refused, page_id)
        return out

    def halves(self) -> list[Left]:
        return [Left(half, self.named) for half in self.part.halves()]


def _names(refused: Refused, page_id: str = "id") -> Column:
    return F.coalesce(refused.holds(F.col(page_id)), F.lit(False))


def _refused(pages: DataFrame, chunks: DataFrame | None, config: Config, sink: Sink, batch: int) -> tuple[list[tuple[Column, str]], bool]:
    """Write what ``sink`` takes; returns conditions on ids of pages that it does not take, with the errors, and whether it has taken any.

    WriteBroken as soon as it has refused three single pages and taken nothing.
    """
    refused: list[tuple[Column, str]] = []
    todo, taken, singles = [Left(Part())], False, 0
    while todo:
        left = todo.pop()
        part, own = left.part, pages.where(left.holds())
        if left.named and own.isEmpty():  # nothing is left to write
            continue
        try:
            cut = chunk_pages(own, config) if chunks is None else chunks.where(left.holds("page_id"))
            sink.write(cut, own, page_blocks(own) if config.include_blocks else None, batch, part.name)
            taken = True
            continue
        except Exception as problem:  # what could not be written is looked at without the pages named, or in halves
            text, wrong = f"{type(problem).__name__}: {problem}", problem
        if isinstance(wrong, Refused) and not own.where(_names(wrong)).isEmpty():
            refused.append((left.holds() & _names(wrong), text))
            logger.error("batch %d, part %s: pages that %s names were not written: %s", batch, part.name, sink.path, text[:500])
            todo.append(Left(part, (*left.named, wrong)))
            continue
        alone = len(own.select("id").distinct().limit(2).collect()) < 2
        singles += alone
        if singles > 2 and not taken:
            raise WriteBroken(f"batch {batch}: {sink.path} takes no page: {text}")
        if alone or len(part.bits) >= DEPTH or singles > SINGLES:
            refused.append((left.holds(), text))
            logger.error("batch %d, part %s was not written to %s: %s", batch, part.name, sink.path, text[:500])
        else:
            todo += left.halves()
    return refused, taken


def deliver(pages: DataFrame, config: Config, sinks: Sequence[Sink], batch: int, letters: DeadLetters, staged: Staged, n: int) -> Counter:
    """Write ``n`` ``pages``, and their chunks, to every sink; counts of pages_failed, chunks and blocks.

    A page that any sink does not take counts as failed, though others may have it.  WriteBroken if a sink takes none of several pages, or
    none of three batches of one page in a row.
    """
    letters.clear(batch)
    chunks = None
    if len(sinks) > 1:
        try:
            chunks = staged.write(chunk_pages(pages, config), "chunks")  # cut once for all sinks
        except Exception as problem:  # a page that cannot be cut is found as one that cannot be written
            logger.warning("batch %d is cut for each sink: %r", batch, problem)
    wrong: list[tuple[Sink, Column, str]] = []
    written = []
    for sink in sinks:
        before = Counter(sink.totals)
        refused, taken = _refused(pages, chunks, config, sink, batch)
        letters.barren[sink.path] = 0 if taken else letters.barren[sink.path] + 1
        if not taken and (n != 1 or letters.barren[sink.path] > 2):
            raise WriteBroken(f"batch {batch}: {sink.path} takes no page: {refused[0][1]}")
        wrong += [(sink, holds, text) for holds, text in refused]
        written.append(Counter(sink.totals) - before)
    found = {k: max(w[k] for w in written) for k in ("chunks", "blocks")}
    if not wrong:
        return Counter(pages_failed=0, **found)
    errors = F.array_compact(F.array(*[F.when(holds, F.struct(F.lit(sink.path).alias("sink"), F.lit(text).alias("error"))) for sink, holds, text in wrong]))
    judged = pages.withColumn("errors", errors)
    failed = letters.write(judged.where(F.size("errors") > 0), batch)
    if len(sinks) > 1:  # what one sink has of a page that another refused is not counted
        good = judged.where(F.size("errors") == 0).drop("errors")
        left = chunk_pages(good, config) if chunks is None else chunks.join(good.select(F.col("id").alias("page_id")).distinct(), "page_id", "left_semi")
        blocks = good.agg(F.coalesce(F.sum(F.size("pieces")), F.lit(0))).first()[0] if found["blocks"] else 0
        found = {"chunks": left.count(), "blocks": blocks}
    return Counter(pages_failed=failed, **found)
