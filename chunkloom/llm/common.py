"""Helpers shared by the training-data operators."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: The six ASCII white-space characters, as a regex class body (Java, RE2 and Python agree on it).
WS = r"\x20\x09-\x0D"
#: Rows times bytes a row that a side may have to be broadcast; larger sides are joined by a shuffle.  Spark's table of
#: such rows takes some four times as much.
BROADCAST_BYTES = 8 << 20

#: A key that more than this part of a side's rows share is joined apart from the others.
HOT_PART = 1000

_local_roots: dict[str, str] = {}
_written: list[str] = []


def scratch_root(spark: SparkSession) -> str:
    """The shared folder of ``spark.checkpoint.dir``.  A local session that names none (tests) gets a temporary one; a cluster's raises."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
    app = spark.sparkContext.applicationId
    if app not in _local_roots:
        _local_roots[app] = tempfile.mkdtemp(prefix="spark-")
    return _local_roots[app]


def scratch_path(spark: SparkSession, label: str) -> str:
    path = f"{scratch_root(spark)}/chunkloom-{label}-{uuid.uuid4().hex}"
    _written.append(path)
    return path


def materialize(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: lineage ends there, and lost executors cost nothing.

    The table stays until ``clear`` or the folder's owner removes it, since what is read from it is computed later.
    """
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def written() -> int:
    """A mark for ``clear``: how many tables this process has written so far."""
    return len(_written)


def clear(spark: SparkSession, since: int, keep: DataFrame | None = None) -> None:
    """Delete the tables written after the mark ``since``, but for those that ``keep`` reads: what else was computed from them must be written by now."""
    held = {p for f in keep.inputFiles() for p in _written if f"/{p.rsplit('/', 1)[-1]}/" in f} if keep is not None else set()
    for path in [p for p in _written[since:] if p not in held]:
        at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(at, True)
    _written[since:] = sorted(held & set(_written[since:]))


def small_side(df: DataFrame, rows: int, row_bytes: int) -> DataFrame:
    """Mark ``df`` for broadcast only if its counted size allows it."""
    return F.broadcast(df) if rows * row_bytes <= BROADCAST_BYTES else df


def join_hot(left: DataFrame, right: DataFrame, key: str, total: int, n: str = "n") -> DataFrame:
    """``left`` joined with ``right``, which has one row for each key and in column ``n`` how many of ``left``'s ``total`` rows have it.

    Keys that more than one row in HOT_PART has are fewer than HOT_PART: they are broadcast, so that their rows stay where they
    are.  The others are joined by a shuffle, in which no key has many rows.
    """
    hot = F.broadcast(right.where(F.col(n) * HOT_PART > total))
    rest = left.join(hot.select(key), key, "left_anti").join(right.where(F.col(n) * HOT_PART <= total), key)
    return left.join(hot, key).unionByName(rest).drop(n)


def quoted(name: str) -> Column:
    return F.col("`" + name.replace("`", "``") + "`")


def whole_row(docs: DataFrame, but: tuple[str, ...] = ()) -> Column:
    """All columns of ``docs`` (but those named) as one struct, out of the way of an operator's own column names."""
    return F.struct(*[quoted(c) for c in docs.columns if c not in but])


def remainder(doc_id: Column, modulus: int) -> Column:
    """crc32 of the id's decimal text, modulo ``modulus``; null ids count as remainder -1."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % modulus, F.lit(-1))


def texts(batch: pa.RecordBatch, column: str) -> list[bytes | None]:
    """The UTF-8 bytes of a string column, without decoding them."""
    return batch.column(column).cast(pa.large_binary()).to_pylist()


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/pages.parquet")


def embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/embeddings.parquet")


def utf8(values: list[bytes]) -> pa.Array:
    return pa.array(values, pa.binary()).cast(pa.string())


Batches = Iterator[pa.RecordBatch]
