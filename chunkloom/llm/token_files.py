"""Token ids in compressed shards: one zstandard frame a document, a dictionary shared by all.

Layout of a shard (little-endian): 4 bytes magic, u32 version, 32 bytes SHA-256 of the dictionary, u32 number of
documents n, then n index entries (i64 doc_id, u8 id is null, u64 offset of the frame, u32 its length, u64 ids in
it, u8 bytes an id takes), then the frames.  A reader finds one document by its entry, seeks to its frame and reads nothing else of the others.

Shards are cells of a Parquet table in the shared folder (part, shard, first_id, last_id, docs, ids, data): Spark's writer commits
them, whatever store the folder is in, so a lost executor or a task run twice leaves no stray file.  A cell is small, and ids
ascend, so the table's statistics leave a single document's cell to read.  The dictionary is a table of one row beside them, found by
the hash that every shard holds.  ``export`` writes the cells as files of their own.
"""

from __future__ import annotations

import hashlib
import io
import json
import math
import os
import re
import struct
import warnings
import zlib
from array import array
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain
from typing import BinaryIO

import numpy as np
import public_tokenizers
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import Batches, materialize, scratch_path, small_side, texts

MAGIC, VERSION = b"CLTK", 1
HEAD = struct.Struct("<4sI32sI")
ENTRY = np.dtype([("doc_id", "<i8"), ("null", "u1"), ("offset", "<u8"), ("size", "<u4"), ("ids", "<u8"), ("width", "u1")])
TOKENIZER = "word_bpe_49k.json"
END_ID = 1
#: Bytes of frames in a shard, and in a row group of the table of shards, about.
SHARD_BYTES, GROUP_BYTES = 1 << 20, 4 << 20
#: Bytes of texts that a writing task is given, about.
TASK_BYTES = 64 << 20
LEVEL = 3
#: The dictionary is fitted on about this many documents, of at most so many code points each; every document is compressed with it.
DICT_DOCS, DICT_CHARS, DICT_BYTES, DICT_LEAST = 2000, 4000, 64 << 10, 8
#: Words whose ids a Python worker remembers.
CACHE_WORDS = 1_500_000
#: A-Z before the first byte of a character that may be a mark to be composed with it.
MARKED = re.compile(rb"[A-Z](?:[\xcc\xcd\xd2\xd6-\xe1\xe3-\xf4]|\xe2\x83)")
#: The pieces that a text is cut to by a tokenizer whose words end before their marks, and those marks: ASCII's without "'", which begins pieces like 's.
PIECES = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
MARKS = bytes(c for c in range(0x21, 0x7F) if not chr(c).isalnum() and chr(c) != "'")
#: Bytes of the texts whose words it learns at once.
GROUP_TEXT = 1 << 20


class WordEncoder:
    """Ids of a text as the tokenizer gives them, remembered word by word.

    A tokenizer that drops white space and never joins pieces across it gives a text the ids
    of its words (runs of other than ASCII white space) in turn; any other encodes each text whole.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.wide = self.tokenizer.get_vocab_size() > 1 << 16
        self.known: dict[bytes, bytes] = {}
        added = [t for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.added = [t.content.encode().lower() for t in added]
        spaceless = all(not (t.lstrip or t.rstrip) and len(t.content.split()) == 1 for t in added)
        self.by_word, self.lowers = spaceless and self.drops_space(), self.lowers_case()
        self.cuts = self.lowers and self.cuts_marks()

    def drops_space(self) -> bool:
        """Whether probes in which words meet in every way have the ids of their words."""
        words = ["The", "cat", "sat,", "on", "a", "a", "1", "000", "été", "漢字", "x_y", "—", "...", "don't", "The"]
        probes = [gap.join(words) for gap in (" ", "  ", "\n", " \t\r\n ")] + [" " + words[0] + " "]
        ids = lambda text: self.tokenizer.encode(text, add_special_tokens=False).ids
        return all(ids(p) == [i for w in p.split() for i in ids(w)] for p in probes)

    def lowers_case(self) -> bool:
        """Whether the tokenizer makes letters small before all but composing characters, so that A-Z may be small from the start."""
        normalizer = json.loads(self.tokenizer.to_str()).get("normalizer") or {}
        steps = normalizer.get("normalizers", [normalizer])
        kinds = [s.get("type") for s in steps]
        before = steps[: kinds.index("Lowercase")] if "Lowercase" in kinds else []
        return "Lowercase" in kinds and all(s["type"] == "NFC" or s["type"] == "Replace" and s["pattern"] == {"Regex": "\\s+"} for s in before)

    def cuts_marks(self) -> bool:
        """Whether the tokenizer cuts a word between an ASCII letter and marks that end it, and gives its model words of a-z as they are."""
        cutter = json.loads(self.tokenizer.to_str()).get("pre_tokenizer") or {}
        first, *more = cutter.get("pretokenizers", [cutter])
        splits = first.get("type") == "Split" and first["pattern"] == {"Regex": PIECES} and first["behavior"] == "Removed" and first["invert"]
        plain = all(s["type"] == "ByteLevel" and not s["add_prefix_space"] and not s["use_regex"] for s in more)
        return splits and plain and not any(t.isalpha() for t in self.added)

    def parted(self, word: bytes) -> tuple[bytes, bytes] | None:
        """A word without the marks that end it, and these, if the ids of both in turn are the word's."""
        head = word.rstrip(MARKS)
        if len(head) == len(word) or not head[-1:].isalpha() or any(t in word.lower() for t in self.added):
            return None
        return head, word[len(head) :]

    def words(self, data: bytes) -> list[bytes]:
        """The words of a text, with A-Z made small if that changes no id.

        It would where an added token stands in other letters, since those are looked for before letters are made small, and where a mark
        that is composed with its letter follows, since not every large letter has the composed form that its small one has.
        """
        if not self.lowers:
            return data.split()
        low = data.lower()  # bytes.lower() maps A-Z alone
        if any(t in low for t in self.added) or not data.isascii() and MARKED.search(data):
            return data.split()
        return low.split()

    def learn(self, words: list[bytes]) -> None:
        """Remember the ids of ``words``; those of a word that marks end are put together from its parts', which other words have too."""
        kind = "I" if self.wide else "H"
        parts = {w: p for w in words if (p := self.parted(w))} if self.cuts else {}
        whole = {w for w in words if w not in parts} | set(chain.from_iterable(parts.values()))
        new = []
        for word in whole.difference(self.known):
            if self.cuts and word.isalpha() and word.islower():  # both are of ASCII
                self.known[word] = array(kind, [t.id for t in self.tokenizer.model.tokenize(word.decode())]).tobytes()
            else:
                new.append(word)
        for start in range(0, len(new), 20_000):
            part = new[start : start + 20_000]
            for word, e in zip(part, self.tokenizer.encode_batch_fast([w.decode() for w in part], add_special_tokens=False), strict=True):
                self.known[word] = array(kind, e.ids).tobytes()
        for word, (head, marks) in parts.items():
            self.known[word] = self.known[head] + self.known[marks]

    def encode(self, group: list[bytes], end: bytes) -> Iterator[bytes]:
        """The serialized ids of each text and the end id; the words of all of them are learned at once."""
        if not self.by_word:
            kind = "I" if self.wide else "H"
            for data in group:
                yield array(kind, self.tokenizer.encode(data.decode(), add_special_tokens=False).ids).tobytes() + end
            return
        split = [self.words(data) for data in group]
        words = set(chain.from_iterable(split))
        if len(self.known) > CACHE_WORDS:
            self.known.clear()
        self.learn(list(words.difference(self.known)))
        for words in split:
            yield b"".join(map(self.known.__getitem__, words)) + end


@lru_cache(maxsize=2)
def encoder(path: str) -> WordEncoder:
    return WordEncoder(path)


def encode_all(batch_texts: list[bytes | None], path: str, end_id: int = END_ID) -> Iterator[tuple[bytes, int]]:
    """(serialized ids, bytes an id takes) of each text; null counts as empty."""
    tool = encoder(path)
    width = 4 if tool.wide else 2
    end = end_id.to_bytes(width, "little")
    group, size = [], 0
    for data in batch_texts:
        group.append(data or b"")
        size += len(group[-1])
        if size >= GROUP_TEXT:
            yield from ((ids, width) for ids in tool.encode(group, end))
            group, size = [], 0
    yield from ((ids, width) for ids in tool.encode(group, end))


def train_dictionary(docs: DataFrame, path: str, n: int) -> bytes:
    """A dictionary for short documents, fitted on a bounded sample of the serialized id arrays of ``n`` documents.

    zstandard cannot fit one to a handful of samples: with fewer than DICT_LEAST of them, or where it
    refuses, there is none, with a warning, and the frames stand without it.
    """
    limit = 1 << 30
    chosen = docs.where((F.length("text") <= DICT_CHARS) & (F.pmod(F.xxhash64("doc_id"), F.lit(limit)) < int(limit * min(1.0, DICT_DOCS / max(n, 1)))))

    def rows(batches: Batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([x for x, _ in encode_all(texts(batch, "text"), path)], pa.binary())], names=["ids"])

    samples = [bytes(r[0]) for r in chosen.select("text").mapInArrow(rows, "ids binary").limit(2 * DICT_DOCS).collect()]
    problem = f"{len(samples)} samples"
    if len(samples) >= DICT_LEAST:
        try:
            return zstandard.train_dictionary(min(DICT_BYTES, max(1024, sum(map(len, samples)) // 8)), samples).as_bytes()
        except zstandard.ZstdError as refused:
            problem = str(refused)
    warnings.warn(f"no dictionary was trained: {problem}", stacklevel=2)
    return b""


def _dict(data: bytes) -> zstandard.ZstdCompressionDict | None:
    return zstandard.ZstdCompressionDict(data) if data else None


def pack_shard(entries: list[tuple[int | None, bytes, int, int]], digest: bytes) -> bytes:
    """The bytes of a shard, from (doc_id, frame, ids, width) of each document."""
    index = np.zeros(len(entries), ENTRY)
    at = 0
    for i, (doc_id, frame, ids, width) in enumerate(entries):
        index[i] = (doc_id or 0, doc_id is None, at, len(frame), ids, width)
        at += len(frame)
    return b"".join([HEAD.pack(MAGIC, VERSION, digest, len(entries)), index.tobytes(), *(e[1] for e in entries)])


class ShardReader:
    """Reads a shard's index, and single documents by it, from an open file: no frame but the wanted one is read."""

    def __init__(self, file: BinaryIO, dictionary: bytes):
        self.file = file
        magic, version, digest, n = HEAD.unpack(file.read(HEAD.size))
        if magic != MAGIC or version != VERSION:
            raise ValueError("not a token shard")
        if digest != hashlib.sha256(dictionary).digest():
            raise ValueError("the shard was written with another dictionary")
        self.index = np.frombuffer(file.read(n * ENTRY.itemsize), ENTRY)
        self.start = HEAD.size + n * ENTRY.itemsize
        self.tool = zstandard.ZstdDecompressor(dict_data=_dict(dictionary))

    def ids(self, place: int) -> np.ndarray:
        e = self.index[place]
        self.file.seek(self.start + int(e["offset"]))
        raw = self.tool.decompress(self.file.read(int(e["size"])))
        return np.frombuffer(raw, "<u2" if e["width"] == 2 else "<u4").astype("<u4")

    def documents(self, doc_id: int) -> list[np.ndarray]:
        """The ids of each document of that id, found by bisection, since ids ascend."""
        nulls = int(self.index["null"].sum())  # they come first
        known = self.index["doc_id"][nulls:]
        return [self.ids(nulls + i) for i in range(int(np.searchsorted(known, doc_id)), int(np.searchsorted(known, doc_id, "right")))]


def write_shards(docs: DataFrame, where: str, tokenizer: str = TOKENIZER) -> None:
    """Write all of ``docs`` (doc_id, text) as shards in ``where``/shards, ascending by doc_id, and their dictionary in ``where``/dictionary.

    Rows are range-partitioned by doc_id (null first) and, where many share one, by a hash of the text, into as many tasks as their bytes ask for; each
    task writes its shards one after the other and holds one.
    """
    path, spark = public_tokenizers.path(tokenizer), docs.sparkSession
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    about = docs.agg(F.count("*").alias("n"), F.sum(F.octet_length("text").cast("long")).alias("bytes")).first()
    dictionary = train_dictionary(docs, path, about["n"])
    digest = hashlib.sha256(dictionary).digest()
    spark.createDataFrame([(digest.hex(), dictionary)], "sha256 string, data binary").coalesce(1).write.parquet(f"{where}/dictionary")
    shared = spark.sparkContext.broadcast(dictionary)  # at most DICT_BYTES

    def rows(batches: Batches):
        part, shard = TaskContext.get().partitionId(), 0
        tool = zstandard.ZstdCompressor(level=LEVEL, dict_data=_dict(shared.value), write_content_size=True)
        entries: list[tuple[int | None, bytes, int, int]] = []
        held = 0

        def flush():
            return pa.RecordBatch.from_arrays(
                [
                    pa.array([x], t)
                    for x, t in (
                        (part, pa.int32()),
                        (shard, pa.int32()),
                        (next((e[0] for e in entries if e[0] is not None), None), pa.int64()),
                        (entries[-1][0], pa.int64()),
                        (len(entries), pa.int64()),
                        (sum(e[2] for e in entries), pa.int64()),
                        (pack_shard(entries, digest), pa.binary()),
                    )
                ],
                names=["part", "shard", "first_id", "last_id", "docs", "ids", "data"],
            )

        for batch in batches:
            for doc_id, (raw, width) in zip(batch.column("doc_id").to_pylist(), encode_all(texts(batch, "text"), path), strict=True):
                frame = tool.compress(raw)
                entries.append((doc_id, frame, len(raw) // width, width))
                held += len(frame)
                if held >= SHARD_BYTES:
                    yield flush()
                    entries, held, shard = [], 0, shard + 1
        if entries:
            yield flush()

    n = max(int(spark.conf.get("spark.sql.shuffle.partitions")), math.ceil((about["bytes"] or 0) / TASK_BYTES))
    order = F.col("doc_id").asc_nulls_first(), F.xxhash64("text")
    ordered = docs.repartitionByRange(n, *order).sortWithinPartitions(*order)
    cells = ordered.mapInArrow(rows, "part int, shard int, first_id long, last_id long, docs long, ids long, data binary")
    cells.write.option("compression", "none").option("parquet.block.size", GROUP_BYTES).parquet(f"{where}/shards")


def read_dictionary(spark: SparkSession, where: str) -> bytes:
    """The dictionary of the shards in ``where``."""
    row = spark.read.parquet(f"{where}/dictionary").first()
    data = bytes(row["data"])
    if hashlib.sha256(data).hexdigest() != row["sha256"]:
        raise ValueError("the dictionary is damaged")
    return data


def read_document(where: str, spark: SparkSession, doc_id: int) -> list[np.ndarray]:
    """The ids of each document of one id.  The filter reaches the scan, whose statistics skip all row groups but those with the id."""
    cells = spark.read.parquet(f"{where}/shards").where((F.col("first_id") <= doc_id) & (F.col("last_id") >= doc_id)).orderBy("part", "shard").select("data")
    dictionary = read_dictionary(spark, where)
    return [ids for cell in cells.toLocalIterator() for ids in ShardReader(io.BytesIO(cell["data"]), dictionary).documents(doc_id)]


def export(where: str, folder: str, spark: SparkSession) -> DataFrame:
    """Write each shard as a file of its own below ``folder``, the dictionary too; returns (part, shard, path) of the shards.

    Spark's text writer writes and commits the files, so any store that it can write to will do, and tasks that run again
    leave one file each.  It ends a file with a line end, which no reader comes to, since the index knows where frames end.
    """
    cells = spark.read.parquet(f"{where}/shards").select("part", "shard", F.col("data").cast("string").alias("value"))  # the same bytes
    cells.write.mode("overwrite").partitionBy("part", "shard").text(f"{folder}/shards")
    held = spark.read.parquet(f"{where}/dictionary").select("sha256", F.col("data").cast("string").alias("value"))
    held.write.mode("overwrite").partitionBy("sha256").text(f"{folder}/dictionary")
    return spark.read.format("binaryFile").load(f"{folder}/shards").select(F.col("part").cast("int").alias("part"), F.col("shard").cast("int").alias("shard"), "path")


def read_shards(where: str, spark: SparkSession, with_ids: bool = True) -> DataFrame:
    """One row per document, from the shards alone: doc_id, start, n_tokens, ids_crc32 and (with_ids) the ids themselves."""
    shards = spark.read.parquet(f"{where}/shards")
    sums = shards.groupBy("part").agg(F.sum("ids").alias("ids")).orderBy("part").toPandas()  # a row for each writing task
    starts = np.concatenate([[0], np.cumsum(sums["ids"].to_numpy(np.int64))])[:-1] if len(sums) else np.zeros(0, np.int64)
    first = spark.createDataFrame([(int(p), int(s)) for p, s in zip(sums["part"], starts, strict=True)], "part int, part_start long")
    before = F.coalesce(F.sum("ids").over(Window.partitionBy("part").orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    placed = shards.select("part", "shard", before.alias("shard_start")).join(small_side(first, len(sums), 16), "part").select("part", "shard", (F.col("shard_start") + F.col("part_start")).alias("start"))
    placed = materialize(placed, "token-starts")
    shared = spark.sparkContext.broadcast(read_dictionary(spark, where))

    def rows(batches: Batches):
        for batch in batches:
            for data, start in zip(batch.column("data").to_pylist(), batch.column("start").to_pylist(), strict=True):
                reader = ShardReader(io.BytesIO(data), shared.value)
                ids = [reader.ids(i) for i in range(len(reader.index))]
                sizes = np.array([len(x) for x in ids], np.int64)
                columns = {
                    "doc_id": pa.array(reader.index["doc_id"], mask=reader.index["null"].astype(bool)),
                    "start": pa.array(start + np.cumsum(sizes) - sizes),
                    "n_tokens": pa.array(sizes),
                    "ids_crc32": pa.array([zlib.crc32(x.tobytes()) for x in ids], pa.int64()),
                }
                if with_ids:
                    columns["ids"] = pa.array([x.astype(np.int32) for x in ids], pa.list_(pa.int32()))
                yield pa.RecordBatch.from_pydict(columns)

    counted = placed.count()
    joined = shards.select("part", "shard", "data").join(small_side(placed, counted, 24), ["part", "shard"])
    return joined.select("data", "start").mapInArrow(rows, "doc_id long, start long, n_tokens long, ids_crc32 long" + ", ids array<int>" * with_ids)


def encoded(docs: DataFrame, tokenizer: str = TOKENIZER, with_ids: bool = True) -> DataFrame:
    """Write ``docs`` as shards in the shared folder and read them back.

    Null and empty texts hold the end id alone.  Repeated ids take neighbouring places, by a hash of the text; null ids come
    first.  Texts of any length are encoded whole.  Other columns of ``docs`` are not looked at.  An empty table gives an empty result.
    """
    where = scratch_path(docs.sparkSession, "token-shards")
    write_shards(docs, where, tokenizer)
    return read_shards(where, docs.sparkSession, with_ids)
