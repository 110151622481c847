"""Single documents from shards, files of their own, hot ids, and tokenizers that keep white space."""

import hashlib
import io
import pathlib
import tempfile

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from chunkloom.llm import token_files
from chunkloom.llm.common import scratch_path

FOLDER = "/root/testdata/sf0.01"


class Counted(io.BytesIO):
    taken = 0

    def read(self, n=-1):
        data = super().read(n)
        self.taken += len(data)
        return data


@pytest.fixture(scope="module")
def shards(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    where = scratch_path(spark, "token-test")
    token_files.write_shards(docs, where)
    return docs, where, token_files.read_dictionary(spark, where)


def test_one_document_is_read_alone(spark, shards):
    docs, where, dictionary = shards
    tokenizer = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    for r in docs.where("doc_id in (0, 7, 400, 999)").collect():
        (ids,) = token_files.read_document(where, spark, r["doc_id"])
        assert ids.tolist() == [*tokenizer.encode(r["text"], add_special_tokens=False).ids, 1]
    assert token_files.read_document(where, spark, 10**9) == []
    # of a shard's bytes only the index and one frame are read
    cell = spark.read.parquet(f"{where}/shards").first()
    file = Counted(bytes(cell["data"]))
    reader = token_files.ShardReader(file, dictionary)
    head = file.taken
    reader.documents(int(reader.index["doc_id"][3]))
    assert file.taken - head == reader.index["size"][3] and head == token_files.HEAD.size + cell["docs"] * token_files.ENTRY.itemsize


def test_files(spark, shards):
    docs, where, dictionary = shards
    folder = tempfile.mkdtemp(prefix="spark-", dir="/tmp")
    for _ in range(2):  # a second run writes the same again
        files = token_files.export(where, folder, spark).collect()
    cells = {(c["part"], c["shard"]): bytes(c["data"]) for c in spark.read.parquet(f"{where}/shards").collect()}
    assert {(f["part"], f["shard"]) for f in files} == set(cells) and len(files) == len(cells)
    total = 0
    for f in files:
        with open(f["path"].removeprefix("file:"), "rb") as file:
            assert file.read() == cells[f["part"], f["shard"]] + b"\n"
            file.seek(0)
            total += len(token_files.ShardReader(file, dictionary).index)
    assert total == docs.count()
    (held,) = [p for p in pathlib.Path(folder, "dictionary").rglob("*.txt")]
    assert held.read_bytes() == dictionary + b"\n" and held.parent.name == "sha256=" + hashlib.sha256(dictionary).hexdigest()


def test_added_tokens_in_every_case(spark):
    """In upper, lower and mixed case, alone and beside words: such strings are added tokens only as they are spelled."""
    tokenizer = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    spelled = [f(t.content) for t in tokenizer.get_added_tokens_decoder().values() for f in (str, str.upper, str.title, str.capitalize)] + ["<|StartOfText|>", "<|ENDoftext|>", "<|endoftext|", "<|"]
    rows = [(i, t) for i, t in enumerate(x for s in spelled for x in (s, f"say {s} now", f"Say{s}NOW", f"{s}{s}", f"É{s} É", f"A{s}\nB {s.lower()} C {s.upper()}"))]
    got = token_files.encoded(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {r["doc_id"]: r["ids"] for r in got} == {i: [*tokenizer.encode(t, add_special_tokens=False).ids, 1] for i, t in rows}


def test_letters_with_marks(spark):
    """Letters A-Z before marks that only their small forms are composed with, and before other letters."""
    tokenizer = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    marks = ["\u0331", "\u0308", "\u030a", "\u030c", "\u0301", "\u1dc4\u0331", "\u20d2\u0308", "\u0483", "ê", "’", "—", "漢", "\u05b0\u0331", "\U00010a0d\u0331", "\ua66f\u030a"]
    texts = [f"x {c}{m}b {c}{m}" for m in marks for c in "ABHJTWYZhjtwy"]
    tool = token_files.WordEncoder(public_tokenizers.path("word_bpe_49k.json"))
    got = [np.frombuffer(x, np.uint16).tolist()[:-1] for t in texts for x in tool.encode([t.encode()], b"\x01\x00")]
    assert got == [e.ids for e in tokenizer.encode_batch(texts, add_special_tokens=False)]


def test_tasks_grow_with_the_bytes(spark, monkeypatch):
    monkeypatch.setattr(token_files, "TASK_BYTES", 10_000)
    where = scratch_path(spark, "token-test")
    token_files.write_shards(spark.range(3000).selectExpr("id AS doc_id", "repeat('word ', 10) AS text"), where)
    assert spark.read.parquet(f"{where}/shards").select("part").distinct().count() > 10


def test_rows_of_one_id_are_dealt_to_several_tasks(spark):
    docs = spark.createDataFrame([(None if n % 3 == 0 else n, f"text number {n}") for n in range(3000)], "doc_id long, text string")
    where = scratch_path(spark, "token-test")
    token_files.write_shards(docs, where)
    dictionary = token_files.read_dictionary(spark, where)
    cells = spark.read.parquet(f"{where}/shards").collect()
    nulls = [int(token_files.ShardReader(io.BytesIO(bytes(c["data"])), dictionary).index["null"].sum()) for c in cells]
    assert sum(nulls) == 1000 and max(nulls) < 900
    back = token_files.read_shards(where, spark).collect()
    assert len(back) == 3000 and sorted(r["start"] for r in back) == [sum(r["n_tokens"] for r in sorted(back, key=lambda r: r["start"])[:i]) for i in (0, 1)] + sorted(r["start"] for r in back)[2:]


def test_a_tokenizer_that_keeps_space_encodes_whole_texts(monkeypatch):
    from tokenizers import models, pre_tokenizers

    tokenizer = Tokenizer(models.WordLevel({"a": 0, " a": 1, "?": 2}, "?"))
    tokenizer.pre_tokenizer = pre_tokenizers.Split(" ", "merged_with_next")
    monkeypatch.setattr(Tokenizer, "from_file", staticmethod(lambda path: tokenizer))
    tool = token_files.WordEncoder("x")
    assert not tool.by_word
    assert [np.frombuffer(x, np.uint16).tolist() for x in tool.encode([b"a a", b""], b"\x05\x00")] == [[0, 1, 5], [5]]
    monkeypatch.undo()
    assert token_files.WordEncoder(public_tokenizers.path("word_bpe_49k.json")).by_word


def test_too_little_to_fit_a_dictionary_warns(spark):
    docs = spark.createDataFrame([(1, "a b")], "doc_id long, text string")
    with pytest.warns(UserWarning, match="no dictionary"):
        assert token_files.encoded(docs).count() == 1
