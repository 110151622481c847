"""BPE against the tokenizers library, on whole tables, odd rows and made-up texts."""

import hashlib
import json
import random

import duckdb
import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from chunkloom.llm import bpe
from chunkloom.llm.queries import op11_bpe

PATH = public_tokenizers.path("byte_bpe_50k.json")
ODD = ["", None, " ", "\n", "a", "<|endoftext|>", "x<|endoftext|> y<|endoftext|>", "<|ENDOFTEXT|>", "<|endoftext|", "a  b", "a   b  ", "\n\xa0", "a\n\n\t b\r\n", "don't we'll 'sa '", "été 漢字　\U0001f600", "a" * 30_000, "ab" * 20_000 + " end", "\x00\x1c\x85", "word " * 50_000]


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


@pytest.fixture(scope="module")
def tool():
    return bpe.Encoder(PATH)


def ids(tool, texts):
    return [np.frombuffer(x, np.int32).tolist() for x in tool.encode(texts)]


def test_made_up_texts(tool, library):
    """Blanks, line ends, contractions, added tokens, letters that are new to Unicode, in every order; and random ids back."""
    rng = random.Random(7)
    parts = [*"ab  \n\n\t\r'sde1 2.é漢  　\xa0՘\x1c\x85😀'̀", "<|endoftext|>", "<|", "'ll", "aaaaaaa", "0000000", "the", " The"]
    texts = ["".join(rng.choices(parts, k=rng.randint(0, 14))) for _ in range(6000)]
    for start in range(0, len(texts), 500):
        assert ids(tool, texts[start : start + 500]) == [e.ids for e in library.encode_batch(texts[start : start + 500], add_special_tokens=False)]
    for _ in range(2000):
        some = [rng.randrange(bpe.encoder(PATH).vocabulary.size + 40) for _ in range(rng.randint(0, 7))]
        assert tool.vocabulary.decode(some) == library.decode(some, skip_special_tokens=False)


def test_every_character_after_a_letter(tool, library):
    texts = [f"a{chr(c)} {chr(c)}b" for c in range(0x110000) if not 0xD800 <= c < 0xE000][::37]
    assert ids(tool, texts) == [e.ids for e in library.encode_batch(texts, add_special_tokens=False)]


def test_query_against_the_library(spark, library):
    folder = "/root/testdata/sf0.001"
    want = []
    for doc_id, text in duckdb.sql(f"select doc_id, text from '{folder}/documents.parquet'").fetchall():
        e = library.encode(text, add_special_tokens=False).ids
        back = library.decode(e, skip_special_tokens=False)
        want.append((doc_id, len(e), hashlib.sha256(",".join(map(str, e)).encode()).hexdigest(), hashlib.sha256(back.encode()).hexdigest()))
    assert sorted(map(tuple, op11_bpe(spark, folder).collect())) == sorted(want)


def test_odd_rows(spark, library):
    rows = [(i if i % 5 else None, t, [1], "x") for i, t in enumerate(ODD * 2)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, ids array<int>, decoded string").repartition(3)
    made = bpe.decode(bpe.encode(docs))
    want = [(r[0], library.encode(r[1] or "", add_special_tokens=False).ids, r[1] or "") for r in rows]
    key = lambda r: (r[0] is None, r[0] or 0, r[2])
    assert sorted(map(tuple, made.collect()), key=key) == sorted(want, key=key)
    assert bpe.decode(bpe.encode(docs.where(F.lit(False)))).count() == 0


def test_decoding_keeps_other_columns(spark):
    rows = spark.createDataFrame([([257, None, -1, 60_000, 257], "k", "old"), (None, "n", "old")], "ids array<int>, `a``b` string, decoded string")
    assert [tuple(r) for r in bpe.decode(rows).collect()] == [([257, None, -1, 60_000, 257], "k", bpe.encoder(PATH).vocabulary.bytes[257].decode() * 2), (None, "n", None)]


def test_blocks_and_caches_make_no_difference(tool, monkeypatch):
    texts = ["one two three\nfour  five", "two three", "", "three " * 50]
    want = ids(tool, texts)
    monkeypatch.setattr(bpe, "CACHE_BYTES", 0)
    assert [x for t in texts for x in ids(tool, [t])] == want and ids(tool, texts) == want
    assert [(s.start, s.stop) for s in bpe._blocks([bpe.BLOCK_TEXT, 1, bpe.BLOCK_TEXT, 2])] == [(0, 1), (1, 3), (3, 4)]


def naive(word, v):
    """Merge the first of a word's lowest pairs, again and again."""
    s = [int(v.of_byte[b]) for b in word]
    while found := [(v.ranks[k], i) for i, k in enumerate(a * v.size + b for a, b in zip(s, s[1:], strict=False)) if k in v.ranks]:
        rank, at = min(found)
        s[at : at + 2] = [v.merges[rank][2]]
    return s


@pytest.mark.parametrize("many", [1, 10**9])
def test_the_index_against_one_word_at_a_time(tool, monkeypatch, many):
    monkeypatch.setattr(bpe, "MANY", many)
    rng = random.Random(3)
    words = [bytes(rng.choices(b"aaabet nors\xc3\xa9", k=rng.randint(1, 25))) for _ in range(3000)]
    assert [np.frombuffer(x, np.int32).tolist() for x in tool.vocabulary.encode_words(words)] == [naive(w, tool.vocabulary) for w in words]


@pytest.mark.parametrize("change", [{"normalizer": {"type": "NFC"}}, {"pre_tokenizer": None}, {"model": {"dropout": 0.1}}, {"model": {"merges": "swapped"}}])
def test_other_tokenizers_are_refused(tmp_path, change):
    with open(PATH) as file:
        about = json.load(file)
    for k, v in change.items():
        if k == "model":
            merges = about["model"]["merges"]
            about["model"] |= {"merges": merges[::-1]} if "merges" in v else v
        else:
            about[k] = v
    (tmp_path / "t.json").write_text(json.dumps(about))
    with pytest.raises(ValueError):
        bpe.Vocabulary(str(tmp_path / "t.json"))
