"""Queries by a tokenizer file, against the library and a plain loop."""

import duckdb
import public_tokenizers
from tokenizers import Tokenizer

from chunkloom.config import Config
from chunkloom.operators.overlap import Packer, tokenizer_counts
from chunkloom.plans.queries import QUERIES

FOLDER = "/root/testdata/sf0.001"


def texts():
    return duckdb.sql(f"select doc_id, text from '{FOLDER}/documents.parquet'").fetchall()


def test_counts(spark):
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    want = sorted((i, len(tokenizer.encode(t, add_special_tokens=False).ids)) for i, t in texts())
    assert sorted(map(tuple, QUERIES["tokenizer_token_counts"](spark, FOLDER).collect())) == want
    odd = spark.createDataFrame([(None, 1, "x"), ("", 2, "y"), ("a b", 3, "z")], "text string, n_tokens int, `a``b` string")
    out = tokenizer_counts(odd, public_tokenizers.path("byte_bpe_50k.json"))
    assert out.columns == ["text", "a`b", "n_tokens"] and sorted((r[1], r[2]) for r in out.collect()) == [("x", 0), ("y", 0), ("z", 2)]


def test_chunks(spark):
    path = public_tokenizers.path("byte_bpe_50k.json")
    tokenizer, packer = Tokenizer.from_file(path), Packer(Config(strategy="tokenizer", tokenizer_path=path, chunk_size=256, chunk_overlap=32))
    packer.count = lambda text: len(tokenizer.encode(text, add_special_tokens=False).ids)  # each text anew
    want = {}
    for doc_id, text in texts()[:60]:
        pieces = [{"block_type": "p", "text": line, "xpath": "", "css_selector": None, "html_id": None} for line in text.split("\n") if line.strip()]
        for no, chunk in enumerate(packer(pieces, "")):
            want[str(doc_id), no] = (" ".join(f["text"] for f in chunk["f"]), " ".join(f["text"] for f in chunk["prev"]))
    ids = {k[0] for k in want}
    rows = [r for r in QUERIES["tokenizer_chunks"](spark, FOLDER).collect() if r["page_id"] in ids]
    assert {(r["page_id"], r["chunk_no"]): (r["normalized_text"], r["overlap_prev_text"]) for r in rows} == want
    assert max(packer.count(r["normalized_text"]) for r in rows) <= 256


def test_a_strategy_of_ones_own(spark):
    from chunkloom import config as settings
    from chunkloom.operators import overlap
    from chunkloom.operators.chunks import chunk_pages
    from chunkloom.sources.tables import text_pages

    overlap.register_strategy("letters", lambda config: len)
    try:
        docs = spark.createDataFrame([(1, "One two three. Four five six. Seven eight.", "s")], "doc_id long, text string, source string")
        config = Config(strategy="letters", chunk_size=20).validate()
        texts = [r["normalized_text"] for r in chunk_pages(text_pages(docs), config).orderBy("chunk_no").collect()]
        assert texts == ["One two three.", "Four five six.", "Seven eight."]
    finally:
        overlap.STRATEGIES.pop("letters")
        settings.STRATEGIES.discard("letters")
    try:
        config.validate()
        raise AssertionError("an unknown strategy passed")
    except ValueError as wrong:
        assert "strategy must be one of simple, tokenizer" in str(wrong)


def test_counting_asks_for_no_offsets(monkeypatch):
    """The library's fast way has ids alone; the other took about as long again."""
    from chunkloom.operators import overlap

    class Fast:
        @staticmethod
        def from_file(path):
            return Fast()

        def encode_batch_fast(self, texts, add_special_tokens):
            return [t.split() for t in texts]

    monkeypatch.setattr("tokenizers.Tokenizer", Fast)
    assert overlap.tokenizer_count("another file")("a b c") == 3
    overlap.tokenizer_count.cache_clear()
