"""op2's counts without sorting, and op7's words put together from their parts."""

import numpy as np
import public_tokenizers
import pytest

from chunkloom.llm import lm_scoring as lm
from chunkloom.llm import token_files


def test_first_round_counts_without_sorting(monkeypatch):
    rng = np.random.default_rng(1)
    model = lm.Model([b"a"], np.array([1]), 10, 1, 1 + rng.random(lm.WIDTH**2), rows=64)
    leaf = rng.integers(0, lm.WIDTH**2, 500)
    hashed = lm.features(rng.integers(0, 40, 500), np.array([0, 200]))
    seen, expected = np.zeros((64, lm.WIDTH), np.float32), np.zeros((64, lm.WIDTH))
    slow_seen, slow_expected = np.zeros_like(seen), np.zeros_like(expected)
    for level, node, digit, rows in lm.steps(model, leaf, hashed):
        for at in rows:
            for r, n, d in zip(at, node, digit, strict=True):
                slow_seen[r, d] += 1
                slow_expected[r] += np.exp(model.bias[level][n])

    def refused(*args, **kind):
        raise AssertionError("sorted")

    monkeypatch.setattr(lm.np, "argsort", refused)
    lm.gather(model, leaf, hashed, seen, expected)
    assert (seen == slow_seen).all() and np.allclose(expected, slow_expected, rtol=1e-6)


def test_words_that_marks_end_are_learned_by_their_parts():
    tool, asked = token_files.WordEncoder(public_tokenizers.path(token_files.TOKENIZER)), []
    library = tool.tokenizer
    odd = "bird, bird. bird!! bird bird's bird' a<|endoftext|> a<|endoftext|>, <|ENDOFTEXT|> É, é. x≮ x̸, İa. a—, 1, a1. ,a ... Bird- ß:"
    words = [w.encode() for w in odd.split()]

    class Asked:
        model = library.model

        def encode_batch_fast(self, texts, **kind):
            asked.extend(texts)
            return library.encode_batch_fast(texts, **kind)

    tool.tokenizer = Asked()
    tool.learn(words)
    for w in words:
        assert np.frombuffer(tool.known[w], np.uint16).tolist() == library.encode(w.decode(), add_special_tokens=False).ids
    assert not {"bird", "bird,", "bird.", "bird!!"} & set(asked)
