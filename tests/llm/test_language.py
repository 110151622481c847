"""Language ID: letters, blocks, and mixtures against a plain expectation-maximisation over all sets of languages."""

from itertools import combinations

import numpy as np
import pytest

from chunkloom.llm import language_id


def test_only_letters_of_unicode_count(spark):
    rows = [(1, "the cat and the dog", "en"), (2, "le chat et le chien", "fr"), (3, "the house of the man", "en"), (4, "½ ² 12", None), (5, "Ⅷ", None), (6, "², ③", "fr"), (7, "", None), (8, None, "en"), (9, "漢字", None), (10, "_ 7 !", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    found = {r["doc_id"]: (r["lang_pred"], r["score"]) for r in language_id.predict(docs, language_id.train(docs)).collect()}
    assert {i for i, (lang, _) in found.items() if lang == "und"} == {4, 5, 6, 7, 8, 10}
    assert all(score == 0 for lang, score in found.values() if lang == "und")
    assert found[1][0] == "en" and found[2][0] == "fr"


def slow_trigrams(text):
    clean = "".join(c if c.isalpha() else " " for c in text.lower())
    clean = f" {' '.join(clean.split())} "
    return sorted(clean[i : i + 3] for i in range(len(clean) - 2))


def test_trigrams_are_the_same_for_any_block():
    text = "Thé cat, sat on the  mat. 12 Ways! " * 3000
    whole = language_id.trigrams(text)
    for block in (1, 7, 1000, 1 << 20):
        at, n = language_id.trigrams(text if block > 7 else text[:500], block=block)
        own, counts = whole if block > 7 else language_id.trigrams(text[:500])
        assert at.tolist() == own.tolist() and n.tolist() == counts.tolist()
    assert whole[1].sum() == len(slow_trigrams(text))


def slow_infer(logs, counts, steps=4000):
    """The best set by penalised likelihood among all sets, with its shares."""
    p, best = np.exp(logs), None
    for size in range(1, len(logs) + 1):
        for own in combinations(range(len(logs)), size):
            share = np.full(size, 1 / size)
            for _ in range(steps):
                mixed = share @ p[list(own)]
                share = share * (p[list(own)] @ (counts / mixed)) / counts.sum()
            value = counts @ np.log(share @ p[list(own)]) - (size - 1) * language_id.PENALTY * np.log(counts.sum() + 1.0)
            if best is None or value > best[0]:
                best = value, dict(zip(own, share.tolist(), strict=True))
    return best[1]


def test_mixtures_against_all_sets():
    rng = np.random.default_rng(3)
    for trial in range(12):
        logs = np.log(rng.dirichlet(np.full(40, 0.3), 4) * 0.999 + 0.001 / 40)
        true = np.zeros(4)
        chosen = rng.choice(4, 1 + trial % 3, replace=False)
        true[chosen] = rng.dirichlet(np.full(len(chosen), 5.0))
        counts = rng.multinomial(3000, true @ np.exp(logs) / (true @ np.exp(logs)).sum())
        at = np.flatnonzero(counts)
        share = language_id.infer(logs, at, counts[at])
        expected = slow_infer(logs[:, at], counts[at], 400)
        assert set(np.flatnonzero(share)) == set(expected)
        assert all(share[i] == pytest.approx(s, abs=0.02) for i, s in expected.items())


def test_ties_go_to_the_first_language(spark):
    rows = [(i, "same words in both", lang) for i, lang in enumerate(["b", "a", "c"])]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    assert {r["lang_pred"] for r in language_id.predict(docs, language_id.train(docs)).collect()} == {"a"}


def test_too_many_languages_raise(spark, monkeypatch):
    monkeypatch.setattr(language_id, "MODEL_BYTES", 2 * 4 * language_id.BUCKETS)
    rows = [(i, "some words", f"l{i}") for i in range(3)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    with pytest.raises(ValueError, match="3 languages"):
        language_id.train(docs)
    assert len(language_id.train(docs, buckets=1 << 10)[0]) == 3


def test_columns_of_any_name(spark):
    rows = [(1, "some words here", "en", "k", "v", "w", "old"), (2, None, None, None, None, None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, _text string, `a``b` string, `c.d` string, score string")
    out = language_id.predict(docs, language_id.train(docs))
    assert out.columns == ["doc_id", "lang", "_text", "a`b", "c.d", "lang_pred", "score", "lang_shares"]
    first, second = sorted(out.collect())
    assert tuple(first[:6]) == (1, "en", "k", "v", "w", "en") and (second["lang_pred"], second["score"], second["lang_shares"]) == ("und", 0.0, [])
    assert language_id.identify(docs).columns == ["doc_id", "held_out", "lang_pred", "score", "lang_shares"]
    assert language_id.identify(docs.where("false")).count() == 0
