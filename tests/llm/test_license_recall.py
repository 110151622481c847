"""License scan: recall on altered notices and precision, against shingles that are counted here."""

import re

import numpy as np
import pytest

from chunkloom.llm import license_scan, license_texts

LONG = ("Apache-2.0", "MIT", "MIT (full)", "BSD-3-Clause", "ISC", "zlib", "GPL", "Unlicense")
INDEX = license_scan.Index(license_texts.TEMPLATES)


def words(text):
    return re.findall(r"[0-9a-z\u0080-\U0010ffff]+", text.lower())


def shingles(own):
    return {tuple(own[i : i + 5]) for i in range(len(own) - 4)}


def noise(rng, n):
    return [f"w{x}" for x in rng.integers(0, 3000, n)]


def altered(rng, own, kind):
    """A copy that is changed as much as leaves 80 % of the shingles, about."""
    own = list(own)
    if kind == "inserted":
        at = int(rng.integers(len(own) // 4, 3 * len(own) // 4))
        return own[:at] + noise(rng, int(rng.uniform(0.2, 0.9) * len(own))) + own[at:]
    for at in sorted(rng.choice(len(own), max(1, len(own) // 60), replace=False).tolist(), reverse=True):
        own[at : at + 1] = [] if kind == "dropped" else ["other"]
    return own


@pytest.mark.parametrize("kind", ["inserted", "dropped", "changed"])
def test_recall_of_altered_notices(kind):
    rng = np.random.default_rng(8)
    caught = wanted = 0
    for name in LONG:
        own = words(license_texts.TEMPLATES[name])
        template = shingles(own)
        for _ in range(40):
            copy = altered(rng, own, kind)
            if len(shingles(copy) & template) < 0.8 * len(template):
                continue
            before = noise(rng, int(rng.integers(0, 400)))
            found = {f[0]: f for f in INDEX.scan(" ".join(before + copy + noise(rng, 200)).encode())}
            wanted += 1
            if name in found:
                caught += 1
                _, a, b, share = found[name]
                assert len(before) - 1 <= a and b <= len(before) + len(copy) + 1
                assert 0.8 <= share <= len(shingles(copy) & template) / len(template) + 1e-9  # of the window that was verified
    assert wanted > 200 and caught >= 0.99 * wanted


def test_clean_and_half_copied_texts_give_nothing():
    rng = np.random.default_rng(4)
    for name in LONG:
        own = words(license_texts.TEMPLATES[name])
        half = own[: len(own) * 6 // 10]
        assert name not in {f[0] for f in INDEX.scan(" ".join(noise(rng, 300) + half + noise(rng, 300)).encode())}
    assert INDEX.scan(" ".join(noise(rng, 200_000)).encode()) == [] == INDEX.scan(None) == INDEX.scan(b"")


def test_two_copies_are_two_passages_also_across_a_block(monkeypatch):
    monkeypatch.setattr(license_scan, "BLOCK", 500)
    rng = np.random.default_rng(2)
    own = words(license_texts.TEMPLATES["ISC"])
    text = noise(rng, 450) + own + noise(rng, 300) + own + noise(rng, 300)
    found = [f[1:3] for f in INDEX.scan(" ".join(text).encode()) if f[0] == "ISC"]
    assert found == [(450, 450 + len(own)), (750 + len(own), 750 + 2 * len(own))]


def test_templates_from_a_table(spark):
    table = spark.createDataFrame([("mine", "one two three four five six seven eight")], "name string, text string")
    docs = spark.createDataFrame([(1, "x one two three four five six seven eight y"), (1, "x one two three four five six seven eight y"), (None, "one two three four five six seven eight"), (2, None)], "doc_id long, text string")
    assert sorted((str(r["doc_id"]), r["license"], r["first_word"]) for r in license_scan.scan(docs, table).collect()) == [("1", "mine", 1), ("1", "mine", 1), ("None", "mine", 0)]
