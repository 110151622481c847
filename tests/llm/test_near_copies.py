"""The pipeline's near-duplicate stage against brute-force Jaccard similarity of 5-word shingles."""

import re
from itertools import combinations

import duckdb
import numpy as np
import pytest

from chunkloom.llm import near_copies

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def slow_set(text):
    words = [w.encode().lower() for w in WORD.findall(text or "")]
    size = min(5, len(words))
    return frozenset(b" ".join(words[i : i + size]) for i in range(len(words) - size + 1)) if words else frozenset()


def slow_jaccard(a, b):
    return 1.0 if a == b else len(a & b) / len(a | b)


def slow_kept(rows):
    """Places of the rows that stay: of each component the one with the smallest id (null last), then place."""
    sets = [slow_set(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, j in combinations(range(len(rows)), 2):
        if min(map(len, (sets[i], sets[j]))) >= 0.8 * max(map(len, (sets[i], sets[j]))) and slow_jaccard(sets[i], sets[j]) >= 0.8:
            root[find(j)] = find(i)
    groups = {}
    for i, (doc_id, _) in enumerate(rows):
        groups.setdefault(find(i), []).append((doc_id is None, doc_id or 0, i))
    return sorted(min(g)[2] for g in groups.values())


@pytest.mark.parametrize("folder", ["sf0.001", "sf0.01"])
def test_provided_documents(spark, folder):
    path = f"/root/testdata/{folder}/documents.parquet"
    rows = [(i, t) for i, t in duckdb.sql(f"select doc_id, text from '{path}'").fetchall()]
    kept = near_copies.keep_one(spark.read.parquet(path)).collect()
    assert sorted(r["doc_id"] for r in kept) == sorted(rows[i][0] for i in slow_kept(rows))


def test_edited_copies_are_found(spark):
    """Copies with a few words changed, at similarities from about 0.6 to 1, among them copies of copies."""
    rng = np.random.default_rng(7)
    rows = []
    for base in range(12):
        words = [f"w{x}" for x in rng.integers(0, 5000, 150)]
        for _ in range(12):
            words = list(words) if rng.random() < 0.5 else list(rows[-1][1].split()) if rows and len(rows) % 12 else words
            for at in rng.choice(150, rng.integers(1, 8), replace=False):
                words[at] = f"x{rng.integers(0, 10**6)}"
            rows.append((len(rows), " ".join(words)))
    expected = slow_kept(rows)
    assert 12 < len(expected) < len(rows)
    kept = near_copies.keep_one(spark.createDataFrame(rows, "doc_id long, text string").repartition(5)).collect()
    assert sorted(r["doc_id"] for r in kept) == expected


def test_rows_that_share_an_id_stay_or_go_by_their_texts(spark):
    def text(n):
        return " ".join(f"t{n}w{i}" for i in range(60))

    copy = text(1).replace("t1w59", "other")
    # null ids with texts of their own, one a near copy of a row with an id; two unrelated texts under one id; a repeated row
    rows = [(1, text(1)), (None, copy), (None, text(2)), (None, text(3)), (7, text(4)), (7, text(5)), (7, text(5)), (None, None), (8, None), (2, copy)]
    kept = near_copies.keep_one(spark.createDataFrame(rows, "doc_id long, text string").repartition(4)).collect()
    assert sorted(map(tuple, kept), key=str) == sorted((rows[i] for i in slow_kept(rows)), key=str)
    assert len(kept) == 6 and near_copies.keep_one(spark.createDataFrame(rows, "doc_id long, text string").where("false")).count() == 0


def group_of_edited_copies(texts=60, words=120, edits=12):
    """Copies of one text, each with some words of its own and some that it shares with a few others: most are apart, some alike."""
    rng = np.random.default_rng(3)
    base = [f"w{i}" for i in range(words)]
    families = [{int(at): f"f{f}x{at}" for at in rng.choice(words, edits, replace=False)} for f in range(12)]
    rows = []
    for i in range(texts):
        own = list(base)
        for at, word in families[i % 12].items():
            own[at] = word
        own[int(rng.integers(0, words))] = f"o{i}"
        rows.append((i, " ".join(own)))
    return rows


def test_golay_keys_find_copies_without_the_bands(spark, monkeypatch):
    """The stage's named keys find near copies of few differing bits by themselves."""
    rng = np.random.default_rng(5)
    rows = []
    for base in range(4):
        words = [f"w{x}" for x in rng.integers(0, 10**6, 400)]
        rows += [(2 * base, " ".join(words)), (2 * base + 1, " ".join([*words, "more"]))]
    prints = [near_copies.fingerprint(near_copies.shingles(t.encode())) for _, t in rows]
    assert all((prints[i] ^ prints[i + 1]).bit_count() <= 4 for i in range(0, 8, 2))
    monkeypatch.setattr(near_copies, "bands", lambda own: np.zeros(0, np.int64))
    kept = near_copies.keep_one(spark.createDataFrame(rows, "doc_id long, text string").repartition(3)).collect()
    assert sorted(r["doc_id"] for r in kept) == [0, 2, 4, 6]


def test_shingles_of_a_text_are_listed_once_for_a_pivot(spark, monkeypatch):
    """In a large group of copies that are apart, work at the end does not grow with the keys in which two texts meet."""
    rows, listed = group_of_edited_copies(), []
    plain = near_copies.materialize

    def seen(df, label):
        made = plain(df, label)
        if label == "near-held":
            listed.extend(made.selectExpr("node", "pivot", "n", "size(other) lists").collect())
        return made

    monkeypatch.setattr(near_copies, "materialize", seen)
    kept = near_copies.keep_one(spark.createDataFrame(rows, "doc_id long, text string").repartition(3)).collect()
    assert sorted(r["doc_id"] for r in kept) == slow_kept(rows) and 1 < len(kept) < len(rows)
    assert listed and len({(r["node"], r["pivot"]) for r in listed}) == len(listed)
    assert all(r["lists"] <= r["n"] // 5 + 1 for r in listed if r["node"] != r["pivot"])
