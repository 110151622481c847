"""The language model against a word-by-word version of itself, as a distribution, and on held-out texts."""

import math
from collections import Counter, defaultdict

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from chunkloom.llm import lm_scoring as L

ALL = (1 << 64) - 1
FOLDER = "/root/testdata/sf0.01"


def tokens(text):
    return [*(text or "").encode().lower().split(), b""]


def hashed(word):
    return xxhash.xxh64_intdigest(word, 42)


def path(word):
    """Two digits: five bits of the hash of the word's last two bytes, and the first five of its own hash."""
    return (hashed(word[-2:]) >> 54) % 32, hashed(word) >> 59


def mix(a, b, salt):
    h = ((a + 2) * 0x9E3779B97F4A7C15 + (b + 2 + salt) * 0xC2B2AE3D27D4EB4F) & ALL
    h ^= h >> 31
    return ((h * 0x94D049BB133111EB) & ALL) >> 32


class Slow:
    """The same model, token by token, with dictionaries."""

    def __init__(self, texts, own_contexts, rows):
        self.rows, self.counts = rows, Counter(w for t in texts for w in tokens(t))
        order = sorted(self.counts, key=lambda w: (-self.counts[w], w))
        self.own = {w: 1 + 1024 + i for i, w in enumerate(order[:own_contexts])}
        self.mass = defaultdict(lambda: 1.0)
        for w, c in self.counts.items():
            self.mass[path(w)] += c + 1
        self.first = [sum(self.mass[i, j] for j in range(32)) for i in range(32)]
        self.weights = defaultdict(float)

    def context(self, word):
        return self.own.get(word, 1 + (hashed(word[-2:]) >> 54))

    def places(self, before, skip, level, node):
        for h in (mix(before, 0, 1), mix(before, skip, 2), mix(skip, 0, 3)):
            yield mix(h, node, 5 + level) % self.rows

    def softmax(self, places, level, node):
        shares = self.first if level == 0 else [self.mass[node, j] for j in range(32)]
        z = [s / sum(shares) * math.exp(sum(self.weights[p, k] for p in places)) for k, s in enumerate(shares)]
        return [x / sum(z) for x in z]

    def walk(self, text):
        before = skip = 0
        for w in tokens(text):
            a, b = path(w)
            yield w, [(level, node, digit, list(self.places(before, skip, level, node))) for level, node, digit in ((0, 0, a), (1, a, b))]
            before, skip = self.context(w), before

    def learn(self, texts):
        seen, expected, met = defaultdict(float), defaultdict(float), Counter()
        for t in texts:
            for _, steps in self.walk(t):
                for level, node, digit, places in steps:
                    p = self.softmax(places, level, node)
                    for at in places:
                        met[at] += 1
                        seen[at, digit] += 1
                        for k in range(32):
                            expected[at, k] += p[k]
        for (at, k), e in expected.items():
            self.weights[at, k] += 0.5 * math.log((met[at] * seen[at, k] / e + 50) / (met[at] + 50))

    def score(self, text):
        return sum(sum(math.log10(self.softmax(places, level, node)[digit]) for level, node, digit, places in steps) + math.log10((self.counts[w] + 1) / self.mass[path(w)]) for w, steps in self.walk(text))


def test_against_a_slow_version(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").where(F.length("text") < 300).select("doc_id", "text")
    rows = [(r["doc_id"], r["text"]) for r in docs.limit(60).collect()]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r["doc_id"]: r for r in L.score(docs, shares=(1,), head_words=100, rows=256).collect()}
    training = [t for i, t in rows if not got[i]["held_out"]]
    slow = Slow(training, 8, 256)
    slow.learn(training)
    for i, t in rows:
        assert got[i]["score"] == pytest.approx(slow.score(t), rel=1e-4)


def test_probabilities_sum_to_one(spark):
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(["a b c a b d", "b c a, zz yy", "le la les la a", "c c c b a zz"])], "doc_id long, text string")
    counts = L.token_counts(docs).persist()
    model, _ = L.train(docs, counts, shares=(1, 1), rows=64)
    code = L.Coder(model)
    words = {r["token"].encode(): r["c"] for r in counts.collect()}
    for before in ([], [b"a"], [b"b", b"c"], [b"never", b"la"]):
        total = 0.0
        known = [np.array([*(code.words[w] for w in before), code.words[w]], np.int64) for w in words]
        for (w, c), ids in zip(words.items(), known, strict=True):
            leaf, context = code(ids)
            total += (c + 1) * 10 ** L.log10_probabilities(model, leaf, L.features(context, np.array([0])))[-1]
        # each last class has one unit of mass for unseen words
        leaf, context = code(np.array([*(code.words[w] for w in before), 0], np.int64))
        h = L.features(np.repeat(context[None], 1024, axis=0).ravel(), np.arange(0, 1024 * len(context), len(context)))
        leaves = np.repeat(leaf[None], 1024, axis=0)
        leaves[:, -1] = np.arange(1024)
        unseen = L.log10_probabilities(model, leaves.ravel(), h).reshape(1024, -1)[:, -1]
        assert total + (10**unseen).sum() == pytest.approx(1, abs=1e-5)


def test_scores_do_not_depend_on_partitions_and_beat_the_unigram_model(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "text")
    one, eight = (L.score(docs.repartition(n)).toPandas().sort_values("doc_id").reset_index(drop=True) for n in (1, 8))
    assert np.allclose(one["score"], eight["score"], rtol=1e-6, atol=0)
    held = one[one["held_out"]]
    assert held["score"].sum() > 0.95 * held["base_score"].sum()  # logarithms: five per cent less


def test_paths_in_sql_and_python_agree(spark):
    words = [b"", b"a", "é".encode(), b"tion", b"the", "çà".encode()]
    table = spark.createDataFrame([(w.decode(),) for w in words], "token string")
    for levels in (2, 3, 4):
        model = L.Model(words[:2], np.array([1, 1]), 2, 2, np.ones(32**levels), levels)
        code = L.Coder(model)
        leaf, _ = code(np.array([code.words[w] for w in words]))
        assert [r[0] for r in table.select(L.leaf_column(F.col("token"), levels)).collect()] == leaf.tolist()
    assert [L.levels_for(v) for v in (0, 10**6, 9 * 10**6, 10**9)] == [2, 2, 3, 4]
