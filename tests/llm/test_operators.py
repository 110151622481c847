"""Operators against brute force on small tables, with nulls, empty and long texts, repeats and clashing columns."""

import hashlib
import io
import math
import re
import zlib
from collections import Counter

import duckdb
import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from chunkloom.llm import exact_dedup, language_id, license_scan, lm_scoring, mixing, packing, quality_rules, simhash, token_files, url_filters
from chunkloom.llm import queries as Q

FOLDER = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")
LONG = "alpha beta gamma delta " * 60_000
KIND = "doc_id long, text string, lang string, source string, n_chars long, id string, row string, kept string, n_words string, key string, copy_no string, bucket string"


def table(spark, rows):
    return spark.createDataFrame([(i, t, lang, s, None, *["x"] * 7) for i, t, lang, s in rows], KIND)


@pytest.fixture(scope="module")
def odd(spark):
    """Nulls in every column, empty and long texts, ties and repeated rows, and columns that operators might name."""
    same = "The cat sat on the mat and the dog slept by the door of the house. " * 5
    rows = [(1, same, "en", "a"), (1, same, "en", "a"), (2, same + " ", "en", "b"), (3, None, None, None), (None, "", "en", "a"), (4, " \n\t", "fr", "b"), (5, LONG, "de", "a"), (1, "other text", "en", "a"), (None, None, None, None), (6, same, "en", "a")]
    return table(spark, rows)


@pytest.fixture(scope="module")
def none(spark):
    return table(spark, [(1, "x", "en", "a")]).where(F.lit(False))


@pytest.fixture(scope="module")
def real(spark):
    """(doc_id, text) of a provided table."""
    return dict(duckdb.sql(f"select doc_id, text from '{FOLDER}/documents.parquet'").fetchall())


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


@pytest.mark.parametrize("name", sorted(Q.ORACLES))
def test_oracles(spark, name):
    con = duckdb.connect()
    for t in ("documents", "pages"):
        con.execute(f"create view {t} as select * from '{FOLDER}/{t}.parquet'")
    said = con.execute(Q.ORACLES[name])
    columns = sorted(d[0] for d in said.description)
    order = [[d[0] for d in said.description].index(c) for c in columns]
    expected = sorted(tuple(str(r[i]) for i in order) for r in said.fetchall())
    got = sorted(tuple(map(str, r)) for r in Q.QUERIES[name](spark, FOLDER).select(*columns).collect())
    assert got == expected


def test_quality_on_odd_rows(spark, odd, none):
    rows = quality_rules.judge(odd).collect()
    assert len(rows) == 10 and all(r["base_failed"] and not r["kept"] for r in rows)
    assert {r["n_words"] for r in rows if r["text"] is None} == {0}
    long = next(r for r in rows if r["doc_id"] == 5)
    assert (long["n_words"], long["n_repeat_words"]) == (240_000, 240_000)
    assert quality_rules.keep_good(none).columns == none.columns and quality_rules.keep_good(none).count() == 0


def test_lm_scores(spark, real, odd, none):
    rows = {r["doc_id"]: r for r in Q.op2_lm_scoring(spark, FOLDER).collect()}
    tokens = {i: [*WORD.findall(lower(t)), ""] for i, t in real.items()}
    held = {i for i in real if zlib.crc32(str(i).encode()) % 7 == 2}
    counts = Counter(w for i in real if i not in held for w in tokens[i])
    total, distinct = sum(counts.values()), len(counts)
    for i, words in tokens.items():
        r = rows[i]
        assert (r["held_out"], r["n_tokens"], r["train_tokens"]) == (i in held, len(words), total)
        assert r["n_known"] == sum(counts[w] > 0 for w in words)
        assert math.isclose(r["base_score"], sum(math.log10((counts[w] + 1) / (total + distinct + 1)) for w in words), rel_tol=1e-9)
    ours, base = (sum(rows[i][c] for i in held) for c in ("score", "base_score"))
    assert ours > base  # better than a unigram model on texts it has not seen
    assert lm_scoring.score(odd).count() == 10 and lm_scoring.score(none).count() == 0
    with_few = lm_scoring.score(odd, head_words=2).select("doc_id", "n_tokens", "n_known", F.round("base_score", 6).alias("b"))
    assert sorted(map(str, with_few.collect())) == sorted(map(str, lm_scoring.score(odd).select("doc_id", "n_tokens", "n_known", F.round("base_score", 6).alias("b")).collect()))


def test_language(spark, odd, none):
    known = dict(duckdb.sql(f"select doc_id, lang from '{FOLDER}/documents.parquet'").fetchall())
    rows = [r for r in Q.op3_language_id(spark, FOLDER).collect() if r["held_out"]]
    assert sum(known[r["doc_id"]] == r["lang_pred"] for r in rows) >= 0.95 * len(rows)
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1) and 0 <= r["score"] <= 1 for r in rows)
    found = language_id.identify(odd).collect()
    assert len(found) == 10 and all(r["lang_pred"] == "und" for r in found if r["doc_id"] in (3, 4))
    assert language_id.identify(none).count() == 0
    # a text in two languages has both, in their proportions
    logs = np.log(np.array([[0.7, 0.1, 0.1, 0.1], [0.1, 0.1, 0.1, 0.7], [0.1, 0.7, 0.1, 0.1]]))
    share = language_id.infer(logs, np.arange(4), np.array([700, 160, 160, 340]))
    assert share[0] > share[1] > 0 and share.sum() == pytest.approx(1)


def test_cascade_is_exact(spark):
    rows = spark.createDataFrame([(i, f"http://h{i % 3000}.com/x") for i in range(6000)] + [(-1, None), (-2, "no scheme")], "page_id long, url string")
    listed = spark.createDataFrame([(f"h{i}.com",) for i in range(0, 3000, 7)] + [(None,), ("absent.com",), ("h7.com",)], "key string")
    found = url_filters.judge_urls(rows, listed, rules=()).collect()
    for r in found:
        inside = r["page_id"] >= 0 and (r["page_id"] % 3000) % 7 == 0
        assert r["listed"] == inside and r["verdict"] == ("block" if inside else "allow")
    host, path = url_filters.host_and_path(F.col("url"))
    parts = url_filters.with_listed(rows.withColumns({"host": host, "path": path}), url_filters.page_keys(F.col("host"), F.col("path")), listed, part_bytes=64)
    assert parts.where("listed").count() == sum(r["listed"] for r in found)
    assert url_filters.judge_urls(rows.where("page_id > 10000"), listed).count() == 0
    assert url_filters.judge_urls(rows, listed.where("key is null")).where("listed").count() == 0


def slow_print(text):
    words = WORD.findall(lower(text))
    if not words:
        return 0
    hashes = [xxhash.xxh64_intdigest(" ".join(words[i : i + 4]).encode(), 42) for i in range(max(1, len(words) - 3))]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def slow_components(prints):
    """Smallest id of each component, from all pairs."""
    root = {i: i for i in prints}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    order = sorted(prints)
    for n, i in enumerate(order):
        for j in order[n + 1 :]:
            if (prints[i] ^ prints[j]).bit_count() <= 4:
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    return {i: find(i) for i in prints}


def test_simhash(spark, real, odd, none):
    prints = {i: slow_print(t) for i, t in real.items()}
    roots = slow_components(prints)
    rows = Q.op5_simhash(spark, FOLDER).collect()
    assert {r["doc_id"]: (r["fingerprint"], r["component_id"]) for r in rows} == {i: (f"{prints[i]:016x}", roots[i]) for i in real}
    assert simhash.near_components(odd).count() == 10 and simhash.near_components(none).count() == 0
    kept = simhash.keep_one(odd)
    assert kept.columns == odd.columns and sorted(r["doc_id"] for r in kept.collect()) == [1, 1, 3, 5]  # two texts under the id 1


def test_golay_keys_find_all_near_prints():
    rng = np.random.default_rng(5)
    a = rng.integers(0, 2**63, 3000, np.uint64)
    b = a.copy()
    for i in range(len(b)):
        for bit in rng.choice(64, i % 5, replace=False):
            b[i] ^= np.uint64(1) << np.uint64(bit)
    rows, keys = simhash.golay_keys(np.concatenate([a, b]))
    held = [set() for _ in range(6000)]
    for r, k in zip(rows.tolist(), keys.tolist(), strict=True):
        held[r].add(k)
    assert all(held[i] & held[i + 3000] for i in range(3000))


def test_chained_components(spark):
    # a chain of prints, each four bits from the next, and copies of one print: links must not be lost in crowded keys
    chain = [sum(1 << b for b in range(4 * n)) for n in range(17)]
    prints = {n: p for n, p in enumerate(chain)} | {100 + n: (1 << 63) | (n << 20) for n in range(40)}
    signed = [(i, p - (1 << 64) if p >> 63 else p) for i, p in prints.items()]
    rows = dict(map(tuple, simhash.linked(spark.createDataFrame(signed, "doc_id long, fp long")).collect()))
    roots = slow_components(prints)
    groups = {}
    for i, p in signed:
        groups.setdefault(roots[i], set()).add(rows.get(p, p))
    assert all(len(g) == 1 for g in groups.values()) and len(set().union(*groups.values())) == len(groups)


def test_license_scan(spark, odd, none):
    rng = np.random.default_rng(1)
    noise = lambda n: [f"w{x}" for x in rng.integers(0, 500, n)]
    mit = license_scan.TEMPLATES["MIT"].split()
    near = [w for n, w in enumerate(mit) if n != 40]  # one word lost
    half = mit[: len(mit) // 2]
    docs = table(spark, [(1, " ".join(noise(300) + mit + noise(200)), "en", "a"), (2, " ".join(noise(90_000) + near), "en", "a"), (3, " ".join(noise(50) + half + noise(50)), "en", "a"), (4, " ".join(noise(400)), "en", "a")])
    rows = license_scan.scan(docs).collect()
    assert sorted((r["doc_id"], r["license"]) for r in rows) == [(1, "MIT"), (2, "MIT")]
    assert next(r for r in rows if r["doc_id"] == 1)["containment"] == 1.0
    assert license_scan.scan(odd).count() == 0 == license_scan.scan(none).count()


def test_license_scan_against_brute_force(spark, real):
    rows = {(r["doc_id"], r["license"]) for r in Q.op6_license_scan(spark, FOLDER).collect()}
    expected = set()
    for name, text in license_scan.TEMPLATES.items():
        own = set(license_scan._shingles(license_scan.words_of(text.encode()), 5).tolist())
        for i, t in real.items():
            h = license_scan._shingles(license_scan.words_of((t or "").encode()), 5).tolist()
            width = len(own) * 2
            if any(len(own & set(h[a : a + width])) >= 0.8 * len(own) for a in range(0, max(1, len(h) - len(own)) + 1, max(1, len(own) // 8))):
                expected.add((i, name))
    assert rows == expected


def test_token_files(spark, real, odd, none):
    import public_tokenizers
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    rows = {r["doc_id"]: r for r in Q.op7_token_files(spark, FOLDER).collect()}
    start = 0
    for i in sorted(real):
        ids = [*tokenizer.encode(real[i] or "", add_special_tokens=False).ids, 1]
        crc = zlib.crc32(np.array(ids, "<u4").tobytes())
        assert (rows[i]["start"], rows[i]["n_tokens"], rows[i]["ids_crc32"]) == (start, len(ids), crc)
        start += len(ids)
    back = token_files.encoded(odd).collect()
    assert len(back) == 10 and [r["ids"] for r in back if r["doc_id"] == 3] == [[1]]
    assert token_files.encoded(none).count() == 0
    with pytest.raises(ValueError):
        token_files.ShardReader(io.BytesIO(token_files.pack_shard([], hashlib.sha256(b"a").digest())), b"b")


def test_mixing(spark, odd, none):
    weights = {"a": 3.0, "b": 1.0}
    many = spark.range(4000).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 10 == 0, "a").otherwise("b").alias("source"), F.lit("t").alias("text"))
    counts = {r["source"]: r["n"] for r in mixing.mix(many, weights, total=8000).groupBy("source").agg(F.count("*").alias("n")).collect()}
    assert abs(counts["a"] - 6000) < 400 and abs(counts["b"] - 2000) < 250
    again = [sorted(map(tuple, mixing.mix(many, weights).select("doc_id", "copy_no").collect())) for _ in range(2)]
    assert again[0] == again[1]
    # a rate far beyond one table: several draws are summed
    few = many.where("doc_id < 20")
    high = [r["n"] for r in mixing.mix(few, {"b": 1.0}, total=18 * 500).groupBy("doc_id").agg(F.count("*").alias("n")).collect()]
    assert len(high) == 18 and abs(np.mean(high) - 500) < 40
    assert mixing.mixed_rows(odd).columns == odd.columns
    assert mixing.mixed_rows(none).count() == 0
    assert mixing.mix(odd, {"a": 1.0}).where("source = 'b' or source is null").count() == 0


def slow_bounds(lengths, counts, buckets):
    from itertools import combinations

    pairs = sorted(zip(lengths, counts, strict=True))
    best = None
    for n in range(1, buckets + 1):
        for cut in combinations(range(len(pairs) - 1), n - 1):
            bounds = [pairs[c][0] for c in cut] + [pairs[-1][0]]
            pad = sum(c * (next(b for b in bounds if b >= x) - x) for x, c in pairs)
            best = pad if best is None else min(best, pad)
    return best


def test_packing(spark, real, odd, none):
    rng = np.random.default_rng(3)
    for _ in range(10):
        lengths = sorted(rng.choice(60, 9, replace=False).tolist())
        counts = rng.integers(1, 9, 9).tolist()
        bounds = packing.best_bounds(lengths, counts, 3)
        pad = sum(c * (next(b for b in bounds if b >= x) - x) for x, c in zip(lengths, counts, strict=True))
        assert pad == slow_bounds(lengths, counts, 3)
    rows = Q.op9_packing(spark, FOLDER).collect()
    assert {r["doc_id"]: r["n_tokens"] for r in rows} == {i: len(WORD.findall(t or "")) + 1 for i, t in real.items()}
    places = Counter((r["bucket"], r["shard"], r["batch"]) for r in rows)
    for r in rows:
        n = places[r["bucket"], r["shard"], r["batch"]]
        assert r["padding"] == r["bucket_tokens"] - r["n_tokens"] >= 0 and (n == 1 or n * r["bucket_tokens"] <= packing.BATCH_TOKENS)
    assert len({(r["bucket"], r["shard"], r["batch"], r["slot"]) for r in rows}) == len(rows)
    assert packing.pack(odd).count() == 10 and packing.pack(none).count() == 0


def test_fingerprints_compose():
    rng = np.random.default_rng(2)
    data = rng.integers(0, 256, 50_000, np.uint8).tobytes()
    whole = exact_dedup.fingerprint(data)
    for at in (0, 1, 16_384, 33_333):
        left, right = exact_dedup.fingerprint(data[:at]), exact_dedup.fingerprint(data[at:])
        assert whole == tuple(exact_dedup.combine(a, b, len(data) - at, base) for a, b, base in zip(left, right, exact_dedup.BASES, strict=True))
    assert whole == exact_dedup.fingerprint(data, chunk=777)


def test_exact_dedup(spark, odd, none):
    rows = exact_dedup.exact_groups(odd).collect()
    assert len(rows) == 10 and sum(r["kept"] for r in rows) == 4
    assert {(r["keep_id"], r["group_size"]) for r in rows if r["doc_id"] == 6} == {(2, 4)}
    assert {(r["keep_id"], r["group_size"]) for r in rows if r["doc_id"] == 3} == {(4, 4)}
    kept = exact_dedup.keep_first(odd)
    assert kept.columns == odd.columns and sorted((r["doc_id"], (r["text"] or "")[:5]) for r in kept.collect()) == [(1, "other"), (2, "The c"), (4, " \n\t"), (5, "alpha")]
    assert exact_dedup.keep_first(none).count() == 0


@pytest.mark.parametrize("part_rows", [2, 1000])
def test_colliding_fingerprints_are_told_apart(spark, monkeypatch, part_rows):
    monkeypatch.setattr(exact_dedup, "PART_ROWS", part_rows)
    docs = spark.createDataFrame([(i, f"text {i % 40:02d}") for i in range(120)], "doc_id long, text string")
    rows = exact_dedup.exact_groups(docs, prime=3).collect()  # three remainders a base: many collisions
    assert all(r["keep_id"] == r["doc_id"] % 40 and r["group_size"] == 3 for r in rows)


def test_license_windows_are_those_of_the_grid_that_hold_a_place():
    rng = np.random.default_rng(5)
    for _ in range(200):
        length, n = int(rng.integers(1, 12)), int(rng.integers(1, 40))
        stride = max(1, length // 4)
        places = np.unique(rng.integers(0, n, 3))
        last = max(n - length, 0)
        grid = sorted({min(s, last) for s in range(0, last + stride, stride)})
        assert license_scan._windows_with(places, length, stride, n).tolist() == [s for s in grid if any(s <= p < s + length for p in places)]
