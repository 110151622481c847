"""The pipeline's stages against brute force, each on what the one before it kept."""

import hashlib
import math
import re
from collections import Counter

import duckdb
import pytest
from test_near_copies import slow_kept

corpus_pipeline = pytest.importorskip("corpus_pipeline")
FOLDER = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def slow_good(text):
    """The quality rules, for one text."""
    from chunkloom.llm.quality_rules import STOP_WORDS

    words = WORD.findall(text or "")
    lines = [x for x in (text or "").split("\n") if WORD.search(x)]
    windows = Counter(zip(words, words[1:], words[2:], strict=False))
    covered = {i + k for i, w in enumerate(zip(words, words[1:], words[2:], strict=False)) if windows[w] > 1 for k in range(3)}
    n, chars = len(words), sum(map(len, words))
    if n < 50 or 100 * len(covered) > 50 * n:
        return False
    stops = sum(w.strip(".,;:!?\"'()[]").lower() in STOP_WORDS for w in words)
    symbols, capitals = len(re.findall(r"[#*$%&|<>]", text)), len(re.findall("[A-Z]", text))
    return 2 <= chars / n <= 15 and symbols <= 0.1 * n and stops >= 0.04 * n and capitals <= 0.3 * chars and len(lines) - len(set(lines)) <= 0.5 * len(lines)


def share(*parts):
    return int(hashlib.md5(":".join(map(str, parts)).encode()).hexdigest()[:13], 16) / 2**52


def slow_copies(rows):
    """How often each of ``rows`` (id, source, text) comes out of mixing to shares by the square root of the source's rows."""
    counts = Counter(source for _, source, _ in rows)
    whole = sum(math.sqrt(n) for n in counts.values())
    out = {}
    for i, source, text in rows:
        rate = len(rows) * math.sqrt(counts[source]) / whole / counts[source]
        key = f"{i}:{hashlib.md5((text if text is not None else 'null').encode()).hexdigest()}"
        u, k, p = share("mix-1", key, 1), 0, math.exp(-rate)
        total = p
        while total <= u:
            k += 1
            p *= rate / k
            total += p
        out[i] = k
    return out


def test_stages(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    columns = docs.columns
    said = duckdb.sql(f"select doc_id, source, text from '{FOLDER}/documents.parquet'").fetchall()
    text, source = {i: t for i, _, t in said}, {i: s for i, s, _ in said}
    results = []
    for name, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, FOLDER)
        if name != "packing":
            assert docs.columns == columns
        results.append(docs.collect())
        docs = spark.createDataFrame(results[-1], docs.schema)
    good, single, apart, mixed, packed = ([r["doc_id"] for r in x] for x in results)
    assert sorted(good) == sorted(i for i in text if slow_good(text[i])) and len(good) < len(text)
    groups = {}
    for i in good:
        groups.setdefault(re.sub(r"[\x20\x09-\x0D]", "", text[i]), []).append((-len(text[i]), i))
    assert sorted(single) == sorted(min(g)[1] for g in groups.values())
    order = sorted(single)
    assert sorted(apart) == [order[k] for k in slow_kept([(i, text[i]) for i in order])]
    assert Counter(mixed) == Counter({i: n for i, n in slow_copies([(i, source[i], text[i]) for i in apart]).items() if n})
    assert sorted(packed) == sorted(mixed)


def test_stages_take_odd_rows(spark):
    """Null ids, texts and sources, empty and long texts, repeated rows, names that stages use themselves, and no rows at all."""
    kind = "doc_id long, text string, lang string, source string, n_chars long, id string, row string, kept string, n_words string, at string, node string, _words string, _row string, bucket string"
    same = " ".join(f"the w{i}a of b{i}c and" for i in range(30))
    rows = [(1, same), (1, same), (2, same + " "), (3, None), (None, ""), (4, " \n"), (None, same.replace("29", "x")), (5, same.replace("w", "bird")), (5, same.replace("b", "fox")), (6, "long " * 200_000), (None, None)]
    docs = spark.createDataFrame([(i, t, "en", None if n % 3 else "s", None, *["x"] * 9) for n, (i, t) in enumerate(rows)], kind)
    sizes = []
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, FOLDER)
        sizes.append(docs.count())
        assert docs.columns == [c.split()[0] for c in kind.split(", ")] and stage(spark, docs.where("false"), FOLDER).count() == 0
    assert sizes[:3] == [6, 4, 3]
    assert corpus_pipeline.STAGES[-1][1](spark, docs, FOLDER).count() == sizes[3]
    name, good = corpus_pipeline.STAGES[0]
    # every stage takes the odd rows themselves too
    odd = spark.createDataFrame([(i, t, "en", None if n % 3 else "s", None, *["x"] * 9) for n, (i, t) in enumerate(rows)], kind)
    counts = {name: stage(spark, odd, FOLDER).count() for name, stage in corpus_pipeline.STAGES}
    assert counts["exact_dedup"] == 6 and counts["near_dedup"] == 5 and counts["packing"] == 11


def test_tables_of_earlier_stages_are_deleted(spark):
    from pathlib import Path

    from chunkloom.llm import common

    root = Path(common.scratch_root(spark).removeprefix("file:"))
    before = set(root.glob("chunkloom-*"))
    packed = corpus_pipeline.run(spark, FOLDER)
    left = {p.name.split("-")[1] for p in set(root.glob("chunkloom-*")) - before}
    assert left == {"pipeline", "pack"} and packed.count() > 0
