"""Language ID by multilingual mixture inference.

Each language is a distribution over hashed character trigrams.  A document is a mixture of languages: for a set of
languages, expectation-maximisation finds the proportions that make its trigrams most likely.  The set grows by the language that
adds most, as long as the gain in log-likelihood exceeds a penalty for one more language; then those go whose loss costs less.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, StringType, StructField, StructType

from .common import Batches, quoted, remainder

MODULUS, HELD_OUT = 3, 1
BUCKETS = 1 << 15
#: A larger model is refused, since each task holds it whole: 2,048 languages.
MODEL_BYTES = 256 << 20
STEPS = 100
#: A further language must gain this much log-likelihood for each log unit of the trigrams' number.
PENALTY = 4.0
UNKNOWN = "und"
#: Characters of a text that are hashed at a time.
BLOCK = 1 << 18
_LETTER = regex.compile(r"\p{L}")
_BETWEEN = regex.compile(r"[^\p{L}\p{M}]+")


def trigrams(text: str | None, buckets: int = BUCKETS, block: int = BLOCK) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of the text's character trigrams and their counts; a run of all but letters and their marks counts as one space, as do the text's ends.

    The text is cleaned whole and hashed in blocks that share two
    characters, so the counts are the same for any size of block.
    """
    if not text:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    cleaned = f" {_BETWEEN.sub(' ', text.lower()).strip(' ')} ".encode("utf-32-le", "replace")
    total: tuple[np.ndarray, np.ndarray] = (np.zeros(0, np.int64), np.zeros(0, np.int64))
    for start in range(0, len(cleaned) // 4 - 2, block):
        c = np.frombuffer(cleaned[4 * start : 4 * (start + block + 2)], np.uint32).astype(np.uint64)
        h = (c[:-2] * np.uint64(0x1F35D) + c[1:-1]) * np.uint64(0x2C1B3) + c[2:]
        h = (h * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(40)
        at, n = np.unique((h % np.uint64(buckets)).astype(np.int64), return_counts=True)
        if len(total[0]):
            at, place = np.unique(np.concatenate([total[0], at]), return_inverse=True)
            n = np.bincount(place, np.concatenate([total[1], n])).astype(np.int64)
        total = at, n
    return total


def _em(likelihood: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, float]:
    """Proportions of the languages (rows of ``likelihood``) and the document's log-likelihood."""
    k = len(likelihood)
    share, n = np.full(k, 1.0 / k), counts.sum()
    for _ in range(STEPS if k > 1 else 0):
        mixed = share @ likelihood
        new = share * (likelihood @ (counts / mixed)) / n
        if np.abs(new - share).max() < 1e-4:
            share = new
            break
        share = new
    return share, float(counts @ np.log(share @ likelihood))


def infer(logs: np.ndarray, at: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """The share of each language (rows of ``logs``) in a document; zero outside the chosen set."""
    own = logs[:, at].astype(np.float64)
    own -= own.max(axis=0)  # the same factor for all languages
    likelihood = np.exp(own)
    single = own @ counts
    chosen = [int(np.argmax(single))]
    share, best = np.ones(1), float(single[chosen[0]])
    penalty = PENALTY * np.log(counts.sum() + 1.0)
    while len(chosen) < len(logs):
        # the gradient of the likelihood in a language's share tells which one adds most
        mixed = share @ likelihood[chosen]
        pull = likelihood @ (counts / mixed)
        pull[chosen] = -np.inf
        added = int(np.argmax(pull))
        if pull[added] <= counts.sum():
            break
        more, value = _em(likelihood[[*chosen, added]], counts)
        if value - best <= penalty:
            break
        chosen, share, best = [*chosen, added], more, value
    while len(chosen) > 1:
        # a language that came early may have become idle beside later ones
        without = [[x for x in chosen if x != gone] for gone in chosen]
        tried = [_em(likelihood[rest], counts) for rest in without]
        k = int(np.argmax([value for _, value in tried]))
        if best - tried[k][1] > penalty:
            break
        chosen, (share, best) = without[k], tried[k]
    out = np.zeros(len(logs))
    out[chosen] = share
    return out


def train(docs: DataFrame, text: str = "text", lang: str = "lang", buckets: int = BUCKETS) -> tuple[list[str], np.ndarray]:
    """Languages and their log-probabilities of buckets, from all rows of ``docs`` with a language.

    The model takes 4 * ``buckets`` bytes for each language: 128 KB, so 25 MB for the 200 or so languages that have corpora.
    More languages than MODEL_BYTES holds raise: fewer ``buckets`` would change the model, so that is for the caller to choose.
    """
    rows_in = docs.select(F.col(text).cast("string").alias("text"), F.col(lang).cast("string").alias("lang")).where("lang is not null and text is not null")
    n = rows_in.select("lang").distinct().count()
    if 4 * n * buckets > MODEL_BYTES:
        raise ValueError(f"a model of {n} languages with {buckets} buckets takes more than {MODEL_BYTES} bytes")
    def rows(batches: Batches):
        tables: dict[str, np.ndarray] = {}
        for batch in batches:
            for data, name in zip(batch.column("text").to_pylist(), batch.column("lang").to_pylist(), strict=True):
                at, counts = trigrams(data, buckets)
                table = tables.setdefault(name, np.zeros(buckets, np.int64))
                table[at] += counts
            if len(tables) > 64:
                yield from emit(tables)
                tables = {}
        yield from emit(tables)

    def emit(tables):
        for name, table in tables.items():
            at = np.flatnonzero(table)
            yield pa.RecordBatch.from_arrays([pa.array([name] * len(at), pa.string()), pa.array(at), pa.array(table[at])], names=["lang", "bucket", "n"])

    counted = rows_in.mapInArrow(rows, "lang string, bucket long, n long").groupBy("lang", "bucket").agg(F.sum("n").alias("n"))
    # a row of the model holds all counts of a language
    found = counted.groupBy("lang").agg(F.collect_list("bucket").alias("at"), F.collect_list("n").alias("n")).orderBy("lang").collect()
    names = [r["lang"] for r in found]
    logs = np.zeros((len(names), buckets), np.float32)
    for i, r in enumerate(found):
        table = np.zeros(buckets)
        table[r["at"]] = r["n"]
        logs[i] = np.log((table + 0.1) / (table.sum() + 0.1 * buckets))
    return names, logs


def predict(docs: DataFrame, model: tuple[list[str], np.ndarray], text: str = "text") -> DataFrame:
    """``docs`` without its text, with lang_pred, score (that language's share) and lang_shares (all languages of the chosen set).

    Other columns are kept, whatever their names, but for those made here.
    Null texts, texts without a letter, and all texts if nothing was learned, are ``und`` with score 0.
    Ties go to the language first in the alphabet.
    """
    names, logs = model
    shared = docs.sparkSession.sparkContext.broadcast((names, logs))
    kept = [c for c in docs.columns if c not in ("lang_pred", "score", "lang_shares", text)]
    # plain names on the way, whatever names the columns have
    given = docs.select(*[quoted(c).alias(f"c{i}") for i, c in enumerate(kept)], quoted(text).cast("string").alias("text"))

    def rows(batches: Batches):
        names, logs = shared.value
        for batch in batches:
            best, score, shares = [], [], []
            for data in batch.column("text").to_pylist():
                if data is None or not names or not _LETTER.search(data):
                    best.append(UNKNOWN), score.append(0.0), shares.append([])
                    continue
                share = infer(logs, *trigrams(data, logs.shape[1]))
                top = int(np.argmax(share))
                best.append(names[top]), score.append(min(1.0, float(share[top])))
                shares.append([(names[i], float(share[i])) for i in np.flatnonzero(share)])
            out = batch.drop_columns(["text"])
            found = pa.StructArray.from_arrays([pa.array([n for x in shares for n, _ in x], pa.string()), pa.array([s for x in shares for _, s in x], pa.float64())], ["lang", "share"])
            lists = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum([len(x) for x in shares])]).astype(np.int32)), found)
            yield pa.RecordBatch.from_arrays([*out.columns, pa.array(best), pa.array(score), lists], names=[*out.schema.names, "lang_pred", "score", "lang_shares"])

    shares = ArrayType(StructType([StructField("lang", StringType()), StructField("share", DoubleType())]))
    added = [StructField("lang_pred", StringType()), StructField("score", DoubleType()), StructField("lang_shares", shares)]
    schema = StructType([*[f for f in given.schema.fields if f.name != "text"], *added])
    return given.mapInArrow(rows, schema).toDF(*kept, "lang_pred", "score", "lang_shares")


def identify(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, lang_pred, score, lang_shares of all ``docs`` (doc_id, text, lang), learned from those not held out that have a language.

    Null texts, texts without a letter, and all texts if nothing was learned, are ``und`` with score 0; null ids are not held out.  Repeated rows
    count as often as they stand there when the model is learned, and are predicted alike.  Texts of any length are read whole, in blocks.  Other columns
    are not looked at, whatever their names.  An empty table gives an empty result.  ValueError if there are more languages than a model holds.
    """
    marked = docs.withColumn("held_out", remainder(F.col("doc_id"), MODULUS) == HELD_OUT)
    model = train(marked.where("not held_out"))
    return predict(marked.select(F.col("doc_id").cast("long").alias("doc_id"), "held_out", "text"), model)
