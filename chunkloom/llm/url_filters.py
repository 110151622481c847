"""URL filters: longest-prefix rules, then a Bloom filter cascade over the corpus's key universe."""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import Batches, materialize, whole_row

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
RULES = (
    ("block", "com", "/en/"),
    ("allow", "example.com", "/en/7"),
    ("allow", "net", "/de/"),
    ("block", "example.net", "/de/8"),
    ("block", "org", "/es/"),
)
#: Listed keys of the query: hosts (with their subdomains), host/folder/ places of any depth, or host/path pages.
LISTED = ("cheap-pills.example.net", "cheap-pills.example.com", "casino-win.example.com", "free-bets.example.com", "tionble.example.com", "ththor.example.com/fr/", "tionsh.example.net/es/", "therat.example.net")
#: Pages and first folders of ``pages`` are listed too if the MD5 of their key begins so; such a list grows with the table.
LISTED_PAGES, LISTED_FOLDERS = "0", "00"
#: A cascade larger than this is built and tested in parts, by hash of the key.
PART_BYTES = 64 << 20
MAX_LEVELS = 64


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path of a url; both are empty for a null or one without ``://``."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")
    rest = F.coalesce(rest, F.lit(""))
    return F.translate(F.regexp_extract(rest, "^[^/?#]*", 0), UPPER, LOWER), F.regexp_extract(rest, "^[^/?#]*([^?#]*)", 1)


def rule_columns(host: Column, path: Column, rules: Sequence[tuple[str, str, str]] = RULES) -> tuple[Column, Column]:
    """The longest fitting rule as text and its verdict, or nulls."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for said, at, prefix in sorted(rules, key=lambda r: (len(r[1] + r[2]), r)):
        fits = ((host == at) | host.endswith("." + at)) & path.startswith(prefix)
        rule, verdict = F.when(fits, at + prefix).otherwise(rule), F.when(fits, said).otherwise(verdict)
    return rule, verdict


def page_keys(host: Column, path: Column) -> Column:
    """What can be listed of a page: each suffix of its host, alone, with each folder the path is in (``/`` to the deepest) and with the whole path."""
    labels, parts = F.split(host, r"\."), F.split(path, "/")
    suffixes = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels) - i + 1), "."))
    folders = F.transform(F.sequence(F.lit(1), F.greatest(F.size(parts) - 1, F.lit(1))), lambda i: F.concat(F.array_join(F.slice(parts, F.lit(1), i), "/"), F.lit("/")))
    prefixes = F.when(path != "", F.concat(F.array(F.lit("")), folders, F.array(path))).otherwise(F.array(F.lit("")))
    keys = F.flatten(F.transform(prefixes, lambda p: F.transform(suffixes, lambda s: F.concat(s, p))))
    return F.when(host != "", F.array_distinct(keys)).otherwise(F.expr("cast(array() as array<string>)"))


def listed_keys(pages: DataFrame, url: str = "url") -> DataFrame:
    """The query's list (``key``): LISTED, and the pages and first folders that LISTED_PAGES and LISTED_FOLDERS choose."""
    host, path = host_and_path(F.col(url))
    split = pages.select(host.alias("host"), path.alias("path")).where("host <> '' and path <> ''").distinct()
    chosen = lambda key, begin: F.when(F.md5(key).startswith(begin), key)
    page, folder = F.concat("host", "path"), F.concat("host", F.lit("/"), F.split("path", "/")[1], F.lit("/"))
    keys = split.select(F.explode(F.array(chosen(page, LISTED_PAGES), F.when(F.col("path").rlike("^/[^/]+/"), chosen(folder, LISTED_FOLDERS)))).alias("key")).where("key is not null")
    return pages.sparkSession.createDataFrame([(x,) for x in LISTED], "key string").unionByName(keys.distinct())


def check_listed(listed: DataFrame) -> None:
    """Raise if a listed key (column ``key``) has a form that no page has: it must be a lower-case host, alone or followed by a path."""
    key = F.col("key").cast("string")
    wrong = listed.where(~key.rlike("^[^/?#A-Z]+(/[^?#]*)?$") | key.contains("://")).select(key).first()
    if wrong:
        raise ValueError(f"no page can match the listed key {wrong[0]!r}; give host, host/folder/ or host/path")


def _mixed(h: np.ndarray, level: int) -> tuple[np.ndarray, np.ndarray]:
    """Two hashes of each key for a level, from its two 64-bit hashes (columns of ``h``)."""
    with np.errstate(over="ignore"):
        a = (h[:, 0] ^ np.uint64((level * 0x9E3779B97F4A7C15) & (2**64 - 1))) * np.uint64(0xFF51AFD7ED558CCD)
        a ^= a >> np.uint64(32)
        b = (h[:, 1] + np.uint64(level)) * np.uint64(0xC4CEB9FE1A85EC53)
        b ^= b >> np.uint64(29)
    return a, b | np.uint64(1)


@dataclass
class Bloom:
    level: int
    bits: int
    hashes: int
    words: np.ndarray

    @staticmethod
    def shape(keys: int, rate: float) -> tuple[int, int]:
        hashes = max(1, round(-math.log2(rate)))
        return max(64, -(-math.ceil(keys * -math.log(rate) / math.log(2) ** 2) // 64) * 64), hashes

    @staticmethod
    def places(h: np.ndarray, level: int, bits: int, hashes: int) -> np.ndarray:
        a, b = _mixed(h, level)
        with np.errstate(over="ignore"):
            return (a[:, None] + np.arange(hashes, dtype=np.uint64) * b[:, None]) % np.uint64(bits)

    def holds(self, h: np.ndarray) -> np.ndarray:
        at = self.places(h, self.level, self.bits, self.hashes)
        return ((self.words[at >> np.uint64(6)] >> (at & np.uint64(63))) & np.uint64(1)).all(axis=1)


def listed_by(levels: Sequence[Bloom], h: np.ndarray) -> np.ndarray:
    """Exact membership of keys of the universe: the first level that lacks a key decides by its parity."""
    answer = np.zeros(len(h), bool)
    alive = np.arange(len(h))
    for bloom in levels:
        alive = alive[bloom.holds(h[alive])]
        answer[alive] = bloom.level % 2 == 0
        if not len(alive):
            break
    return answer


def _hash_matrix(batch: pa.RecordBatch) -> np.ndarray:
    return np.stack([batch.column(c).to_numpy(zero_copy_only=False).view(np.uint64) for c in ("h1", "h2")], axis=1)


def _build_level(keys: DataFrame, level: int, count: int, rate: float) -> Bloom:
    """Bits of all ``keys``: set in tasks, merged by a grouped OR, then gathered (their number was computed before)."""
    bits, hashes = Bloom.shape(count, rate)

    def words(batches: Batches):
        for batch in batches:
            at = np.unique(Bloom.places(_hash_matrix(batch), level, bits, hashes).ravel())
            word, first = np.unique(at >> np.uint64(6), return_index=True)
            value = np.bitwise_or.reduceat(np.uint64(1) << (at & np.uint64(63)), first) if len(at) else np.zeros(0, np.uint64)
            yield pa.RecordBatch.from_arrays([pa.array(word.astype(np.int64)), pa.array(value.view(np.int64))], names=["word", "value"])

    merged = keys.select("h1", "h2").mapInArrow(words, "word long, value long").groupBy("word").agg(F.bit_or("value").alias("value")).toPandas()
    array = np.zeros(bits // 64, np.uint64)
    array[merged["word"].to_numpy()] = merged["value"].to_numpy().view(np.uint64)
    return Bloom(level, bits, hashes, array)


def build_cascade(universe: DataFrame) -> list[Bloom]:
    """Levels for ``universe`` (h1, h2, listed): level 0 holds the listed keys, level 1 the unlisted ones
    that level 0 takes in, and so on until no key is taken in wrongly.  No listed keys: no levels."""
    known = {bool(r["listed"]): r["count"] for r in universe.groupBy("listed").count().collect()}
    inside, outside = universe.where("listed"), universe.where("not listed")
    count, others = known.get(True, 0), known.get(False, 0)
    levels: list[Bloom] = []
    rate = min(0.5, max(1e-4, math.sqrt(0.5) * count / max(others, 1)))
    while count:
        if len(levels) == MAX_LEVELS:
            raise ValueError("two keys share both hashes; choose other seeds")
        bloom = _build_level(inside, len(levels), count, rate)
        levels.append(bloom)
        if not others:
            break

        def taken(batches: Batches, bloom=bloom):
            for batch in batches:
                yield batch.filter(pa.array(bloom.holds(_hash_matrix(batch))))

        wrong = materialize(outside.mapInArrow(taken, outside.schema), f"cascade{len(levels)}")
        inside, outside = wrong, inside
        count, others, rate = wrong.count(), count, 0.5
    return levels


def with_listed(rows: DataFrame, keys: Column, listed: DataFrame, part_bytes: int = PART_BYTES) -> DataFrame:
    """``rows`` with ``listed``: whether any of a row's ``keys`` is in ``listed`` (one column ``key``).

    The universe is every key of ``rows``, so the answers are exact.  Rows are tested in place,
    without a join.  Empty key arrays, nulls in the list and repeated keys are fine; a key of a form that no page has raises.
    """
    check_listed(listed)
    packed = rows.select(whole_row(rows).alias("row"), keys.alias("_keys"))
    keyed = packed
    own = keyed.select(F.explode("_keys").alias("key")).distinct().select("key", F.lit(True).alias("seen"), F.lit(False).alias("listed"))
    given = listed.select(F.col("key").cast("string"), F.lit(False).alias("seen"), F.lit(True).alias("listed")).where("key is not null")
    hashed = own.unionByName(given).groupBy("key").agg(F.max("seen").alias("seen"), F.max("listed").alias("listed")).where("seen")
    hashed = hashed.select(F.xxhash64("key", F.lit(1)).alias("h1"), F.xxhash64(F.lit(2), "key").alias("h2"), "listed")
    universe = materialize(hashed, "url-universe")
    counted = {bool(r["listed"]): r["count"] for r in universe.groupBy("listed").count().collect()}
    rate = min(0.5, max(1e-4, math.sqrt(0.5) * counted.get(True, 0) / max(counted.get(False, 0), 1)))
    parts = max(1, -(-3 * Bloom.shape(counted.get(True, 0), rate)[0] // 8 // part_bytes))
    keyed = keyed.withColumns({"_h1": F.transform("_keys", lambda k: F.xxhash64(k, F.lit(1))), "_h2": F.transform("_keys", lambda k: F.xxhash64(F.lit(2), k)), "listed": F.lit(False)}).drop("_keys")
    for part in range(parts):
        levels = rows.sparkSession.sparkContext.broadcast(build_cascade(universe.where(F.pmod("h1", F.lit(parts)) == part)))

        def test(batches: Batches, part=part, levels=levels):
            for batch in batches:
                lists = batch.column("_h1")
                offsets = lists.offsets.to_numpy()
                h = np.stack([batch.column(c).flatten().to_numpy(zero_copy_only=False).view(np.uint64) for c in ("_h1", "_h2")], axis=1)
                hit = listed_by(levels.value, h) & (h[:, 0].view(np.int64) % parts == part)
                total = np.concatenate([[0], np.cumsum(hit)])
                offsets = offsets - offsets[0]
                found = (total[offsets[1:]] > total[offsets[:-1]]) | batch.column("listed").to_numpy(zero_copy_only=False)
                yield batch.set_column(batch.schema.get_field_index("listed"), "listed", pa.array(found))

        keyed = keyed.mapInArrow(test, keyed.schema)
        if parts > 1:
            keyed = materialize(keyed, "url-part")
    return keyed.select(*[F.col("row")[c].alias(c) for c in rows.columns if c != "listed"], "listed")


def judge_urls(pages: DataFrame, listed: DataFrame, rules: Sequence[tuple[str, str, str]] = RULES, url: str = "url") -> DataFrame:
    """Add host, path, rule, listed and verdict to ``pages``: the rule's verdict, else block if listed, else allow.

    Null urls and those without ``://`` have an empty host and path, fit no rule and are allowed.  Repeated rows are judged
    alike; urls may be of any length; an empty table gives an empty result.  Columns of ``pages`` that have the names of the five
    give way; others may have any name.
    """
    host, path = host_and_path(F.col(url))
    split = pages.drop("host", "path", "rule", "listed", "verdict").withColumns({"host": host, "path": path})
    rule, said = rule_columns(F.col("host"), F.col("path"), rules)
    tested = with_listed(split, page_keys(F.col("host"), F.col("path")), listed)
    return tested.withColumns({"rule": rule, "verdict": F.coalesce(said, F.when(F.col("listed"), "block").otherwise("allow"))})


def _oracle() -> str:
    rules = sorted(RULES, key=lambda r: (-len(r[1] + r[2]), r))
    fits = [f"(host = '{h}' OR ends_with(host, '.{h}')) AND starts_with(path, '{p}')" for _, h, p in rules]
    case = lambda values: "CASE " + " ".join(f"WHEN {f} THEN '{v}'" for f, v in zip(fits, values, strict=True)) + " END"
    given = ", ".join(f"('{key}')" for key in LISTED)
    return f"""
WITH r AS (SELECT row_number() OVER () AS no, page_id, CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest FROM pages),
h AS (SELECT no, page_id, translate(regexp_extract(coalesce(rest, ''), '^[^/?#]*'), '{UPPER}', '{LOWER}') AS host,
             regexp_extract(coalesce(rest, ''), '^[^/?#]*([^?#]*)', 1) AS path FROM r),
given AS (SELECT key FROM (VALUES {given}) AS v(key)
          UNION SELECT host || path FROM h WHERE host <> '' AND path <> '' AND starts_with(md5(host || path), '{LISTED_PAGES}')
          UNION SELECT host || '/' || split_part(path, '/', 2) || '/' FROM h
                WHERE host <> '' AND regexp_matches(path, '^/[^/]+/') AND starts_with(md5(host || '/' || split_part(path, '/', 2) || '/'), '{LISTED_FOLDERS}')),
p AS (SELECT no, string_split(host, '.') AS labels, string_split(path, '/') AS parts, path FROM h WHERE host <> ''),
s AS (SELECT no, unnest(list_transform(range(1, len(labels) + 1), lambda i: array_to_string(labels[i:], '.'))) AS suffix,
             CASE WHEN path = '' THEN [''] ELSE list_concat(['', path], list_transform(range(1, greatest(len(parts), 2)), lambda i: array_to_string(parts[:i], '/') || '/')) END AS prefixes FROM p),
k AS (SELECT no, suffix || unnest(prefixes) AS key FROM s),
hit AS (SELECT DISTINCT no FROM k SEMI JOIN given USING (key))
SELECT page_id, host, path, {case([h + p for _, h, p in rules])} AS rule,
       coalesce({case([v for v, _, _ in rules])}, CASE WHEN no IN (SELECT no FROM hit) THEN 'block' ELSE 'allow' END) AS verdict
FROM h
"""


ORACLE_SQL = _oracle()
