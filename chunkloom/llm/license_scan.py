"""License scans: MinHash bands over overlapping windows find templates, exact shingle containment verifies them."""

from __future__ import annotations

import math
import re
from collections import defaultdict
from collections.abc import Mapping
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import BROADCAST_BYTES, Batches
from .license_texts import TEMPLATES

SHINGLE_WORDS = 5
CONTAINMENT = 0.8
#: A matching passage is missed with this probability at most.
MISS = 1e-4
#: Windows of one template that are at most this many of its lengths apart count as one passage, if none holds enough alone: what
#: is inserted in a notice may be so long.
GAP_LENGTHS = 1
BLOCK = 1 << 16
_WORD = re.compile(rb"[0-9a-z\x80-\xff]+")


def words_of(data: bytes | None) -> list[bytes]:
    return _WORD.findall((data or b"").lower())


def _shingles(words: list[bytes], size: int) -> np.ndarray:
    """64-bit hashes of all runs of ``size`` words."""
    if len(words) < size:
        return np.zeros(0, np.uint64)
    digest = xxhash.xxh64_intdigest
    h = np.array([digest(w) for w in words], np.uint64)
    n = len(h) - size + 1
    out = np.zeros(n, np.uint64)
    with np.errstate(over="ignore"):
        for i in range(size):
            out = out * np.uint64(0x9E3779B97F4A7C15) + h[i : i + n]
        out ^= out >> np.uint64(29)
        out *= np.uint64(0xBF58476D1CE4E5B9)
    return out ^ (out >> np.uint64(32))


def permutations(n: int) -> np.ndarray:
    """Odd factors and offsets of ``n`` orders of the shingle hashes, from a fixed seed."""
    rng = np.random.default_rng(20_24)
    return np.stack([rng.integers(0, 2**63, n, np.uint64) * np.uint64(2) + np.uint64(1), rng.integers(0, 2**63, n, np.uint64)])


def bands_for(similarity: float, miss: float = MISS) -> int:
    """How many bands of one row find sets of this similarity with probability 1 - miss or more."""
    return max(1, math.ceil(math.log(miss) / math.log(1 - min(similarity, 1 - 1e-9))))


class Index:
    """Templates by window length, and band values of each length's templates."""

    def __init__(self, templates: Mapping[str, str], shingle_words: int = SHINGLE_WORDS, containment: float = CONTAINMENT):
        self.size, self.containment = shingle_words, containment
        self.shingles: dict[str, np.ndarray] = {}
        lengths: dict[int, list[str]] = defaultdict(list)
        for name, text in templates.items():
            words = words_of(text.encode())
            size = len(words) - shingle_words + 1
            if size < 1:
                raise ValueError(f"template {name!r} has fewer than {shingle_words} words")
            self.shingles[name] = np.unique(_shingles(words, shingle_words))
            lengths[size].append(name)
        self.windows = []
        #: for a shingle: the windows and orders in which it gives the band value, and the templates that have it
        self.least: dict[int, list[tuple[int, int, np.ndarray, list[str]]]] = defaultdict(list)
        for length, names in sorted(lengths.items()):
            stride = max(1, length // 4)
            # the window nearest to a passage misses half a stride of it at most
            shared = max(1.0, containment * length - stride / 2) if length > 1 else 1.0
            orders = permutations(bands_for(shared / (2 * length - shared)))
            self.windows.append((length, stride))
            for order in orders.T:
                having: dict[int, list[str]] = defaultdict(list)
                for name in names:
                    own = self.shingles[name]
                    having[int(own[self._order(own, order).argmin()])].append(name)
                for shingle, named in having.items():
                    self.least[shingle].append((length, stride, order, named))
        self.anchors = np.array(sorted(self.least), np.uint64)

    @staticmethod
    def _order(h: np.ndarray, order: np.ndarray) -> np.ndarray:
        with np.errstate(over="ignore"):
            x = h * order[0] + order[1]
        return x ^ (x >> np.uint64(31))

    def candidates(self, h: np.ndarray):
        """(template, first shingle, end) of windows that share a band value with a template.

        An order gives different shingles different values, so a window has a template's band value if it holds the
        shingle that gave it and none that comes before.  Only windows with such a shingle need their minimum.
        """
        near = np.minimum(np.searchsorted(self.anchors, h), len(self.anchors) - 1)
        hits = np.flatnonzero(self.anchors[near] == h)
        for shingle in np.unique(h[hits]):
            places = hits[h[hits] == shingle]
            for length, stride, order, names in self.least[int(shingle)]:
                starts = _windows_with(places, length, stride, len(h))
                held = h[starts[:, None] + np.arange(min(length, len(h)))]
                low = self._order(held, order).min(axis=1) == self._order(np.array([shingle]), order)
                for at in starts[low].tolist():
                    for name in names:
                        yield name, max(0, at - stride), min(len(h), at + length + stride)

    def verified(self, name: str, h: np.ndarray, a: int, b: int) -> tuple[int, int, float] | None:
        """First and end word of the template's shingles within [a, b), and their share of the template, if it suffices."""
        at = np.flatnonzero(np.isin(h[a:b], self.shingles[name]))
        if not len(at):
            return None
        share = len(np.unique(h[a:b][at])) / len(self.shingles[name])
        return (a + int(at[0]), a + int(at[-1]) + self.size, share) if share >= self.containment else None

    def scan(self, data: bytes | None) -> list[tuple[str, int, int, float]]:
        """(template, first word, end word, containment) of the verified passages of one text, overlapping ones merged."""
        words, found = words_of(data), defaultdict(list)
        overlap = (2 + 2 * GAP_LENGTHS) * max((length for length, _ in self.windows), default=0) + self.size
        for begun in range(0, len(words), BLOCK):
            h = _shingles(words[begun : begun + BLOCK + overlap], self.size)
            if not (len(h) and len(self.anchors)):
                continue
            windows = defaultdict(list)
            for name, a, b in sorted(set(self.candidates(h))):
                windows[name].append((a, b))
            for name, own in windows.items():
                for chain in _chains(own, GAP_LENGTHS * len(self.shingles[name])):
                    hits = [hit for a, b in chain if (hit := self.verified(name, h, a, b))]
                    if not hits and len(chain) > 1 and (hit := self.verified(name, h, chain[0][0], max(b for _, b in chain))):
                        hits = [hit]
                    found[name] += [(begun + a, begun + b, share) for a, b, share in hits]
        out = []
        for name, passages in found.items():
            merged: list[list] = []
            for a, b, share in sorted(passages):
                if merged and a < merged[-1][1]:
                    merged[-1][1], merged[-1][2] = max(merged[-1][1], b), max(merged[-1][2], share)
                else:
                    merged.append([a, b, share])
            out += [(name, *m) for m in merged]
        return sorted(out)


def _chains(windows: list[tuple[int, int]], gap: int) -> list[list[tuple[int, int]]]:
    """Runs of ``windows`` (sorted) of which each begins at most ``gap`` after the end of those before it."""
    out: list[list[tuple[int, int]]] = []
    end = 0
    for a, b in windows:
        if out and a <= end + gap:
            out[-1].append((a, b))
        else:
            out.append([(a, b)])
            end = b
        end = max(end, b)
    return out


def _windows_with(places: np.ndarray, length: int, stride: int, n: int) -> np.ndarray:
    """Starts of the windows over ``n`` shingles that hold one of ``places``: one each ``stride``, and the last possible one."""
    last = max(n - length, 0)
    starts = np.clip((places[:, None] // stride + 1 - np.arange(length // stride + 2)) * stride, 0, last)
    return np.unique(starts[(starts <= places[:, None]) & (places[:, None] < starts + length)])


@lru_cache(maxsize=4)
def _index(templates: tuple[tuple[str, str], ...], shingle_words: int, containment: float) -> Index:
    return Index(dict(templates), shingle_words, containment)


def scan(docs: DataFrame, templates: Mapping[str, str] | DataFrame = TEMPLATES, shingle_words: int = SHINGLE_WORDS, containment: float = CONTAINMENT) -> DataFrame:
    """One row for each verified passage: doc_id, license, first_word, end_word, containment (of the best window verified).

    Words are runs of letters and digits (and any non-ASCII character), lower-cased A-Z.  ``templates`` are names and texts, or a table
    (name, text) of them of BROADCAST_BYTES at most; they go with the task, and documents stay where they are.
    Null, empty and clean texts give no row; repeated rows give theirs again; texts of any length are scanned whole, in
    blocks that overlap; other columns are not looked at; an empty table gives an empty result.
    """
    if isinstance(templates, DataFrame):
        size = templates.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
        if size > BROADCAST_BYTES:
            raise ValueError(f"the templates take {size} bytes, more than {BROADCAST_BYTES}")
        templates = {r["name"]: r["text"] for r in templates.select("name", "text").collect()}
    given = tuple(templates.items())

    def rows(batches: Batches):
        index = _index(given, shingle_words, containment)
        for batch in batches:
            out = [(doc_id, *hit) for doc_id, data in zip(batch.column("doc_id").to_pylist(), batch.column("text").cast(pa.large_binary()).to_pylist(), strict=True) for hit in index.scan(data)]
            kinds = (pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.float64())
            yield pa.RecordBatch.from_arrays([pa.array([x[i] for x in out], k) for i, k in enumerate(kinds)], names=["doc_id", "license", "first_word", "end_word", "containment"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(rows, "doc_id long, license string, first_word long, end_word long, containment double")
