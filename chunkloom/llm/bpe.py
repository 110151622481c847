"""Byte-level BPE by an index of pairs, and its decoding.

All new words of a block are laid out one after the other as linked symbols.  An index maps each pair of neighbours that has a
rank to all its places in the block.  The active ranks are taken in ascending order from a heap: a rank's pair is merged at all its places at
once, and the pairs that come about left and right of each enter the lists of their own ranks.  No rank is looked for twice in a word, and a word of
any length takes time in proportion (but for the heap's logarithm).

That order gives each word what merging its own lowest pair again and again would, since in the tables taken here a merge ranks
above those that build its parts; other tables are refused.
"""

from __future__ import annotations

import heapq
import json
import os
import re
from array import array
from collections.abc import Iterator, Sequence
from functools import lru_cache
from itertools import chain

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from .common import Batches, quoted, texts

TOKENIZER = "byte_bpe_50k.json"
#: Bytes of texts that are encoded, and whose new words are indexed, at a time.
BLOCK_TEXT = 2 << 20
#: A pair with so many places is merged at all of them by array operations, which cost some 50 places otherwise.
MANY = 48
#: Bytes of words and ids that a worker remembers, about; beyond it forgets all.
CACHE_BYTES = 96 << 20
# Fixed value: how words of ASCII characters are cut before merging.
ASCII_WORD = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d| ?[A-Za-z]+| ?[0-9]+| ?[^\t-\r A-Za-z0-9]+|[\t-\r ]+(?![^\t-\r ])|[\t-\r ]+")
# Fixed value: Unicode's white space.  Runs of three, and of two at the end of a text, may be no place to cut at.
_SPACE = "\\t-\\r \x85\xa0  -     　"
INNER_SPACE = re.compile(f"(?:[{_SPACE}][ \\n]|\\n[{_SPACE}])(?:[{_SPACE}]|\\Z)")
#: The options of a tokenizer file that would change what is done here.
PLAIN_MODEL = {"type": "BPE", "dropout": None, "unk_token": None, "continuing_subword_prefix": None, "end_of_word_suffix": None, "byte_fallback": False, "ignore_merges": False}
PLAIN_CUT = {"type": "ByteLevel", "add_prefix_space": False, "use_regex": True}


def byte_letters() -> dict[str, int]:
    """The letter that stands for each byte in a vocabulary: itself if it is visible in Latin-1, else the next code point from 256 on."""
    visible = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    hidden = [b for b in range(256) if b not in visible]
    return {chr(b): b for b in visible} | {chr(256 + i): b for i, b in enumerate(hidden)}


class Vocabulary:
    """The tables of a byte-level BPE tokenizer file.

    ValueError for a file with options that are not followed here: a normalizer, another cut into words, dropout, added tokens that take
    space beside them, merges out of order.
    """

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            about = json.load(file)
        model = about["model"]
        odd = [k for k, v in PLAIN_MODEL.items() if model.get(k) not in (v, "" if v is None else v)]
        odd += [k for k, v in PLAIN_CUT.items() if (about["pre_tokenizer"] or {}).get(k) != v] + ["normalizer"] * bool(about["normalizer"])
        odd += [t["content"] for t in about["added_tokens"] if t["single_word"] or t["lstrip"] or t["rstrip"]]
        if odd:
            raise ValueError(f"options that are not followed: {', '.join(odd)}")
        letters, vocab = byte_letters(), model["vocab"]
        self.added = {t["content"]: t["id"] for t in about["added_tokens"]}
        self.size = 1 + max([*vocab.values(), *self.added.values()])
        spelled = dict(sorted((i, w) for w, i in (vocab | self.added).items()))
        #: The bytes of each id; none for ids without a token.
        self.bytes = [self._spelling(spelled.get(i, ""), letters) for i in range(self.size)]
        self.of_byte = np.array([vocab[c] for c, _ in sorted(letters.items(), key=lambda x: x[1])], np.int32)
        #: The merges by rank (left, right, made), and the rank of each pair as one number.
        self.merges, self.ranks = [], {}
        built = set(self.of_byte.tolist())
        for rank, pair in enumerate(model["merges"]):
            left, right = pair if isinstance(pair, list) else pair.split(" ")
            a, b, made = vocab[left], vocab[right], vocab[left + right]
            if made in built or not {a, b} <= built:
                raise ValueError(f"merge {rank} is out of order")
            built.add(made)
            self.merges.append((a, b, made))
            self.ranks[a * self.size + b] = rank
        self.keys = np.array(sorted(self.ranks), np.int64)
        self.key_ranks = np.array([self.ranks[k] for k in self.keys.tolist()], np.int32)
        self.of_two_bytes = np.full(1 << 16, -1, np.int32)
        for i, a in enumerate(self.of_byte.tolist()):
            for j, b in enumerate(self.of_byte.tolist()):
                self.of_two_bytes[i << 8 | j] = self.ranks.get(a * self.size + b, -1)
        self.cut_added = re.compile("|".join(map(re.escape, sorted(self.added, key=len, reverse=True)))) if self.added else None

    @staticmethod
    def _spelling(token: str, letters: dict[str, int]) -> bytes:
        return bytes(map(letters.__getitem__, token)) if all(c in letters for c in token) else token.encode()

    def encode_words(self, words: list[bytes]) -> list[bytes]:
        """The ids of each word, none of which is empty, as packed 32-bit integers."""
        if not words:
            return []
        data = np.frombuffer(b"".join(words), np.uint8)
        ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)))
        n, none = len(data), -1
        after, before = np.arange(1, n + 1, dtype=np.int32), np.arange(-1, n - 1, dtype=np.int32)
        after[ends - 1] = before[np.concatenate([[0], ends[:-1]])] = none
        first = self.of_two_bytes[data[:-1].astype(np.int32) << 8 | data[1:]]
        first[ends[:-1] - 1] = none
        ranked = np.flatnonzero(first >= 0)
        ranked = ranked[np.argsort(first[ranked], kind="stable")]
        starts = np.flatnonzero(np.diff(first[ranked], prepend=none))
        index = {int(first[ranked[at]]): array("i", places.astype(np.int32).tobytes()) for at, places in zip(starts, np.split(ranked, starts[1:]), strict=True)} if len(ranked) else {}
        state = tuple(array("i", x.tobytes()) for x in (self.of_byte[data], after, before))
        heap = list(index)
        heapq.heapify(heap)
        while heap:
            rank = heapq.heappop(heap)
            places = index.pop(rank)
            left, right, _ = self.merges[rank]
            # of places that overlap, as in aaa, the first is merged
            found = self._merged_many(rank, places, state) if len(places) >= MANY and left != right else self._merged(rank, sorted(places) if left == right else places, state)
            for new, at in found:
                if new not in index:
                    index[new] = array("i")
                    heapq.heappush(heap, new)
                index[new].frombytes(at) if isinstance(at, bytes) else index[new].append(at)
        symbols = state[0]
        final = np.frombuffer(symbols, np.int32)
        kept = final >= 0
        bounds = 4 * np.concatenate([[0], np.cumsum(kept)[ends - 1]])
        packed = final[kept].tobytes()
        return [packed[a:b] for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True)]

    def _merged(self, rank: int, places, state: tuple[array, array, array]) -> Iterator[tuple[int, int]]:
        """Merge the pair of ``rank`` at its ``places`` one by one; (rank, place) of the pairs that come about."""
        symbols, after, before = state
        left, right, made = self.merges[rank]
        ranks, size = self.ranks, self.size
        for at in places:
            if symbols[at] != left or (other := after[at]) < 0 or symbols[other] != right:
                continue  # a neighbour has been merged since
            symbols[at], symbols[other] = made, -1
            after[at] = beyond = after[other]
            if beyond >= 0:
                before[beyond] = at
                if (new := ranks.get(made * size + symbols[beyond])) is not None:
                    yield new, at
            if (ahead := before[at]) >= 0 and (new := ranks.get(symbols[ahead] * size + made)) is not None:
                yield new, ahead

    def _merged_many(self, rank: int, places: array, state: tuple[array, array, array]) -> Iterator[tuple[int, bytes]]:
        """The same for many places at once, none of which overlap; the new places of a rank together, packed."""
        symbols, after, before = (np.frombuffer(x, np.int32) for x in state)
        left, right, made = self.merges[rank]
        at = np.frombuffer(places, np.int32)
        at = at[symbols[at] == left]
        other = after[at]
        fits = (other >= 0) & (symbols[other] == right)
        at = np.unique(at[fits])
        other = after[at]
        symbols[at], symbols[other] = made, -1
        beyond = after[other]
        after[at] = beyond
        inner = beyond >= 0
        before[beyond[inner]] = at[inner]
        ahead = before[at]
        ahead = ahead[ahead >= 0]
        starts = np.concatenate([at[inner], ahead])
        keys = np.concatenate([np.int64(made) * self.size + symbols[beyond[inner]], symbols[ahead].astype(np.int64) * self.size + made])
        spot = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        known = self.keys[spot] == keys
        new, starts = self.key_ranks[spot[known]], starts[known]
        order = np.argsort(new, kind="stable")
        new, starts = new[order], starts[order]
        bounds = [*np.flatnonzero(np.diff(new, prepend=-1)).tolist(), len(new)]
        for a, b in zip(bounds, bounds[1:], strict=False):
            yield int(new[a]), starts[a:b].tobytes()

    def decode(self, ids: Sequence[int]) -> str:
        """The text of ids; ids without a token are left out, bytes that are no UTF-8 become the replacement character."""
        ids = np.asarray(ids, np.int64)
        return b"".join(map(self.bytes.__getitem__, ids[(ids >= 0) & (ids < self.size)].tolist())).decode("utf-8", "replace")


class Encoder:
    """Encodes texts in blocks, and remembers the ids of what stands between blanks."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import pre_tokenizers

        self.vocabulary = Vocabulary(path)
        #: Cuts words that hold other than ASCII characters, so that Unicode's classes are those of that library.
        self.cut = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=True).pre_tokenize_str
        self.known: dict[str, bytes] = {}  # pieces at the start of a line, and those of texts with runs of space
        self.spaced: dict[str, bytes] = {}  # pieces that follow a blank, without it
        self.held = 0

    def words(self, piece: str) -> list[str]:
        if piece.isascii():
            if piece.lstrip(" ").isalpha() and piece[1:2] != " ":
                return [piece]
            return ASCII_WORD.findall(piece)
        return [piece[a:b] for _, (a, b) in self.cut(piece)]

    def pieces(self, text: str) -> list[tuple[str | int, list[str]]]:
        """(first, others) for each line: what stands before its first blank and what follows each blank; or the id of an added token and nothing.

        A blank or a line end that is not inside a run of white space always begins a word, so all between is encoded alone.
        """
        tool, out, at = self.vocabulary, [], 0
        for found in [*(tool.cut_added.finditer(text) if tool.cut_added else ()), None]:
            part = text[at : found.start()] if found else text[at:]
            if INNER_SPACE.search(part):
                out += [(word, []) for word in self.words(part)]
            elif part:
                for number, line in enumerate(part.split("\n")):
                    first, *others = line.split(" ")
                    out += [("\n", [])] * (number > 0) + [(first, others)]
            if found:
                out.append((tool.added[found.group()], []))
                at = found.end()
        return out

    def learn(self, plain: set[str], spaced: set[str]) -> None:
        """Index and encode all new pieces together."""
        new = [(self.known, p, p) for p in plain.difference(self.known)] + [(self.spaced, p, " " + p) for p in spaced.difference(self.spaced)]
        cut = [self.words(whole) for _, _, whole in new]
        distinct = {w: i for i, w in enumerate(dict.fromkeys(chain.from_iterable(cut)))}
        ids = self.vocabulary.encode_words([w.encode() for w in distinct])
        for (into, piece, _), words in zip(new, cut, strict=True):
            into[piece] = b"".join([ids[distinct[w]] for w in words])
            self.held += 200 + 4 * len(piece) + len(into[piece])

    def encode(self, block: list[str]) -> list[bytes]:
        """The ids of each text, packed."""
        if self.held > CACHE_BYTES:
            self.known.clear()
            self.spaced.clear()
            self.held = 0
        cut = [self.pieces(text) for text in block]
        starts, follow = set(), set()
        for pieces in cut:
            for first, others in pieces:
                if isinstance(first, str):
                    starts.add(first)
                follow.update(others)
        self.learn(starts, follow)
        known, spaced, out = self.known, self.spaced, []
        for pieces in cut:
            joined: list[bytes] = []
            for first, others in pieces:
                joined.append(known[first] if isinstance(first, str) else first.to_bytes(4, "little"))
                joined += map(spaced.__getitem__, others)
            out.append(b"".join(joined))
        return out


@lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    return Encoder(path)


def _blocks(sizes: list[int]) -> Iterator[slice]:
    """Runs of rows of about BLOCK_TEXT bytes together."""
    start = held = 0
    for at, size in enumerate(sizes):
        held += size
        if held >= BLOCK_TEXT or at == len(sizes) - 1:
            yield slice(start, at + 1)
            start, held = at + 1, 0


def encode(rows: DataFrame, tokenizer: str = TOKENIZER) -> DataFrame:
    """``rows`` (doc_id, text) -> doc_id and ``ids``, the ids of the whole text as the tokenizers library gives them.

    Added tokens in a text become their ids, and none is added.  Null and empty texts have no ids.  Rows are encoded one by one where
    they are, so null and repeated ids and rows make no difference; other columns are not looked at, whatever their names.  An
    empty table gives an empty result.
    """
    path = public_tokenizers.path(tokenizer)

    def made(batches: Batches):
        for batch in batches:
            sizes = pc.fill_null(pc.binary_length(batch.column("text")), 0).to_numpy()
            for part in _blocks(sizes.tolist()):
                own = batch.slice(part.start, part.stop - part.start)
                packed = encoder(path).encode([(x or b"").decode() for x in texts(own, "text")])
                offsets = np.zeros(len(packed) + 1, np.int32)
                np.cumsum([len(x) // 4 for x in packed], out=offsets[1:])
                lists = pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.frombuffer(b"".join(packed), np.int32)))
                yield pa.RecordBatch.from_arrays([own.column("doc_id"), lists], names=["doc_id", "ids"])

    return rows.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(made, "doc_id long, ids array<int>")


def decode(rows: DataFrame, tokenizer: str = TOKENIZER, ids: str = "ids", text: str = "decoded") -> DataFrame:
    """``rows`` with the text of their ids in a new column; a column that has its name already is replaced.  Null ids give a null text, null entries nothing."""
    path = public_tokenizers.path(tokenizer)
    kept = [c for c in rows.columns if c != text]
    given = rows.select(*[quoted(c).alias(f"c{i}") for i, c in enumerate(kept)])  # names that any function takes
    place = kept.index(ids)

    def made(batches: Batches):
        for batch in batches:
            sizes = pc.fill_null(pc.list_value_length(batch.column(place)), 0).to_numpy()
            for part in _blocks((4 * sizes.astype(np.int64)).tolist()):
                own = batch.slice(part.start, part.stop - part.start)
                lists = own.column(place)
                flat = pc.fill_null(lists.flatten(), -1).to_numpy()  # those of rows that are not null, in order
                ends = np.cumsum(sizes[part]).tolist()
                decoder = encoder(path).vocabulary
                found = [decoder.decode(flat[a:b]) if there else None for a, b, there in zip([0, *ends], ends, lists.is_valid().to_pylist(), strict=False)]
                yield pa.RecordBatch.from_arrays([*own.columns, pa.array(found, pa.string())], names=[*own.schema.names, "decoded"])

    return given.mapInArrow(made, StructType([*given.schema.fields, StructField("decoded", StringType())])).toDF(*kept, text)
