"""Packing where a chunk's room depends on the text of the one before: overlap, and tokenizers whose counts do not add up.

That chain is sequential within a page, so a page is packed by a small Python step; pages stay where they are, and numbers,
ids, texts and links are made by the same expressions as for other chunks.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from functools import lru_cache
from itertools import groupby

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql.types import LongType, StructField, StructType

from ..config import STRATEGIES as known_strategies
from ..config import Config
from ..functions.text import SENTENCE_END, SPACE, TOKEN, WORD, quoted
from .chunks import HELD, LEAST_ROOM, PAGE_COLUMNS

_TOKEN, _END = regex.compile(TOKEN), regex.compile(SENTENCE_END)
#: Characters below this, among them all white space, are looked up in classes that are written out, by Python's own and faster engine.
COMMON = 0x3001


def _written_out(kind: str) -> str:
    """The characters of a class below COMMON as ranges."""
    found = [c for c in range(COMMON) if regex.fullmatch(f"[{kind}]", chr(c))]
    runs = [[c for _, c in run] for _, run in groupby(enumerate(found), lambda x: x[1] - x[0])]
    return "".join(f"\\u{run[0]:04x}-\\u{run[-1]:04x}" for run in runs)


_WORD_CHARS, _SPACE_CHARS = _written_out(WORD), _written_out(SPACE)
_COMMON_TOKEN = re.compile(f"[{_WORD_CHARS}]+|[^{_WORD_CHARS}{_SPACE_CHARS}]")
_RARE = re.compile(f"[^\\u0000-\\u{COMMON - 1:04x}]")
_SPACE = re.compile(f"[{_SPACE_CHARS}]+")
_BLANK = "".join(chr(c) for c in range(COMMON) if _SPACE.fullmatch(chr(c)))
_HEADING = regex.compile("h[1-6]")
#: Counts that a worker remembers, and texts that are encoded together.
KEPT_COUNTS, BATCH_TEXTS = 1 << 15, 256
#: Characters shown of a neighbour of which not one sentence or run of words fits.
SHOWN_CHARS = 200


# a block's sentences are looked at several times, alone and as beginnings of what is left of it
@lru_cache(KEPT_COUNTS)
def simple_count(text: str) -> int:
    return len((_TOKEN if not text.isascii() and _RARE.search(text) else _COMMON_TOKEN).findall(text))


@lru_cache(maxsize=2)
def tokenizer_count(path: str) -> Callable[[str], int]:
    """Counts by a tokenizer file, loaded once in each worker."""
    try:
        from tokenizers import Tokenizer
    except ImportError as problem:
        raise RuntimeError("the strategy 'tokenizer' needs the tokenizers library") from problem
    tokenizer = Tokenizer.from_file(path)
    return lru_cache(KEPT_COUNTS)(lambda text: len(tokenizer.encode_batch_fast([text], add_special_tokens=False)[0]))


def tokenizer_counts(rows: DataFrame, path: str, text: str = "text", into: str = "n_tokens") -> DataFrame:
    """``rows`` with the number of their text's tokens by a tokenizer file in column ``into``; null texts have none.

    Texts are encoded a batch at a time, so the library may use what it has for many; a column named ``into`` is replaced.
    """
    kept = [c for c in rows.columns if c != into]
    place = kept.index(text)
    given = rows.select(*[quoted(c).alias(f"c{i}") for i, c in enumerate(kept)])  # plain names on the way

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from tokenizers import Tokenizer

        tokenizer = Tokenizer.from_file(path)
        for batch in batches:
            for start in range(0, batch.num_rows, BATCH_TEXTS):
                own = batch.slice(start, BATCH_TEXTS)
                found = tokenizer.encode_batch_fast([t or "" for t in own.column(place).to_pylist()], add_special_tokens=False)
                yield own.append_column("n", pa.array([len(e.ids) for e in found], pa.int64()))

    return given.mapInArrow(counted, StructType([*given.schema.fields, StructField("n", LongType())])).toDF(*kept, into)


def sentences(text: str) -> list[str]:
    return [s for s in (s.strip(_BLANK) for s in _END.sub("\\1\x01", text).split("\x01")) if s]


def words(text: str) -> list[str]:
    return [w for w in _SPACE.split(text) if w]


#: How texts are counted, by the name that the setting ``strategy`` has; each makes a function from text to tokens in a worker.
STRATEGIES: dict[str, Callable[[Config], Callable[[str], int]]] = {"simple": lambda config: simple_count, "tokenizer": lambda config: tokenizer_count(config.tokenizer_path)}


def register_strategy(name: str, build: Callable[[Config], Callable[[str], int]]) -> None:
    """Make a way of counting known by a name.  ``build`` goes to the workers, so it must be picklable."""
    known_strategies.add(name)
    STRATEGIES[name] = build


class Packer:
    """The chunks of one page at a time."""

    def __init__(self, config: Config, build: Callable[[Config], Callable[[str], int]] | None = None):
        self.c = config
        self.count = (build or STRATEGIES[config.strategy])(config)

    def fitting(self, texts: list[str], cap: int) -> int:
        """How many of the first texts fit together."""
        used = 0
        for n, t in enumerate(texts):
            used += self.count(t)
            if used > cap:
                return n
        return len(texts)

    def bins(self, texts: list[str], cap: int) -> list[str]:
        out = []
        while texts:
            n = max(1, self.fitting(texts, cap))
            out.append(" ".join(texts[:n]))
            texts = texts[n:]
        return out

    def parts(self, text: str, cap: int) -> list[str]:
        """Whole sentences as far as they fit together; a longer one in runs of words."""
        out, held = [], []
        for s in [*sentences(text), None]:
            if s is None or self.count(s) > cap:
                out += self.bins(held, cap)
                held = []
                out += [] if s is None else self.bins(words(s), cap)
            else:
                held.append(s)
        return out

    def prefix(self, text: str, cap: int, must_take: bool) -> tuple[str, str]:
        units = sentences(text)
        n = self.fitting(units, cap)
        if not n and must_take:
            units = words(text)
            n = max(1, self.fitting(units, cap))
        return (" ".join(units[:n]), " ".join(units[n:])) if n else ("", text)

    def tags(self, title: str, hierarchy: list[str]) -> int:
        lines = [f"[PAGE] {title}"] if self.c.page_tag and title.strip() else []
        shown = hierarchy[: self.c.max_heading_levels]
        lines += [f"[SECTION] {' > '.join(shown)}"] if self.c.section_tag and shown else []
        return self.count("\n".join([*lines, "[TEXT] "])) if lines else 0

    def blocks(self, pieces: list[dict], title: str) -> list[dict]:
        """Blocks with the headings they stand under; those too long for a chunk are cut."""
        out, stack = [], []
        for p in pieces:
            if heading := bool(_HEADING.fullmatch(p["block_type"])):
                stack = [h for h in stack if h["block_type"] < p["block_type"]] + [p]
            under = {"hierarchy": [h["text"] for h in reversed(stack)], "nearest": stack[-1]["html_id"] if stack else None}
            cap = max(LEAST_ROOM, self.c.chunk_size - self.tags(title, under["hierarchy"]) - 2 * self.c.chunk_overlap)
            texts = [p["text"]] if heading or self.count(p["text"]) <= cap else self.parts(p["text"], cap)
            out += [p | under | {"text": t} for t in texts]
        return out

    def shown(self, core: list[dict], from_end: bool) -> list[dict]:
        """What a neighbour shows of ``core``: parts (k, text) from its end or start, within the overlap."""
        left, out = self.c.chunk_overlap, []
        order = range(len(core) - 1, -1, -1) if from_end else range(len(core))
        for k in order:
            if left <= 0:
                break
            n = self.count(core[k]["text"])
            if n <= left:
                out.append({"k": k, "text": core[k]["text"]})
                left -= n
                continue
            cut = self.parts(core[k]["text"], left)
            near = cut[::-1] if from_end else cut
            taken = near[: self.fitting(near, left)]
            text = " ".join(taken[::-1] if from_end else taken) or near[0][:SHOWN_CHARS]
            out.append({"k": k, "text": text})
            break
        return out[::-1] if from_end else out

    def __call__(self, pieces: list[dict], title: str) -> list[dict]:
        c, blocks, out, at = self.c, self.blocks(pieces, title), [], 0
        while at < len(blocks):
            prev = self.shown(out[-1]["f"], True) if out and c.chunk_overlap else []
            first = out[-1]["f"][prev[0]["k"]] if prev else blocks[at]
            free = c.chunk_size - self.tags(title, first["hierarchy"]) - self.count(" ".join(x["text"] for x in prev)) - c.chunk_overlap
            if free <= 0:
                prev, first = [], blocks[at]
                room = c.chunk_size - self.tags(title, first["hierarchy"])
                free = next((n for n in (room - c.chunk_overlap, room) if n > 0), max(LEAST_ROOM, c.chunk_size // 4))
            core: list[dict] = []
            while at < len(blocks) and free > 0:
                b, n = blocks[at], self.count(blocks[at]["text"])
                if n > free:
                    taken, rest = self.prefix(b["text"], free, must_take=not core)
                    if taken:
                        core.append(b | {"text": taken})
                        if rest:
                            blocks[at] = b | {"text": rest}
                        else:
                            at += 1
                    break
                core.append(b)
                free -= n
                at += 1
            out.append({"html_id": first["nearest"], "hierarchy": first["hierarchy"], "f": core, "prev": prev, "next": []})
        for chunk, follower in zip(out, out[1:], strict=False):
            chunk["next"] = self.shown(follower["f"], False)
        return out


_PART = pa.struct([(n, pa.string()) for n in ("block_type", "xpath", "css_selector", "html_id", "text")])
_SHOWN = pa.list_(pa.struct([("k", pa.int32()), ("text", pa.string())]))
_HELD = pa.list_(pa.struct([("html_id", pa.string()), ("hierarchy", pa.list_(pa.string())), ("f", pa.list_(_PART)), ("prev", _SHOWN), ("next", _SHOWN)]))


def packed_overlapping(rows: DataFrame, config: Config) -> DataFrame:
    """``rows`` with ``held`` in place of ``pieces``."""

    build = STRATEGIES[config.strategy]  # workers know those of the library alone

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer = Packer(config, build)
        for batch in batches:
            held = [packer(p, t) for p, t in zip(batch.column("pieces").to_pylist(), batch.column("title").to_pylist(), strict=True)]
            kept = batch.drop_columns(["pieces"])
            yield pa.RecordBatch.from_arrays([*kept.columns, pa.array(held, _HELD)], names=[*kept.schema.names, "held"])

    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema if f.name in PAGE_COLUMNS)
    return rows.mapInArrow(pack, f"{kinds}, held {HELD}")
