"""Settings of the chunking engine, from code or from environment variables."""

from __future__ import annotations

import re
from collections.abc import Mapping
from dataclasses import dataclass, field, fields, replace

_IDENTIFIER = re.compile(r"[A-Za-z_][A-Za-z0-9_]*")
#: Names of the ways of counting tokens; ``operators.overlap.register_strategy`` adds to them.
STRATEGIES = {"simple", "tokenizer"}
SENTENCE_BACKENDS = ("regex",)


def is_identifier(name: str) -> bool:
    """Whether ``name`` is safe as the name of a table."""
    return bool(_IDENTIFIER.fullmatch(name.strip()))


@dataclass(frozen=True)
class Config:
    """All options with their defaults; ``validate`` reports every wrong one at once."""

    # source
    base_url: str = ""
    token: str = field(default="", repr=False)
    page_ids: tuple[str, ...] = ()
    page_size: int = 100
    timeout_s: int = 30
    max_retries: int = 3
    max_concurrent_requests: int = 10
    max_ids_per_batch: int = 10_000
    # chunks
    chunk_size: int = 512
    chunk_overlap: int = 0
    strategy: str = "simple"
    tokenizer_path: str = ""
    sentence_backend: str = "regex"
    max_heading_levels: int = 2
    page_tag: bool = True
    section_tag: bool = True
    # pages
    # The tags that form blocks, and those that are left out.
    block_tags: tuple[str, ...] = ("p", "div", "blockquote", "pre", "ul", "ol", "table", "h1", "h2", "h3", "h4", "h5", "h6", "section", "article", "figure", "figcaption")
    excluded_tags: tuple[str, ...] = ("code", "script", "style", "hr", "nav", "header", "footer")
    excluded_classes: tuple[str, ...] = ()
    excluded_ids: tuple[str, ...] = ()
    # sinks
    json_enabled: bool = True
    table_enabled: bool = False
    include_blocks: bool = False
    output_dir: str = "output"
    output_prefix: str = "chunks"
    table_name: str = "chunks"
    replace_pages: bool = False
    extra_sinks: tuple[str, ...] = ()

    @classmethod
    def from_env(cls, env: Mapping[str, str], prefix: str = "CHUNKLOOM_") -> Config:
        """Options from variables such as CHUNKLOOM_CHUNK_SIZE: true/false in any case, lists cut at commas."""
        given = {}
        for option in fields(cls):
            text = env.get(prefix + option.name.upper())
            if text is None:
                continue
            if isinstance(option.default, bool):
                given[option.name] = text.strip().lower() == "true"
            elif isinstance(option.default, int):
                given[option.name] = int(text)
            elif isinstance(option.default, tuple):
                given[option.name] = tuple(x.strip() for x in text.split(",") if x.strip())
            else:
                given[option.name] = text
        return cls(**given)

    def validate(self) -> Config:
        """This object, or a ValueError that names every wrong option."""
        wrong = [f"{n} must be positive" for n in ("page_size", "timeout_s", "max_retries", "max_concurrent_requests", "max_ids_per_batch", "chunk_size", "max_heading_levels") if getattr(self, n) < 1]
        if self.chunk_overlap < 0 or self.chunk_overlap >= self.chunk_size:
            wrong.append("chunk_overlap must be 0 or more and less than chunk_size")
        if self.strategy not in STRATEGIES:
            wrong.append(f"strategy must be one of {', '.join(sorted(STRATEGIES))}")
        if self.strategy == "tokenizer" and not self.tokenizer_path:
            wrong.append("strategy tokenizer needs tokenizer_path")
        if self.sentence_backend not in SENTENCE_BACKENDS:
            wrong.append(f"sentence_backend must be one of {', '.join(SENTENCE_BACKENDS)}")
        if not self.json_enabled and not self.table_enabled and not self.extra_sinks:
            wrong.append("no sink is enabled")
        if self.table_enabled and not is_identifier(self.table_name):
            wrong.append("table_name must be an identifier")
        if "/" in self.output_prefix:
            wrong.append("output_prefix must not name a folder")
        if wrong:
            raise ValueError("; ".join(wrong))
        return self

    def with_(self, **changes) -> Config:
        return replace(self, **changes)

    def display(self) -> dict[str, object]:
        """All options for a log, with the token hidden."""
        return {f.name: ("set" if self.token else "not set") if f.name == "token" else getattr(self, f.name) for f in fields(self)}
