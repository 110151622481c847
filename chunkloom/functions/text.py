"""Text functions as Column expressions; they stay in the JVM."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps
from typing import TypeVar

from pyspark import SparkContext
from pyspark.sql import Column
from pyspark.sql import functions as F

#: Regex class bodies that mean the same to Java, RE2 and Python: word characters and white space.
WORD = r"\p{L}\p{N}_"
SPACE = r"\t-\r\x1c-\x20\x85\p{Z}"
TOKEN = rf"[{WORD}]+|[^{WORD}{SPACE}]"
SENTENCE_END = rf"([.!?…]+[)\]\"'»]*)(?:[{SPACE}]+|$)"
CUT = "\x01"
ID_PREFIX = "EDU"


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of ``value``, which is computed once however often ``body`` uses it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


Made = TypeVar("Made")


def built_once(make: Callable[..., Made]) -> Callable[..., Made]:
    """``make``, whose Columns are built once for each choice of arguments.

    A large expression is thousands of calls to the JVM, some seconds; it names columns and holds no data, so every plan can share it.
    """
    held: dict[tuple, Made] = {}

    @wraps(make)
    def get(*args) -> Made:
        key = (id(SparkContext._gateway), *args)
        if key not in held:
            held[key] = make(*args)
        return held[key]

    return get


def quoted(name: str) -> Column:
    """The column of that name, whatever characters it has."""
    return F.col("`" + name.replace("`", "``") + "`")


def trim_space(text: Column) -> Column:
    return F.regexp_replace(text, rf"^[{SPACE}]+|[{SPACE}]+$", "")


def normalize_space(text: Column) -> Column:
    """Non-breaking spaces, line ends and runs of blanks as one space; no white space at either end."""
    plain = F.regexp_replace(F.replace(text, F.lit(" "), F.lit(" ")), r"[ \t]*[\r\n]+[ \t]*", " ")
    return trim_space(F.regexp_replace(plain, r"[ \t]+", " "))


def count_tokens(text: Column) -> Column:
    """Words and single symbols; 0 for an empty text, null for null."""
    return F.regexp_count(text, F.lit(TOKEN)).cast("long")


def sentences(text: Column) -> Column:
    """Sentences without white space around them: a cut follows end marks, with any closing marks, before white space."""
    marked = F.regexp_replace(F.translate(text, CUT, " "), SENTENCE_END, "$1" + CUT)
    return F.filter(F.transform(F.split(marked, CUT), trim_space), lambda s: s != "")


def words(text: Column) -> Column:
    return F.array_remove(F.split(text, rf"[{SPACE}]+"), "")


def page_tag_text(title: Column) -> Column:
    return F.concat(F.lit("[PAGE] "), title)


def section_tag_text(hierarchy: Column) -> Column:
    return F.concat(F.lit("[SECTION] "), F.array_join(hierarchy, " > "))


def embedding_text(title: Column, hierarchy: Column, text: Column, page_tag: bool = True, section_tag: bool = True) -> Column:
    """Title, headings and text on lines of their own, each with its tag; the bare text without tags."""
    no_line = F.lit(None).cast("string")
    body = trim_space(text)
    has_title, has_section = F.coalesce(trim_space(title), F.lit("")) != "", F.size(hierarchy) > 0
    page = F.when(has_title, page_tag_text(trim_space(title))) if page_tag else no_line
    section = F.when(has_section, section_tag_text(hierarchy)) if section_tag else no_line
    tagged = F.concat_ws("\n", page, section, F.concat(F.lit("[TEXT] "), body))
    return F.when(page.isNull() & section.isNull(), body).otherwise(tagged)


def tag_tokens(title: Column, hierarchy: Column, page_tag: bool = True, section_tag: bool = True) -> Column:
    """Tokens that title, headings and tags take up in the embedding text."""
    zero = F.lit(0).cast("long")
    has_title, has_section = F.coalesce(trim_space(title), F.lit("")) != "", F.size(hierarchy) > 0
    page = F.when(has_title, count_tokens(page_tag_text(title))).otherwise(zero) if page_tag else zero
    section = F.when(has_section, count_tokens(section_tag_text(hierarchy))).otherwise(zero) if section_tag else zero
    return let(page + section, lambda n: F.when(n > 0, n + 3).otherwise(n))


def url_quote(text: Column) -> Column:
    """Percent-encoding that leaves ``/``, ``~`` and unreserved characters, and writes a space as %20."""
    coded = F.url_encode(text)
    for old, new in (("+", "%20"), ("%2F", "/"), ("%7E", "~"), ("*", "%2A")):
        coded = F.replace(coded, F.lit(old), F.lit(new))
    return coded


def navigation_url(url: Column, first_id: Column, heading_id: Column, text: Column) -> Column:
    """A link to the block's own anchor, else to the heading's, else to the first 80 characters of the text."""
    anchor = F.coalesce(F.nullif(first_id, F.lit("")), F.nullif(heading_id, F.lit("")))
    fragment = F.concat(F.lit(":~:text="), url_quote(trim_space(F.substring(text, 1, 80))))
    return F.concat(url, F.lit("#"), F.coalesce(anchor, fragment))


def block_id(page_id: Column, index: Column) -> Column:
    return F.concat(F.lit(ID_PREFIX + ":"), page_id, F.lit("-"), index.cast("string"))


def chunk_id(page_id: Column, first: Column, last: Column) -> Column:
    return F.concat(F.lit(ID_PREFIX + ":"), page_id, F.lit(":"), first.cast("string"), F.lit("-"), last.cast("string"))


def page_of_block(block: Column) -> Column:
    """The page of a block's id, or null for any other text."""
    return F.nullif(F.regexp_extract(block, rf"(?s)^{ID_PREFIX}:(.*)-[^-]*$", 1), F.lit(""))


def absolute_url(url: Column, base: str) -> Column:
    return F.when((url != "") & ~url.startswith("http"), F.concat(F.lit(base), url)).otherwise(url)
