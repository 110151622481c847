import regex
from pyspark.sql import functions as F

from chunkloom.config import Config
from chunkloom.functions.text import SPACE
from chunkloom.operators.chunks import chunk_pages, page_rows, unfold
from chunkloom.operators.overlap import packed_overlapping, simple_count
from chunkloom.sources.tables import conversation_pages, parsed_pages, text_pages


def documents(spark, texts):
    return spark.createDataFrame([(i, t, "s") for i, t in enumerate(texts)], "doc_id long, text string, source string")


TEXTS = [
    "One two three. Four five six! Seven eight? " * 7 + "\nLine two is here.\n" + "word " * 50,
    None,
    "",
    "\n \n",
    "a  b   c.\nd",
    " ".join(f"w{i}" for i in range(120)) + ".",
    "Short.\n" * 30,
]
HTML = "<body><h1 id='top'>Alpha</h1><p>" + "Some words here. " * 9 + "</p><h2>Beta</h2><p>x y z.</p><h1>Gamma</h1><ul><li>one</li><li>two</li></ul></body>"


def plain(text):
    return regex.sub(f"[{SPACE}]+", " ", text).strip()


def test_nothing_is_lost_and_chunks_are_bounded(spark):
    config = Config(chunk_size=24)
    rows = chunk_pages(text_pages(documents(spark, TEXTS)), config).orderBy("page_id", "chunk_no").collect()
    for i, text in enumerate(TEXTS):
        own = [r for r in rows if r["page_id"] == str(i)]
        assert " ".join(plain(r["normalized_text"]) for r in own) == plain(text or "")
        assert all(simple_count(r["normalized_text"]) <= 24 for r in own)
        indices = [k for r in own for k in r["core_block_indices"]]
        assert indices == list(range(len(indices)))
        offset = 0
        for r in own:
            assert r["text_offset_start"] == offset
            for f in r["highlight_metadata"]["core_fragments"]:
                assert f["text_offset"] == offset and f["text_length"] == len(f["text"])
                offset += f["text_length"] + 1


def test_native_and_sequential_packing_agree(spark):
    pages = parsed_pages(spark.createDataFrame([(1, "http://h/p", HTML)], "page_id long, url string, html string"), Config())
    for source in (text_pages(documents(spark, TEXTS)), pages):
        for size in (24, 40, 512):
            config = Config(chunk_size=size)
            key = ["page_id", "chunk_no"]
            native = chunk_pages(source, config).orderBy(*key).collect()
            other = unfold(packed_overlapping(page_rows(source), config), config).orderBy(*key).collect()
            assert native == other


def test_headings_and_links(spark):
    pages = parsed_pages(spark.createDataFrame([(1, "http://h/p", "<title>T</title>" + HTML)], "page_id long, url string, html string"), Config())
    rows = chunk_pages(pages, Config(chunk_size=30)).orderBy("chunk_no").collect()
    assert rows[0]["navigation_url"] == "http://h/p#top" and rows[0]["full_heading_hierarchy"] == ["Alpha"]
    assert rows[0]["embedding_text"].startswith("[PAGE] T\n[SECTION] Alpha\n[TEXT] Alpha")
    assert rows[-1]["normalized_text"].endswith("one two")
    assert all(simple_count(r["embedding_text"]) <= 30 for r in rows)


def test_overlap(spark):
    config = Config(chunk_size=24, chunk_overlap=6)
    rows = chunk_pages(text_pages(documents(spark, ["One two three. Four five six! " * 10])), config).orderBy("chunk_no").collect()
    assert plain(" ".join(r["normalized_text"] for r in rows)) == plain("One two three. Four five six! " * 10)
    for a, b in zip(rows, rows[1:], strict=False):
        assert a["normalized_text"].endswith(b["overlap_prev_text"]) and b["overlap_prev_text"]
        assert b["normalized_text"].startswith(a["overlap_next_text"]) and a["overlap_next_text"]
        assert b["full_text"] == " ".join(t for t in (b["overlap_prev_text"], b["normalized_text"], b["overlap_next_text"]) if t)
    assert not rows[0]["overlap_prev_text"] and not rows[-1]["overlap_next_text"]
    assert max(simple_count(r["full_text"]) for r in rows) <= 24


def test_tokenizer_strategy(spark):
    import public_tokenizers

    config = Config(chunk_size=24, strategy="tokenizer", tokenizer_path=public_tokenizers.path("word_bpe_49k.json"))
    rows = chunk_pages(text_pages(documents(spark, [TEXTS[0]])), config.validate()).orderBy("chunk_no").collect()
    assert plain(" ".join(r["normalized_text"] for r in rows)) == plain(TEXTS[0])


def test_conversations(spark):
    turns = spark.createDataFrame([(1, 1, "user", "Second."), (1, 0, "system", "First."), (2, 0, "user", None)], "conv_id long, turn long, role string, text string")
    rows = chunk_pages(conversation_pages(turns), Config()).collect()
    assert [(r["page_id"], r["normalized_text"]) for r in rows] == [("1", "First. Second.")]


def test_empty_table(spark):
    empty = documents(spark, ["x"]).where(F.lit(False))
    assert chunk_pages(text_pages(empty), Config()).count() == 0
    assert chunk_pages(text_pages(empty), Config(chunk_overlap=8)).count() == 0


def parts_by_hand(text, cap):
    """Next-fit over sentences; a sentence too long for a part is cut into parts of words."""
    from chunkloom.operators.overlap import sentences

    out, held = [], []

    def close(sep_units):
        if sep_units:
            out.append(" ".join(sep_units))

    for s in sentences(text):
        if simple_count(s) > cap:
            close(held)
            held, run = [], []
            for w in regex.split(f"[{SPACE}]+", s):
                if run and simple_count(" ".join([*run, w])) > cap:
                    close(run)
                    run = []
                run.append(w)
            close(run)
        elif held and simple_count(" ".join([*held, s])) > cap:
            close(held)
            held = [s]
        else:
            held.append(s)
    close(held)
    return out


def test_overlap_shows_as_much_as_fits(spark):
    """Whole blocks of the neighbour from its near side as long as they fit, then as many parts of the next block as fit."""
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").where("n_chars < 4000")
    rows = chunk_pages(text_pages(docs), Config(chunk_size=96, chunk_overlap=16)).orderBy("page_id", "chunk_no").collect()
    cut_blocks = whole_blocks = 0
    for a, b in zip(rows, rows[1:], strict=False):
        if a["page_id"] != b["page_id"]:
            continue
        before = (a["highlight_metadata"]["core_fragments"][::-1], b["highlight_metadata"]["overlap_prev_fragments"][::-1], -1)
        after = (b["highlight_metadata"]["core_fragments"], a["highlight_metadata"]["overlap_next_fragments"] or [], 1)
        for core, shown, way in (before, after):
            left, expected = 16, []
            for c in core:
                if left <= 0:
                    break
                n = simple_count(c["text"])
                if n <= left:
                    expected.append((c["block_index"], c["text"]))
                    left, whole_blocks = left - n, whole_blocks + 1
                    continue
                near = parts_by_hand(c["text"], left)[::way]
                fits = max(k for k in range(len(near) + 1) if sum(map(simple_count, near[:k])) <= left)
                expected.append((c["block_index"], " ".join(near[:fits][::way]) or near[0][:200]))
                cut_blocks += 1
                break
            if shown or way == 1:  # what comes before is left out for want of room
                assert [(s["block_index"], s["text"]) for s in shown] == expected
    assert whole_blocks > 100 and cut_blocks > 50


def test_counts_by_written_out_classes():
    """The fast classes say the same as Unicode's, and what a block holds is counted once, not each time that it is looked at."""
    import random

    import regex

    from chunkloom.functions.text import SPACE, TOKEN
    from chunkloom.operators import overlap

    chars = [chr(c) for c in range(0x11000) if not 0xD800 <= c < 0xE000]
    for text in [*("".join(chars[i : i + 64]) for i in range(0, len(chars), 64)), *(f"a{c}b {c}" for c in chars[:0x3100])]:
        assert simple_count(text) == len(regex.findall(TOKEN, text)), text
    rng = random.Random(3)
    for _ in range(500):
        text = "".join(rng.choices("ab.!? \t\n\x1c\x85\xa0\u2003\u3000\u200b»…)漢é", k=30))
        assert overlap.words(text) == [w for w in regex.split(f"[{SPACE}]+", text) if w]
        assert overlap.sentences(text) == [s for s in (regex.sub(f"^[{SPACE}]+|[{SPACE}]+$", "", x) for x in regex.sub(overlap._END, lambda m: m[1] + "\x01", text).split("\x01")) if s]
    simple_count.cache_clear()
    line = " ".join(f"Word{i} of a sentence." for i in range(400))
    overlap.Packer(Config(chunk_size=96, chunk_overlap=16))([{"block_type": "p", "text": line, "xpath": "", "css_selector": None, "html_id": None}], "")
    seen = simple_count.cache_info()
    assert seen.hits > seen.misses
