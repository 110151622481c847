"""Listed folders of any depth and listed pages against brute force; keys that no page can have."""

import pytest

from chunkloom.llm import url_filters

PATHS = ("", "/", "/a", "/a/", "/a/b", "/a/b/", "/a/b/c.html", "/a/b/c.html?q=1", "//x/y", "/a//b", "/b/a/b/c.html#f")


def test_every_prefix_of_a_path_can_be_listed(spark):
    urls = [f"http://{h}{p}" for h in ("h.com", "s.h.com", "xh.com") for p in PATHS]
    rows = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")
    for key in ("h.com/", "h.com/a/", "h.com/a/b/", "s.h.com/a/b/c.html", "h.com/a/b", "h.com//x/"):
        found = url_filters.judge_urls(rows, spark.createDataFrame([(key,)], "key string"), rules=()).collect()
        at, _, place = key.partition("/")
        for r in found:
            path = "/" + place
            fits = r["path"].startswith(path) if path.endswith("/") else r["path"] == path
            assert r["listed"] == ((r["host"] == at or r["host"].endswith("." + at)) and fits), (key, r["url"])


@pytest.mark.parametrize("key", ["http://h.com/a/", "H.com", "h.com/a?q=1", "/a/", "", "h.com#f"])
def test_keys_that_no_page_has_raise(spark, key):
    rows = spark.createDataFrame([(1, "http://h.com/a/")], "page_id long, url string")
    with pytest.raises(ValueError):
        url_filters.judge_urls(rows, spark.createDataFrame([(key,), (None,), ("h.com",)], "key string"))


def test_columns_that_clash_and_repeated_rows(spark):
    rows = spark.createDataFrame([(1, "http://a.com/x", "u", "v", "k", "h", "i", "r")] * 2 + [(2, None, *["z"] * 6)], "page_id long, url string, host string, verdict string, _keys string, _h1 string, listed string, row string")
    found = url_filters.judge_urls(rows, spark.createDataFrame([("a.com",)], "key string"), rules=())
    assert set(found.columns) == {"page_id", "url", "_keys", "_h1", "row", "host", "path", "rule", "listed", "verdict"}
    assert sorted((r["page_id"], r["verdict"], r["_keys"], r["row"]) for r in found.collect()) == [(1, "block", "k", "r")] * 2 + [(2, "allow", "z", "z")]


def test_the_list_grows_with_the_table(spark):
    rows = [(n, f"http://h{n % 50}.com/f{n % 400}/p{n}") for n in range(4000)]
    listed = [url_filters.listed_keys(spark.createDataFrame(rows[:n], "page_id long, url string")).count() - len(url_filters.LISTED) for n in (400, 4000)]
    assert 10 < listed[0] < 60 and 150 < listed[1] < 400
