import duckdb
import pytest

import __spark_entry__ as entry
from chunkloom.plans import queries as plans

FOLDER = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{FOLDER}/{t}.parquet'")
    return con


def rows(columns, values):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(str(round(v[i], 6) if isinstance(v[i], float) else v[i]) for i in order) for v in values)


@pytest.mark.parametrize("name", sorted(plans.QUERIES))
def test_query(spark, duck, name):
    found = plans.QUERIES[name](spark, FOLDER)
    got = found.collect()
    if name in plans.ORACLES:
        said = duck.execute(plans.ORACLES[name])
        columns = [d[0] for d in said.description]
        assert sorted(columns) == sorted(found.columns)
        assert rows(found.columns, got) == rows(columns, said.fetchall())
    elif name not in ("empty_pages",):
        assert got


@pytest.mark.parametrize("name", ["block_split_counts", "chunk_texts", "chunks_overlapping"])
def test_texts_are_not_cut_for_a_filter(spark, name):
    """A condition on what is made of a text would be moved below the dealing out, to the scan, and make it all once more."""
    plan = plans.QUERIES[name](spark, FOLDER)._jdf.queryExecution().optimizedPlan().toString()
    assert "posexplode" in plan or "explode" in plan
    assert not [line for line in plan.split("\n") if "Filter (" in line and "regexp" in line.split("Filter (", 1)[1]]


def test_entry(spark):
    assert entry.entry(spark).count() > 0
    assert set(plans.QUERIES) <= set(entry.queries()) and set(entry.oracle_sql()) <= set(entry.queries())


def test_core_does_not_know_the_training_operators():
    import re
    from pathlib import Path

    top = Path(plans.__file__).parents[1]
    for path in top.rglob("*.py"):
        if "llm" not in path.relative_to(top).parts:
            assert not re.search(r"\bllm\b|corpus_pipeline", path.read_text()), path
