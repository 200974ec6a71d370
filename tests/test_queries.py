"""Every registered query against its SQL in DuckDB, on the smallest tables."""

import duckdb
import pytest

import __spark_entry__ as entry

DIR = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
NAMES = [n for n in entry.oracle_sql() if not n.startswith("op")]


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    con.execute("set timezone = 'UTC'")
    for t in TABLES:
        con.execute(f"create view {t} as select * from read_parquet('{DIR}/{t}.parquet')")
    return con


def plain(value):
    if isinstance(value, float):
        return f"{value:.9g}"
    if isinstance(value, (list, tuple)):
        return [plain(x) for x in value]
    return str(value)


@pytest.mark.parametrize("name", NAMES)
def test_query(spark, duck, name):
    df = entry.queries()[name](spark, DIR)
    found = duck.execute(entry.oracle_sql()[name])
    columns = [c[0] for c in found.description]
    assert sorted(df.columns) == sorted(columns)
    order = sorted(columns)
    ours = sorted(str(plain([r[c] for c in order])) for r in df.collect())
    theirs = sorted(str(plain([r[columns.index(c)] for c in order])) for r in found.fetchall())
    assert ours == theirs


def test_entry(spark):
    assert entry.entry(spark).count() > 0


def test_entry_without_the_optional_modules(monkeypatch):
    import importlib

    def refuse(name, *rest):
        if name.startswith("quaver.llm") or name == "corpus_pipeline":
            raise ModuleNotFoundError(f"No module named '{name}'")
        return real(name, *rest)

    real = importlib.import_module
    monkeypatch.setattr(importlib, "import_module", refuse)
    assert "bar_polyphony" in entry.queries() and not [n for n in entry.queries() if n.startswith("op") or n == "pipeline"]
    assert set(entry.oracle_sql()) <= set(entry.queries())
