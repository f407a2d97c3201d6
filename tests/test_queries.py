"""Every registered query with SQL gives the rows that DuckDB gives."""

import difflib
import math
import unicodedata

import duckdb
import pandas as pd
import pytest

from folioflow import plans

DATA = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def duck():
    c = duckdb.connect()
    for t in TABLES:
        c.sql(f"create view {t} as select * from read_parquet('{DATA}/{t}.parquet')")
    return c


def plain(v):
    if v is None or v is pd.NaT or v is pd.NA or (isinstance(v, float) and math.isnan(v)):
        return None
    if hasattr(v, "item") and not hasattr(v, "__len__"):
        v = v.item()
    if isinstance(v, float):
        return int(v) if v == int(v) else float(f"{v:.9g}")
    return v if isinstance(v, (int, bool)) else str(v)


def rows(df):
    df = df[sorted(df.columns)]
    return list(df.columns), sorted((tuple(plain(v) for v in r) for r in df.itertuples(index=False)), key=repr)


@pytest.mark.parametrize("name", sorted(plans.ORACLES))
def test_oracle(spark, duck, name):
    assert rows(plans.QUERIES[name](spark, DATA).toPandas()) == rows(duck.sql(plans.ORACLES[name]).df())


def test_few_queries_have_no_sql():
    assert set(plans.QUERIES) - set(plans.ORACLES) == {"f43_unicode_normalization", "f47_sequence_ratio", "m1_text_clusters", "m5_vector_clusters"}


def test_unicode_normalization(spark, duck):
    docs = duck.sql("select doc_id, text from documents").fetchall()
    got = {r["doc_id"]: r["clean"] for r in plans.QUERIES["f43_unicode_normalization"](spark, DATA).collect()}
    assert len(got) == len(docs)
    for i, t in docs:  # the given texts have no marks to fold: words stay, white space collapses
        assert got[i] == " ".join(unicodedata.normalize("NFKC", t or "").replace("-\n", "").split())


def test_sequence_ratio(spark, duck):
    items = duck.sql("select item_id, text from benchmark").fetchall()
    got = {r["item_id"]: r["ratio"] for r in plans.QUERIES["f47_sequence_ratio"](spark, DATA).collect()}
    assert got == {i: difflib.SequenceMatcher(None, t, t[::-1]).ratio() for i, t in items}


@pytest.mark.parametrize("name, table, key, most", [("m1_text_clusters", "documents", "doc_id", 8), ("m5_vector_clusters", "embeddings", "vec_id", 6)])
def test_clusters(spark, duck, name, table, key, most):
    got = plans.QUERIES[name](spark, DATA).toPandas()
    keys = [r[0] for r in duck.sql(f"select {key} from {table}").fetchall()]
    assert sorted(got[key]) == sorted(keys)
    numbers = [c for c in got.columns if c != key]
    assert all(1 <= got[c].nunique() <= max(most, len(keys)) for c in numbers)


def test_entry_imports_without_corpus_operators(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).columns == ["slug", "tahun", "status"]
    assert set(entry.oracle_sql()) <= set(entry.queries())
