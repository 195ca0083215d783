import datetime
import glob
import os
import re

import duckdb
import pytest

import __spark_entry__ as entry
from inkmill.functions import fixed
from inkmill.plans import catalogue

SMALL = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SMALL), reason="no test tables here")


def norm(v):
    if isinstance(v, float):
        return round(v, 9)
    if isinstance(v, datetime.datetime):
        return v.replace(tzinfo=None)
    return tuple(map(norm, v)) if isinstance(v, list) else v


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    con.execute("SET timezone = 'UTC'")
    for p in glob.glob(f"{SMALL}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(p)[:-8]} AS SELECT * FROM '{p}'")
    return con


@pytest.mark.parametrize("name", sorted(catalogue.oracle_sql()))
def test_query_as_sql(spark, duck, name):
    df = catalogue.queries()[name](spark, SMALL)
    columns = sorted(df.columns)
    ours = sorted((tuple(norm(r[c]) for c in columns) for r in df.collect()), key=repr)
    found = duck.execute(catalogue.oracle_sql()[name])
    names = [x[0] for x in found.description]
    theirs = sorted((tuple(norm(r[names.index(c)]) for c in columns) for r in found.fetchall()), key=repr)
    assert sorted(names) == columns and ours == theirs


@pytest.mark.parametrize("name", sorted(set(catalogue.queries()) - set(catalogue.oracle_sql())))
def test_query_runs(spark, name):
    assert catalogue.queries()[name](spark, SMALL).count() > 0


def test_names_of_texts_with_any_character(spark, tmp_path):
    """As Python's regexes find them, whatever else a text holds."""
    texts = [
        "Mira Stone met Old Roland — and “Ada Thorn” left.", "Éva Stone, Mira Stoné and Zoë Marsh; Orla  Vane’s café", "Über Bron Hale_x, éBron Tarn and Karl Voss", "The Second, Two Three", None,
    ]
    rows = [(i, t, "en") for i, t in enumerate(texts)] + [(90, "Lena Kraus", "de")]
    spark.createDataFrame(rows, "doc_id long, text string, lang string").write.parquet(f"{tmp_path}/documents.parquet")
    no = set(fixed.NOT_NAMES + fixed.NUMBER_WORDS)
    found = {re.sub(" +", " ", n) for t in texts if t for n in re.findall(r"\b[A-Z][a-z]{2,15}[ ]+[A-Z][a-z]{2,15}\b", t)}
    want = {n for n in found if not no & set(n.split(" "))}
    got = {r["name"] for r in catalogue.queries()["lore_names"](spark, str(tmp_path)).collect()}
    assert got == want and {"Mira Stone", "Ada Thorn", "Orla Vane", "Karl Voss"} <= got and "Bron Tarn" not in got


def test_entry(spark):
    assert entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())
