"""Every registered query against its SQL on DuckDB, and without SQL that it runs."""

from collections import Counter

import duckdb
import pytest

from corpusloom import plans

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def duck(sf_dir):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def plain(v):
    return tuple(map(plain, v)) if isinstance(v, (list, tuple)) else round(v, 9) if isinstance(v, float) else v


@pytest.mark.parametrize("name", sorted(plans.oracle_sql()))
def test_against_sql(spark, sf_dir, duck, name):
    df = plans.queries()[name](spark, sf_dir)
    cur = duck.execute(plans.oracle_sql()[name])
    names = [c[0] for c in cur.description]
    assert sorted(names) == sorted(df.columns)
    want = Counter(tuple(plain(r[names.index(c)]) for c in sorted(names)) for r in cur.fetchall())
    assert Counter(tuple(plain(r[c]) for c in sorted(names)) for r in df.collect()) == want


@pytest.mark.parametrize("name", sorted(plans.queries().keys() - plans.oracle_sql().keys()))
def test_runs(spark, sf_dir, name):
    assert plans.queries()[name](spark, sf_dir).count() > 0


def test_entry(spark):
    import __spark_entry__ as e

    assert e.entry(spark).count() > 0
    assert set(plans.queries()) <= set(e.queries())
    assert set(e.oracle_sql()) <= set(e.queries())


def test_detectors_agree_with_labels(spark, sf_dir):
    rows = plans.queries()["detect_language"](spark, sf_dir).collect()
    said = [r for r in rows if r["detected"] != "und"]
    assert len(said) > 0.7 * len(rows)
    assert sum(r["detected"] == r["lang"] for r in said) > 0.97 * len(said)
