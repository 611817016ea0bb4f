"""Driver contract and the DuckDB oracle on the smallest scale factor."""

import math

import duckdb
import pytest
from conftest import SF_SMALL

import __spark_entry__ as E

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.count() > 0 and df.columns == ["region", "total_spend"]


def test_every_oracle_has_a_query():
    assert set(E.oracle_sql()) <= set(E.queries())


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return con


def _norm(v):
    if isinstance(v, float):
        return round(v, 6) if not math.isnan(v) else "nan"
    return v


@pytest.mark.parametrize("name", sorted(E.oracle_sql()))
def test_query_matches_oracle(spark, duck, name):
    sdf = E.queries()[name](spark, SF_SMALL)
    cols = sorted(sdf.columns)
    a = sorted((tuple(_norm(r[c]) for c in cols) for r in sdf.collect()), key=repr)
    rel = duck.execute(E.oracle_sql()[name])
    dcols = [d[0] for d in rel.description]
    assert sorted(dcols) == cols
    b = sorted((tuple(_norm(dict(zip(dcols, r))[c]) for c in cols) for r in rel.fetchall()), key=repr)
    assert a == b


def test_trusted_questions_map_to_registered_queries(spark):
    from quartermaster.plans.trusted import TRUSTED, answer, trusted_key
    assert set(TRUSTED.values()) <= set(E.queries())
    assert trusted_key("  who are our BEST suppliers ") == "bm_best_suppliers"
    assert answer(spark, SF_SMALL, "How many purchase orders do we have?").first().order_count > 0
    with pytest.raises(KeyError):
        trusted_key("what is the meaning of life?")


def test_docs_list_every_registered_query():
    import os
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    coverage = open(os.path.join(root, "COVERAGE.md")).read()
    readme = open(os.path.join(root, "README.md")).read()
    missing = [k for k in E.queries() if k not in coverage]
    assert not missing, missing
    # the README lists every non-§2.10 query by name (§2.10 ones are in COVERAGE)
    from quartermaster.plans.results import RESULTS
    extra = [k for k in E.queries() if k not in RESULTS and not k.startswith("f_") and k not in readme]
    assert not extra, extra
