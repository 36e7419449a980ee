"""Every registered query against its SQL on the same tables."""

import math

import duckdb
import pandas as pd
import pytest

from lodestone.plans import registry

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def db(data):
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{data}/{t}.parquet'")
    return con


def rows(df: pd.DataFrame) -> list[tuple]:
    def plain(x):
        if x is None or x is pd.NaT or x is pd.NA or isinstance(x, float) and math.isnan(x):
            return ""
        return repr(float(x)) if isinstance(x, (int, float)) and not isinstance(x, bool) or hasattr(x, "dtype") and x.dtype.kind in "iuf" else str(x)

    return sorted(tuple(plain(x) for x in r) for r in df[sorted(df.columns)].itertuples(index=False))


@pytest.mark.parametrize("name", sorted(registry.queries()))
def test_query(spark, data, db, name):
    got = registry.queries()[name](spark, data).toPandas()
    sql = registry.oracle_sql().get(name)
    if sql is None:
        assert len(got.columns)
        return
    want = db.execute(sql).fetchdf()
    assert sorted(got.columns) == sorted(want.columns)
    assert rows(got) == rows(want)


def test_entry_points():
    import __spark_entry__ as entry

    assert set(registry.queries()) <= set(entry.queries()) and set(entry.oracle_sql()) <= set(entry.queries())
    assert set(registry.oracle_sql()) <= set(registry.queries())


def test_bootstrap_draws_all_resamples(spark, data):
    assert registry.queries()["bootstrap_ci"](spark, data).first().samples == 2000


def test_boosted_trees_try_all_sizes(spark, data, monkeypatch):
    from lodestone.operators import boosting

    def grow(df, features, label, held, models, trees, *rest):
        raise LookupError(f"{models} {trees}")

    monkeypatch.setattr(boosting, "_grow", grow)
    with pytest.raises(LookupError, match=r"\(7, False\), \(15, False\), \(31, False\), \(7, True\), \(15, True\), \(31, True\)\] 200"):
        registry.queries()["gbt_score"](spark, data)
