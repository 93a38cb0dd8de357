"""Every query with SQL gives what DuckDB gives on the same tables."""

import duckdb
import pytest

from framesift.plans import all_queries

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def db(sf_dir):
    c = duckdb.connect()
    for t in TABLES:
        c.sql(f"create view {t} as select * from '{sf_dir}/{t}.parquet'")
    return c


def rows(frame):
    names = sorted(frame.columns)
    x = frame[names].astype(object).where(frame[names].notna(), None)
    return names, sorted(map(str, (tuple(round(float(v), 6) if isinstance(v, (int, float)) and not isinstance(v, bool) else v for v in r) for r in x.values.tolist())))


@pytest.mark.parametrize("name", sorted(all_queries.QUERIES))
def test_query(spark, sf_dir, db, name):
    got = all_queries.QUERIES[name](spark, sf_dir).toPandas()
    if name in all_queries.ORACLE_SQL:
        assert rows(got) == rows(db.sql(all_queries.ORACLE_SQL[name]).df())
    else:
        assert len(got)


def test_entry(spark):
    import __spark_entry__ as e

    assert set(e.oracle_sql()) <= set(e.queries())
    assert e.entry(spark).columns == ["sample_id", "group_id", "role", "dup_of"]
