import duckdb
import pytest

from driftvault.plans import queries

DIR = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{DIR}/{t}.parquet'")
    return con


def rows(frame):
    return sorted(tuple("~" if v is None or v != v else f"{v:.9g}" if isinstance(v, float) else str(v) for v in r) for r in frame[sorted(frame.columns)].itertuples(index=False))


@pytest.mark.parametrize("name", sorted(queries.QUERIES))
def test_query_against_sql(spark, duck, name):
    got = queries.QUERIES[name](spark, DIR).toPandas()
    assert rows(got) == rows(duck.sql(queries.ORACLE_SQL[name]).df())


def test_flagship(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).count() > 0
    assert set(queries.QUERIES) <= set(entry.queries())
