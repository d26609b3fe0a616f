"""Every registered query against its SQL, on the smallest tables."""

import duckdb
import pytest

from leafmill.plans.queries import ORACLES, QUERIES

TABLES = ("events", "documents", "pages", "conversations")


@pytest.fixture(scope="module")
def duck(small):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from read_parquet('{small}/{t}.parquet')")
    return con


def rows(frame):
    frame = frame[sorted(frame.columns)]
    plain = lambda v: None if v is None or v != v else float(v) if isinstance(v, (int, float)) and not isinstance(v, bool) else str(v)
    return sorted(repr(tuple(map(plain, r))) for r in frame.itertuples(index=False))


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, small, name):
    got = QUERIES[name](spark, small).toPandas()
    assert len(got)
    if name in ORACLES:
        want = duck.execute(ORACLES[name]).fetchdf()
        assert sorted(got.columns) == sorted(want.columns)
        assert rows(got) == rows(want)


def test_entry_reads_every_page(spark):
    import __spark_entry__ as entry

    out = entry.entry(spark)
    assert out.columns == ["page_id", "url", "title", "lang", "chars", "text"]
    assert out.count() == 50
    assert set(entry.oracle_sql()) <= set(entry.queries())
