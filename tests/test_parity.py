"""Every registered query of the engine's own operators against its DuckDB SQL on the smallest tables."""

from pathlib import Path

import duckdb
import pytest

from compare import rows_of
from quarry.plans import registry


@pytest.fixture(scope="module")
def con(sf):
    c = duckdb.connect()
    for f in Path(sf).glob("*.parquet"):
        c.execute(f"create view {f.stem} as select * from '{f}'")
    return c


@pytest.mark.parametrize("name", sorted(registry.ORACLE))
def test_query_equals_sql(spark, sf, con, name):
    d = registry.QUERIES[name](spark, sf)
    r = con.execute(registry.ORACLE[name])
    assert rows_of(d.columns, d.collect()) == rows_of([c[0] for c in r.description], r.fetchall())


@pytest.mark.parametrize("name", sorted(set(registry.QUERIES) - set(registry.ORACLE)))
def test_query_runs(spark, sf, name):
    assert registry.QUERIES[name](spark, sf).count() > 0


def test_entry_names_are_callable():
    import __spark_entry__ as e

    q = e.queries()
    assert set(e.oracle_sql()) <= set(q) and all(callable(f) for f in q.values())
