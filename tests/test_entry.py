"""The driver contract in __spark_entry__.py."""

from __future__ import annotations

import __spark_entry__ as E


def test_entry_runs_the_flagship_query(spark):
    df = E.entry(spark)
    assert df.columns == ["trip_month", "qtd_corridas", "receita_media_usd", "receita_total_usd"]
    rows = df.collect()
    assert [r.trip_month for r in rows] == [1, 2, 3, 4, 5]
    assert all(r.qtd_corridas > 0 for r in rows)


def test_registry_shape():
    queries, sql = E.queries(), E.oracle_sql()
    assert all(callable(f) for f in queries.values())
    assert set(sql) <= set(queries)
    assert {q for q in set(queries) - set(sql) if not q.startswith("op") and q != "pipeline"} == set()
