import __spark_entry__ as E
from demandlens.plans.catalog import QUERIES
from demandlens.plans.oracle import ORACLE


def test_entry_schema_is_stable(spark):
    df = E.entry(spark)
    assert df.columns == ["Warehouse", "rows", "outlier_rows", "sparse_rows", "lower_fence", "upper_fence"]
    rows = df.collect()
    assert len(rows) == 4 and all(r.rows > 0 for r in rows)


def test_oracle_keys_are_query_keys():
    q, o = E.queries(), E.oracle_sql()
    assert set(o) <= set(q) and set(QUERIES) <= set(q) and set(ORACLE) <= set(o)
    assert all(sql.lstrip().upper().startswith(("WITH", "SELECT")) for sql in o.values())
