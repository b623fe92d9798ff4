import datetime as dt

from demandlens.operators import quality as Q
from demandlens.operators import summaries as S

SCHEMA = "Product_Code string, Warehouse string, Order_Demand long, Date date, is_negative_demand boolean, is_zero_demand boolean, date_parse_failed boolean"


def _rows(first, n):
    day = dt.date(2020, 1, 1)
    return [
        (f"P{k % 700}" if k % 50 else None, f"W{k % 3}", k % 5 or None, day + dt.timedelta(days=k % 90) if k % 7 else None,
         k % 11 == 0, k % 13 == 0, k % 7 == 0)
        for k in range(first, first + n)
    ]


def test_merged_landings_equal_one_summary(spark, tmp_path):
    path = str(tmp_path / "summaries")
    parts = {"monday": _rows(0, 900), "tuesday": _rows(500, 1200), "nothing": []}
    for name, rows in parts.items():
        S.add_landing(path, name, spark.createDataFrame(rows, SCHEMA))
    S.add_landing(path, "monday", spark.createDataFrame(parts["monday"], SCHEMA))  # again: replaced
    table = S.landings(spark, path)
    assert table.count() == 3
    got = S.merge(table).first()
    everything = spark.createDataFrame([r for rows in parts.values() for r in rows], SCHEMA)
    exact = Q.quality_summary(everything).first()
    for c in (*S.COUNTS, "min_date", "max_date"):
        assert got[c] == exact[c], c
    assert abs(got.distinct_products - exact.distinct_products) <= 0.05 * exact.distinct_products
    assert got.distinct_warehouses == exact.distinct_warehouses == 3
    each = {r.landing: r.total_rows for r in S.merge(table, ["landing"]).collect()}
    assert each == {"monday": 900, "tuesday": 1200, "nothing": 0}


def test_a_new_landing_reads_its_own_rows_only(spark, tmp_path):
    """The landing's plan knows no other table, and others keep their files."""
    path = tmp_path / "summaries"
    S.add_landing(str(path), "a", spark.createDataFrame(_rows(0, 50), SCHEMA))
    before = {f: f.stat().st_mtime_ns for f in path.glob("landing=a/*.parquet")}
    S.add_landing(str(path), "b", spark.createDataFrame(_rows(0, 70), SCHEMA))
    assert before and {f: f.stat().st_mtime_ns for f in path.glob("landing=a/*.parquet")} == before
    assert S.merge(S.landings(spark, str(path))).first().total_rows == 120


def test_tables_without_flags(spark):
    df = spark.createDataFrame(_rows(0, 30), SCHEMA).drop("is_zero_demand")
    row = S.merge(S.summarise(df, ["Warehouse"])).first()
    assert row.zero_demand_rows is None and row.total_rows == 30
