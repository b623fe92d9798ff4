"""The ``raw_demand`` view: dirty order records derived from the driver's
``lineitem`` / ``orders`` / ``part`` tables (deterministic, scales with them).

Every raw column is a string, exactly as a header CSV with an explicit
all-string schema would arrive.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from demandlens.session import ensure_parallelism, scratch_path

_LANDED: dict[tuple, str] = {}


def _stamp(spark: SparkSession, sf_dir: str) -> tuple:
    """Names, sizes and times of the files that the raw view is made of."""
    out = []
    for name in ("lineitem", "orders", "part"):
        path = spark._jvm.org.apache.hadoop.fs.Path(f"{sf_dir.rstrip('/')}/{name}.parquet")
        files = path.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(path)
        out += [(str(f.getPath()), f.getLen(), f.getModificationTime()) for f in files]
    return tuple(sorted(out))


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _padded(text: Column, width: int) -> Column:
    """Zero-padded to at least ``width`` characters, never shortened."""
    return F.when(F.length(text) < width, F.lpad(text, width, "0")).otherwise(text)


def _code(prefix: str, key: Column) -> Column:
    return F.concat(F.lit(prefix), _padded(key.cast("string"), 4))


def raw_demand(spark: SparkSession, sf_dir: str) -> DataFrame:
    # a scan's partition count comes from file splits (no job); a small
    # single-row-group file is spread over the cores before the joins
    li = ensure_parallelism(
        _table(spark, sf_dir, "lineitem").select(
            "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_returnflag"
        )
    )
    # the three text layouts are formatted once per order, not per line
    orders = _table(spark, sf_dir, "orders").select(
        "o_orderkey",
        F.date_format("o_orderdate", "yyyy/M/d").alias("_d_slash"),
        F.date_format("o_orderdate", "MM/dd/yyyy").alias("_d_us"),
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("_d_iso"),
    )
    part = _table(spark, sf_dir, "part").select("p_partkey", "p_brand")
    j = li.join(orders, li.l_orderkey == orders.o_orderkey).join(
        part, li.l_partkey == part.p_partkey
    )
    ok, pk, sk = F.col("l_orderkey"), F.col("l_partkey"), F.col("l_suppkey")
    qty100 = (F.col("l_quantity") * 100).cast("bigint").cast("string")

    # The injected defects of the fixture (padded / lower-case
    # keys, NULL warehouses, three date layouts, bad dates, accounting
    # negatives, zeros, N/A, extreme values, trailing blanks).
    product = F.when(pk % 7 == 0, _code(" product_", pk)).otherwise(_code("Product_", pk))
    warehouse = (
        F.when(ok % 211 == 0, F.lit(None).cast("string"))
        .when(sk % 4 == 0, F.lit("Whse_A"))
        .when(sk % 4 == 1, F.lit(" whse_c"))
        .when(sk % 4 == 2, F.lit("WHSE_J "))
        .otherwise(F.lit("Whse_S"))
    )
    category = F.concat(F.lit("Category_"), _padded(F.expr("substring(p_brand, 7)"), 3))
    date = (
        F.when(ok % 97 == 0, F.lit("not-a-date"))
        .when(ok % 101 == 0, F.lit(None).cast("string"))
        .when(ok % 3 == 0, F.col("_d_slash"))
        .when(ok % 3 == 1, F.col("_d_us"))
        .otherwise(F.col("_d_iso"))
    )
    demand = (
        F.when(ok % 103 == 0, F.lit(None).cast("string"))
        .when(ok % 107 == 0, F.lit("N/A"))
        .when(
            (F.col("l_linenumber") == 7) & (F.col("l_returnflag") == "R"),
            F.concat(F.lit("("), qty100, F.lit(")")),
        )
        .when(ok % 11 == 0, F.lit("0 "))
        .when(
            ok % 503 == 0,
            F.concat(F.col("l_quantity").cast("bigint").cast("string"), F.lit("000000")),
        )
        .otherwise(F.concat(qty100, F.lit(" ")))
    )
    return j.select(
        product.alias("Product_Code"),
        warehouse.alias("Warehouse"),
        category.alias("Product_Category"),
        date.alias("Date"),
        demand.alias("Order_Demand"),
    )


def landed(spark: SparkSession, sf_dir: str, name: str, build) -> DataFrame:
    """A table derived from the driver's tables, written once per session to
    the shared folder by ``build(spark, sf_dir)`` and read from there: raw
    files land before they are cleaned, cleaned tables before they are
    explored, trained on and scored. Changed files land anew."""
    key = (spark.sparkContext.applicationId, name, _stamp(spark, sf_dir))
    path = _LANDED.get(key)
    if path is None:
        path = scratch_path(spark, name)
        build(spark, sf_dir).write.mode("overwrite").parquet(path)
        _LANDED[key] = path
    return spark.read.parquet(path)


def landed_raw_demand(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The raw view as an all-string table, the way raw CSV files land."""
    return ensure_parallelism(landed(spark, sf_dir, "raw_demand", raw_demand))


# DuckDB text of the same view (used by the oracle SQL of every query).
RAW_DEMAND_DUCKDB = r"""
SELECT
  CASE WHEN l_partkey % 7 = 0 THEN concat(' product_', lpad(CAST(l_partkey AS VARCHAR), greatest(4, length(CAST(l_partkey AS VARCHAR)))::INTEGER, '0'))
       ELSE concat('Product_', lpad(CAST(l_partkey AS VARCHAR), greatest(4, length(CAST(l_partkey AS VARCHAR)))::INTEGER, '0')) END AS Product_Code,
  CASE WHEN l_orderkey % 211 = 0 THEN NULL
       WHEN l_suppkey % 4 = 0 THEN 'Whse_A'
       WHEN l_suppkey % 4 = 1 THEN ' whse_c'
       WHEN l_suppkey % 4 = 2 THEN 'WHSE_J '
       ELSE 'Whse_S' END AS Warehouse,
  concat('Category_', lpad(substring(p_brand, 7), greatest(3, length(substring(p_brand, 7)))::INTEGER, '0')) AS Product_Category,
  CASE WHEN l_orderkey % 97 = 0 THEN 'not-a-date'
       WHEN l_orderkey % 101 = 0 THEN NULL
       WHEN l_orderkey % 3 = 0 THEN strftime(o_orderdate, '%Y/%-m/%-d')
       WHEN l_orderkey % 3 = 1 THEN strftime(o_orderdate, '%m/%d/%Y')
       ELSE strftime(o_orderdate, '%Y-%m-%d') END AS Date,
  CASE WHEN l_orderkey % 103 = 0 THEN NULL
       WHEN l_orderkey % 107 = 0 THEN 'N/A'
       WHEN l_linenumber = 7 AND l_returnflag = 'R'
            THEN concat('(', CAST(CAST(l_quantity * 100 AS BIGINT) AS VARCHAR), ')')
       WHEN l_orderkey % 11 = 0 THEN '0 '
       WHEN l_orderkey % 503 = 0
            THEN concat(CAST(CAST(l_quantity AS BIGINT) AS VARCHAR), '000000')
       ELSE concat(CAST(CAST(l_quantity * 100 AS BIGINT) AS VARCHAR), ' ') END AS Order_Demand
FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey
"""
