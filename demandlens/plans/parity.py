"""Spark-vs-DuckDB comparison of registered queries (used by tests and as a
CLI: ``python -m demandlens.plans.parity SF_DIR [key ...]``)."""

from __future__ import annotations

import math
import sys
import time

# Driver tables registered as DuckDB views.
TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def duckdb_con(sf_dir: str):
    import duckdb

    con = duckdb.connect()
    for t in ("lineitem", "orders", "part"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


# Spark simple type names and the Arrow names they map to.
_SPARK_TO_ARROW = {
    "bigint": "int64", "int": "int32", "smallint": "int16", "tinyint": "int8", "double": "double",
    "float": "float", "string": "string", "date": "date32", "boolean": "bool",
}


def _spark_name(t: str) -> str:
    return _SPARK_TO_ARROW.get(t, t)


def _arrow_name(t) -> str:
    name = str(t)
    return {"large_string": "string", "date32[day]": "date32", "string_view": "string"}.get(name, name)


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return None
        return round(v, 6)
    if hasattr(v, "isoformat"):
        return v.isoformat()[:10] if len(v.isoformat()) >= 10 else v.isoformat()
    return v


def _rows(cols, records):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    out = [tuple(_norm(r[i]) for i in order) for r in records]
    return sorted(out, key=lambda t: tuple((x is None, str(type(x)), x if x is not None else 0) for x in t))


def compare(spark, con, key: str, sf_dir: str, spark_fn, sql: str) -> dict:
    t0 = time.time()
    sdf = spark_fn(spark, sf_dir)
    s_cols = sdf.columns
    s_rows = [tuple(r) for r in sdf.collect()]
    t1 = time.time()
    tbl = con.sql(sql).to_arrow_table()
    d_cols = list(tbl.column_names)
    d_rows = [tuple(r.values()) for r in tbl.to_pylist()]
    d_types = {f.name: _arrow_name(f.type) for f in tbl.schema}
    s_types = {f.name: _spark_name(f.dataType.simpleString()) for f in sdf.schema.fields}
    out = {"key": key, "spark_rows": len(s_rows), "duck_rows": len(d_rows), "sec": round(t1 - t0, 2)}
    out["cols_match"] = sorted(s_cols) == sorted(d_cols)
    if not out["cols_match"]:
        out["spark_cols"] = sorted(s_cols)
        out["duck_cols"] = sorted(d_cols)
        out["ok"] = False
        return out
    out["types_match"] = s_types == d_types
    if not out["types_match"]:
        out["type_diffs"] = {k: (s_types.get(k), d_types.get(k)) for k in s_types if s_types.get(k) != d_types.get(k)}
    a, b = _rows(s_cols, s_rows), _rows(d_cols, d_rows)
    out["values_match"] = a == b
    if not out["values_match"]:
        diff = [(x, y) for x, y in zip(a, b) if x != y][:3]
        out["first_diffs"] = diff
    out["ok"] = (
        out["cols_match"] and out["values_match"] and out["types_match"] and len(s_rows) == len(d_rows)
    )
    return out


def main(argv):
    sys.path.insert(0, ".")
    from demandlens.plans.catalog import QUERIES
    from demandlens.plans.oracle import ORACLE
    from demandlens.session import build_session

    sf_dir = argv[0]
    keys = argv[1:] or [k for k in QUERIES if k in ORACLE]
    spark = build_session(master="local[8]", shuffle_partitions=8)
    con = duckdb_con(sf_dir)
    bad = 0
    for k in keys:
        try:
            r = compare(spark, con, k, sf_dir, QUERIES[k], ORACLE[k])
        except Exception as e:  # report and go on
            r = {"key": k, "ok": False, "error": repr(e)[:500]}
        bad += not r["ok"]
        print(r, flush=True)
    print(f"{len(keys) - bad}/{len(keys)} ok")


if __name__ == "__main__":
    main(sys.argv[1:])
