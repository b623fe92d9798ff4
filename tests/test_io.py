import gzip

import pytest

from demandlens.session import s3a_conf, scratch_path
from demandlens.sources.readers import SourceConfig, read_cleaned, read_raw, source_uri
from demandlens.plans.jobs import clean_job
from demandlens.sources.sinks import write_cleaned, write_table, write_to


def test_source_uris():
    assert source_uri(SourceConfig("local", path="/d/x.csv")) == "/d/x.csv"
    assert source_uri(SourceConfig("s3", bucket="raw", key="a b.csv")) == "s3a://raw/a b.csv"
    assert source_uri(SourceConfig("hdfs", path="hdfs://nn:8020/x")) == "hdfs://nn:8020/x"
    assert source_uri(SourceConfig("hdfs", path="/x", namenode="nn:8020")) == "hdfs://nn:8020/x"
    with pytest.raises(ValueError):
        source_uri(SourceConfig("ftp", path="x"))


def test_s3a_conf_prefers_arguments(monkeypatch):
    monkeypatch.setenv("S3_ENDPOINT", "http://env:9000")
    conf = s3a_conf(access_key="k")
    assert conf["spark.hadoop.fs.s3a.endpoint"] == "http://env:9000"
    assert conf["spark.hadoop.fs.s3a.access.key"] == "k"
    assert s3a_conf(endpoint="http://arg")["spark.hadoop.fs.s3a.endpoint"] == "http://arg"


def test_csv_read_padded_header_and_quotes(spark, tmp_path):
    p = tmp_path / "raw.csv"
    p.write_text(' Product_Code,Warehouse ,Product_Category,Date,Order_Demand\n'
                 'X9,North,Toys,2019/8/21,"(1,200)"\n"X""8",South,Books,8/2/2019,\n')
    rows = read_raw(spark, str(p)).collect()
    assert rows[0].Order_Demand == "(1,200)" and rows[1].Product_Code == 'X"8' and rows[1].Order_Demand is None


def test_csv_columns_are_found_by_name(spark, tmp_path):
    p = tmp_path / "reordered.csv"
    p.write_text("Warehouse, Product_Code ,note,Product_Category,Order_Demand,Date\nW9,P7,x,C3,12,2016/2/3\n")
    row = read_raw(spark, str(p)).first()
    assert row.asDict() == {"Product_Code": "P7", "Warehouse": "W9", "Product_Category": "C3",
                            "Date": "2016/2/3", "Order_Demand": "12"}
    few = tmp_path / "few.csv"
    few.write_text("Warehouse,Date\nW9,2016/2/3\n")
    with pytest.raises(ValueError, match="Order_Demand"):
        read_raw(spark, str(few))
    with pytest.raises(ValueError, match="Order_Demand"):
        clean_job(spark, str(few), scratch_path(spark, "never"))
    bare = tmp_path / "bare.csv"
    bare.write_text("P7,W9,C3,2016/2/3,12\n")
    assert read_raw(spark, str(bare), header=False).first().Order_Demand == "12"


def test_files_of_one_folder_may_differ_in_layout(spark, tmp_path):
    folder = tmp_path / "many files"
    folder.mkdir()
    (folder / "a.csv").write_text("Product_Code,Warehouse,Product_Category,Date,Order_Demand\np0,w0,c0,2011/3/4,7\n")
    (folder / "b.csv").write_text(
        '\ufeffOrder_Demand,note, Date ,"Product_Category",Warehouse,Product_Code\n8,"x,y",2011/3/5,c1,w1,p1\n'
        "9,z,2011/3/6,c2,w2,p2\n"
    )
    with gzip.open(folder / "c.csv.gz", "wt") as f:
        f.write("Date,Order_Demand,Product_Code,Warehouse,Product_Category,Date\n2011/3/7,10,p3,w3,c3,never\n")
    (folder / "d.csv").write_text("")
    rows = sorted(read_raw(spark, str(folder)).collect())
    assert [tuple(r) for r in rows] == [
        (f"p{k}", f"w{k}", f"c{k}", f"2011/3/{4 + k}", str(7 + k)) for k in range(4)
    ]
    (folder / "e.csv").write_text("Warehouse,Date\nw,2011/3/8\n")
    with pytest.raises(ValueError, match="e.csv lacks"):
        read_raw(spark, str(folder))
    empty = tmp_path / "empty"
    empty.mkdir()
    (empty / "a.csv").write_text("")
    assert read_raw(spark, str(empty)).collect() == []


def test_overwrite_replaces_every_partition(spark):
    path = scratch_path(spark, "t")
    old = spark.conf.get("spark.sql.sources.partitionOverwriteMode")
    spark.conf.set("spark.sql.sources.partitionOverwriteMode", "dynamic")
    try:
        for rows in ([("P", "W1", 1), ("Q", "W2", 2)], [("P", "W1", 3)]):
            write_cleaned(spark.createDataFrame(rows, "Product_Code string, Warehouse string, v int"), path)
    finally:
        spark.conf.set("spark.sql.sources.partitionOverwriteMode", old)
    assert [(r.Warehouse, r.v) for r in read_cleaned(spark, path).collect()] == [("W1", 3)]


def test_sink_dispatch_by_kind(spark, tmp_path):
    df = spark.createDataFrame([("P", "W1", 1)], "Product_Code string, Warehouse string, v int")
    uri = write_to(df, SourceConfig("local", path=str(tmp_path / "out")))
    assert read_cleaned(spark, uri).count() == 1
    with pytest.raises(ValueError):
        write_to(df, SourceConfig("tape", path="x"))


def test_partitioned_roundtrip(spark):
    df = spark.createDataFrame([("P", "W1", 1), ("Q", "W2", 2)], "Product_Code string, Warehouse string, v int")
    path = scratch_path(spark, "t")
    write_cleaned(df, path)
    back = read_cleaned(spark, path)
    assert back.columns[-1] == "Warehouse"
    assert back.filter("Warehouse = 'W2'").collect()[0].v == 2
    csv = scratch_path(spark, "c")
    write_table(df, csv, "csv", ["Warehouse"])
    assert read_cleaned(spark, csv, "csv", "Product_Code string, v int, Warehouse string").count() == 2
    with pytest.raises(ValueError):
        write_table(df, path, "xls")
