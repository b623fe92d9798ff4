"""Sources: raw CSV (any Hadoop URI), cleaned partitioned tables, and the
mapping from a source configuration to a URI."""

from __future__ import annotations

import csv
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StringType, StructField, StructType

from demandlens.config import RAW_COLUMNS

#: First lines that are read at the same time.
HEADER_THREADS = 16

RAW_SCHEMA = StructType([StructField(c, StringType(), True) for c in RAW_COLUMNS])


def _csv(spark: SparkSession, header: bool):
    return (
        spark.read.option("header", str(header).lower())
        .option("quote", '"')
        .option("escape", '"')
        .option("multiLine", "false")
        .option("mode", "PERMISSIVE")
    )


def first_line(spark: SparkSession, path: str) -> str | None:
    """A file's first line, through Hadoop's file system and codecs, so from
    any store; nothing but the beginning of the file is read."""
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    target = jvm.org.apache.hadoop.fs.Path(jvm.java.net.URI(path))
    stream = target.getFileSystem(conf).open(target)
    codec = jvm.org.apache.hadoop.io.compress.CompressionCodecFactory(conf).getCodec(target)
    reader = jvm.java.io.BufferedReader(
        jvm.java.io.InputStreamReader(codec.createInputStream(stream) if codec else stream, "UTF-8")
    )
    try:
        return reader.readLine()
    finally:
        reader.close()


def header_columns(spark: SparkSession, path: str) -> tuple[str, ...] | None:
    """Column names of a header CSV file, stripped; None for an empty file."""
    line = first_line(spark, path)
    if not line:
        return None
    return tuple(c.strip() for c in next(csv.reader([line.lstrip("\ufeff")])))


def layouts(spark: SparkSession, uri: str) -> dict[tuple[str, ...], list[str]]:
    """The files under ``uri`` by their header, in the order of the listing;
    empty files are left out."""
    paths = _csv(spark, True).schema(RAW_SCHEMA).csv(uri).inputFiles()
    with ThreadPoolExecutor(HEADER_THREADS) as pool:
        headers = list(pool.map(lambda p: header_columns(spark, p), paths))
    found: dict[tuple[str, ...], list[str]] = {}
    for path, header in zip(paths, headers):
        if header is not None:
            found.setdefault(header, []).append(path)
    return found


def read_raw(
    spark: SparkSession,
    uri: str,
    header: bool = True,
    infer_schema: bool = False,
    schema: StructType | None = RAW_SCHEMA,
) -> DataFrame:
    """CSV with ``"`` as quote and escape, one record per line.

    Columns of files with a header are found by name, per file: the first
    lines are read on their own, names are stripped of blanks, columns that
    ``schema`` asks for must all be there (in any order, beside others), and
    the files of each layout are read with an explicit all-string schema in
    their own order, so nothing is scanned to infer one and files split across
    tasks. Files of one folder may differ in their layout. Without a header,
    columns go by position. ``infer_schema=True`` ignores ``schema`` (one extra
    pass over the data)."""
    reader = _csv(spark, header)
    if infer_schema or schema is None:
        reader = reader.option("inferSchema", str(infer_schema).lower())
        return reader.csv(uri)
    if not header:
        return reader.schema(schema).csv(uri)
    kinds = {f.name: f.dataType for f in schema}
    found = layouts(spark, uri)
    for names, paths in found.items():
        missing = [c for c in kinds if c not in names]
        if missing:
            raise ValueError(f"{paths[0]} lacks the columns {missing}; its header has {list(names)}")
    out = None
    for names, paths in found.items():
        # a name that occurs twice counts where it occurs first
        unique = [c if c not in names[:i] else f"__again_{i}" for i, c in enumerate(names)]
        layout = StructType([StructField(c, kinds.get(c, StringType()), True) for c in unique])
        part = _csv(spark, header).option("enforceSchema", "true").schema(layout)
        # the listing's paths are escaped as in a URI, the reader's are not
        rows = part.csv(uri if len(found) == 1 else [unquote(p) for p in paths]).select(*kinds)
        out = rows if out is None else out.unionByName(rows)
    return spark.createDataFrame([], schema) if out is None else out


#: Columns of a cleaned table that is not self-describing.
CLEANED_SCHEMA = (
    "Product_Code string, Product_Category string, Order_Demand bigint, Date date, year int, "
    "month int, day_of_week int, week_of_year int, Warehouse string"
)


def read_cleaned(
    spark: SparkSession, uri: str, fmt: str = "parquet", schema: str | StructType = CLEANED_SCHEMA
) -> DataFrame:
    """Cleaned table root; ``Warehouse=...`` directories become a column
    and filters on it prune directories. ``schema`` serves CSV only: no pass
    over the data to infer one."""
    reader = spark.read.format(fmt)
    if fmt == "csv":
        reader = reader.option("header", "true").schema(schema)
    return reader.load(uri)


@dataclass(frozen=True)
class SourceConfig:
    kind: str  # local | s3 | hdfs
    path: str = ""
    bucket: str = ""
    key: str = ""
    namenode: str = ""


def source_uri(cfg: SourceConfig) -> str:
    """One path-based reader serves every store; only the URI differs."""
    if cfg.kind == "local":
        return cfg.path
    if cfg.kind in ("s3", "minio"):
        if not cfg.bucket:
            raise ValueError("object-store source needs a bucket")
        return f"s3a://{cfg.bucket}/{cfg.key.lstrip('/')}"
    if cfg.kind == "hdfs":
        if cfg.path.startswith("hdfs://"):
            return cfg.path
        if not cfg.namenode:
            raise ValueError("hdfs source needs a namenode or an hdfs:// path")
        return f"hdfs://{cfg.namenode}/{cfg.path.lstrip('/')}"
    raise ValueError(f"no such kind of store: {cfg.kind!r} (local, s3, minio or hdfs)")


def read_source(spark: SparkSession, cfg: SourceConfig, **kw) -> DataFrame:
    return read_raw(spark, source_uri(cfg), **kw)
