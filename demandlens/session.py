"""Session construction, object-store settings and the shared folder."""

from __future__ import annotations

import os
import re
import tempfile
import uuid

from pyspark.sql import SparkSession

# S3A connector settings of the object-store source/sink.
_S3A_STATIC = {
    "spark.hadoop.fs.s3a.impl": "org.apache.hadoop.fs.s3a.S3AFileSystem",
    "spark.hadoop.fs.s3a.path.style.access": "true",
    "spark.hadoop.fs.s3a.connection.ssl.enabled": "false",
    "spark.hadoop.fs.s3a.connection.timeout": "60000",
    "spark.hadoop.fs.s3a.connection.establish.timeout": "60000",
    "spark.hadoop.fs.s3a.threads.keepalivetime": "60000",
}

DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def s3a_conf(
    endpoint: str | None = None,
    access_key: str | None = None,
    secret_key: str | None = None,
) -> dict[str, str]:
    """`spark.hadoop.fs.s3a.*` settings; explicit arguments win over the
    environment (S3_ENDPOINT, S3_ACCESS_KEY, S3_SECRET_KEY)."""
    conf = dict(_S3A_STATIC)
    endpoint = endpoint or os.environ.get("S3_ENDPOINT")
    access_key = access_key or os.environ.get("S3_ACCESS_KEY")
    secret_key = secret_key or os.environ.get("S3_SECRET_KEY")
    if endpoint:
        conf["spark.hadoop.fs.s3a.endpoint"] = endpoint
    if access_key:
        conf["spark.hadoop.fs.s3a.access.key"] = access_key
    if secret_key:
        conf["spark.hadoop.fs.s3a.secret.key"] = secret_key
    return conf


def build_session(
    app_name: str = "demandlens",
    master: str | None = None,
    shuffle_partitions: int | None = None,
    extra_conf: dict[str, str] | None = None,
) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    if os.environ.get("S3_ENDPOINT") or os.environ.get("S3_ACCESS_KEY"):
        conf.update(s3a_conf())
    conf.update(extra_conf or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    shared_dir(spark)
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The cluster-wide folder named by ``spark.checkpoint.dir``.

    Read from the session; only when it is unset (local tests) a fresh
    folder is created and registered."""
    sc = spark.sparkContext
    path = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get(
        "spark.checkpoint.dir", None
    )
    if not path:
        existing = sc.getCheckpointDir()
        if existing:
            path = existing
        else:
            if not re.match(r"local(\[|$)", sc.master):
                raise RuntimeError(
                    "set spark.checkpoint.dir to a folder that the driver and all executors share"
                )
            path = tempfile.mkdtemp(prefix="run-", dir="/tmp")
        spark.conf.set("spark.checkpoint.dir", path)
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(path)
    return path


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique location under the shared folder."""
    base = shared_dir(spark).rstrip("/")
    return f"{base}/{name}-{uuid.uuid4().hex[:12]}"


def ensure_parallelism(df):
    """Round-robin spread a DataFrame that arrives in fewer partitions than
    the cluster has cores (a small single-row-group file scans as one
    task). Inputs that already split wider are returned untouched, so on
    large data this is a no-op and adds no shuffle. Meant for scans: the
    partition count of a file scan is known without running anything."""
    spark = df.sparkSession
    cores = spark.sparkContext.defaultParallelism
    if df.rdd.getNumPartitions() < cores:
        return df.repartition(cores)
    return df
