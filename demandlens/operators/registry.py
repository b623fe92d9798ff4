"""Model persistence and a small versioned model table with aliases.

Models are ``PipelineModel`` directories; the table, beside the models,
records name, version, alias, path and metrics so a scorer can load "the
Production model" without a tracking server.

The table is a log with one small file per version. Writing a version means
creating its file, which the file system refuses where it exists: of two
writers that want the same number one gets it, the other takes the next. No
file is ever replaced, so no version is shared or lost, and a writer that dies
half-way leaves a number without a row. (On stores whose create is not atomic,
as plain object stores, one writer at a time has to be arranged otherwise.)
"""

from __future__ import annotations

import hashlib
import json
import re
import uuid

from py4j.protocol import Py4JJavaError
from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import (
    DoubleType,
    IntegerType,
    StringType,
    StructField,
    StructType,
)

REGISTRY_SCHEMA = StructType(
    [
        StructField("registry_name", StringType(), False),
        StructField("model", StringType(), False),
        StructField("version", IntegerType(), False),
        StructField("alias", StringType(), True),
        StructField("path", StringType(), False),
        StructField("mae", DoubleType(), True),
        StructField("f1", DoubleType(), True),
    ]
)


def slug(name: str) -> str:
    """Lower-case words of a model's name, joined by hyphens."""
    return "-".join(re.findall(r"[a-z0-9]+", name.lower()))


def save_models(
    models: dict[str, PipelineModel], winner: str, model_dir: str, run: str | None = None
) -> dict[str, str]:
    """Every model under ``model_dir/<run>/<slug>[_best]``; each run has a
    folder of its own, so registered versions keep pointing at their models."""
    root = f"{model_dir.rstrip('/')}/{run or uuid.uuid4().hex[:12]}"
    paths = {}
    for name, model in models.items():
        path = f"{root}/{slug(name)}{'_best' if name == winner else ''}"
        model.write().save(path)
        paths[name] = path
    return paths


def _hadoop(spark: SparkSession, path: str):
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target, target.getFileSystem(spark._jsc.hadoopConfiguration())


def _log(registry_path: str, registry_name: str) -> str:
    """A registered name's folder; the digest keeps names apart whose slugs agree."""
    digest = hashlib.sha256(registry_name.encode()).hexdigest()[:12]
    return f"{registry_path.rstrip('/')}/{slug(registry_name)}-{digest}"


def latest_number(spark: SparkSession, folder: str) -> int:
    """The highest version of which a file exists, readable or not."""
    target, files = _hadoop(spark, folder)
    if not files.exists(target):
        return 0
    names = [str(f.getPath().getName()) for f in files.listStatus(target)]
    return max((int(m[1]) for m in map(re.compile(r"(\d+)\.json$").match, names) if m), default=0)


def _create(spark: SparkSession, path: str, text: str) -> bool:
    """Whether this call made the file; False where there is one already."""
    target, files = _hadoop(spark, path)
    if files.getScheme() == "file":
        # Hadoop's local file system looks and creates in two steps
        files.mkdirs(target.getParent())
        try:
            with open(files.makeQualified(target).toUri().getPath(), "x") as f:
                f.write(text)
        except FileExistsError:
            return False
        return True
    try:
        out = files.create(target, False)
    except Py4JJavaError:
        if files.exists(target):
            return False
        raise
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()
    return True


def add_version(spark: SparkSession, registry_path: str, row: dict) -> int:
    """Writes a row under the next free version and returns it."""
    folder = _log(registry_path, row["registry_name"])
    version = latest_number(spark, folder) + 1
    while not _create(
        spark, f"{folder}/{version:010d}.json", json.dumps({**row, "version": version}) + "\n"
    ):
        version = max(version, latest_number(spark, folder)) + 1
    return version


def versions(spark: SparkSession, registry_path: str) -> DataFrame:
    """All registered versions as they were written; an unreadable row raises,
    a file without a row (its writer died) is a number that is not in use."""
    table = (
        spark.read.schema(REGISTRY_SCHEMA)
        .option("mode", "FAILFAST")
        .option("pathGlobFilter", "*.json")
        .option("recursiveFileLookup", "true")
        .json(registry_path)
    )
    return table.select(*REGISTRY_SCHEMA.names)


def register(
    spark: SparkSession,
    registry_path: str,
    registry_name: str,
    board: DataFrame,
    paths: dict[str, str],
    alias: str = "Production",
) -> DataFrame:
    """Add one new version of every model, best rank last, so that the winner
    (rank 1), which carries the alias, comes when all others are in. The alias
    belongs to the latest version that carries it."""
    rows = board.select("model", "mae", "f1", "rank").collect()  # one row per model
    for r in sorted(rows, key=lambda r: r["rank"], reverse=True):
        row = {
            "registry_name": registry_name,
            "model": r["model"],
            "alias": alias if r["rank"] == 1 else None,
            "path": paths[r["model"]],
            "mae": float(r["mae"]) if r["mae"] is not None else None,
            "f1": float(r["f1"]) if r["f1"] is not None else None,
        }
        add_version(spark, registry_path, row)
    return current_versions(spark, registry_path)


def current_versions(spark: SparkSession, registry_path: str) -> DataFrame:
    """The registry with each alias on its latest version only."""
    table = versions(spark, registry_path)
    latest = F.max(F.when(F.col("alias").isNotNull(), F.col("version"))).over(
        Window.partitionBy("registry_name", "alias")
    )
    return table.withColumn("alias", F.when(F.col("version") == latest, F.col("alias")))


def load_by_alias(
    spark: SparkSession, registry_path: str, registry_name: str, alias: str = "Production"
) -> tuple[PipelineModel, str]:
    row = (
        versions(spark, registry_path)
        .filter((F.col("registry_name") == registry_name) & (F.col("alias") == alias))
        .orderBy(F.desc("version"))
        .first()
    )
    if row is None:
        raise LookupError(f"No model of '{registry_name}' carries alias '{alias}'")
    return PipelineModel.load(row["path"]), f"models:/{registry_name}@{alias} (v{row['version']})"
