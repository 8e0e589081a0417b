"""Saving and loading what was fitted."""

from __future__ import annotations

import os
import threading
from datetime import datetime, timezone

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskloom.operators.binning import BINS_SCHEMA, BinMap
from riskloom.operators.shaping import latest_with_fallback


def save_transformer(spark: SparkSession, bins: BinMap, path: str) -> None:
    """The bin map, already cut to the selected features, as a Parquet table."""
    bins.to_table(spark).coalesce(1).write.mode("overwrite").parquet(path)


def load_transformer(spark: SparkSession, path: str, missing: str = "zero") -> BinMap:
    return BinMap.from_table(spark.read.schema(BINS_SCHEMA).parquet(path), missing)


def save_scorer(spark: SparkSession, bins: BinMap, model: PipelineModel, path: str) -> None:
    save_transformer(spark, bins, os.path.join(path, "bins"))
    model.write().overwrite().save(os.path.join(path, "model"))


VERSIONS_SCHEMA = "name string, version bigint, stage string, ts timestamp, path string"


#: Versions of one driver are claimed one at a time, as not every file system creates atomically.
_CLAIMING = threading.Lock()


def model_versions(spark: SparkSession, root: str) -> DataFrame:
    """(name, version, stage, ts, path) of all models registered under ``root``.

    Each version's row is a folder of its own, so that runs that register together do not
    disturb each other's files.
    """
    reader = spark.read.schema(VERSIONS_SCHEMA).option("recursiveFileLookup", True)
    return reader.parquet(f"{root}/model_versions")


def claim_version(spark: SparkSession, root: str, name: str) -> int:
    """The next version number of a name, which nobody else gets.

    A number is taken by creating its file, which fails if the file is there; whoever comes second
    tries the next number. A run that dies after that leaves a gap in the numbers, no more.
    """
    jvm = spark.sparkContext._jvm
    folder = jvm.org.apache.hadoop.fs.Path(f"{root}/version_claims/{name}")
    fs = folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    fs.mkdirs(folder)
    taken = [int(f.getPath().getName()) for f in fs.listStatus(folder)]
    version = max(taken, default=0) + 1
    while True:
        with _CLAIMING:
            if fs.createNewFile(jvm.org.apache.hadoop.fs.Path(folder, str(version))):
                return version
        version += 1


def register_scorer(
    spark: SparkSession, bins: BinMap, model: PipelineModel, root: str, name: str, stage: str = "None"
) -> int:
    """Save a scorer under its own path and add it to the table as the name's next version.

    Earlier versions stay as they are, and any number of runs may register a name at a time. A
    version can be seen once its scorer is written.
    """
    version = claim_version(spark, root, name)
    path = f"{root}/scorers/{name}/{version}"
    save_scorer(spark, bins, model, path)
    row = [(name, version, stage, datetime.now(timezone.utc), path)]
    table = spark.createDataFrame(row, VERSIONS_SCHEMA).coalesce(1)
    table.write.parquet(f"{root}/model_versions/{name}/{version}")
    return version


def current_version(versions: DataFrame) -> DataFrame:
    """Per name the newest version in production, else the newest in no stage."""
    return latest_with_fallback(versions, "name", "stage", ["version"])


def load_registered(spark: SparkSession, root: str, name: str) -> tuple[BinMap, PipelineModel]:
    """The scorer that ``current_version`` chooses."""
    found = current_version(model_versions(spark, root).where(F.col("name") == name)).first()
    if found is None:
        raise ValueError(f"no version of {name} can be used")
    return load_scorer(spark, found["path"])


def load_scorer(spark: SparkSession, path: str) -> tuple[BinMap, PipelineModel]:
    bins = load_transformer(spark, os.path.join(path, "bins"))
    return bins, PipelineModel.load(os.path.join(path, "model"))
