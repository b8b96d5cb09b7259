"""Session helpers.

Settings every job in this library relies on: UTC session time zone (dates
are cut from timestamps), ANSI mode (bad casts raise unless ``try_*`` is
used), adaptive execution with skew-join splitting and dynamic partition
overwrite (sinks replace only the partitions they touch). The package itself is
added to the session's Python files, so that executors can import it wherever
they run.
"""

from __future__ import annotations

import os
import re
import shutil
import tempfile

from pyspark.sql import DataFrame, SparkSession

BASE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # Rows of the text stage carry whole-document name lists (up to ~20k names);
    # a row-count cap keeps one Arrow batch to a few hundred MB in the worst case.
    "spark.sql.execution.arrow.maxRecordsPerBatch": "1000",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def apply_conf(spark: SparkSession) -> SparkSession:
    """Apply the runtime-settable part of ``BASE_CONF`` to an existing session."""
    for key, value in BASE_CONF.items():
        if key.startswith("spark.sql."):
            spark.conf.set(key, value)
    ship_package(spark)
    return spark


def build_session(
    master: str | None = None,
    app_name: str = "limelight",
    shuffle_partitions: int | None = None,
    extra_conf: dict[str, str] | None = None,
) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(BASE_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra_conf or {})
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ship_package(spark)
    return spark


def ship_package(spark: SparkSession) -> None:
    """Add this package to the Python path of the executors, once per Spark context.

    Functions that run in Python workers are pickled by module name, so a worker
    outside the source folder must be able to import the package."""
    sc = spark.sparkContext
    if getattr(sc, "_limelight_shipped", False):
        return
    here = os.path.dirname(os.path.abspath(__file__))
    folder = os.path.realpath(tempfile.mkdtemp(prefix="limelight-package-"))
    source = os.path.join(folder, "source", os.path.basename(here))
    shutil.copytree(here, source, ignore=shutil.ignore_patterns("__pycache__"))
    sc.addPyFile(shutil.make_archive(os.path.join(folder, "limelight"), "zip", os.path.dirname(source)))
    shutil.rmtree(os.path.join(folder, "source"))
    sc._limelight_shipped = True


def shared_dir(spark: SparkSession) -> str:
    """The folder of ``spark.checkpoint.dir``. Where that is unset, a scratch folder in local
    mode (one process: driver and executors share it), an error on a cluster."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if not current:
        if not re.fullmatch(r"local(\[[^\]]*\])?", sc.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
        current = tempfile.mkdtemp(prefix="limelight-shared-")
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(current)
    return current


def checkpointed(df: DataFrame) -> DataFrame:
    """Write ``df`` to the shared folder and go on from there; its partitions are fixed by that."""
    shared_dir(df.sparkSession)
    return df.checkpoint()
