"""Session settings and the shared scratch folder."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile

from pyspark.sql import DataFrame, SparkSession


def build_session(app: str = "vacancylake", cores: str | int = "*", **conf: str) -> SparkSession:
    """A local session with the settings the jobs are tuned for.

    On a cluster the submitter owns these settings; nothing in the library
    depends on them beyond UTC as the session zone.
    """
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
    )
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can read and write.

    It is the one the cluster names in ``spark.checkpoint.dir``. Only a local
    session, where all tasks share one disk, may fall back to a temporary one.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named
    already = spark.sparkContext.getCheckpointDir()
    if already:
        return already
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    folder = tempfile.mkdtemp(prefix="vacancylake-")
    spark.sparkContext.setCheckpointDir(folder)
    return folder


def new_shared_path(spark: SparkSession, label: str) -> str:
    """A fresh path under the shared folder; never reused, so never overwritten."""
    return os.path.join(shared_folder(spark), f"{label}-{uuid.uuid4().hex}")


def cut_lineage(df: DataFrame) -> DataFrame:
    """Materialise ``df`` reliably so later steps see one fixed row layout."""
    spark = df.sparkSession
    folder = shared_folder(spark)
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(folder)
    return df.checkpoint(eager=True)


def stored(df: DataFrame, label: str) -> DataFrame:
    """``df`` written once to the shared folder and read back.

    For results with several readers: the work above is not repeated per reader,
    and a lost executor costs a re-read, not a re-computation.
    """
    path = new_shared_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def ship_package(spark: SparkSession) -> None:
    """Give the Python tasks of this application the package's own modules, once."""
    context = spark.sparkContext
    if getattr(context, "_vacancylake_shipped", False):
        return
    home = os.path.dirname(os.path.abspath(__file__))
    archive = os.path.join(tempfile.mkdtemp(prefix="vacancylake-code-"), "vacancylake.zip")
    with zipfile.ZipFile(archive, "w") as out:
        for folder, _, files in os.walk(home):
            for name in files:
                if name.endswith(".py"):
                    path = os.path.join(folder, name)
                    out.write(path, os.path.relpath(path, os.path.dirname(home)))
    context.addPyFile(archive)  # the driver serves it to every executor
    context._vacancylake_shipped = True
