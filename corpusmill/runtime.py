"""Session helpers shared by all operators."""

from __future__ import annotations

import shutil
import tempfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusmill.errors import ConfigError

#: Rows up to which a table of a few numbers a row may be broadcast; beyond it the join shuffles.
BROADCAST_ROWS = 500_000


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """One Parquet table of a data folder."""
    ship(spark)
    return spark.read.parquet(f"{folder}/{name}.parquet")


def ship(spark: SparkSession) -> None:
    """Make the package importable in Python workers that were started without it on their path; once a session."""
    context = spark.sparkContext
    if not getattr(context, "_corpusmill_shipped", False):
        package = Path(__file__).resolve().parent
        folder = tempfile.mkdtemp(prefix="corpusmill-")
        context.addPyFile(shutil.make_archive(f"{folder}/corpusmill", "zip", package.parent, package.name))
        context._corpusmill_shipped = True


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors share: ``spark.checkpoint.dir``; a temporary one where that is unset and all runs on this machine."""
    context = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None)
    if context._jsc.sc().getCheckpointDir().isEmpty():
        if not named and not context.master.startswith("local"):
            raise ConfigError("spark.checkpoint.dir names no folder that all executors share")
        context.setCheckpointDir(named or tempfile.mkdtemp(prefix="corpusmill-"))
    return named or context._jsc.sc().getCheckpointDir().get()


def checkpointed(frame: DataFrame) -> DataFrame:
    """The frame, computed once and held in the shared folder, so that losing an executor loses nothing."""
    shared_folder(frame.sparkSession)
    return frame.checkpoint(eager=True)


def small_side(frame: DataFrame, rows: int, limit: int = BROADCAST_ROWS) -> DataFrame:
    """The frame with a broadcast hint if its counted rows are within the limit, else unchanged."""
    return F.broadcast(frame) if rows <= limit else frame


def spread(frame: DataFrame) -> DataFrame:
    """The rows of a scan over all cores, if it has at most half as many partitions as there are cores.

    For scans that feed work in Python: a small table may be one file that
    cannot be split. Tables with enough partitions, and frames that are no
    plain scans, stay as they are and are not shuffled.
    """
    cores = frame.sparkSession.sparkContext.defaultParallelism
    query = frame._jdf.queryExecution()
    if query.executedPlan().getClass().getSimpleName() == "AdaptiveSparkPlanExec":
        return frame
    return frame.repartition(cores) if 2 * query.toRdd().getNumPartitions() <= cores else frame
