"""Session settings and the shared folder for staged tables."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession


GIB = 1 << 30


def sizing(input_bytes: int) -> dict[str, str]:
    """Partition settings for an input of this size.

    Adaptive execution only merges shuffle partitions, so there must be enough of them to start
    with: one per GiB of input, and 200 at least. Joins and groupings here shuffle a fraction of
    the input's columns. The settings of a cluster may say otherwise, as may ``get_session(**conf)``.
    """
    partitions = max(200, -(-input_bytes // GIB))
    return {"spark.sql.adaptive.coalescePartitions.initialPartitionNum": str(partitions)}


def get_session(app_name: str = "lumbung", input_bytes: int | None = None, **conf: str) -> SparkSession:
    """A session with the settings every job here assumes; ``conf`` adds or overrides.

    ``input_bytes``, the size of the largest table, sets the partition numbers.
    """
    settings = {
        **(sizing(input_bytes) if input_bytes else {}),
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.ansi.enabled": "true",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.ui.enabled": "false",
        **conf,
    }
    builder = SparkSession.builder.appName(app_name)
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach, as named by ``spark.checkpoint.dir``.

    Only a session with a single process (master ``local`` or ``local[n]``) that names none gets a
    temporary folder of its own.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if folder:
        return folder.rstrip("/")
    if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by the whole cluster")
    spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="lumbung-"))
    return spark.sparkContext.getCheckpointDir().rstrip("/")


#: Folder of the stages of the job that runs, below that of the application.
_AREA: ContextVar[str] = ContextVar("area", default="")


def _stage_root(spark: SparkSession) -> str:
    return f"{shared_folder(spark)}/lumbung/{spark.sparkContext.applicationId}{_AREA.get()}"


def stage_path(spark: SparkSession, name: str) -> str:
    """A new, unused path below the shared folder."""
    return f"{_stage_root(spark)}/{name}-{uuid.uuid4().hex}"


def drop_stages(spark: SparkSession) -> None:
    """Delete the staged tables of this application or ``staging_area``, once no result needs them any more."""
    root = spark._jvm.org.apache.hadoop.fs.Path(_stage_root(spark))
    root.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(root, True)


@contextmanager
def staging_area(spark: SparkSession) -> Iterator[str]:
    """A folder for what is staged inside, which is deleted at the end, also after a failure."""
    token = _AREA.set(f"{_AREA.get()}/job-{uuid.uuid4().hex}")
    try:
        yield _stage_root(spark)
    finally:
        drop_stages(spark)
        _AREA.reset(token)


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once to the shared folder, at once, and read it back.

    Functions that call this run jobs while they build their result. ``drop_stages`` deletes what
    an application has staged, when nothing reads it any more; a job whose result is stored
    elsewhere runs in a ``staging_area``.

    Use it for a small result that several later steps read: it cuts the lineage, survives the
    loss of executors, and gives the planner real file sizes, so that later joins are broadcast
    only when the table is below ``spark.sql.autoBroadcastJoinThreshold``.
    """
    spark = df.sparkSession
    path = stage_path(spark, name)
    df.write.mode("errorifexists").parquet(path)
    return spark.read.schema(df.schema).parquet(path)
