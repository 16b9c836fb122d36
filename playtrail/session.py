"""Session settings and the shared folder used by writes that cut lineage."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import SparkSession

LOCAL_FOLDER = "/tmp/checkpoints"
# Settings a job should run with; none of them changes a result.
RECOMMENDED = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    # event records have more than 100 leaves; beyond this bound Spark stops compiling stages
    "spark.sql.codegen.maxFields": "500",
    "spark.ui.enabled": "false",
}


def build_session(app: str, master: str | None = None, **extra: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**RECOMMENDED, **extra}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach, as the cluster names it.

    A session on one machine that names none uses LOCAL_FOLDER; a cluster has to name one.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    current = spark.sparkContext.getCheckpointDir()
    if current:
        return current.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    return f"file:{LOCAL_FOLDER}"


_OPEN: ContextVar[list[str] | None] = ContextVar("intermediate", default=None)


def fresh_path(spark: SparkSession, label: str) -> str:
    """A new path under the shared folder. Nothing is reused; what is written inside ``intermediate`` goes at its end."""
    path = f"{shared_folder(spark)}/{label}-{uuid.uuid4().hex}"
    made = _OPEN.get()
    if made is not None:
        made.append(path)
    return path


@contextmanager
def intermediate(spark: SparkSession) -> Iterator[None]:
    """The tables that jobs write on their way are removed at the end of this block, whether it succeeds or not.

    Results have to be written inside the block: a job's rows are still read from these tables when they are used. A
    block inside another one removes its own tables only.
    """
    made: list[str] = []
    token = _OPEN.set(made)
    try:
        yield
    finally:
        _OPEN.reset(token)
        for path in made:
            place = spark._jvm.org.apache.hadoop.fs.Path(path)
            place.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(place, True)
