"""The folder for tables a job writes and reads back."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

SETTING = "spark.checkpoint.dir"
COMPRESSION = "zstd"

# The folder of the job that runs just now, if it has one of its own.
_JOB: ContextVar[str | None] = ContextVar("scratch_of_job", default=None)


def scratch_folder(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder the cluster names, so executors can be lost.

    A cluster without the setting is refused: a folder of one machine would lose what other
    executors write. Driver and executors of a local session are one process, so there a
    temporary folder serves.
    """
    base = _JOB.get() or spark.conf.get(SETTING, None)
    if not base:
        base = shared_by_one_process(spark.sparkContext.master)
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def shared_by_one_process(master: str) -> str:
    """The temporary folder of a local session; an error for any cluster."""
    if master != "local" and not master.startswith("local["):
        raise ValueError(f"set {SETTING} to a folder that the driver and all executors share")
    return local_folder()


_LOCAL: list[str] = []


def local_folder() -> str:
    """A temporary folder that goes when this process ends."""
    if not _LOCAL:
        _LOCAL.append(tempfile.mkdtemp(prefix="outagelens-"))
        atexit.register(shutil.rmtree, _LOCAL[0], ignore_errors=True)
    return _LOCAL[0]


@contextmanager
def job_scratch(spark: SparkSession, name: str) -> Iterator[str]:
    """One scratch folder for all that is stored inside, removed at the end of the job.

    Tables that outlive the job must be written elsewhere before it ends.
    """
    folder = scratch_folder(spark, name)
    token = _JOB.set(folder)
    try:
        yield folder
    finally:
        _JOB.reset(token)
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def stored(rows: DataFrame, name: str) -> DataFrame:
    """The rows written to a scratch folder now and read back.

    For intermediate results that are read several times: they are derived once, and what
    follows does not depend on the executors that derived them. Ids and texts of digits, which
    fill these tables, take half the disk with ``COMPRESSION``.
    """
    path = scratch_folder(rows.sparkSession, name)
    rows.write.parquet(path, compression=COMPRESSION)
    return rows.sparkSession.read.schema(rows.schema).parquet(path)
