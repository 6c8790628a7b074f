"""What the operators share: tables in the scratch folder, batch sizes, free column names."""

from __future__ import annotations

import gc
import os
import shutil
import tempfile
from collections.abc import Callable, Hashable
from typing import TypeVar

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from outagelens.sources.scratch import scratch_folder

#: Rows and bytes of text that a Python worker holds at once.
BATCH_ROWS = 1024
BATCH_BYTES = 16 * 1024 * 1024


Model = TypeVar("Model")

_SHIPPED: set[str] = set()


def prepare(spark: SparkSession) -> SparkSession:
    """Send this package to the executors once; bound what one Arrow batch carries.

    Rows are bounded by number and bytes, as single texts may be very long.
    """
    context = spark.sparkContext
    if context.applicationId not in _SHIPPED:
        top = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
        archive = os.path.join(tempfile.mkdtemp(prefix="outagelens-code-"), "outagelens_code")
        context.addPyFile(shutil.make_archive(archive, "zip", top, "outagelens"))
        _SHIPPED.add(context.applicationId)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    return spark


_MODEL: dict[tuple[str, object], object] = {}


def model_of(kind: str, definition: Hashable, make: Callable[[], Model]) -> Model:
    """What this process works with, made once; of other kinds and definitions none is kept.

    Python workers outlive a stage, and each stage works with one model: those of earlier stages
    would only fill the memory of the machine.
    """
    if (kind, definition) not in _MODEL:
        _MODEL.clear()
        gc.collect()
        _MODEL[kind, definition] = make()
    return _MODEL[kind, definition]


def kept(rows: DataFrame, name: str) -> DataFrame:
    """Write the rows to the shared scratch folder and read them back.

    Later steps then neither derive them anew nor depend on the executors that made them.
    """
    path = scratch_folder(rows.sparkSession, name)
    rows.write.parquet(path)
    return rows.sparkSession.read.schema(rows.schema).parquet(path)


def whole_text(column: Column | str = "text") -> Column:
    """The text, null read as empty."""
    column = F.col(column) if isinstance(column, str) else column
    return F.coalesce(column.cast("string"), F.lit(""))


def free_name(df: DataFrame, base: str) -> str:
    """A column name the table does not have (names are compared without case)."""
    taken = {name.lower() for name in df.columns}
    name = base
    while name.lower() in taken:
        name = f"_{name}"
    return name


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One table of a data folder, through Spark's reader."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
