"""Where stage outputs live, and how a stage's lineage is cut."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_SETTING = "spark.checkpoint.dir"
#: Of folders that one run owns; no label of ``scratch_path`` begins like this.
RUN_PREFIX = "whole-run-"

_RUN: ContextVar[str | None] = ContextVar("run", default=None)


def shared_folder(spark: SparkSession) -> str:
    """The shared folder for intermediate data: the session's checkpoint folder.

    A local master with the setting unset uses the session's warehouse folder; on a cluster
    the folder must be named, since a machine-local one would be lost with its machine.
    """
    context = spark.sparkContext
    folder = spark.conf.get(CHECKPOINT_SETTING, None) or context.getCheckpointDir()
    if not folder:
        if not context.master.startswith("local"):
            raise ValueError(f"set {CHECKPOINT_SETTING} to a folder all executors share")
        folder = f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/scratch"
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(folder)
    return folder.rstrip("/")


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path in the shared folder; nothing is ever overwritten there."""
    return f"{_RUN.get() or _root(spark)}/{label}-{uuid.uuid4().hex}"


def _root(spark: SparkSession) -> str:
    return f"{shared_folder(spark)}/tickerloom"


@contextmanager
def run_folder(spark: SparkSession) -> Iterator[None]:
    """Intermediate tables of the block go to a folder of their own, removed at its end.

    What the block returns must not read them any more.
    """
    path = f"{_root(spark)}/{RUN_PREFIX}{uuid.uuid4().hex}"
    token = _RUN.set(path)
    try:
        yield
    finally:
        _RUN.reset(token)
        remove_folder(spark, path)


def remove_folder(spark: SparkSession, path: str) -> None:
    """Delete a folder in whatever file system it lies; a missing one is no error."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def materialize(df: DataFrame, label: str) -> DataFrame:
    """Write a stage output as a table and return a scan of it.

    Several branches that read the result then share one computation, a lost executor costs a
    re-read instead of a re-run, and the scan still prunes columns and pushes filters.
    """
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def fit_layout(table: DataFrame, partitions: int, *key: str) -> DataFrame:
    """A table dealt and ordered by its unique key, for fits that sample per partition.

    The layout, and so the model, does not depend on cores, files or the order of the rows.
    """
    return table.repartition(partitions, *key).sortWithinPartitions(*key)


def read_if_present(spark: SparkSession, path: str) -> DataFrame | None:
    """The parquet table at ``path``, or None if there is none."""
    try:
        return spark.read.parquet(path)
    except AnalysisException as error:
        if error.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return None
        raise
