"""Small helpers the operators of this subpackage share."""

from __future__ import annotations

import ctypes
import uuid
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickerloom.sources.storage import materialize, scratch_path

__all__ = ["materialize", "scratch_path", "read_table", "words", "text_column", "task_count",
           "write_bytes", "read_range", "open_file", "texts_of", "release_memory"]


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def words(text: str | None) -> list[bytes]:
    """Maximal runs of anything but space and U+0009..U+000D, as UTF-8; null has none.

    ``bytes.split`` separates on exactly those six characters.
    """
    return text.encode().split() if text else []


def text_column(name: str = "text"):
    """The text with null as the empty string."""
    return F.coalesce(F.col(name).cast("string"), F.lit(""))


def task_count(spark: SparkSession) -> int:
    """Partitions for rows that are few but stand for much work each (files, bins, tiles)."""
    return max(
        int(spark.conf.get("spark.sql.shuffle.partitions")),
        2 * spark.sparkContext.defaultParallelism,
    )


def texts_of(batch: pa.RecordBatch, name: str = "text") -> Iterator[str]:
    """The texts of a batch one at a time, null as empty; never a second copy of the batch."""
    for value in batch.column(name):
        yield value.as_py() or ""


def release_memory() -> None:
    """Give freed memory back to the system at the end of a task: Spark keeps Python workers, and
    what they hold on to stands beside every later stage."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc's
    if trim is not None:
        trim(0)


# --- files in the shared folder, written and read inside tasks -------------------------------


def _located(uri: str) -> tuple[pyarrow.fs.FileSystem, str]:
    return pyarrow.fs.FileSystem.from_uri(uri)


def write_bytes(folder: str, stem: str, chunks: list[bytes]) -> str:
    """Write one new file and return its URI.

    Every attempt of a task writes names of its own, and a file counts only if the manifest
    that Spark commits names it. A lost executor or a second attempt leaves at most an orphan.
    """
    uri = f"{folder}/{stem}-{uuid.uuid4().hex}"
    system, path = _located(uri)
    system.create_dir(path.rsplit("/", 1)[0], recursive=True)
    with system.open_output_stream(path) as out:
        for chunk in chunks:
            out.write(chunk)
    return uri


def open_file(uri: str) -> pa.NativeFile:
    system, path = _located(uri)
    return system.open_input_file(path)


def read_range(uri: str, offset: int, length: int) -> bytes:
    with open_file(uri) as source:
        return source.read_at(length, offset)
