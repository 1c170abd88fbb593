"""Readers and writers for the clean, feature and result tables."""

from __future__ import annotations

import hashlib
import warnings
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs
import pyarrow.parquet
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

BUCKET = "ticker_bucket"

_CSV = {"header": True}
_UNTRIMMED = {"ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}


def bucket_of(ticker: str | Column, buckets: int) -> Column:
    return F.pmod(F.xxhash64(ticker), F.lit(buckets)).cast("int")


def write_by_ticker(
    bars: DataFrame, path: str, buckets: int | None = None, clustered: bool = False
) -> None:
    """Parquet, one folder per ticker, in date order; replaces the table.

    A ticker's rows must share a task for its folder to get one file. ``clustered`` says they
    already do -- true for the output of any per-ticker window -- which saves a shuffle of the
    whole table. A folder per ticker suits universes up to some thousands; for more,
    ``buckets`` bounds the number of folders, and the sort lets row-group statistics find a
    ticker inside its bucket.
    """
    if buckets is not None:
        folder = BUCKET
        laid_out = bars.withColumn(BUCKET, bucket_of("ticker", buckets)).repartition(BUCKET)
    else:
        folder = "ticker"
        laid_out = bars if clustered else bars.repartition("ticker")
    order = dict.fromkeys([folder, "ticker", "date"])
    laid_out.sortWithinPartitions(*order).write.mode("overwrite").partitionBy(folder).parquet(path)


def unreadable_files(spark: SparkSession, path: str) -> DataFrame:
    """(file, error) of the files below ``path`` whose parquet footer cannot be read.

    Files are listed by Spark, which passes over empty ones, and opened in tasks, which read
    nothing but footers.
    """

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            for file in batch.column("file").to_pylist():
                system, place = pyarrow.fs.FileSystem.from_uri(file)
                try:
                    with system.open_input_file(place) as source:
                        pyarrow.parquet.read_metadata(source)
                except (pa.ArrowException, OSError) as error:
                    found.append((file, str(error).splitlines()[0]))
            columns = list(zip(*found)) if found else [(), ()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, pa.string()) for c in columns], ["file", "error"]
            )

    listed = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
    files = listed.select(F.col("_metadata.file_path").alias("file"))
    # A few bytes of each file are read, whatever its size; deal files, not bytes.
    return files.repartition("file").mapInArrow(check, "file string, error string")


def read_by_ticker(
    spark: SparkSession, path: str, schema: StructType, skip_corrupt: bool = False,
    ticker: str | None = None, buckets: int | None = None,
) -> DataFrame:
    """A table of ``write_by_ticker``, or one ticker of it.

    The explicit schema keeps tickers such as "600000" text; inferring the folder names would
    turn them into numbers. With ``buckets`` as written, one ticker opens one bucket only.
    ``skip_corrupt`` leaves out files that cannot be read, and warns of them;
    ``unreadable_files`` lists them.
    """
    if skip_corrupt:
        skipped = unreadable_files(spark, path).agg(
            F.count("*").alias("files"), F.min_by("error", "file").alias("error"),
            F.min("file").alias("first"),
        ).first()
        if skipped.files:
            warnings.warn(
                f"{skipped.files} unreadable files are skipped, the first {skipped.first}: "
                f"{skipped.error}", stacklevel=2,
            )
    reader = spark.read.option("ignoreCorruptFiles", skip_corrupt)
    if ticker is not None and buckets is not None:
        bucketed = reader.schema(StructType([*schema.fields, StructField(BUCKET, IntegerType())]))
        table = bucketed.parquet(path).filter(
            F.col(BUCKET) == bucket_of(F.lit(ticker), buckets)
        )
    else:
        table = reader.schema(schema).parquet(path)
    if ticker is not None:
        table = table.filter(F.col("ticker") == ticker)
    return table.select(*schema.names)


def _catalog_name(path: str, buckets: int) -> str:
    """The session's name for a bucketed table; the files are the table, the name only tells
    Spark their layout."""
    return "bars_" + hashlib.sha256(f"{path}/{buckets}".encode()).hexdigest()[:24]


def write_bucketed(bars: DataFrame, path: str, buckets: int) -> None:
    """Parquet in ``buckets`` files by hash of the ticker, each in (ticker, date) order; replaces
    the table.

    Reads with the layout (``read_bucketed``) need no Exchange for any per-ticker work. Rows
    that are already dealt by ticker into as many partitions are written where they are; others
    are shuffled once.
    """
    laid_out = bars.repartition(buckets, "ticker")
    (
        laid_out.write.mode("overwrite").format("parquet").option("path", path)
        .bucketBy(buckets, "ticker").sortBy("ticker", "date")
        .saveAsTable(_catalog_name(path, buckets))
    )


def read_bucketed(
    spark: SparkSession, path: str, schema: StructType, buckets: int
) -> DataFrame:
    """A table of ``write_bucketed``, also one of another session, with its layout known."""
    name = _catalog_name(path, buckets)
    if not spark.catalog.tableExists(name):
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
        place = path.replace("\\", "\\\\").replace("'", "\\'")
        spark.sql(
            f"CREATE TABLE {name} ({columns}) USING parquet CLUSTERED BY (ticker) "
            f"SORTED BY (ticker, date) INTO {buckets} BUCKETS LOCATION '{place}'"
        )
    return spark.table(name).select(*schema.names)


def write_csv(table: DataFrame, path: str) -> None:
    """Header CSV written by the executors; nothing passes through the driver. Blanks around a
    text belong to it."""
    table.write.mode("overwrite").options(**_CSV, **_UNTRIMMED).csv(path)


def read_csv(spark: SparkSession, path: str, schema: StructType | str) -> DataFrame:
    return spark.read.schema(schema).options(**_CSV, **_UNTRIMMED).csv(path)


def write_json(table: DataFrame, path: str) -> None:
    table.write.mode("overwrite").json(path)


def read_json(spark: SparkSession, path: str, schema: StructType | str) -> DataFrame:
    return spark.read.schema(schema).json(path)
