"""Committed manifests: which source file a cache holds, and in which generation of bars.

A manifest is a small table of its own folder. It counts once Spark's job commit has marked that
folder; the latest marked one is the state of the cache. Generations that no manifest names are
never read, so a run that broke off needs no repair.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickerloom.sources.storage import remove_folder

SCHEMA = "file string, length bigint, modified timestamp, generation int"


def _folders(spark: SparkSession, cache: str, pattern: str) -> list[str]:
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{cache}/{pattern}")
    system = path.getFileSystem(spark._jsc.hadoopConfiguration())
    return [str(found.getPath()) for found in system.globStatus(path) or []]


def _versions(spark: SparkSession, cache: str) -> dict[int, str]:
    """Folder of every committed manifest by its version."""
    marks = _folders(spark, cache, "manifest-*/_SUCCESS")
    folders = [mark.rsplit("/", 1)[0] for mark in marks]
    return {int(folder.rsplit("-", 1)[1]): folder for folder in folders}


def latest(spark: SparkSession, cache: str) -> tuple[int, DataFrame | None]:
    """(version, its files) of the last committed manifest, or (0, None)."""
    versions = _versions(spark, cache)
    if not versions:
        return 0, None
    version = max(versions)
    return version, spark.read.schema(SCHEMA).parquet(versions[version])


def write_bars(bars: DataFrame, cache: str, generation: int) -> None:
    bars.write.mode("overwrite").parquet(f"{cache}/bars/generation={generation}")


def commit(files: DataFrame, cache: str, version: int) -> None:
    """Make the manifest the cache's state; of the older ones the last stays, for runs that are
    reading by it, and generations that neither names are removed."""
    spark = files.sparkSession
    files.selectExpr("file", "length", "modified", "generation").write.mode("overwrite").parquet(
        f"{cache}/manifest-{version}"
    )
    versions = _versions(spark, cache)
    kept = sorted(versions)[-2:]
    for old in sorted(versions)[:-2]:
        remove_folder(spark, versions[old])
    named = {
        row.generation
        for v in kept
        for row in spark.read.schema(SCHEMA).parquet(versions[v]).select("generation").distinct().collect()
    }
    for folder in _folders(spark, cache, "bars/generation=*"):
        if int(folder.rsplit("=", 1)[1]) not in named:
            remove_folder(spark, folder)


def bars(spark: SparkSession, cache: str, files: DataFrame) -> DataFrame:
    """The bars of the manifest's files, each from its generation."""
    if not _folders(spark, cache, "bars/generation=*"):
        raise FileNotFoundError(f"the cache {cache} holds no bars")
    table = spark.read.parquet(f"{cache}/bars")
    named = files.select(F.col("file").alias("source_file"), "generation")
    return table.join(named, ["source_file", "generation"], "left_semi").drop("generation")
