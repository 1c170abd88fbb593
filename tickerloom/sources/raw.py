"""Raw bars from CSV folders or a parquet cache."""

from __future__ import annotations

import datetime as dt
import warnings
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tickerloom.functions.scalars import as_day, as_price, as_ticker, as_volume
from tickerloom.operators.cleaning import in_date_range, in_universe
from tickerloom.params import BAR_COLUMNS, BAR_TYPES, PRICE_COLUMNS, Params
from tickerloom.sources import manifests
from tickerloom.sources.storage import materialize


# Column of the cache: the text of a date that fits no format.
UNREAD = "unread_date"


def normalize_columns(raw: DataFrame) -> DataFrame:
    """Lower-case trimmed headers with underscores; ``name`` stands in for ``ticker``.

    Two headers that become one name are an error.
    """
    headers: dict[str, str] = {}
    for header in raw.columns:
        name = "_".join(header.strip().lower().split(" "))
        if name in headers:
            raise ValueError(f"headers {headers[name]!r} and {header!r} both mean {name!r}")
        headers[name] = header
    renamed = {"name": "ticker"} if "ticker" not in headers else {}
    return raw.toDF(*(renamed.get(name, name) for name in headers))


def union_sources(sources: list[DataFrame]) -> DataFrame:
    """All rows of all sources by column name; a column a source lacks is null."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), sources)


FILE = "source_file"


def csv_files(spark: SparkSession, folder: str) -> DataFrame:
    """(file, length, modified) of the folder's CSV files; nothing of them is read."""
    listed = spark.read.format("binaryFile").option("pathGlobFilter", "*.csv").load(folder)
    return listed.select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_size").alias("length"),
        F.col("_metadata.file_modification_time").alias("modified"),
    )


def _lines(spark: SparkSession, folder: str, options: dict[str, str]) -> DataFrame:
    """The lines of the CSV files that are not blank."""
    lines = spark.read.options(pathGlobFilter="*.csv", **options).text(folder)
    return lines.filter(F.trim("value") != "").select(
        "value", F.col("_metadata.file_path").alias(FILE),
        F.col("_metadata.file_block_start").alias("_offset"),
        F.col("_metadata.file_name").alias("_name"),
    )


def _fields(line: Column | str, width: int) -> Column:
    """The fields of a CSV line; fields it lacks are null."""
    schema = ", ".join(f"c{i} string" for i in range(width))
    parsed = F.from_csv(line, schema)
    return F.array(*[parsed[f"c{i}"] for i in range(width)])


def _headers(lines: DataFrame) -> tuple[DataFrame, int, list[str]]:
    """((source_file, header, names) of every file, most fields of a header, all names).

    The headers are rows: only their greatest width and the different names, not the files,
    come to the driver. Two headers of one file that become one name are an error.
    """
    first = lines.filter("_offset = 0").withColumn("_line", F.monotonically_increasing_id())
    first = first.groupBy(FILE).agg(F.min_by("value", "_line").alias("header"))
    first = materialize(first, "headers")
    commas = F.length("header") - F.length(F.replace("header", F.lit(",")))
    width = (first.agg(F.max(commas)).first()[0] or 0) + 1

    def plain(field: Column) -> Column:
        bare = F.regexp_replace(F.coalesce(field, F.lit("")), r"^\s+|\s+$", "")
        return F.replace(F.lower(bare), F.lit(" "), F.lit("_"))

    named = first.withColumn("_plain", F.transform(_fields("header", width), plain))
    ticker = F.array_contains("_plain", "ticker")
    names = F.transform(
        "_plain", lambda n: F.when((n == "name") & ~ticker, F.lit("ticker")).otherwise(n)
    )
    named = named.select(FILE, "header", names.alias("names"))
    found = (
        named.select(FILE, "header", F.explode("names").alias("name")).filter("name <> ''")
        .groupBy(FILE, "header", "name").agg(F.count(F.lit(1)).alias("n"))
        .groupBy("name").agg(F.max_by("header", "n").alias("header"), F.max("n").alias("n"))
        .orderBy("name").collect()
    )
    for row in found:
        if row.n > 1:
            raise ValueError(f"headers of {row.header!r} both mean {row.name!r}")
    return named, width, [row.name for row in found]


def read_csv_folder(
    spark: SparkSession, folder: str, same_header: bool = False, only: DataFrame | None = None,
    keep_file: bool = False, options: dict[str, str] | None = None,
) -> DataFrame:
    """Every ``*.csv`` of a folder as text columns, united by normalised column name.

    One text scan serves any number of headers: each line is parsed and its fields are picked by
    the names in its own file's header, which is joined as a row. A line equal to its file's
    header is a header. A file with neither a ticker nor a name column gets its ticker from the
    file name. ``only`` (file) restricts the files, ``options`` go to the scan, ``keep_file``
    adds the path as ``source_file``.

    ``same_header`` promises a single header: Spark's own CSV scan then reads the folder without
    the pass for the headers, and fails on a file that breaks the promise.
    """
    try:
        if csv_files(spark, folder).limit(1).count() == 0:
            raise FileNotFoundError(f"no CSV files in {folder}")
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        raise FileNotFoundError(f"no CSV files in {folder}") from error
    stem = F.regexp_replace(F.col("_name"), r"\.[^.]*$", "")
    own_ticker = F.upper(F.url_decode(stem))
    wanted = None if only is None else only.select(F.col("file").alias(FILE))
    if same_header:
        plain = {"header": True, "pathGlobFilter": "*.csv"}
        header = spark.read.options(**plain).csv(folder).columns
        schema = ", ".join(f"`{name.replace('`', '``')}` STRING" for name in header)
        scan = spark.read.schema(schema).options(**plain, enforceSchema=False, **(options or {}))
        rows = scan.csv(folder)
        table = normalize_columns(rows)
        names = table.columns
        table = table.select("*", F.col("_metadata.file_path").alias(FILE),
                             F.col("_metadata.file_name").alias("_name"))
        table = table if wanted is None else table.join(wanted, FILE, "left_semi")
    else:
        lines = _lines(spark, folder, options or {})
        lines = lines if wanted is None else lines.join(wanted, FILE, "left_semi")
        headers, width, names = _headers(lines)
        rows = lines.join(headers, FILE).filter((F.col("_offset") > 0) | (F.col("value") != F.col("header")))
        rows = rows.withColumn("_fields", _fields("value", width))

        def field(name: str) -> Column:
            place = F.array_position("names", name).cast("int")
            return F.when(place > 0, F.get("_fields", place - 1)).alias(name)

        table = rows.select(*[field(name) for name in names], FILE, "_name", "names")
        if "ticker" in names:
            lacking = ~F.array_contains("names", "ticker")
            table = table.withColumn("ticker", F.when(lacking, own_ticker).otherwise(F.col("ticker")))
    if "ticker" not in names:
        table = table.withColumn("ticker", own_ticker)
    kept = list(dict.fromkeys([*names, "ticker"]))
    return table.select(*kept, *([FILE] if keep_file else []))


def coerce_raw(
    raw: DataFrame, missing_volume: int | None = None, date_formats: tuple[str, ...] = ()
) -> DataFrame:
    """Typed bars from text: bad dates and prices become null, bad volume ``missing_volume``.

    Keeps the bar columns that are present and drops rows without a date or close.
    """
    return _typed(raw, missing_volume, date_formats).dropna(subset=["close", "date"])


def _typed(raw: DataFrame, missing_volume: int | None, date_formats: tuple[str, ...]) -> DataFrame:
    casts = {
        "date": as_day(F.col("date"), date_formats),
        "ticker": as_ticker(F.col("ticker")),
        **{c: as_price(F.col(c)) for c in PRICE_COLUMNS},
    }
    if "volume" in raw.columns:
        casts["volume"] = as_volume(F.col("volume"), missing_volume)
    kept = [casts[c].alias(c) for c in BAR_COLUMNS if c in raw.columns]
    return raw.select(*kept, *[c for c in (UNREAD, FILE) if c in raw.columns])


def unparsed_date(params: Params) -> Column:
    """Whether a row has a date that is not blank and fits no known format."""
    blank = F.coalesce(F.trim(F.col("date").cast("string")) == "", F.lit(True))
    return ~blank & as_day(F.col("date"), params.date_formats).isNull()


def load_bars(raw: DataFrame, params: Params, missing_volume: int | None = None) -> DataFrame:
    """Typed bars of the universe inside the date range."""
    typed = coerce_raw(raw, missing_volume, params.date_formats)
    return typed.transform(in_universe, params.universe).transform(in_date_range, params)


def write_raw(bars: DataFrame, path: str) -> None:
    bars.write.mode("overwrite").parquet(path)


def update_cache(
    spark: SparkSession, folder: str, cache: str, params: Params, same_header: bool = False,
    refresh: bool = False,
) -> DataFrame:
    """The cache's bars, after what changed in the folder has been read.

    A committed manifest says which file (path, length, time) the cache holds in which
    generation of bars. Files that are new or changed are read into a new generation, files
    that are gone leave; the next manifest makes all of it visible at once. A run that stops
    before that commit leaves the cache as it was. Without the folder, or without any change,
    the cache is served as it is.
    """
    version, known = manifests.latest(spark, cache)
    try:
        current = csv_files(spark, folder)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        if known is None:
            raise FileNotFoundError(f"no CSV files in {folder}") from error
        return manifests.bars(spark, cache, known)
    place = ["file", "length", "modified"]
    before = known if known is not None and not refresh else None
    if before is None:
        staged = current.withColumn("generation", F.lit(version + 1))
    else:
        staged = current.join(before, place, "left").withColumn(
            "generation", F.coalesce("generation", F.lit(version + 1))
        )
    staged = materialize(staged.select(*place, "generation"), "manifest")
    fresh = staged.filter(F.col("generation") == version + 1)
    facts = staged.agg(
        F.count("*").alias("files"), F.count_if(F.col("generation") <= version).alias("kept"),
        F.min(F.when(F.col("generation") > version, F.col("modified"))).alias("since"),
    ).first()
    if known is None and not facts.files:
        raise FileNotFoundError(f"no CSV files in {folder}")
    if before is not None and facts.kept == facts.files == before.count():
        return manifests.bars(spark, cache, known)
    if facts.kept < facts.files:
        # Files from before the first change are not even listed by the scan.
        options = {"timeZone": "UTC"}
        if before is not None:
            since = facts.since - dt.timedelta(seconds=2)
            options["modifiedAfter"] = since.astimezone(dt.timezone.utc).strftime("%Y-%m-%dT%H:%M:%S")
        text = read_csv_folder(spark, folder, same_header, fresh, True, options)
        unread = F.when(unparsed_date(params), F.col("date").cast("string"))
        typed = _typed(text.withColumn(UNREAD, unread), None, params.date_formats)
        missing = [c for c in BAR_COLUMNS if c not in typed.columns]
        typed = typed.withColumns({c: F.lit(None).cast(BAR_TYPES[c]) for c in missing})
        manifests.write_bars(typed, cache, version + 1)
    manifests.commit(staged, cache, version + 1)
    return manifests.bars(spark, cache, staged)


def ingest(
    spark: SparkSession, folder: str, cache: str, params: Params, same_header: bool = False,
    refresh: bool = False,
) -> DataFrame:
    """Raw bars of a CSV folder through its parquet cache, which follows the folder's files.

    The cache holds every typed bar of the folder; universe and date range are applied on
    reading, so one cache serves any request. ``refresh`` reads every file again. The text of a
    date that fits no format is kept and tried again on reading; such rows are warned of, and if
    no row has a readable date, that is an error.
    """
    cached = update_cache(spark, folder, cache, params, same_header, refresh).drop(FILE)
    again = F.coalesce("date", as_day(F.col(UNREAD), params.date_formats))
    tried = cached.withColumn("date", again)
    lost = tried.agg(
        F.count(F.lit(1)).alias("rows"),
        F.count_if(F.col("date").isNull() & F.col(UNREAD).isNotNull()).alias("unread"),
    ).first()
    if lost.unread and lost.unread == lost.rows:
        raise ValueError(f"none of the {lost.rows} dates in {folder} fits the date formats")
    if lost.unread:
        warnings.warn(f"{lost.unread} of {lost.rows} rows have unreadable dates", stacklevel=2)
    return load_bars(tried.drop(UNREAD), params)
