"""Daily bars derived from a trade table (line items priced through their part)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

TRADE_ORDER = ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "price")


def read_trades(spark: SparkSession, folder: str) -> DataFrame:
    """One row per trade: ticker, date, the trade-order columns, price and quantity.

    The join carries no hint: the part table grows with the data, so its measured size
    decides between a broadcast and a skew-aware shuffle join.
    """
    items = spark.read.parquet(f"{folder}/lineitem.parquet").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
        "l_quantity", "l_discount", "l_shipdate",
    )
    parts = spark.read.parquet(f"{folder}/part.parquet").select(
        "p_partkey", "p_brand", "p_retailprice"
    )
    return items.join(parts, items.l_partkey == parts.p_partkey).select(
        F.col("p_brand").alias("ticker"),
        F.to_date("l_shipdate").alias("date"),
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
        (F.col("p_retailprice") * (1 - F.col("l_discount"))).alias("price"),
        F.col("l_quantity").alias("quantity"),
    )


def bars_from_trades(trades: DataFrame) -> DataFrame:
    """Open/high/low/close/volume per (ticker, date).

    Every aggregate has a map-side partial, so a ticker that holds a third of all trades
    shuffles one row per day and map task.
    """
    order = F.struct(*TRADE_ORDER)
    return trades.groupBy("date", "ticker").agg(
        F.min_by("price", order).alias("open"),
        F.max("price").alias("high"),
        F.min("price").alias("low"),
        F.max_by("price", order).alias("close"),
        F.sum("quantity").cast("bigint").alias("volume"),
    )
