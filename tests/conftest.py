import datetime as dt
import os
import sys

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tickerloom.params import Params

BAR_SCHEMA = (
    "ticker string, date date, open double, high double, low double, close double, volume bigint"
)


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[4]")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "4g")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("checkpoints")))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def params():
    return Params(universe=None, benchmark="AAA")


def day(n: int) -> dt.date:
    return dt.date(2024, 1, 1) + dt.timedelta(days=n)


@pytest.fixture
def make_bars(spark):
    """Bars from closes per ticker; open/high/low follow the close."""

    def make(closes: dict[str, list], volumes: dict[str, list] | None = None):
        rows = []
        for ticker, series in closes.items():
            for i, close in enumerate(series):
                volume = 100 if volumes is None else volumes[ticker][i]
                rows.append((ticker, day(i), close, close, close, close, volume))
        return spark.createDataFrame(rows, BAR_SCHEMA)

    return make


@pytest.fixture
def column():
    """One column of one ticker, in date order."""

    def get(df, name, ticker="AAA"):
        return [r[name] for r in df.filter(df.ticker == ticker).orderBy("date").collect()]

    return get
