import datetime as dt
import random
import warnings
from dataclasses import replace
from types import SimpleNamespace

import pytest
from conftest import day
from pyspark.sql import functions as F

from tickerloom.operators.cleaning import add_daily_return
from tickerloom.params import Params
from tickerloom.sources import manifests, raw, storage, tables
from tickerloom.sources.trades import bars_from_trades

WIDE = Params(universe=None, start=dt.date(1900, 1, 1), end=dt.date(2100, 1, 1))


@pytest.fixture
def csv_folder(tmp_path):
    folder = tmp_path / "raw"
    folder.mkdir()
    (folder / "b.csv").write_text(
        "Date,NAME,Open,High,Low,Close ,Volume\n"
        "2024-01-02, aaa ,1,2,0.5,1.5,100\n"
        "2024-01-03,aaa,x,2,0.5,1.6,\n"
        "bad,aaa,1,2,0.5,1.5,100\n"
    )
    (folder / "a.csv").write_text(
        "close,date,ticker\n2.5,2024-01-02,BBB\n,2024-01-03,BBB\n"
    )
    (folder / "ccc.d.csv").write_text("date,close,volume\n2024-01-02 00:00:00,9,7\n")
    (folder / "zz.csv").write_text("close,date,ticker\n3.5,2024-01-04,BBB\n")
    (folder / "notes.txt").write_text("not,a,bar\n")
    return str(folder)


def test_csv_folder_unites_header_styles(spark, csv_folder):
    table = raw.read_csv_folder(spark, csv_folder)
    assert set(table.columns) == {"date", "ticker", "open", "high", "low", "close", "volume"}
    assert table.count() == 7
    bars = raw.load_bars(table, WIDE).orderBy("ticker", "date").collect()
    assert [(r.ticker, r.date.day, r.close, r.volume) for r in bars] == [
        ("AAA", 2, 1.5, 100), ("AAA", 3, 1.6, None), ("BBB", 2, 2.5, None), ("BBB", 4, 3.5, None),
        ("CCC.D", 2, 9.0, 7),
    ]
    assert bars[1].open is None


def test_one_header_needs_no_extra_pass(spark, tmp_path):
    (tmp_path / "x.csv").write_text("Date,Close\n2024-01-02,1\n")
    (tmp_path / "y.csv").write_text("Date,Close\n2024-01-03,2\n")
    (tmp_path / "z.txt").write_text("Other\n1\n")
    table = raw.read_csv_folder(spark, str(tmp_path), same_header=True)
    assert sorted(map(tuple, table.select("ticker", "date", "close").collect())) == [
        ("X", "2024-01-02", "1"), ("Y", "2024-01-03", "2")
    ]
    (tmp_path / "w.csv").write_text("Close,Date\n3,2024-01-04\n")
    with pytest.raises(Exception, match="(?i)header"):
        raw.read_csv_folder(spark, str(tmp_path), same_header=True).collect()


def test_cluster_without_a_shared_folder_is_an_error():
    context = SimpleNamespace(master="yarn", getCheckpointDir=lambda: None)
    session = SimpleNamespace(
        sparkContext=context, conf=SimpleNamespace(get=lambda name, default: default)
    )
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        storage.shared_folder(session)


def test_missing_folder_or_files_is_an_error(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        raw.read_csv_folder(spark, str(tmp_path / "absent"))
    (tmp_path / "empty").mkdir()
    with pytest.raises(FileNotFoundError):
        raw.read_csv_folder(spark, str(tmp_path / "empty"))


def test_ingest_prefers_the_cache(spark, csv_folder, tmp_path):
    cache = str(tmp_path / "cache")
    first = raw.ingest(spark, csv_folder, cache, WIDE).count()
    only = Params(universe=("AAA",), start=day(1), end=day(1))
    again = raw.ingest(spark, "/nowhere", cache, only).collect()
    assert first == 5 and [(r.ticker, r.date) for r in again] == [("AAA", day(1))]


def test_one_cache_serves_a_wider_request(spark, csv_folder, tmp_path):
    cache = str(tmp_path / "cache")
    only = Params(universe=("AAA",), start=day(1), end=day(1))
    with pytest.warns(UserWarning, match="1 of 7 rows"):
        assert raw.ingest(spark, csv_folder, cache, only).count() == 1
    assert raw.ingest(spark, "/nowhere", cache, WIDE).count() == 5


def closes(bars):
    return sorted(r.close for r in bars.collect())


def test_the_cache_follows_its_files(spark, tmp_path):
    """An added, a changed and a removed file each show up, and nothing else is read again."""
    folder, cache = tmp_path / "raw", str(tmp_path / "cache")
    folder.mkdir()
    for name, close in (("a", 1), ("b", 2), ("c", 3)):
        (folder / f"{name}.csv").write_text(f"date,ticker,close\n2024-01-02,{name},{close}\n")
    assert closes(raw.ingest(spark, str(folder), cache, WIDE)) == [1, 2, 3]
    assert manifests.latest(spark, cache)[0] == 1
    assert closes(raw.ingest(spark, str(folder), cache, WIDE)) == [1, 2, 3]
    assert manifests.latest(spark, cache)[0] == 1  # nothing changed, nothing written
    (folder / "d.csv").write_text("Close,Date,Name\n4,2024-01-03,d\n")
    assert closes(raw.ingest(spark, str(folder), cache, WIDE)) == [1, 2, 3, 4]
    version, files = manifests.latest(spark, cache)
    by_file = {r.file.rsplit("/", 1)[1]: r.generation for r in files.collect()}
    assert version == 2 and by_file == {"a.csv": 1, "b.csv": 1, "c.csv": 1, "d.csv": 2}
    (folder / "a.csv").write_text("date,ticker,close\n2024-01-02,a,10\n2024-01-03,a,11\n")
    (folder / "b.csv").unlink()
    assert closes(raw.ingest(spark, str(folder), cache, WIDE)) == [3, 4, 10, 11]
    assert closes(raw.ingest(spark, "/nowhere", cache, WIDE)) == [3, 4, 10, 11]
    (folder / "c.csv").unlink()
    assert closes(raw.ingest(spark, str(folder), cache, WIDE)) == [4, 10, 11]
    assert closes(raw.ingest(spark, str(folder), cache, WIDE, refresh=True)) == [4, 10, 11]
    assert {r.generation for r in manifests.latest(spark, cache)[1].collect()} == {5}


def test_a_broken_run_leaves_the_cache_as_it_was(spark, tmp_path, monkeypatch):
    folder, cache = tmp_path / "raw", str(tmp_path / "cache")
    folder.mkdir()
    (folder / "a.csv").write_text("date,ticker,close\n2024-01-02,A,1\n")
    raw.ingest(spark, str(folder), cache, WIDE)
    (folder / "b.csv").write_text("date,ticker,close\n2024-01-03,A,2\n")
    with monkeypatch.context() as broken:
        broken.setattr(manifests, "commit", lambda *a: (_ for _ in ()).throw(OSError("lost")))
        with pytest.raises(OSError, match="lost"):
            raw.ingest(spark, str(folder), cache, WIDE)
    assert closes(raw.ingest(spark, "/nowhere", cache, WIDE)) == [1]
    assert closes(raw.ingest(spark, str(folder), cache, WIDE)) == [1, 2]


def test_many_headers_are_one_scan(spark, tmp_path):
    names = ["date", "ticker", "close", "volume", *(f"extra{i}" for i in range(6))]
    rng = random.Random(0)
    for i in range(60):
        order = rng.sample(names, len(names))
        values = {"date": "2024-01-02", "ticker": f"t{i}", "close": str(i), "volume": f'"{i}"'}
        line = ",".join(values.get(name, "x") for name in order)
        header = ",".join(rng.choice([name.upper(), f" {name} "]) for name in order)
        (tmp_path / f"f{i}.csv").write_text(f"\n{header}\n{line}\n\n")
    table = raw.read_csv_folder(spark, str(tmp_path))
    plan = table._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan text") == 1 and "Union" not in plan
    bars = raw.load_bars(table, WIDE).collect()
    assert {(r.ticker, r.close, r.volume) for r in bars} == {(f"T{i}", i, i) for i in range(60)}


def test_headers_that_collide_in_a_file_are_an_error(spark, tmp_path):
    (tmp_path / "a.csv").write_text("date,close\n2024-01-02,1\n")
    (tmp_path / "b.csv").write_text("date,Close,close \n2024-01-02,1,2\n")
    with pytest.raises(ValueError, match="both mean 'close'"):
        raw.read_csv_folder(spark, str(tmp_path))


def test_dates_in_other_formats_are_kept_or_reported(spark, tmp_path):
    folder = tmp_path / "raw"
    folder.mkdir()
    (folder / "a.csv").write_text("date,ticker,close\n01/15/2021,A,1\n02/15/2021,A,2\n")
    formats = replace(WIDE, date_formats=("MM/dd/yyyy",))
    bars = raw.ingest(spark, str(folder), str(tmp_path / "cache"), formats)
    assert sorted(r.date for r in bars.collect()) == [dt.date(2021, 1, 15), dt.date(2021, 2, 15)]
    other = str(tmp_path / "other")
    with pytest.raises(ValueError, match="none of the 2 dates"):
        raw.ingest(spark, str(folder), other, WIDE)
    assert raw.ingest(spark, "/nowhere", other, formats).count() == 2


def test_headers_that_collide_are_an_error(spark):
    table = spark.createDataFrame([(1, 2)], "Close int, `close ` int")
    with pytest.raises(ValueError, match="'Close'.*'close '"):
        raw.normalize_columns(table)


def test_coerce_fills_volume_only_when_asked(spark):
    text = spark.createDataFrame(
        [("2024-01-02", " x ", "1", "n/a", "keep out"), ("01/15/2024", "y", "2", "3.9", "")],
        "date string, ticker string, close string, volume string, other string",
    )
    typed = raw.coerce_raw(
        text.withColumns({c: F.lit("1") for c in ("open", "high", "low")}),
        missing_volume=0, date_formats=("MM/dd/yyyy",),
    )
    assert typed.columns == ["date", "ticker", "open", "high", "low", "close", "volume"]
    rows = typed.orderBy("ticker").collect()
    assert [(r.date, r.ticker, r.volume) for r in rows] == [
        (dt.date(2024, 1, 2), "X", 0), (dt.date(2024, 1, 15), "Y", 3),
    ]


@pytest.mark.parametrize("buckets", [None, 3])
def test_ticker_tables_keep_numeric_looking_tickers(spark, make_bars, tmp_path, buckets):
    bars = add_daily_return(make_bars({"600000": [1.0, 2.0], "007": [3.0], "AAA": [4.0]}))
    path = str(tmp_path / "table")
    for _ in range(2):
        tables.write_by_ticker(bars, path, buckets)
    back = tables.read_by_ticker(spark, path, bars.schema)
    assert back.schema == bars.schema
    assert sorted(map(str, back.collect())) == sorted(map(str, bars.collect()))
    one = tables.read_by_ticker(spark, path, bars.schema, ticker="007", buckets=buckets)
    assert [r.close for r in one.collect()] == [3.0] and one.schema == bars.schema
    plan = one._jdf.queryExecution().executedPlan().toString()
    assert ("ticker_bucket" if buckets else "ticker") in plan.split("PartitionFilters:")[1]


def test_ticker_folders_hold_one_file_and_prune(spark, make_bars, tmp_path):
    path = tmp_path / "table"
    tables.write_by_ticker(make_bars({"AAA": [1.0] * 9, "BBB": [2.0] * 9}).repartition(6), str(path))
    assert sorted(len(list(f.glob("*.parquet"))) for f in path.glob("ticker=*")) == [1, 1]
    back = tables.read_by_ticker(spark, str(path), make_bars({"A": [1.0]}).schema)
    plan = back.filter("ticker = 'AAA'")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(ticker" in plan


def test_window_output_is_written_without_another_shuffle(spark, make_bars, tmp_path):
    bars = add_daily_return(make_bars({f"T{i}": [1.0, 2.0, 3.0] for i in range(12)}).repartition(5))
    path = tmp_path / "table"
    tables.write_by_ticker(bars, str(path), clustered=True)
    assert [len(list(f.glob("*.parquet"))) for f in path.glob("ticker=*")] == [1] * 12
    laid_out = bars.sortWithinPartitions("ticker", "date")
    plan = laid_out._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1
    assert tables.read_by_ticker(spark, str(path), bars.schema).count() == 36


def test_corrupt_files_can_be_skipped(spark, make_bars, tmp_path):
    path = tmp_path / "table"
    bars = make_bars({"AAA": [1.0], "BBB": [2.0]})
    tables.write_by_ticker(bars, str(path))
    (path / "ticker=BBB" / "part-broken.parquet").write_bytes(b"not parquet at all")
    cut = next((path / "ticker=AAA").glob("*.parquet"))
    (path / "ticker=AAA" / "part-cut.parquet").write_bytes(cut.read_bytes()[:-9])
    (path / "ticker=AAA" / "part-empty.parquet").write_bytes(b"")  # no file to Spark
    bad = {r.file.rsplit("/", 1)[1]: r.error for r in tables.unreadable_files(spark, str(path)).collect()}
    assert set(bad) == {"part-broken.parquet", "part-cut.parquet"}
    assert all(bad.values())
    with pytest.warns(UserWarning, match="2 unreadable files are skipped"):
        back = tables.read_by_ticker(spark, str(path), bars.schema, skip_corrupt=True)
    assert sorted(r.ticker for r in back.collect()) == ["AAA", "BBB"]


def test_no_warning_without_unreadable_files(spark, make_bars, tmp_path):
    bars = make_bars({"AAA": [1.0]})
    tables.write_by_ticker(bars, str(tmp_path / "table"))
    with warnings.catch_warnings():
        warnings.simplefilter("error", UserWarning)
        back = tables.read_by_ticker(spark, str(tmp_path / "table"), bars.schema, skip_corrupt=True)
    assert back.count() == 1 and tables.unreadable_files(spark, str(tmp_path / "table")).count() == 0


def test_materialize_keeps_schema_and_cuts_lineage(spark, make_bars):
    bars = make_bars({"AAA": [1.0, 2.0]})
    table = storage.materialize(bars, "t")
    assert table.schema == bars.schema and table.count() == 2
    assert "FileScan parquet" in table._jdf.queryExecution().executedPlan().toString()
    assert storage.scratch_path(spark, "t").startswith(spark.conf.get("spark.checkpoint.dir"))


def test_csv_export_round_trip(spark, make_bars, tmp_path):
    bars = make_bars({"AAA": [1.1, 1 / 3]})
    tables.write_csv(bars, str(tmp_path / "csv"))
    back = tables.read_csv(spark, str(tmp_path / "csv"), bars.schema)
    assert sorted(map(str, back.collect())) == sorted(map(str, bars.collect()))


def test_bars_from_trades_use_the_trade_order(spark):
    rows = [
        ("A", day(0), 2, 1, 1, 1, 9.0, 1.0), ("A", day(0), 1, 2, 1, 1, 5.0, 2.0),
        ("A", day(0), 1, 1, 1, 2, 4.0, 3.0), ("A", day(0), 1, 1, 1, 1, 6.0, 4.0),
        ("A", day(0), 3, 1, 1, 1, 7.0, 5.0), ("A", day(1), 3, 1, 1, 1, 7.0, 5.0),
    ]
    trades = spark.createDataFrame(
        rows,
        "ticker string, date date, l_orderkey long, l_linenumber int, l_partkey long, "
        "l_suppkey long, price double, quantity double",
    )
    first = bars_from_trades(trades).filter(F.col("date") == day(0)).first()
    assert (first.open, first.high, first.low, first.close, first.volume) == (6.0, 9.0, 4.0, 7.0, 15)
