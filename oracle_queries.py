"""DuckDB SQL for the registered queries, composed from named common table expressions.

Written from the definitions, not from the Spark plans: first/last with an ORDER BY where
Spark uses min_by/max_by, ranking where Spark aggregates, real recursion where Spark uses
blocked sums, a full sort where Spark counts, pairwise distances where Spark uses blocks.
"""

from __future__ import annotations

import re

PREDICTORS = (
    "daily_return, ma7, ma30, ma_cross_signal, ma_spread, rsi, rsi_binned, bb_pct_b, "
    "momentum_14d, volatility, sharpe_ratio, beta, drawdown_30d, day_of_week, volume_ma20, "
    "volume_ratio, return_lag_1, return_lag_5, return_lag_10"
).split(", ")

CLUSTER_FEATURES = ("annualised_return", "volatility", "sharpe_ratio", "beta")

EPS = "cast(1e-10 as double)"


def r6(expression: str, alias: str | None = None) -> str:
    """Rounded to 6 places; adding 0.0 turns a negative zero into zero."""
    return f"round({expression}, 6) + cast(0.0 as double) AS {alias or expression}"


def many(*columns: str) -> str:
    return ", ".join(r6(c) for c in columns)


DAY = "cast(date as varchar) AS date"
O = "partition by ticker order by date"


def trailing(n: int) -> str:
    return f"({O} rows between {n - 1} preceding and current row)"


# name -> body; a query lists what it needs and the prelude is built in this order.
CTES: dict[str, str] = {
    "trades": """
        select p_brand as ticker, cast(l_shipdate as date) as date, l_orderkey, l_linenumber,
               l_partkey, l_suppkey, p_retailprice * (1 - l_discount) as price,
               l_quantity as quantity
        from lineitem join part on l_partkey = p_partkey""",
    "bars": """
        select date, ticker,
               first(price order by l_orderkey, l_linenumber, l_partkey, l_suppkey, price) as open,
               max(price) as high, min(price) as low,
               last(price order by l_orderkey, l_linenumber, l_partkey, l_suppkey, price) as close,
               cast(sum(quantity) as bigint) as volume
        from trades group by date, ticker""",
    "returns": f"""
        select *, (close - lag(close) over ({O})) / nullif(lag(close) over ({O}), 0)
                  as daily_return
        from bars""",
    "clean": """
        select * from returns
        where daily_return is null or (daily_return >= -0.5 and daily_return <= 0.5)""",
    "benched": """
        select c.*, b.daily_return as bench_return
        from clean c left join (select * from clean where ticker = 'Brand#1') b
        on c.date = b.date""",
    "stats": f"""
        select ticker,
               (avg(daily_return) * 252 - cast(0.04 as double))
                 / (stddev_samp(daily_return) * sqrt(252) + {EPS}) as sharpe_ratio,
               covar_samp(daily_return, bench_return) / (var_samp(bench_return) + {EPS}) as beta
        from benched group by ticker""",
    "framed": f"""
        select b.*, s.sharpe_ratio, s.beta,
          avg(close) over {trailing(7)} as ma7,
          avg(close) over {trailing(30)} as ma30,
          avg(case when daily_return > 0 then daily_return else 0 end) over {trailing(14)} as up,
          avg(case when daily_return < 0 then -daily_return else 0 end) over {trailing(14)} as down,
          avg(close) over {trailing(20)} as bb_mid,
          stddev_samp(close) over {trailing(20)} as dev,
          stddev_samp(daily_return) over {trailing(30)} * sqrt(252) as volatility,
          lag(close, 14) over ({O}) as close14,
          max(close) over {trailing(30)} as peak,
          avg(cast(volume as double)) over {trailing(20)} as volume_ma20,
          lag(daily_return, 1) over ({O}) as return_lag_1,
          lag(daily_return, 5) over ({O}) as return_lag_5,
          lag(daily_return, 10) over ({O}) as return_lag_10,
          (lead(close, 10) over ({O}) - close) / nullif(close, 0) as forward_return
        from benched b join stats s using (ticker)""",
    "features": f"""
        select *,
          case when ma7 > ma30 then 1.0 else -1.0 end::double as ma_cross_signal,
          (ma7 - ma30) / (ma30 + {EPS}) as ma_spread,
          100 - 100 / (1 + up / (down + {EPS})) as rsi,
          case when 100 - 100 / (1 + up / (down + {EPS})) < 30 then 0.0
               when 100 - 100 / (1 + up / (down + {EPS})) > 70 then 2.0
               else 1.0 end::double as rsi_binned,
          bb_mid + 2 * dev as bb_upper, bb_mid - 2 * dev as bb_lower,
          (close - (bb_mid - 2 * dev)) / (4 * dev + {EPS}) as bb_pct_b,
          (close - close14) / (close14 + {EPS}) as momentum_14d,
          (close - peak) / (peak + {EPS}) as drawdown_30d,
          cast(dayofweek(date) + 1 as double) as day_of_week,
          cast(volume as double) / (volume_ma20 + {EPS}) as volume_ratio
        from framed""",
    "profile": f"""
        select * from (
          select ticker, avg(daily_return) * 252 as annualised_return,
                 avg(volatility) as volatility, avg(sharpe_ratio) as sharpe_ratio,
                 avg(beta) as beta, avg(rsi) as avg_rsi, avg(bb_pct_b) as avg_bb_pct_b,
                 count(date) as trading_days
          from features group by ticker)
        where {" and ".join(f"{c} is not null" for c in CLUSTER_FEATURES)}""",
    "ml_rows": f"""
        select ticker, date, {", ".join(PREDICTORS)},
               case when forward_return > 0 then 1 else 0 end as is_profitable
        from features
        where forward_return is not null
          and {" and ".join(f"{c} is not null" for c in PREDICTORS)}""",
    "split": """
        select *, case when row_number() over (order by date, md5(ticker), ticker)
                       <= floor(count(*) over () * cast(0.8 as double)) then 0 else 1 end as is_test
        from ml_rows""",
    "test_rows": """
        select *, case when rsi < 50 then 1 else 0 end as prediction,
               case when ma_cross_signal < 0 then 1 else 0 end as trend_prediction
        from split where is_test = 1""",
    # models with a truth: a rule on two predictors, and four groups of profiles
    "planted_rows": """
        select ticker, date, ma_cross_signal, day_of_week, return_lag_10,
               case when ma_cross_signal < 0 and day_of_week <= 4 then 1 else 0 end as is_profitable
        from features
        where forward_return is not null and ma_cross_signal is not null
          and day_of_week is not null and return_lag_10 is not null""",
    "planted_split": """
        select *, case when row_number() over (order by date, md5(ticker), ticker)
                       <= floor(count(*) over () * cast(0.8 as double)) then 0 else 1 end as is_test
        from planted_rows""",
    "planted_groups": """
        select ticker, n % 4 as g,
               [0.1, 0.2, 0.3, 0.4][n % 4 + 1]::double + (n % 7) / 1000.0::double as x1,
               [0.1, 0.4, 0.9, 2.0][n % 4 + 1]::double + (n % 7) / 1000.0::double as x2,
               [2.0, 1.0, 0.5, -1.0][n % 4 + 1]::double + (n % 7) / 1000.0::double as x3,
               [0.2, 0.8, 1.5, 3.0][n % 4 + 1]::double + (n % 7) / 1000.0::double as x4
        from (select distinct ticker, cast(regexp_extract(ticker, '([0-9]+)$', 1) as integer) as n
              from features)""",
    "planted_scaled": """
        select ticker, g, x1 / stddev_samp(x1) over () as y1, x2 / stddev_samp(x2) over () as y2,
               x3 / stddev_samp(x3) over () as y3, x4 / stddev_samp(x4) over () as y4
        from planted_groups""",
    "planted_score": """
        select avg((nearest - within) / greatest(nearest, within)) as silhouette from (
          select ticker, min(d) filter (g = own) as within, min(d) filter (g <> own) as nearest
          from (select a.ticker, a.g as own, b.g, avg(sqrt(
                  (a.y1 - b.y1) ** 2 + (a.y2 - b.y2) ** 2
                  + (a.y3 - b.y3) ** 2 + (a.y4 - b.y4) ** 2)) as d
                from planted_scaled a join planted_scaled b on a.ticker <> b.ticker group by all)
          group by ticker)""",
    # inputs with planted faults
    "trade_bars": """
        select date, ticker, price as open, price as high, price as low,
               case when l_orderkey % 97 <> 0 then price end as close,
               cast(quantity as bigint) as volume
        from trades""",
    "text_bars": """
        select case when l_orderkey % 103 = 0 then 'not a date'
                    else cast(date as varchar) end as date,
               ' ' || lower(ticker) || ' ' as ticker,
               case when l_orderkey % 101 = 0 then 'abc' else cast(price as varchar) end as open,
               cast(price as varchar) as high, cast(price as varchar) as low,
               case when l_orderkey % 97 = 0 then '' else cast(price as varchar) end as close,
               case when l_orderkey % 107 = 0 then 'n/a' else cast(quantity as varchar) end
                 as volume
        from trades""",
    "typed": """
        select try_cast(date as date) as date, upper(trim(ticker)) as ticker,
               try_cast(open as double) as open, try_cast(high as double) as high,
               try_cast(low as double) as low, try_cast(close as double) as close,
               cast(trunc(try_cast(volume as double)) as bigint) as volume
        from text_bars""",
    "survivors": """
        select date, ticker, open, high, low, close, volume from (
          select *, row_number() over (partition by ticker, date
            order by open nulls first, high nulls first, low nulls first,
                     close nulls first, volume nulls first) as place
          from trade_bars where close is not null)
        where place = 1""",
    "survivor_returns": f"""
        select *, (close - lag(close) over ({O})) / nullif(lag(close) over ({O}), 0)
                  as daily_return
        from survivors""",
    "faulty": """
        select date, ticker, open,
               case when day(date) = 13 then low else high end as high,
               case when day(date) = 13 then high else low end as low,
               close, case when day(date) = 29 then 0 else volume end as volume, daily_return
        from clean
        union all
        select date, ticker, open, high, low, close, volume, daily_return
        from clean where day(date) = 7""",
    # recursive averages
    "numbered": f"""
        select ticker, date, close, volume, open, high, low, daily_return,
               row_number() over ({O}) as n
        from clean""",
    "clipped": f"""
        select ticker, date, close, volume, open, high, low,
               greatest(cast(-0.15 as double), least(cast(0.15 as double), daily_return))
                 as daily_return,
               row_number() over ({O}) as n
        from clean where daily_return is not null""",
}

NEEDS = {
    "trades": (), "bars": ("trades",), "returns": ("bars",), "clean": ("returns",),
    "benched": ("clean",), "stats": ("benched",), "framed": ("benched", "stats"),
    "features": ("framed",), "profile": ("features",), "ml_rows": ("features",),
    "split": ("ml_rows",), "test_rows": ("split",),
    "planted_rows": ("features",), "planted_split": ("planted_rows",),
    "planted_groups": ("features",), "planted_scaled": ("planted_groups",),
    "planted_score": ("planted_scaled",),
    "trade_bars": ("trades",), "text_bars": ("trades",), "typed": ("text_bars",),
    "survivors": ("trade_bars",), "survivor_returns": ("survivors",), "faulty": ("clean",),
    "numbered": ("clean",), "clipped": ("clean",),
}


def _needed(names: set[str]) -> set[str]:
    found: set[str] = set()
    waiting = list(names)
    while waiting:
        name = waiting.pop()
        if name not in found:
            found.add(name)
            waiting.extend(NEEDS[name])
    return found


def query(body: str, *extra: tuple[str, str], recursive: bool = False) -> str:
    """The body under a WITH clause holding every CTE it mentions."""
    text = body + " ".join(sql for _, sql in extra)
    mentioned = {name for name in CTES if re.search(rf"\b{name}\b", text)}
    needed = _needed(mentioned)
    parts = [f"{name} AS MATERIALIZED ({CTES[name]})" for name in CTES if name in needed]
    parts += [f"{name} AS ({sql})" for name, sql in extra]
    head = "WITH RECURSIVE " if recursive else "WITH "
    return head + ",\n".join(parts) + "\n" + body


def _walk(source: str) -> tuple[str, str]:
    """Averages of spans 9, 12 and 26 and the MACD signal, bar by bar."""
    return ("walk(ticker, n, e9, e12, e26, signal)", f"""
        select ticker, n, close, close, close, cast(0.0 as double) from {source} where n = 1
        union all
        select b.ticker, b.n,
               w.e9 + (b.close - w.e9) * 2 / 10,
               w.e12 + (b.close - w.e12) * 2 / 13,
               w.e26 + (b.close - w.e26) * 2 / 27,
               w.signal + ((w.e12 + (b.close - w.e12) * 2 / 13)
                           - (w.e26 + (b.close - w.e26) * 2 / 27) - w.signal) * 2 / 10
        from walk w join {source} b on b.ticker = w.ticker and b.n = w.n + 1""")


RISK = (
    "avg(volatility) + greatest(avg(beta), 0.0) "
    "- greatest(-2.0, least(5.0, avg(sharpe_ratio))) * cast(0.3 as double)"
)
LABELS = (
    "(values (0, 'Conservative', '#3B82F6'), (1, 'Balanced', '#10B981'), "
    "(2, 'Growth', '#F59E0B'), (3, 'Aggressive', '#EF4444')) "
    "as labels(risk_rank, cluster_label, cluster_color)"
)


def _ruled(clusters: int, ranked_below: int | None = None) -> list[tuple[str, str]]:
    """Rule-made cluster ids and their ranking."""
    limit = "" if ranked_below is None else f"where cluster_id < {ranked_below}"
    return [
        ("ruled", f"""select *, cast(regexp_extract(ticker, '([0-9]+)$', 1) as integer)
                      % {clusters} as cluster_id from profile"""),
        ("risks", f"select cluster_id, {RISK} as risk_score from ruled {limit} group by cluster_id"),
        ("ranking", f"""
          select r.*, l.cluster_label, l.cluster_color from (
            select *, cast(row_number() over (order by risk_score, cluster_id) - 1 as integer)
                      as risk_rank from risks) r
          left join {LABELS.replace('as labels', 'as l')} on r.risk_rank = l.risk_rank"""),
        ("labelled", """select r.*, coalesce(k.cluster_label, 'Unknown') as cluster_label,
                               k.cluster_color
                        from ruled r left join ranking k on r.cluster_id = k.cluster_id"""),
    ]


BAR_LIST = f"{DAY}, ticker, {many('open', 'high', 'low', 'close')}, volume"
FEATURE_DOUBLES = (
    "daily_return, ma7, ma30, ma_cross_signal, rsi, bb_mid, bb_upper, bb_lower, bb_pct_b, "
    "volatility, sharpe_ratio, bench_return, beta, momentum_14d, drawdown_30d, day_of_week, "
    "ma_spread, rsi_binned, volume_ma20, volume_ratio, return_lag_1, return_lag_5, "
    "return_lag_10, forward_return"
).split(", ")
FEATURE_LIST = f"{BAR_LIST}, {many(*FEATURE_DOUBLES)}"


def _indicator(*columns: str) -> str:
    return query(f"select ticker, {DAY}, {many(*columns)} from features")


def _report(prediction: str) -> str:
    """Per class, then macro and weighted averages."""
    return query(
        f"""
        select scope, {many('precision', 'recall', 'f1_score')}, support, {r6('accuracy')}
        from (select * from per_class
              union all
              select 'macro avg', avg(precision), avg(recall), avg(f1_score),
                     cast(sum(support) as bigint) from per_class
              union all
              select 'weighted avg', sum(precision * support) / sum(support),
                     sum(recall * support) / sum(support), sum(f1_score * support) / sum(support),
                     cast(sum(support) as bigint) from per_class),
             (select avg(case when is_profitable = {prediction} then 1.0 else 0.0 end) as accuracy
              from test_rows)""",
        ("per_class", f"""
          select cast(c as varchar) as scope,
                 coalesce(hits / nullif(predicted, 0), 0) as precision,
                 coalesce(hits / nullif(actual, 0), 0) as recall,
                 coalesce(2.0 * hits / nullif(predicted + actual, 0), 0) as f1_score,
                 actual as support
          from (select c, count(*) filter (is_profitable = c and {prediction} = c) as hits,
                       count(*) filter ({prediction} = c) as predicted,
                       count(*) filter (is_profitable = c) as actual
                from test_rows, (values (0), (1)) as classes(c) group by c)"""),
    )


def _scores(prediction: str) -> str:
    return f"""
        avg(case when is_profitable = {prediction} then 1.0 else 0.0 end) as accuracy,
        coalesce(2.0 * count(*) filter (is_profitable = 1 and {prediction} = 1)
          / nullif(count(*) filter (is_profitable = 1) + count(*) filter ({prediction} = 1), 0), 0)
          as f1_score"""


def build() -> dict[str, str]:
    sql: dict[str, str] = {}

    # sources and sinks
    sql["normalize_columns"] = query(
        "select cast(date as varchar) AS trade_date, ticker, l_orderkey AS order_key, "
        f"{r6('quantity', 'volume')} from trades"
    )
    half = BAR_LIST.replace("volume", "case when day(bars.date) < 15 then volume end AS volume")
    sql["union_sources"] = query(f"select {half} from bars")
    sql["csv_ingest"] = query(
        f"select {half.replace('ticker', 'upper(ticker) AS ticker', 1)} from bars"
    )
    sql["coerce_raw"] = query(
        f"select {BAR_LIST.replace('volume', 'coalesce(volume, 0) AS volume')} "
        "from typed where date is not null and close is not null"
    )
    unread = "l_orderkey % 109 = 0 or l_orderkey % 103 = 0"
    prices = ", ".join(f"{r6('price', c)}" for c in ("open", "high", "low", "close"))
    sql["coerce_dates"] = query(
        f"select {DAY}, upper(ticker) AS ticker, {prices}, "
        f"cast(trunc(quantity) as bigint) AS volume from trades where not ({unread})"
    )
    sql["unparsed_dates"] = query(
        "select count(*) AS rows, count(*) filter (l_orderkey % 103 = 0 "
        "and l_orderkey % 109 <> 0) AS unparsed from trades"
    )
    sql["load_bars"] = query(
        f"select {BAR_LIST} from typed where close is not null "
        "and ticker in ('BRAND#1', 'BRAND#3', 'BRAND#7', 'BRAND#12', 'BRAND#21') "
        "and date between date '1995-01-01' and date '1999-12-31'"
    )
    sql["bars_from_trades"] = sql["raw_roundtrip"] = query(f"select {BAR_LIST} from bars")
    sql["clean_roundtrip"] = query(
        f"select {BAR_LIST}, {r6('daily_return')} from survivor_returns "
        "where daily_return is null or daily_return between -0.5 and 0.5"
    )
    sql["bucketed_roundtrip"] = query(f"select {BAR_LIST}, {r6('daily_return')} from clean")
    sql["features_all"] = sql["features_csv"] = query(f"select {FEATURE_LIST} from features")

    # cleaning
    sql["cast_numerics"] = query(
        "select t.date, t.ticker, "
        + ", ".join(r6(f"try_cast(t.{c} as double)", c) for c in ("open", "high", "low", "close"))
        + ", cast(trunc(try_cast(t.volume as double)) as bigint) AS volume from text_bars t"
    )
    sql["drop_nulls"] = query(f"select {BAR_LIST} from trade_bars where close is not null")
    sql["dedupe_bars"] = query(f"""
        select {BAR_LIST} from (
          select *, row_number() over (partition by ticker, date
            order by open nulls first, high nulls first, low nulls first,
                     close nulls first, volume nulls first) as place
          from trade_bars) where place = 1""")
    sql["universe_filter"] = query(
        f"select {BAR_LIST} from bars "
        "where ticker in (select p_brand from part where p_size = 50)"
    )
    sql["date_range"] = query(
        f"select {BAR_LIST} from bars where date >= date '1995-01-01' and date <= date '1999-12-31'"
    )
    sql["daily_return"] = query(f"select ticker, {DAY}, {many('close', 'daily_return')} from clean")
    sql["outlier_filter"] = query(
        f"select ticker, {DAY}, {r6('daily_return')} from returns "
        "where daily_return is null or daily_return between -0.12 and 0.12"
    )
    sql["winsorize"] = query(f"select ticker, {DAY}, {r6('daily_return')} from clipped")
    sql["clean_bars"] = query(
        f"select {BAR_LIST}, {r6('daily_return')} from survivor_returns "
        "where daily_return is null or daily_return between -0.12 and 0.12"
    )
    sql["sorted_layout"] = query(f"select ticker, {DAY}, {r6('close')} from clean")
    sql["preview"] = query(
        f"select {BAR_LIST}, {r6('daily_return')} from "
        "(select * from clean order by ticker, date limit 5)"
    )

    # quality
    sql["drop_report"] = query("""
        select n_all AS rows_in, n_all - n_valid AS null_rows, n_valid - n_kept AS duplicate_rows,
               n_out AS outlier_rows, n_kept - n_out AS rows_out
        from (select count(*) as n_all, count(close) as n_valid from trade_bars),
             (select count(*) as n_kept,
                     count(*) filter (daily_return < -0.12 or daily_return > 0.12) as n_out
              from survivor_returns)""")
    sql["audit"] = query(f"""
        select count(*) AS row_count, count(distinct ticker) AS tickers,
               cast(min(date) as varchar) AS first_date, cast(max(date) as varchar) AS last_date,
               count(*) filter (daily_return is null) AS null_cells,
               (select cast(sum(n - 1) as bigint)
                from (select count(*) as n from faulty group by ticker, date)) AS duplicate_keys,
               {r6('avg(daily_return)', 'return_mean')},
               {r6('stddev_samp(daily_return)', 'return_std')},
               {r6('min(daily_return)', 'return_min')}, {r6('max(daily_return)', 'return_max')},
               count(*) filter (high < low or close > high or close < low) AS bad_ohlc_rows,
               count(*) filter (volume = 0) AS zero_volume_rows
        from faulty""")
    sql["audit_tickers"] = query("""
        select ticker, count(*) AS row_count, cast(min(date) as varchar) AS first_date,
               cast(max(date) as varchar) AS last_date
        from faulty group by ticker""")
    sql["load_report"] = query("""
        select count(*) filter (daily_return is null) AS null_returns,
               count(*) filter (daily_return < -0.15 or daily_return > 0.15) AS clipped_returns,
               count(daily_return) AS row_count,
               count(distinct ticker) filter (daily_return is not null) AS tickers,
               cast(min(date) filter (daily_return is not null) as varchar) AS first_date,
               cast(max(date) filter (daily_return is not null) as varchar) AS last_date
        from clean""")

    # indicators
    for name, columns in {
        "moving_averages": ("ma7", "ma30"), "ma_cross": ("ma_cross_signal",),
        "ma_spread": ("ma_spread",), "rsi": ("rsi",), "rsi_bins": ("rsi_binned",),
        "bollinger": ("bb_mid", "bb_upper", "bb_lower", "bb_pct_b"),
        "volatility": ("volatility",), "momentum": ("momentum_14d",),
        "drawdown": ("drawdown_30d",), "day_of_week": ("day_of_week",),
        "volume_features": ("volume_ma20", "volume_ratio"),
        "lag_returns": ("return_lag_1", "return_lag_5", "return_lag_10"),
        "forward_return": ("forward_return",), "sharpe": ("sharpe_ratio",),
        "bench_join": ("daily_return", "bench_return"), "beta": ("beta",),
    }.items():
        sql[name] = _indicator(*columns)
    sql["full_window_ma"] = query(
        f"select ticker, {DAY}, "
        + ", ".join(
            r6(f"case when row_number() over ({O}) >= {n} then ma{n} end", f"ma{n}")
            for n in (7, 30)
        )
        + " from features"
    )
    sql["ema"] = query(
        f"select b.ticker, cast(b.date as varchar) AS date, {r6('e9', 'ema9')}, "
        f"{r6('e12', 'ema12')}, {r6('e26', 'ema26')} "
        "from numbered b join walk w on b.ticker = w.ticker and b.n = w.n",
        _walk("numbered"), recursive=True,
    )
    sql["ema_returns"] = query(
        f"select b.ticker, cast(b.date as varchar) AS date, {many('daily_return')}, "
        f"{r6('e9', 'ema9')}, {r6('e26', 'ema26')} "
        "from numbered b left join steps w on b.ticker = w.ticker and b.n = w.n",
        ("steps(ticker, n, e9, e26)", """
            select ticker, n, daily_return, daily_return from numbered where n = 2
            union all
            select b.ticker, b.n, w.e9 + (b.daily_return - w.e9) * 2 / 10,
                   w.e26 + (b.daily_return - w.e26) * 2 / 27
            from steps w join numbered b on b.ticker = w.ticker and b.n = w.n + 1"""),
        recursive=True,
    )
    macd = (
        f"{r6('e12 - e26', 'macd')}, {r6('signal', 'macd_signal_line')}, "
        f"{r6('e12 - e26 - signal', 'macd_histogram')}"
    )
    sql["macd"] = query(
        f"select b.ticker, cast(b.date as varchar) AS date, {macd} "
        "from numbered b join walk w on b.ticker = w.ticker and b.n = w.n",
        _walk("numbered"), recursive=True,
    )
    sql["side_features"] = query(
        f"""select {DAY}, ticker, {many('open', 'high', 'low', 'close')}, volume,
                   {r6('daily_return')}, {macd}, {many('volume_ma20', 'volume_ratio')},
                   {many('return_lag_1', 'return_lag_5', 'return_lag_10')}
            from (select b.*, e12, e26, signal,
                    avg(cast(volume as double)) over {trailing(20)} as volume_ma20,
                    volume / nullif(avg(cast(volume as double)) over {trailing(20)}, 0)
                      as volume_ratio,
                    lag(daily_return, 1) over ({O}) as return_lag_1,
                    lag(daily_return, 5) over ({O}) as return_lag_5,
                    lag(daily_return, 10) over ({O}) as return_lag_10
                  from (select c.*, e12, e26, signal from clipped c
                        join walk w on c.ticker = w.ticker and c.n = w.n) b)
            where return_lag_1 is not null and return_lag_5 is not null
              and return_lag_10 is not null""",
        _walk("clipped"), recursive=True,
    )

    # profiles and reports
    profile = f"ticker, {many(*CLUSTER_FEATURES, 'avg_rsi', 'avg_bb_pct_b')}, trading_days"
    sql["ticker_profile"] = query(f"select {profile} from profile")
    sql["ticker_lookup"] = query(f"select {profile} from profile where ticker = 'Brand#7'")
    sql["standardize"] = query(
        "select ticker, "
        + ", ".join(
            r6(f"({c} - avg({c}) over ()) / stddev_pop({c}) over ()", c) for c in CLUSTER_FEATURES
        )
        + f", {many('avg_rsi', 'avg_bb_pct_b')}, trading_days from profile"
    )
    sql["cluster_rank"] = query(
        f"select cluster_id, {r6('risk_score')}, risk_rank, cluster_label, cluster_color "
        "from ranking",
        *_ruled(4)[:3],
    )
    sql["label_map"] = query(
        "select ticker, cluster_id, cluster_label, cluster_color from labelled",
        *_ruled(5, ranked_below=4),
    )
    sql["label_kpis"] = query(
        f"""select risk_rank, labels.cluster_label, labels.cluster_color,
                   coalesce(found, 0) AS tickers, {many('sharpe_ratio', 'beta')}
            from {LABELS} left join (
              select cluster_label, count(*) as found, avg(sharpe_ratio) as sharpe_ratio,
                     avg(beta) as beta
              from labelled group by cluster_label) a
            on labels.cluster_label = a.cluster_label""",
        *_ruled(3),
    )
    sql["plot_sizes"] = query(
        f"select ticker, cluster_label, {r6('sharpe_ratio')}, "
        f"{r6('greatest(sharpe_ratio, 0.1)', 'plot_size')} from labelled",
        *_ruled(3),
    )

    # model rows and metrics
    sql["ml_dataset"] = query(
        f"select ticker, {DAY}, {many(*PREDICTORS)}, is_profitable from ml_rows"
    )
    sql["walk_forward_split"] = query(f"select ticker, {DAY}, is_test from split")
    sql["split_counts"] = query(
        "select count(*) filter (is_test = 0) AS n_train, count(*) filter (is_test = 1) AS n_test, "
        "count(distinct ticker) AS tickers from split"
    )
    sql["cv_folds"] = query(f"""
        select ticker, {DAY}, is_profitable,
               cast(floor((place - 1) * 5 / n) as integer) AS fold
        from (select *, row_number() over (partition by is_profitable
                                           order by date, md5(ticker), ticker) as place,
                     count(*) over (partition by is_profitable) as n
              from split where is_test = 0)""")
    sql["class_weights"] = query(f"""
        select is_profitable, n AS rows, {r6('sum(n) over () / (count(*) over () * n)', 'weight')}
        from (select is_profitable, count(*) as n from split where is_test = 0 group by 1)""")
    sql["baseline_accuracy"] = query(
        f"select {r6('avg(is_profitable)', 'baseline_accuracy')}, count(*) AS rows from test_rows"
    )
    sql["classification_report"] = _report("prediction")
    sql["accuracy_scores"] = query(
        f"select {many('accuracy', 'f1_score')} from (select {_scores('prediction')} from test_rows)"
    )
    sql["tournament_rule"] = query(f"""
        select {many('accuracy', 'f1_score')}, contender, priority from (
          select {_scores('prediction')}, 'low_rsi' as contender, 0 as priority from test_rows
          union all
          select {_scores('trend_prediction')}, 'down_trend', 1 from test_rows)
        order by accuracy desc, priority limit 1""")
    sql["train_only_scaling"] = query(
        f"select ticker, {DAY}, "
        + ", ".join(
            r6(
                f"({c} - avg({c}) filter (is_test = 0) over ()) "
                f"/ stddev_pop({c}) filter (is_test = 0) over ()",
                c,
            )
            for c in PREDICTORS
        )
        + ", is_test from split"
    )
    kept = [c for c in PREDICTORS
            if c not in ("ma7", "ma30", "rsi", "volume_ma20", "ma_cross_signal",
                         "momentum_14d", "rsi_binned")]
    sql["scenario_grid"] = query(f"""
        select ticker, {DAY}, {many(*kept)},
               cast(150 as double) AS ma7, cast(150 as double) AS ma30, cast(50 as double) AS rsi,
               cast(1000000 as double) AS volume_ma20,
               cast(case when ma_spread > 0 then 1 else -1 end as double) AS ma_cross_signal,
               cast(m as double) AS momentum_14d, cast(b as double) AS rsi_binned
        from (select * from features
              qualify row_number() over (partition by ticker order by date desc) = 1),
             (values (-0.1), (0.0), (0.1)) as momenta(m),
             (values (0.0), (1.0), (2.0)) as states(b)""")

    # models: what they must find
    sql["model_roundtrip"] = query(
        "select count(*) AS rows, cast(0 as bigint) AS differing from test_rows"
    )
    sql["kmeans_clusters"] = query(
        f"select ticker, cluster_label, cluster_color from planted_groups join {LABELS} "
        "on risk_rank = g"
    )
    sql["predict_cluster"] = query(
        f"select 'new ' || ticker AS ticker, cluster_label from planted_groups join {LABELS} "
        "on risk_rank = (g + 1) % 4"
    )
    sql["k_sweep"] = query(
        "select k, 'euclidean' AS metric, k = 4 AS is_best, "
        "case when k = 4 then round((select silhouette from planted_score), 4) end AS silhouette "
        "from (values (2), (3), (4), (5), (6), (7)) as swept(k) "
        "where k < (select count(*) from planted_groups)"
    )
    sql["clustering_stage"] = query(
        "select cluster_label, (select count(*) from planted_groups where g = risk_rank) AS tickers, "
        "'euclidean' AS metric, round((select silhouette from planted_score), 4) AS silhouette, "
        f"4 AS best_k from {LABELS}"
    )
    sql["rf_fit"] = sql["gbt_fit"] = query("""
        select scope, cast(1 as double) AS precision, cast(1 as double) AS recall,
               cast(1 as double) AS f1_score, cast(1 as double) AS accuracy, support from (
          select cast(is_profitable as varchar) as scope, count(*) as support
          from planted_split where is_test = 1 group by 1
          union all select 'macro avg', count(*) from planted_split where is_test = 1
          union all select 'weighted avg', count(*) from planted_split where is_test = 1)""")
    sql["tournament"] = """
        select contender, cast(priority as integer) AS priority, cast(1 as double) AS accuracy,
               cast(1 as double) AS f1_score, 'Random Forest Classifier' AS winner
        from (values ('Random Forest Classifier', 0), ('Gradient Boosting Classifier', 1))
             as t(contender, priority)"""
    sql["cv_accuracy"] = query("""
        select is_profitable, count(*) AS rows, cast(1 as double) AS mean_accuracy,
               cast(0 as double) AS spread
        from planted_split where is_test = 0 group by 1""")
    sql["feature_importances"] = """
        select feature, place
        from (values ('ma_cross_signal', 1), ('day_of_week', 2), ('return_lag_10', null))
             as t(feature, place)"""
    sql["score_batch"] = query(
        f"select ticker, {DAY}, cast(is_profitable as double) AS prediction "
        "from planted_split where is_test = 1"
    )
    sql["scenario_scores"] = query(f"""
        select ticker, {DAY}, cast(w as double) AS day_of_week, cast(r as double) AS return_lag_10,
               cast(case when w <= 4 and not coalesce(ma_spread > 0, false) then 1 else 0 end
                    as double) AS prediction
        from (select * from features
              qualify row_number() over (partition by ticker order by date desc) = 1),
             (values (2.0), (4.0), (6.0)) as weekdays(w),
             (values (-0.05), (0.0), (0.05)) as returns_before(r)""")
    sql["prediction_stage"] = query(f"""
        select 'Random Forest Classifier' AS winning_model, cast(1 as double) AS accuracy,
               cast(1 as double) AS f1_score, cast(1 as double) AS cv_accuracy,
               round(avg(is_profitable) filter (is_test = 1), 4) AS baseline_accuracy,
               count(*) filter (is_test = 0) AS n_train, count(*) filter (is_test = 1) AS n_test,
               cast(10 as integer) AS forward_days
        from planted_split""")
    sql["run_summary"] = query("""
        select (select count(*) from profile) AS tickers_processed,
               cast(4 as integer) AS n_clusters, 'euclidean' AS silhouette_metric,
               (select count(*) from profile) AS tickers_in_clusters,
               cast(10 as integer) AS forward_days, true AS accuracy_in_range,
               (select count(*) from bars) AS rows_in, cast(0 as bigint) AS null_rows,
               cast(0 as bigint) AS duplicate_rows, cast(1 as bigint) AS best_k,
               (select count(*) from test_rows) AS test_rows""")
    sql["cache_refresh"] = query(
        f"select {BAR_LIST.replace('ticker', 'upper(ticker) AS ticker', 1)} from bars"
    )
    sql["skipped_files"] = query(
        "select count(*) AS rows, cast(1 as bigint) AS skipped, 'ticker=damaged' AS first from clean"
    )
    sql["bucketed_features"] = sql["features_all"]
    sql["removed_rows"] = sql["drop_report"]

    # silhouettes
    pairs = """
        select a.vec_id, a.label as own, b.label as other, count(*) as n,
               sum({distance}) as total
        from (select vec_id, label, cast(embedding as double[]) as v from embeddings) a,
             (select vec_id, label, cast(embedding as double[]) as v from embeddings) b
        where a.vec_id <> b.vec_id group by 1, 2, 3"""
    for name, distance, column in (
        ("silhouette_exact", "list_distance(a.v, b.v)", "silhouette"),
        ("silhouette_fast", "list_distance(a.v, b.v) ** 2", "silhouette_squared"),
    ):
        sql[name] = f"""
        with pairs as ({pairs.format(distance=distance)}),
        sides as (
          select vec_id, max(case when other = own then total / n end) as within,
                 min(case when other <> own then total / n end) as nearest
          from pairs group by vec_id)
        select round(avg(case when within is null then 0
                              else (nearest - within) / greatest(nearest, within) end), 6)
               + cast(0.0 as double) AS {column}
        from sides"""
    return sql
