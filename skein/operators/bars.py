"""Daily price series and n-way symbol joins over OHLCV bars.

Bars are `(symbol, granularity, date)` keyed rows with open/high/low/close.
All functions take the bars DataFrame and only add the filters whose
argument is given (optional arguments fold away instead of becoming
`arg IS NULL OR ...` predicates), so Catalyst pushes every given filter
into the scan.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.scalars import mid_price


def _as_ts(d: dt.date | str) -> Column:
    """A date bound compared with a timestamp column: midnight of that day."""
    return F.lit(str(d)).cast("date").cast("timestamp_ntz")


def filter_bars(bars: DataFrame, symbol: str | None = None, granularity: str | None = None,
                first: dt.date | str | None = None, last: dt.date | str | None = None,
                symbols: Sequence[str] | None = None) -> DataFrame:
    """Optional filters; `last` compares a timestamp with a date, so only bars at
    or before 00:00 of `last` pass (the reference's behaviour)."""
    if granularity is not None:
        bars = bars.filter(F.col("granularity") == granularity)
    if symbol is not None:
        bars = bars.filter(F.col("symbol") == symbol)
    if symbols is not None:
        bars = bars.filter(F.col("symbol").isin(list(dict.fromkeys(symbols))))
    if first is not None:
        bars = bars.filter(F.col("date") >= _as_ts(first))
    if last is not None:
        bars = bars.filter(F.col("date") <= _as_ts(last))
    return bars


def stock_day(bars: DataFrame, symbol: str | None = None, granularity: str | None = None,
              first=None, last=None) -> DataFrame:
    """Per (symbol, calendar day) mean mid price and its sample stddev."""
    b = filter_bars(bars, symbol, granularity, first, last)
    return (b.select("symbol", F.to_date("date").alias("date"), mid_price("open", "close").alias("price"))
             .groupBy("symbol", "date")
             .agg(F.avg("price").alias("price"), F.stddev_samp("price").alias("price_stddev")))


def stock_day_rows(bars: DataFrame, granularity: str, symbol: str | None = None,
                   first=None, last=None) -> DataFrame:
    """The same mid price per bar, without grouping."""
    b = filter_bars(bars, symbol, granularity, first, last)
    return b.select("symbol", F.to_date("date").alias("date"), mid_price("open", "close").alias("price"))


def _daily_wide(bars: DataFrame, symbols: Sequence[str], granularity: str | None) -> DataFrame:
    """One aggregation keyed by day with one conditional mean per requested symbol.

    Equivalent to n-1 inner joins of per-symbol `stock_day` results on the
    date, but needs a single (partially pre-aggregated) shuffle on the day
    instead of one shuffle per join.  Days missing any symbol are dropped.
    """
    b = filter_bars(bars, granularity=granularity, symbols=symbols)
    b = b.select("symbol", F.to_date("date").alias("date"), mid_price("open", "close").alias("price"))
    uniq = list(dict.fromkeys(symbols))
    aggs = [F.avg(F.when(F.col("symbol") == s, F.col("price"))).alias(f"_p{j}") for j, s in enumerate(uniq)]
    # A day counts for a symbol only if that symbol has at least one bar that day.
    aggs += [F.count_if(F.col("symbol") == s).alias(f"_n{j}") for j, s in enumerate(uniq)]
    wide = b.groupBy("date").agg(*aggs)
    cond = None
    for j in range(len(uniq)):
        c = F.col(f"_n{j}") > 0
        cond = c if cond is None else cond & c
    wide = wide.filter(cond)
    pos = {s: j for j, s in enumerate(uniq)}
    return wide.select("date", *[F.col(f"_p{pos[s]}").alias(f"price{i + 1}") for i, s in enumerate(symbols)])


def join_stock_pair(bars: DataFrame, symbol1: str, symbol2: str, granularity: str | None = None) -> DataFrame:
    """(date, symbol1, symbol2, price1, price2) on days both symbols traded."""
    w = _daily_wide(bars, [symbol1, symbol2], granularity)
    return w.select("date", F.lit(symbol1).alias("symbol1"), F.lit(symbol2).alias("symbol2"), "price1", "price2")


def stock_day_n(bars: DataFrame, symbols: Sequence[str]) -> DataFrame:
    """J03a-d (`stockDay2..5`): (ts, price1..n), all granularities mixed."""
    w = _daily_wide(bars, symbols, None)
    return w.withColumnRenamed("date", "ts")


def join_symbols(bars: DataFrame, symbols: Sequence[str], granularity: str | None = None) -> DataFrame:
    """J04 (`joinStocksVar`): (date, symbol_i, price_i for each i)."""
    w = _daily_wide(bars, symbols, granularity)
    cols = [F.col("date")]
    for i, s in enumerate(symbols, start=1):
        cols += [F.lit(s).alias(f"symbol{i}"), F.col(f"price{i}")]
    return w.select(*cols)
