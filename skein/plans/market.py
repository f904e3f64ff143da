"""Registered bar queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.scalars import round4
from ..operators import bars
from .fixtures import fixture, sql_with
from .registry import register

SYMBOLS = ["Brand#13", "Brand#21", "Brand#4", "Brand#2", "Brand#19"]
R4 = "round({x} + 1e-9, 4)"


def r4(x: str) -> str:
    return R4.format(x=x)


MID = "(coalesce(open, close) + coalesce(close, open)) / 2"


@register("stock_day", sql_with(["stocks"], f"""
select symbol, cast(date as date) as date, {r4('avg(price)')} as price, {r4('stddev_samp(price)')} as price_stddev
from (select symbol, date, {MID} as price from stocks where granularity = '1m')
group by symbol, cast(date as date)"""))
def q_stock_day(spark, sf_dir):
    r = bars.stock_day(fixture(spark, sf_dir).stocks, granularity="1m")
    return r.select("symbol", "date", round4("price").alias("price"), round4("price_stddev").alias("price_stddev"))


@register("stock_day_window", sql_with(["stocks"], f"""
select symbol, cast(date as date) as date, {r4('avg(price)')} as price, {r4('stddev_samp(price)')} as price_stddev
from (select symbol, date, {MID} as price from stocks
      where symbol = 'Brand#13' and date >= timestamp '1994-01-01' and date <= timestamp '1996-06-30')
group by symbol, cast(date as date)"""))
def q_stock_day_window(spark, sf_dir):
    r = bars.stock_day(fixture(spark, sf_dir).stocks, symbol="Brand#13", first="1994-01-01", last="1996-06-30")
    return r.select("symbol", "date", round4("price").alias("price"), round4("price_stddev").alias("price_stddev"))


@register("stock_day_rows", sql_with(["stocks"], f"""
select symbol, cast(date as date) as date, {r4(MID)} as price from stocks where granularity = '5m'"""))
def q_stock_day_rows(spark, sf_dir):
    r = bars.stock_day_rows(fixture(spark, sf_dir).stocks, granularity="5m")
    return r.select("symbol", "date", round4("price").alias("price"))


def _daily_sql(symbol: str, gran: str | None, alias: str) -> str:
    g = f" and granularity = '{gran}'" if gran else ""
    return (f"{alias} as (select cast(date as date) as date, avg({MID}) as price from stocks "
            f"where symbol = '{symbol}'{g} group by cast(date as date))")


@register("join_stock_pair", sql_with(["stocks"], f"""
select s1.date, 'Brand#13' as symbol1, 'Brand#21' as symbol2, {r4('s1.price')} as price1, {r4('s2.price')} as price2
from s1 join s2 on s1.date = s2.date""", extra=_daily_sql("Brand#13", "1m", "s1") + ",\n" + _daily_sql("Brand#21", "1m", "s2")))
def q_join_stock_pair(spark, sf_dir):
    r = bars.join_stock_pair(fixture(spark, sf_dir).stocks, "Brand#13", "Brand#21", "1m")
    return r.select("date", "symbol1", "symbol2", round4("price1").alias("price1"), round4("price2").alias("price2"))


def _stock_n_sql(n: int) -> str:
    extra = ",\n".join(_daily_sql(SYMBOLS[i], None, f"s{i + 1}") for i in range(n))
    cols = ", ".join(f"{r4(f's{i + 1}.price')} as price{i + 1}" for i in range(n))
    joins = " ".join(f"join s{i + 1} on s{i + 1}.date = s1.date" for i in range(1, n))
    return sql_with(["stocks"], f"select s1.date as ts, {cols} from s1 {joins}", extra=extra)


def _make_stock_n(n: int):
    def q(spark, sf_dir):
        r = bars.stock_day_n(fixture(spark, sf_dir).stocks, SYMBOLS[:n])
        return r.select("ts", *[round4(f"price{i + 1}").alias(f"price{i + 1}") for i in range(n)])
    return q


for _n in (2, 3, 4, 5):
    register(f"join_stock_{_n}", _stock_n_sql(_n))(_make_stock_n(_n))


def _join_n_sql() -> str:
    syms = SYMBOLS[:4]
    extra = ",\n".join(_daily_sql(s, None, f"s{i + 1}") for i, s in enumerate(syms))
    cols = ", ".join(f"'{s}' as symbol{i + 1}, {r4(f's{i + 1}.price')} as price{i + 1}" for i, s in enumerate(syms))
    joins = " ".join(f"join s{i + 1} on s{i + 1}.date = s1.date" for i in range(1, len(syms)))
    return sql_with(["stocks"], f"select s1.date, {cols} from s1 {joins}", extra=extra)


@register("join_stock_n", _join_n_sql())
def q_join_stock_n(spark, sf_dir):
    syms = SYMBOLS[:4]
    r = bars.join_symbols(fixture(spark, sf_dir).stocks, syms)
    cols = [F.col("date")]
    for i in range(1, len(syms) + 1):
        cols += [F.col(f"symbol{i}"), round4(f"price{i}").alias(f"price{i}")]
    return r.select(*cols)
