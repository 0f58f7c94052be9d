"""Reporting queries over the product statistics table (GMV)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from emberflow import schemas as S
from emberflow.functions.scalars import to_yyyymmdd


def _day(date: int | Column | None) -> Column:
    """``0``/None means today, like the report endpoint."""
    if date is None or (isinstance(date, int) and date == 0):
        return F.date_format(F.current_date(), "yyyyMMdd").cast("int")
    return F.lit(date) if isinstance(date, int) else date


def gmv_total(product_stats: DataFrame, date: int | None = None) -> DataFrame:
    """``select sum(order_amount) from product_stats where toYYYYMMDD(stt)=date``."""
    return (product_stats.filter(to_yyyymmdd("stt") == _day(date))
            .agg(F.sum("order_amount").cast(S.MONEY).alias("order_amount")))


def gmv_by_brand(product_stats: DataFrame, date: int | None = None, limit: int = 5) -> DataFrame:
    """Top ``limit`` trademarks by order amount on one day (ties by name)."""
    return (product_stats.filter(to_yyyymmdd("stt") == _day(date))
            .groupBy("tm_name").agg(F.sum("order_amount").cast(S.MONEY).alias("order_amount"))
            .orderBy(F.desc("order_amount"), F.asc_nulls_first("tm_name")).limit(limit))


def gmv_daily(product_stats: DataFrame) -> DataFrame:
    """``gmv_total`` for every day at once: ``(dt, order_amount)``."""
    return (product_stats.groupBy(to_yyyymmdd("stt").alias("dt"))
            .agg(F.sum("order_amount").cast(S.MONEY).alias("order_amount")))


def gmv_by_brand_daily(product_stats: DataFrame, limit: int = 5) -> DataFrame:
    """``gmv_by_brand`` for every day: rank within a day after the aggregate
    (a day holds one row per brand, so the window is small)."""
    per = (product_stats.groupBy(to_yyyymmdd("stt").alias("dt"), "tm_name")
           .agg(F.sum("order_amount").cast(S.MONEY).alias("order_amount")))
    w = Window.partitionBy("dt").orderBy(F.desc("order_amount"), F.asc_nulls_first("tm_name"))
    return (per.withColumn("rk", F.row_number().over(w)).filter(F.col("rk") <= limit))


def gmv_by_brand_series(ranked: DataFrame, group: str | None = "dt") -> DataFrame:
    """Chart series: ordered ``categories`` (brand names) and ``data``
    (amounts) arrays, one row per ``group`` value (or one row overall).
    ``ranked`` needs ``rk``, ``tm_name`` and ``order_amount``."""
    items = F.sort_array(F.collect_list(F.struct("rk", "tm_name", "order_amount")))
    g = ranked.groupBy(group) if group else ranked.groupBy()
    return g.agg(items.alias("_i")).select(
        *([group] if group else []),
        F.transform("_i", lambda x: x["tm_name"]).alias("categories"),
        F.transform("_i", lambda x: x["order_amount"]).alias("data"))
