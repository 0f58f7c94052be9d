"""Scalar column functions shared by the stages."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from emberflow import schemas as S


def _c(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def order_time_parts(order_info: DataFrame, col: str = "create_time") -> DataFrame:
    """``create_date`` (text before the space), ``create_hour`` (two-digit
    hour text) and ``create_ts`` (epoch millis) from ``yyyy-MM-dd HH:mm:ss``."""
    t = F.col(col)
    return (order_info
            .withColumn("create_date", F.split(t, " ").getItem(0))
            .withColumn("create_hour", F.split(F.split(t, " ").getItem(1), ":").getItem(0))
            .withColumn("create_ts",
                        F.unix_millis(F.try_to_timestamp(t, F.lit(S.TIME_FORMAT)))))


def user_age(birthday: str | Column, as_of: Column | None = None) -> Column:
    """Whole 365-day years between ``birthday`` (``yyyy-MM-dd``) and ``as_of``
    (default: today)."""
    as_of = as_of if as_of is not None else F.current_date()
    days = F.datediff(as_of, F.try_to_date(_c(birthday), "yyyy-MM-dd"))
    return F.floor(days / 365).cast("int")


def event_time_whole_seconds(ts: str | Column) -> Column:
    """``TO_TIMESTAMP(FROM_UNIXTIME(ts/1000))``: integer division, whole seconds."""
    return F.timestamp_seconds(F.floor(_c(ts) / 1000))


def fmt(ts: str | Column) -> Column:
    return F.date_format(_c(ts), S.TIME_FORMAT)


def to_yyyymmdd(ts_text: str | Column) -> Column:
    """``toYYYYMMDD(stt)``: the date of a time text as an int like 20240101."""
    return F.date_format(F.try_to_timestamp(_c(ts_text), F.lit(S.TIME_FORMAT)),
                         "yyyyMMdd").cast("int")


def now_millis() -> Column:
    """``UNIX_TIMESTAMP()*1000``: wall clock at query start, whole seconds."""
    return F.unix_timestamp() * 1000


# Business code sets (fixed values, in code order).
CODE_LABELS = {
    # 10 order status
    "1001": "unpaid", "1002": "paid", "1003": "cancelled", "1004": "finished",
    "1005": "refunding", "1006": "refund done",
    # 11 payment type
    "1101": "alipay", "1102": "wechat", "1103": "unionpay",
    # 12 appraise
    "1201": "good", "1202": "neutral", "1203": "bad", "1204": "auto",
    # 13 refund reason
    "1301": "quality problem", "1302": "not as described", "1303": "out of stock",
    "1304": "wrong size", "1305": "ordered by mistake", "1306": "no longer wanted",
    "1307": "other",
    # 14 coupon status
    "1401": "unused", "1402": "in use", "1403": "used",
    # 15 refund type
    "1501": "refund only", "1502": "return and refund",
    # 24 source type
    "2401": "query", "2402": "promotion", "2403": "auto recommend", "2404": "activity",
    # activity rule type
    "3101": "amount off", "3102": "discount by count", "3103": "discount",
    # coupon type
    "3201": "amount off", "3202": "discount by count", "3203": "voucher",
    # coupon range
    "3301": "category3", "3302": "trademark", "3303": "spu",
}
APPRAISE_GOOD = "1201"


def code_label(code: str | Column) -> Column:
    """Look a business code up in the fixed code table (null when unknown)."""
    m = F.create_map(*[x for k, v in CODE_LABELS.items() for x in (F.lit(k), F.lit(v))])
    return m[_c(code)]


def snake_to_camel_name(name: str) -> str:
    head, *rest = name.lower().split("_")
    return head + "".join(p[:1].upper() + p[1:] for p in rest)


def snake_to_camel(df: DataFrame) -> DataFrame:
    """Rename columns ``ORDER_ID``/``order_id`` -> ``orderId`` (names only)."""
    return df.toDF(*[snake_to_camel_name(c) for c in df.columns])

