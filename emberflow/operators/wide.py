"""Order wide rows (order x detail + six dimensions) and payment wide rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from emberflow import schemas as S
from emberflow.functions.scalars import order_time_parts, user_age
from emberflow.operators.joins import enrich, interval_join


def _time(col: str, fallback: str | None = None) -> Column:
    """Event time of a ``yyyy-MM-dd HH:mm:ss`` text; a text that does not
    parse gives null, or the ``fallback`` column (e.g. the topic record's
    own timestamp) when one is named."""
    t = F.try_to_timestamp(F.col(col), F.lit(S.TIME_FORMAT))
    return F.coalesce(t, F.col(fallback)) if fallback else t


def order_detail_join(order_info: DataFrame, order_detail: DataFrame,
                      lower_ms: int = -5_000, upper_ms: int = 5_000,
                      watermark: str | None = None, record_time: str | None = None) -> DataFrame:
    """Interval join of orders and their detail lines on the order id.

    Detail time must lie in ``[order time + lower, order time + upper]``
    (both ends included). ``watermark`` (e.g. ``"0 seconds"``) is applied to
    both sides when they are streams.
    """
    o = order_time_parts(order_info).withColumn("_ort", _time("create_time", record_time))
    d = order_detail.select(*[F.col(c).alias(f"d_{c}") for c in order_detail.columns]) \
        .withColumn("_drt", _time("d_create_time",
                                  f"d_{record_time}" if record_time else None))
    if watermark and o.isStreaming:
        o = o.withWatermark("_ort", watermark)
    if watermark and d.isStreaming:
        d = d.withWatermark("_drt", watermark)
    if not d.isStreaming:
        # both sides are facts that grow together: a sort-merge join on the
        # order id (spills, AQE splits hot ids), never a broadcast of lines
        d = d.hint("merge")
    return interval_join(o, d, "id", "d_order_id", "_ort", "_drt", lower_ms, upper_ms)


def order_wide_merge(joined: DataFrame) -> DataFrame:
    """Which wide column comes from which side.

    ``expire_time``, ``operate_time`` and ``split_feight_fee`` are never
    filled by the merge; ``order_id`` comes from the order side.
    """
    null_s = F.lit(None).cast("string")
    return joined.select(
        F.col("d_id").alias("detail_id"), F.col("id").alias("order_id"),
        F.col("d_sku_id").alias("sku_id"), F.col("d_order_price").alias("order_price"),
        F.col("d_sku_num").alias("sku_num"), F.col("d_sku_name").alias("sku_name"),
        "province_id", "order_status", "user_id", "total_amount", "activity_reduce_amount",
        "coupon_reduce_amount", "original_total_amount", "feight_fee",
        F.lit(None).cast(S.MONEY).alias("split_feight_fee"),
        F.col("d_split_activity_amount").alias("split_activity_amount"),
        F.col("d_split_coupon_amount").alias("split_coupon_amount"),
        F.col("d_split_total_amount").alias("split_total_amount"),
        null_s.alias("expire_time"), "create_time", null_s.alias("operate_time"),
        "create_date", "create_hour", "_ort")


def order_wide_coalesce(a: DataFrame, b: DataFrame, key: str = "detail_id",
                        order: str | None = None) -> DataFrame:
    """First-non-null merge of partial wide rows with the same key.

    Every row of ``a`` gives one row: a key that ``b`` holds several times is
    first reduced to its first non-null value per column, by the column
    ``order`` of ``b`` (without one, the smallest value, so that the result
    does not depend on the order of rows). The three ``split_*`` amounts take
    only the own (left) value. A null key matches nothing.
    """
    own_only = {"split_activity_amount", "split_coupon_amount", "split_total_amount"}
    shared = [c for c in a.columns if c != key and c not in own_only and c in b.columns]

    def first(c: str) -> Column:
        return F.min(c) if order is None else F.min_by(c, F.when(F.col(c).isNotNull(), F.col(order)))

    one = b.groupBy(F.col(key).alias("_key")).agg(F.count(F.lit(1)).alias("_n"), *[first(c).alias(f"_b_{c}") for c in shared])
    return a.join(one, F.col(key) == F.col("_key"), "left").select(
        *[F.coalesce(F.col(c), F.col(f"_b_{c}")).alias(c) if c in shared else F.col(c) for c in a.columns])


def enrich_user(wide: DataFrame, dim_user: DataFrame, as_of: Column | None = None) -> DataFrame:
    out = enrich(wide, dim_user, "user_id", {"user_gender": "GENDER", "_birthday": "BIRTHDAY"},
                 key_type="bigint")
    return out.withColumn("user_age", user_age("_birthday", as_of)).drop("_birthday")


def enrich_province(wide: DataFrame, dim_province: DataFrame) -> DataFrame:
    return enrich(wide, dim_province, "province_id",
                  {"province_name": "NAME", "province_area_code": "AREA_CODE",
                   "province_iso_code": "ISO_CODE", "province_3166_2_code": "ISO_3166_2"},
                  key_type="bigint")  # provinces: fixed reference data


def enrich_sku(wide: DataFrame, dim_sku: DataFrame) -> DataFrame:
    """SKU name (dim wins where the dim row exists), spu / tm / category3 ids."""
    out = enrich(wide, dim_sku, "sku_id",
                 {"_dim_sku_name": "SKU_NAME",
                  "category3_id": F.col("CATEGORY3_ID").try_cast("bigint"),
                  "spu_id": F.col("SPU_ID").try_cast("bigint"),
                  "tm_id": F.col("TM_ID").try_cast("bigint"),
                  "_dim_hit": F.lit(True)},
                 key_type="bigint")
    return out.withColumn("sku_name", F.when(F.col("_dim_hit"), F.col("_dim_sku_name"))
                          .otherwise(F.col("sku_name"))).drop("_dim_sku_name", "_dim_hit")


def enrich_spu(wide: DataFrame, dim_spu: DataFrame) -> DataFrame:
    return enrich(wide, dim_spu, "spu_id", {"spu_name": "SPU_NAME"}, key_type="bigint")


def enrich_tm(wide: DataFrame, dim_tm: DataFrame) -> DataFrame:
    return enrich(wide, dim_tm, "tm_id", {"tm_name": "TM_NAME"}, key_type="bigint")


def enrich_category3(wide: DataFrame, dim_cat: DataFrame) -> DataFrame:
    return enrich(wide, dim_cat, "category3_id", {"category3_name": "NAME"}, key_type="bigint")


def dim_product(dim_sku: DataFrame, dim_spu: DataFrame, dim_tm: DataFrame,
                dim_cat: DataFrame) -> DataFrame:
    """The product snowflake joined once on the dimension side.

    SKU rows with their spu / trademark / category3 names (left joins, so a
    missing parent leaves nulls). Facts then take one product lookup instead
    of four: at scale that is one pass (one shuffle, if the product dim is
    too large to broadcast) over the facts instead of four.
    """
    sku = dim_sku.select(F.col("ID").try_cast("bigint").alias("sku_key"), "SKU_NAME", "PRICE",
                         F.col("SPU_ID").try_cast("bigint").alias("SPU_KEY"),
                         F.col("TM_ID").try_cast("bigint").alias("TM_KEY"),
                         F.col("CATEGORY3_ID").try_cast("bigint").alias("CAT_KEY"))
    spu = dim_spu.select(F.col("ID").try_cast("bigint").alias("SPU_KEY"), "SPU_NAME")
    tm = dim_tm.select(F.col("ID").try_cast("bigint").alias("TM_KEY"), "TM_NAME")
    cat = dim_cat.select(F.col("ID").try_cast("bigint").alias("CAT_KEY"),
                         F.col("NAME").alias("CATEGORY3_NAME"))
    return (sku.join(spu, "SPU_KEY", "left").join(tm, "TM_KEY", "left")
            .join(cat, "CAT_KEY", "left"))


def enrich_product(wide: DataFrame, product: DataFrame) -> DataFrame:
    """sku name (dim wins where the sku row exists), ids and the three names."""
    out = enrich(wide, product, "sku_id",
                 {"_dim_sku_name": "SKU_NAME", "category3_id": "CAT_KEY", "spu_id": "SPU_KEY",
                  "tm_id": "TM_KEY", "spu_name": "SPU_NAME", "tm_name": "TM_NAME",
                  "category3_name": "CATEGORY3_NAME", "_dim_hit": F.lit(True)},
                 dim_key="sku_key")
    return out.withColumn("sku_name", F.when(F.col("_dim_hit"), F.col("_dim_sku_name"))
                          .otherwise(F.col("sku_name"))).drop("_dim_sku_name", "_dim_hit")


def order_wide(order_info: DataFrame, order_detail: DataFrame, dims: dict[str, DataFrame],
               lower_ms: int = -5_000, upper_ms: int = 5_000, as_of: Column | None = None,
               watermark: str | None = None) -> DataFrame:
    """dwd order + detail -> dwm order wide rows (35 columns, bean order).

    ``dims`` holds ``user, province`` and either ``product`` (see
    ``dim_product``) or ``sku, spu, tm, category3``; the snowflake is then
    joined on the dimension side first (sku brings the spu / tm / category3
    ids, as in the original lookup order).
    """
    return order_wide_lookups(order_wide_merge(order_detail_join(
        order_info, order_detail, lower_ms, upper_ms, watermark)), dims, as_of)


def order_wide_lookups(merged: DataFrame, dims: dict[str, DataFrame], as_of: Column | None = None) -> DataFrame:
    """The dimension lookups of ``order_wide`` on merged order and detail rows."""
    w = enrich_user(merged, dims["user"], as_of)
    w = enrich_province(w, dims["province"])
    product = dims.get("product")
    if product is None:
        product = dim_product(dims["sku"], dims["spu"], dims["tm"], dims["category3"])
    w = enrich_product(w, product)
    return w.select(*S.ORDER_WIDE_COLUMNS)


def payment_wide_join(payment_info: DataFrame, order_wide_rows: DataFrame,
                      lower_ms: int = -15 * 60_000, upper_ms: int = 5_000,
                      watermark: str | None = None, record_time: str | None = None) -> DataFrame:
    """Payments joined to order wide rows whose time lies in
    ``[payment time + lower, payment time + upper]``. With ``record_time``
    (a timestamp column on both inputs, e.g. the topic record time), a
    ``create_time`` that does not parse falls back to it."""
    p = payment_info.select(*[F.col(c).alias(f"p_{c}") for c in payment_info.columns]) \
        .withColumn("_prt", _time("p_create_time", f"p_{record_time}" if record_time else None))
    ow = order_wide_rows.withColumn("_owrt", _time("create_time", record_time))
    if watermark and p.isStreaming:
        p = p.withWatermark("_prt", watermark)
    if watermark and ow.isStreaming:
        ow = ow.withWatermark("_owrt", watermark)
    return interval_join(p, ow, "p_order_id", "order_id", "_prt", "_owrt", lower_ms, upper_ms)


def payment_wide_merge(joined: DataFrame) -> DataFrame:
    """All order-wide columns, then the payment's: payment wins on
    ``order_id``, ``user_id``, ``total_amount`` (even when null)."""
    from_payment = {"payment_id": "p_id", "subject": "p_subject",
                    "payment_type": "p_payment_type", "payment_create_time": "p_create_time",
                    "callback_time": "p_callback_time", "order_id": "p_order_id",
                    "user_id": "p_user_id", "total_amount": "p_total_amount",
                    "order_create_time": "create_time"}
    return joined.select(*[F.col(from_payment.get(c, c)).alias(c)
                           for c in S.PAYMENT_WIDE_COLUMNS])


def payment_wide(payment_info: DataFrame, order_wide_rows: DataFrame,
                 lower_ms: int = -15 * 60_000, upper_ms: int = 5_000,
                 watermark: str | None = None) -> DataFrame:
    return payment_wide_merge(payment_wide_join(payment_info, order_wide_rows, lower_ms,
                                                upper_ms, watermark))


def payment_wide_from_orders(payment_info: DataFrame, order_info: DataFrame,
                             order_detail: DataFrame, dims: dict[str, DataFrame],
                             order_lower_ms: int = -5_000, order_upper_ms: int = 5_000,
                             lower_ms: int = -15 * 60_000, upper_ms: int = 5_000,
                             as_of: Column | None = None) -> DataFrame:
    """``payment_wide`` with the payment join moved before the dimension
    lookups. Both joins key on the order id, so at scale the payment side is
    the only one shuffled for it (the order/detail join output is already
    partitioned by order id), and only paid lines are enriched. The lookups
    are left joins on unique dimension keys, so the rows are the same.
    """
    merged = order_wide_merge(order_detail_join(order_info, order_detail, order_lower_ms,
                                                order_upper_ms))
    j = payment_wide_join(payment_info, merged, lower_ms, upper_ms)
    j = enrich_user(j, dims["user"], as_of)
    j = enrich_province(j, dims["province"])
    product = dims.get("product")
    if product is None:
        product = dim_product(dims["sku"], dims["spu"], dims["tm"], dims["category3"])
    return payment_wide_merge(enrich_product(j, product))
