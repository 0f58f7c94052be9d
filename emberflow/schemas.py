"""Row shapes. Field order of the report schemas is the sink contract."""

from __future__ import annotations

from pyspark.sql import types as T

S = T.StringType()
L = T.LongType()
I = T.IntegerType()
MONEY = T.DecimalType(16, 2)
STR_MAP = T.MapType(S, S)

COMMON = T.StructType([T.StructField(n, S) for n in
                       ("ar", "ba", "ch", "is_new", "md", "mid", "os", "uid", "vc")])
PAGE = T.StructType([
    T.StructField("during_time", L), T.StructField("item", S), T.StructField("item_type", S),
    T.StructField("last_page_id", S), T.StructField("page_id", S), T.StructField("source_type", S),
])
DISPLAY = T.StructType([
    T.StructField("display_type", S), T.StructField("item", S), T.StructField("item_type", S),
    T.StructField("order", I), T.StructField("pos_id", I),
])
# One app-log line. ``start`` is kept as raw JSON text: only non-emptiness is used.
PAGE_LOG = T.StructType([
    T.StructField("common", COMMON), T.StructField("page", PAGE),
    T.StructField("displays", T.ArrayType(DISPLAY)), T.StructField("start", S),
    T.StructField("ts", L),
])

# Raw change record as landed by a change-capture connector (value of topic
# ``server.database.table``).
CHANGE_VALUE = T.StructType([
    T.StructField("before", STR_MAP), T.StructField("after", STR_MAP),
    T.StructField("source", STR_MAP), T.StructField("op", S), T.StructField("ts_ms", L),
])

# Normalised change envelope.
ENVELOPE = T.StructType([
    T.StructField("database", S), T.StructField("tableName", S),
    T.StructField("before", STR_MAP), T.StructField("after", STR_MAP),
    T.StructField("type", S), T.StructField("ts_ms", L),
])

# Routing configuration row.
TABLE_PROCESS = T.StructType([
    T.StructField("source_table", S), T.StructField("operate_type", S),
    T.StructField("sink_type", S), T.StructField("sink_table", S),
    T.StructField("sink_columns", S), T.StructField("sink_pk", S),
    T.StructField("sink_extend", S), T.StructField("version", L),
])
SINK_TYPE_KAFKA = "kafka"
SINK_TYPE_HBASE = "hbase"


# Wide rows (field order of the published rows).
ORDER_WIDE_COLUMNS = [
    "detail_id", "order_id", "sku_id", "order_price", "sku_num", "sku_name", "province_id",
    "order_status", "user_id", "total_amount", "activity_reduce_amount",
    "coupon_reduce_amount", "original_total_amount", "feight_fee", "split_feight_fee",
    "split_activity_amount", "split_coupon_amount", "split_total_amount", "expire_time",
    "create_time", "operate_time", "create_date", "create_hour", "province_name",
    "province_area_code", "province_iso_code", "province_3166_2_code", "user_age",
    "user_gender", "spu_id", "tm_id", "category3_id", "spu_name", "tm_name", "category3_name",
]
PAYMENT_WIDE_COLUMNS = [
    "payment_id", "subject", "payment_type", "payment_create_time", "callback_time",
    "detail_id", "order_id", "sku_id", "order_price", "sku_num", "sku_name", "province_id",
    "order_status", "user_id", "total_amount", "activity_reduce_amount",
    "coupon_reduce_amount", "original_total_amount", "feight_fee", "split_feight_fee",
    "split_activity_amount", "split_coupon_amount", "split_total_amount",
    "order_create_time", "province_name", "province_area_code", "province_iso_code",
    "province_3166_2_code", "user_age", "user_gender", "spu_id", "tm_id", "category3_id",
    "spu_name", "tm_name", "category3_name",
]

# Report tables: column order is the positional insert contract.
VISITOR_STATS_COLUMNS = ["stt", "edt", "vc", "ch", "ar", "is_new", "uv_ct", "pv_ct", "sv_ct",
                         "uj_ct", "dur_sum", "ts"]
PRODUCT_STATS_COLUMNS = [
    "stt", "edt", "sku_id", "sku_name", "sku_price", "spu_id", "spu_name", "tm_id", "tm_name",
    "category3_id", "category3_name", "display_ct", "click_ct", "favor_ct", "cart_ct",
    "order_sku_num", "order_amount", "order_ct", "payment_amount", "paid_order_ct",
    "refund_order_ct", "refund_amount", "comment_ct", "good_comment_ct", "ts",
]
PROVINCE_STATS_COLUMNS = ["stt", "edt", "province_id", "province_name", "province_area_code",
                          "province_iso_code", "province_3166_2_code", "order_amount",
                          "order_count", "ts"]
KEYWORD_STATS_COLUMNS = ["keyword", "ct", "source", "stt", "edt", "ts"]

TIME_FORMAT = "yyyy-MM-dd HH:mm:ss"
