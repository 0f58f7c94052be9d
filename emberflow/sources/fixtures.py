"""Driver tables -> the warehouse's input shapes.

The driver ships TPC-H-like tables plus ``events`` and ``documents``. These
adapters turn them into what the warehouse consumes: app-log lines, change
records, order/detail/payment facts and all-string dimension tables. Every
rule is a column expression (no per-row Python) and each one is restated in
``emberflow.plans.oracle`` as DuckDB SQL, so the oracle can rebuild the same
rows independently.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from emberflow import schemas as S

# ---------------------------------------------------------------------------
# Fixed values of the fixture mapping (kept together, in natural order).
#   area code by user_id % 5 : 110000, 310000, 440000, 330000, 510000
#   channel   by user_id % 4 : app, web, kiosk, partner
#   version   by user_id % 3 : r3.2, r3.1, r2.9
#   brand / model / os       : Kestrel, Kestrel K2, TinyOS 4
#   is_new                   : '1' when value < 100, else '0'
#   event_type -> page_id    : view home, signup login, click good_detail,
#                              purchase trade; error rows are start logs
#   last_page_id             : view null, signup '', click home,
#                              purchase good_detail
#   item, item_type          : click (k, sku_id), purchase (k, sku_ids)
#   displays (view rows)     : (promotion, k, sku_id, 1, k % 5 + 1),
#                              (activity, user_id % 3 + 1, activity_id, 2, 1)
#   start object (error rows): entry icon, loading_time = during time,
#                              open_ad_id k, open_ad_ms 0, open_ad_skip_ms 0
#   favor/cart/refund/comment: signup / purchase / error / view events
#   appraise                 : 1201 when value >= 20, 1202 when >= 5, else 1203
#   payment_type by key % 3  : 1101, 1102, 1103
#   detail time              : order date + (o_orderkey + l_linenumber) % 14 - 7
#                              seconds
#   payment time             : order date + (o_orderkey % 20) minutes,
#                              callback 30 seconds later
#   search rows              : 2024-01-01 00:00:00 + doc_id seconds
# ---------------------------------------------------------------------------
AREA_CODES = ["110000", "310000", "440000", "330000", "510000"]
CHANNELS = ["app", "web", "kiosk", "partner"]
VERSIONS = ["r3.2", "r3.1", "r2.9"]
BRAND, MODEL, OS = "Kestrel", "Kestrel K2", "TinyOS 4"
NEW_VALUE_CUT = 100.0
PAGE_OF_TYPE = {"view": "home", "signup": "login", "click": "good_detail",
                "purchase": "trade"}
SEARCH_EPOCH = "2024-01-01 00:00:00"


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A driver table as its files are when the query is built."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _pick(values: list[str], key: Column) -> Column:
    """values[pmod(key, len(values))] as a CASE expression."""
    out = None
    n = len(values)
    for i, v in enumerate(values):
        cond = F.pmod(key, F.lit(n)) == i
        out = F.when(cond, F.lit(v)) if out is None else out.when(cond, F.lit(v))
    return out


def epoch_millis(ts_col: str | Column) -> Column:
    """Epoch millis of a driver timestamp (read in the session zone)."""
    c = F.col(ts_col) if isinstance(ts_col, str) else ts_col
    return F.unix_millis(c.cast("timestamp"))


def fmt_time(ts_col: str | Column) -> Column:
    c = F.col(ts_col) if isinstance(ts_col, str) else ts_col
    return F.date_format(c, S.TIME_FORMAT)


def _event_k() -> Column:
    return F.get_json_object("props", "$.k").cast("bigint")


# --------------------------------------------------------------------------
# App log
# --------------------------------------------------------------------------
def _log_struct(events: DataFrame) -> DataFrame:
    """events -> structured log rows (seq, common, page, displays, start, ts)."""
    et = F.col("event_type")
    k = _event_k()
    uid = F.col("user_id")
    during = F.round(F.col("value") * 1000).cast("bigint")
    common = F.struct(
        _pick(AREA_CODES, uid).alias("ar"), F.lit(BRAND).alias("ba"),
        _pick(CHANNELS, uid).alias("ch"),
        F.when(F.col("value") < NEW_VALUE_CUT, "1").otherwise("0").alias("is_new"),
        F.lit(MODEL).alias("md"), F.concat(F.lit("dev-"), uid.cast("string")).alias("mid"),
        F.lit(OS).alias("os"), uid.cast("string").alias("uid"),
        _pick(VERSIONS, uid).alias("vc"))
    page_id = F.coalesce(*[F.when(et == t, F.lit(p)) for t, p in PAGE_OF_TYPE.items()])
    last_page = (F.when(et == "signup", F.lit("")).when(et == "click", F.lit("home"))
                 .when(et == "purchase", F.lit("good_detail")))
    item = F.when(et.isin("click", "purchase"), k.cast("string"))
    item_type = F.when(et == "click", F.lit("sku_id")).when(et == "purchase", F.lit("sku_ids"))
    page = F.when(et != "error", F.struct(
        during.alias("during_time"), item.alias("item"), item_type.alias("item_type"),
        last_page.alias("last_page_id"), page_id.alias("page_id"),
        F.lit(None).cast("string").alias("source_type")))
    displays = F.when(et == "view", F.array(
        F.struct(F.lit("promotion").alias("display_type"), k.cast("string").alias("item"),
                 F.lit("sku_id").alias("item_type"), F.lit(1).alias("order"),
                 (F.pmod(k, F.lit(5)) + 1).cast("int").alias("pos_id")),
        F.struct(F.lit("activity").alias("display_type"),
                 (F.pmod(uid, F.lit(3)) + 1).cast("string").alias("item"),
                 F.lit("activity_id").alias("item_type"), F.lit(2).alias("order"),
                 F.lit(1).alias("pos_id"))))
    start = F.when(et == "error", F.struct(
        F.lit("icon").alias("entry"), during.alias("loading_time"), k.alias("open_ad_id"),
        F.lit(0).alias("open_ad_ms"), F.lit(0).alias("open_ad_skip_ms")))
    return events.select(F.col("event_id").alias("seq"), common.alias("common"),
                         page.alias("page"), displays.alias("displays"),
                         start.alias("start"), epoch_millis("ts").alias("ts"))


def raw_log_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The landed app-log topic: ``(seq, value)``.

    Event rows become JSON lines (nulls left out, as the collector's JSON
    writer does); raw web pages from ``pages`` land on the same topic as junk
    that does not parse, with offsets after the events.
    """
    events = read_table(spark, sf_dir, "events")
    pages = read_table(spark, sf_dir, "pages")
    good = _log_struct(events).select(
        "seq", F.to_json(F.struct("common", "page", "displays", "start", "ts")).alias("value"))
    junk = pages.select((F.lit(1_000_000_000_000) + F.col("page_id")).alias("seq"),
                        F.col("html").alias("value"))
    return good.unionByName(junk)


def page_log_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Structured log rows as the parser emits them (``start`` as JSON text)."""
    events = read_table(spark, sf_dir, "events")
    return _log_struct(events).withColumn(
        "start", F.when(F.col("start").isNotNull(), F.to_json("start")))


def search_page_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Search-result page views whose search term is a whole document text.

    Shape of the SQL page table: ``common MAP, page MAP, ts BIGINT``.
    """
    docs = read_table(spark, sf_dir, "documents")
    ts = (F.unix_millis(F.to_timestamp(F.lit(SEARCH_EPOCH)))
          + F.col("doc_id") * 1000)
    return docs.select(
        F.create_map(F.lit("mid"), F.concat(F.lit("dev-doc-"), F.col("doc_id").cast("string")),
                     F.lit("lang"), F.col("lang")).alias("common"),
        F.create_map(F.lit("page_id"), F.lit("good_list"), F.lit("last_page_id"),
                     F.lit("search"), F.lit("item"), F.col("text"),
                     F.lit("item_type"), F.lit("keyword")).alias("page"),
        ts.alias("ts"))


# --------------------------------------------------------------------------
# Business facts
# --------------------------------------------------------------------------
def _money(c: str | Column) -> Column:
    c = F.col(c) if isinstance(c, str) else c
    return c.cast(S.MONEY)


def order_info(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = read_table(spark, sf_dir, "orders")
    customer = read_table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    zero = F.lit(0).cast(S.MONEY)
    return (orders.join(customer, orders.o_custkey == customer.c_custkey, "left")
            .select(F.col("o_orderkey").alias("id"),
                    F.col("c_nationkey").cast("bigint").alias("province_id"),
                    F.col("o_orderstatus").alias("order_status"),
                    F.col("o_custkey").alias("user_id"),
                    _money("o_totalprice").alias("total_amount"),
                    zero.alias("activity_reduce_amount"), zero.alias("coupon_reduce_amount"),
                    _money("o_totalprice").alias("original_total_amount"),
                    zero.alias("feight_fee"),
                    F.lit(None).cast("string").alias("expire_time"),
                    fmt_time("o_orderdate").alias("create_time"),
                    F.lit(None).cast("string").alias("operate_time")))


def order_detail(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Detail lines, written from 7 s before to 6 s after their order."""
    li = read_table(spark, sf_dir, "lineitem").join(
        read_table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("l_orderkey"), "o_orderdate"), "l_orderkey")
    written = F.expr("timestampadd(SECOND, pmod(l_orderkey + l_linenumber, 14) - 7, o_orderdate)")
    price = _money("l_extendedprice")
    disc = F.col("l_discount").cast("decimal(4,2)")
    return li.select(
        # a line number may stand twice in an order: the whole line names the row
        F.xxhash64("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice",
                   "l_discount").alias("id"),
        F.col("l_orderkey").alias("order_id"), F.col("l_partkey").alias("sku_id"),
        price.alias("order_price"), F.col("l_quantity").cast("bigint").alias("sku_num"),
        F.concat(F.lit("sku-"), F.col("l_partkey").cast("string")).alias("sku_name"),
        fmt_time(written).alias("create_time"),
        F.round(price * (F.lit(1) - disc), 2).cast(S.MONEY).alias("split_total_amount"),
        F.round(price * disc, 2).cast(S.MONEY).alias("split_activity_amount"),
        F.lit(0).cast(S.MONEY).alias("split_coupon_amount"))


def payment_info(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = read_table(spark, sf_dir, "orders")
    paid_at = F.expr("timestampadd(MINUTE, pmod(o_orderkey, 20), o_orderdate)")
    return orders.select(
        F.col("o_orderkey").alias("id"), F.col("o_orderkey").alias("order_id"),
        F.col("o_custkey").alias("user_id"), _money("o_totalprice").alias("total_amount"),
        F.concat(F.lit("order "), F.col("o_orderkey").cast("string")).alias("subject"),
        _pick(["1101", "1102", "1103"], F.col("o_orderkey")).alias("payment_type"),
        fmt_time(paid_at).alias("create_time"),
        fmt_time(paid_at + F.expr("INTERVAL '30' SECOND")).alias("callback_time"))


def _event_fact(spark: SparkSession, sf_dir: str, event_type: str) -> DataFrame:
    ev = read_table(spark, sf_dir, "events").filter(
        F.col("event_type") == event_type)
    return ev.select(F.col("event_id").alias("id"), _event_k().alias("sku_id"),
                     F.col("user_id"), F.col("value"), fmt_time("ts").alias("create_time"))


def favor_info(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _event_fact(spark, sf_dir, "signup").select("id", "user_id", "sku_id", "create_time")


def cart_info(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _event_fact(spark, sf_dir, "purchase").select("id", "user_id", "sku_id",
                                                         "create_time")


def order_refund_info(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _event_fact(spark, sf_dir, "error").select(
        "id", F.col("id").alias("order_id"), "sku_id",
        _money("value").alias("refund_amount"), "create_time")


def comment_info(spark: SparkSession, sf_dir: str) -> DataFrame:
    v = F.col("value")
    appraise = F.when(v >= 20, "1201").when(v >= 5, "1202").otherwise("1203")
    return _event_fact(spark, sf_dir, "view").select(
        "id", "user_id", "sku_id", appraise.alias("appraise"), "create_time")


# --------------------------------------------------------------------------
# Dimension tables (all STRING, upper-case names, key ID)
# --------------------------------------------------------------------------
def dim_user_info(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = read_table(spark, sf_dir, "customer")
    return c.select(
        F.col("c_custkey").cast("string").alias("ID"), F.col("c_name").alias("NAME"),
        F.when(F.pmod("c_custkey", F.lit(2)) == 0, "F").otherwise("M").alias("GENDER"),
        F.date_format(F.date_add(F.to_date(F.lit("1960-01-01")),
                                 F.pmod("c_custkey", F.lit(14600)).cast("int")),
                      "yyyy-MM-dd").alias("BIRTHDAY"))


def dim_base_province(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = read_table(spark, sf_dir, "nation")
    r = read_table(spark, sf_dir, "region")
    # Both sides are fixed-size reference tables (25 and 5 rows).
    return n.join(F.broadcast(r), n.n_regionkey == r.r_regionkey).select(
        F.col("n_nationkey").cast("string").alias("ID"), F.col("n_name").alias("NAME"),
        F.col("r_regionkey").cast("string").alias("REGION_ID"),
        F.concat(F.col("r_regionkey").cast("string"),
                 F.lpad(F.col("n_nationkey").cast("string"), 4, "0")).alias("AREA_CODE"),
        F.concat(F.lit("CN-"), F.lpad(F.col("n_nationkey").cast("string"), 2, "0"))
        .alias("ISO_CODE"),
        F.concat(F.lit("CN-"), F.upper(F.substring("n_name", 1, 2))).alias("ISO_3166_2"))


def dim_sku_info(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = read_table(spark, sf_dir, "part")
    spu = p.groupBy("p_name").agg(F.min("p_partkey").alias("spu_key"))
    cat = p.groupBy("p_type").agg(F.min("p_partkey").alias("cat_key"))
    return (p.join(spu, "p_name").join(cat, "p_type").select(
        F.col("p_partkey").cast("string").alias("ID"), F.col("p_name").alias("SKU_NAME"),
        _money("p_retailprice").cast("string").alias("PRICE"),
        F.col("cat_key").cast("string").alias("CATEGORY3_ID"),
        F.col("spu_key").cast("string").alias("SPU_ID"),
        F.regexp_extract("p_brand", r"#(\d+)", 1).alias("TM_ID")))


def dim_spu_info(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = read_table(spark, sf_dir, "part")
    return p.groupBy("p_name").agg(F.min("p_partkey").cast("string").alias("ID")).select(
        "ID", F.col("p_name").alias("SPU_NAME"))


def dim_base_trademark(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = read_table(spark, sf_dir, "part")
    return p.select(F.regexp_extract("p_brand", r"#(\d+)", 1).alias("ID"),
                    F.col("p_brand").alias("TM_NAME")).distinct()


def dim_base_category3(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = read_table(spark, sf_dir, "part")
    return p.groupBy("p_type").agg(F.min("p_partkey").cast("string").alias("ID")).select(
        "ID", F.col("p_type").alias("NAME"))


# --------------------------------------------------------------------------
# Change records and routing config
# --------------------------------------------------------------------------
CHANGE_SERVER = "shop_changes"
CHANGE_DATABASE = "shop"


def _str_map(**cols: Column) -> Column:
    args = []
    for k, v in cols.items():
        args += [F.lit(k), v.cast("string")]
    return F.create_map(*args)


def change_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw change records ``(seq, topic, value)`` built from customer and orders.

    user_info: every customer is inserted; customers with a negative balance
    are then updated (name upper-cased); those below -500 are deleted.
    order_info: every order is inserted ('F' orders first as 'O'), 'F' orders
    are then updated to 'F'.
    """
    c = read_table(spark, sf_dir, "customer")
    o = read_table(spark, sf_dir, "orders")
    gender = F.when(F.pmod("c_custkey", F.lit(2)) == 0, "F").otherwise("M")
    birthday = F.date_format(F.date_add(F.to_date(F.lit("1960-01-01")),
                                        F.pmod("c_custkey", F.lit(14600)).cast("int")),
                             "yyyy-MM-dd")
    user_img = _str_map(id=F.col("c_custkey"), name=F.col("c_name"), gender=gender,
                        birthday=birthday, nation_id=F.col("c_nationkey"))
    user_upd = _str_map(id=F.col("c_custkey"), name=F.upper("c_name"), gender=gender,
                        birthday=birthday, nation_id=F.col("c_nationkey"))
    base = F.lit(1_700_000_000_000) + F.col("c_custkey") * 10
    null_map = F.lit(None).cast(S.STR_MAP)
    u_topic = F.lit(f"{CHANGE_SERVER}.{CHANGE_DATABASE}.user_info")
    users = c.select(
        F.explode(F.array(
            F.struct(null_map.alias("before"), user_img.alias("after"), F.lit("c").alias("op"),
                     base.alias("ts_ms")),
            F.when(F.col("c_acctbal") < 0, F.struct(
                user_img.alias("before"), user_upd.alias("after"), F.lit("u").alias("op"),
                (base + 5).alias("ts_ms"))),
            F.when(F.col("c_acctbal") < -500, F.struct(
                user_upd.alias("before"), null_map.alias("after"), F.lit("d").alias("op"),
                (base + 7).alias("ts_ms"))),
        )).alias("r")).filter(F.col("r").isNotNull()).select(u_topic.alias("topic"), "r.*")

    first_status = F.when(F.col("o_orderstatus") == "F", "O").otherwise(F.col("o_orderstatus"))

    def order_img(status: Column) -> Column:
        return _str_map(id=F.col("o_orderkey"), user_id=F.col("o_custkey"),
                        order_status=status, total_amount=_money("o_totalprice"),
                        create_time=fmt_time("o_orderdate"))

    ots = epoch_millis("o_orderdate") + F.col("o_orderkey")
    o_topic = F.lit(f"{CHANGE_SERVER}.{CHANGE_DATABASE}.order_info")
    orders = o.select(
        F.explode(F.array(
            F.struct(null_map.alias("before"), order_img(first_status).alias("after"),
                     F.lit("c").alias("op"), ots.alias("ts_ms")),
            F.when(F.col("o_orderstatus") == "F", F.struct(
                order_img(first_status).alias("before"),
                order_img(F.col("o_orderstatus")).alias("after"),
                F.lit("u").alias("op"), (ots + 60_000).alias("ts_ms"))),
        )).alias("r")).filter(F.col("r").isNotNull()).select(o_topic.alias("topic"), "r.*")

    src = F.create_map(F.lit("db"), F.lit(CHANGE_DATABASE))
    return users.unionByName(orders).select(
        F.col("ts_ms").alias("seq"), "topic",
        F.to_json(F.struct("before", "after", src.alias("source"), "op", "ts_ms"))
        .alias("value"))


# Routing configuration (fixed values). Later versions of a key win.
ROUTING_CONFIG = [
    # source_table, operate_type, sink_type, sink_table, sink_columns, sink_pk, sink_extend, version
    ("user_info", "insert", "hbase", "dim_user_info", "id,name,gender", None, None, 1),
    ("user_info", "insert", "hbase", "dim_user_info", "id,name,gender,birthday", "id", None, 2),
    ("user_info", "update", "hbase", "dim_user_info", "id,name,gender,birthday", "id", None, 1),
    ("order_info", "insert", "kafka", "dwd_order_info",
     "id,user_id,order_status,total_amount,create_time", None, None, 1),
    ("payment_info", "insert", "clickhouse", "payment_archive", "id", None, None, 1),
]


def routing_config(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(ROUTING_CONFIG, S.TABLE_PROCESS)


# --------------------------------------------------------------------------
# Comma lines for the interval-join demo: "id,name,ts" and "id,sex,ts" (ts in s)
# --------------------------------------------------------------------------
def csv_name_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = read_table(spark, sf_dir, "events")
    return ev.select(F.concat_ws(",", F.col("user_id").cast("string"), F.col("event_type"),
                                 F.unix_seconds(F.col("ts").cast("timestamp")).cast("string"))
                     .alias("value"))


def csv_sex_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = read_table(spark, sf_dir, "events")
    sex = F.when(F.pmod("user_id", F.lit(2)) == 0, "F").otherwise("M")
    return ev.select(F.concat_ws(",", F.col("user_id").cast("string"), sex,
                                 F.unix_seconds(F.col("ts").cast("timestamp")).cast("string"))
                     .alias("value"))


def dim_sku_brand(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The part of the sku lookups that brand reports read: sku id -> trademark name."""
    p = read_table(spark, sf_dir, "part")
    return p.select(F.col("p_partkey").cast("string").alias("ID"), F.col("p_brand").alias("TM_NAME"))
