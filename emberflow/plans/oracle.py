"""DuckDB SQL restating each catalog query from the raw driver tables.

The oracle rebuilds the fixture rows itself (same rules as
``emberflow.sources.fixtures``) and computes each operator the plain way:
window functions where the Spark side uses skew-safe aggregates, direct
joins, ``count(DISTINCT ...)``. Timestamps are read as UTC wall clock.
"""

from __future__ import annotations

WIN = 10_000
ORDER_BAND_S = 5
JUMP_WITHIN_MS = 3_600_000
CSV_BAND_S = 3_600
AGE_AS_OF = "2026-01-01"
WORD_RE = r"[\p{L}\p{N}]+"

# --------------------------------------------------------------------------
# fixture CTEs
# --------------------------------------------------------------------------
LOGS = """
logs0 AS (
  SELECT event_id AS seq, event_type,
    CASE user_id % 5 WHEN 0 THEN '110000' WHEN 1 THEN '310000' WHEN 2 THEN '440000'
                     WHEN 3 THEN '330000' ELSE '510000' END AS ar,
    'Kestrel' AS ba,
    CASE user_id % 4 WHEN 0 THEN 'app' WHEN 1 THEN 'web' WHEN 2 THEN 'kiosk'
                     ELSE 'partner' END AS ch,
    CASE WHEN value < 100 THEN '1' ELSE '0' END AS is_new_raw,
    'Kestrel K2' AS md, 'dev-' || CAST(user_id AS VARCHAR) AS mid, 'TinyOS 4' AS os,
    CAST(user_id AS VARCHAR) AS uid,
    CASE user_id % 3 WHEN 0 THEN 'r3.2' WHEN 1 THEN 'r3.1' ELSE 'r2.9' END AS vc,
    CAST(round(value * 1000) AS BIGINT) AS during_time,
    CAST(json_extract_string(props, '$.k') AS BIGINT) AS k,
    user_id, value, (epoch_us(ts) // 1000) AS ts, ts AS ts_raw
  FROM events),
logs AS (
  SELECT *,
    CASE WHEN is_new_raw = '1' AND
              row_number() OVER (PARTITION BY mid, is_new_raw ORDER BY ts, seq) > 1
         THEN '0' ELSE is_new_raw END AS is_new,
    CASE event_type WHEN 'view' THEN 'home' WHEN 'signup' THEN 'login'
                    WHEN 'click' THEN 'good_detail' WHEN 'purchase' THEN 'trade' END AS page_id,
    CASE event_type WHEN 'signup' THEN '' WHEN 'click' THEN 'home'
                    WHEN 'purchase' THEN 'good_detail' END AS last_page_id,
    CASE WHEN event_type IN ('click', 'purchase') THEN CAST(k AS VARCHAR) END AS item,
    CASE event_type WHEN 'click' THEN 'sku_id' WHEN 'purchase' THEN 'sku_ids' END AS item_type,
    CAST(NULL AS VARCHAR) AS source_type
  FROM logs0),
page_rows AS (
  SELECT *, coalesce(length(last_page_id), 0) = 0 AS is_entry
  FROM logs WHERE event_type <> 'error')
"""

ORDER_INFO = """
order_info AS (
  SELECT o_orderkey AS id, CAST(c_nationkey AS BIGINT) AS province_id,
    o_orderstatus AS order_status, o_custkey AS user_id,
    CAST(o_totalprice AS DECIMAL(16,2)) AS total_amount,
    CAST(0 AS DECIMAL(16,2)) AS activity_reduce_amount,
    CAST(0 AS DECIMAL(16,2)) AS coupon_reduce_amount,
    CAST(o_totalprice AS DECIMAL(16,2)) AS original_total_amount,
    CAST(0 AS DECIMAL(16,2)) AS feight_fee,
    CAST(NULL AS VARCHAR) AS expire_time,
    strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS create_time,
    CAST(NULL AS VARCHAR) AS operate_time,
    strftime(o_orderdate, '%Y-%m-%d') AS create_date,
    strftime(o_orderdate, '%H') AS create_hour,
    o_orderdate AS ort
  FROM orders LEFT JOIN customer ON o_custkey = c_custkey)
"""

ORDER_DETAIL = """
order_detail AS (
  SELECT l_orderkey AS order_id, l_partkey AS sku_id,
    CAST(l_extendedprice AS DECIMAL(16,2)) AS order_price,
    CAST(l_quantity AS BIGINT) AS sku_num,
    'sku-' || CAST(l_partkey AS VARCHAR) AS sku_name,
    strftime(o_orderdate + to_seconds(CAST((l_orderkey + l_linenumber) % 14 - 7 AS BIGINT)), '%Y-%m-%d %H:%M:%S')
      AS create_time,
    CAST(round(CAST(l_extendedprice AS DECIMAL(16,2))
               * (1 - CAST(l_discount AS DECIMAL(4,2))), 2) AS DECIMAL(16,2)) AS split_total_amount,
    CAST(round(CAST(l_extendedprice AS DECIMAL(16,2))
               * CAST(l_discount AS DECIMAL(4,2)), 2) AS DECIMAL(16,2)) AS split_activity_amount,
    CAST(0 AS DECIMAL(16,2)) AS split_coupon_amount,
    o_orderdate + to_seconds(CAST((l_orderkey + l_linenumber) % 14 - 7 AS BIGINT)) AS drt
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey)
"""

ORDER_JOIN = f"""
od_join AS (
  SELECT o.id AS order_id, d.sku_id, d.order_price, d.sku_num, d.sku_name, o.province_id,
    o.order_status, o.user_id, o.total_amount, o.activity_reduce_amount,
    o.coupon_reduce_amount, o.original_total_amount, o.feight_fee,
    CAST(NULL AS DECIMAL(16,2)) AS split_feight_fee, d.split_activity_amount,
    d.split_coupon_amount, d.split_total_amount, o.expire_time, o.create_time,
    o.operate_time, o.create_date, o.create_hour, d.create_time AS detail_time
  FROM order_info o JOIN order_detail d
    ON o.id = d.order_id
   AND d.drt >= o.ort - INTERVAL {ORDER_BAND_S} SECOND
   AND d.drt <= o.ort + INTERVAL {ORDER_BAND_S} SECOND)
"""

DIMS = f"""
dim_user AS (
  SELECT c_custkey AS id, CASE WHEN c_custkey % 2 = 0 THEN 'F' ELSE 'M' END AS gender,
    strftime(DATE '1960-01-01' + CAST(c_custkey % 14600 AS INTEGER), '%Y-%m-%d') AS birthday
  FROM customer),
dim_province AS (
  SELECT n_nationkey AS id, n_name AS name,
    CAST(r_regionkey AS VARCHAR) || lpad(CAST(n_nationkey AS VARCHAR), 4, '0') AS area_code,
    'CN-' || lpad(CAST(n_nationkey AS VARCHAR), 2, '0') AS iso_code,
    'CN-' || upper(substr(n_name, 1, 2)) AS iso_3166_2
  FROM nation JOIN region ON n_regionkey = r_regionkey),
spu_keys AS (SELECT p_name, min(p_partkey) AS spu_id FROM part GROUP BY p_name),
cat_keys AS (SELECT p_type, min(p_partkey) AS category3_id FROM part GROUP BY p_type),
dim_sku AS (
  SELECT p_partkey AS id, p.p_name AS sku_name,
    CAST(p_retailprice AS DECIMAL(16,2)) AS price,
    c.category3_id, s.spu_id,
    CAST(regexp_extract(p_brand, '#(\\d+)', 1) AS BIGINT) AS tm_id
  FROM part p JOIN spu_keys s ON p.p_name = s.p_name JOIN cat_keys c ON p.p_type = c.p_type),
dim_spu AS (SELECT spu_id AS id, p_name AS spu_name FROM spu_keys),
dim_tm AS (
  SELECT DISTINCT CAST(regexp_extract(p_brand, '#(\\d+)', 1) AS BIGINT) AS id, p_brand AS tm_name
  FROM part),
dim_cat AS (SELECT category3_id AS id, p_type AS name FROM cat_keys)
"""

ORDER_WIDE = f"""
order_wide AS (
  SELECT j.order_id, j.sku_id, j.order_price, j.sku_num,
    CASE WHEN s.id IS NOT NULL THEN s.sku_name ELSE j.sku_name END AS sku_name,
    j.province_id, j.order_status, j.user_id, j.total_amount, j.activity_reduce_amount,
    j.coupon_reduce_amount, j.original_total_amount, j.feight_fee, j.split_feight_fee,
    j.split_activity_amount, j.split_coupon_amount, j.split_total_amount, j.expire_time,
    j.create_time, j.operate_time, j.create_date, j.create_hour,
    pr.name AS province_name, pr.area_code AS province_area_code,
    pr.iso_code AS province_iso_code, pr.iso_3166_2 AS province_3166_2_code,
    CAST(floor(datediff('day', CAST(u.birthday AS DATE), DATE '{AGE_AS_OF}') / 365) AS INTEGER)
      AS user_age,
    u.gender AS user_gender, s.spu_id, s.tm_id, s.category3_id, sp.spu_name, t.tm_name,
    c.name AS category3_name
  FROM od_join j
  LEFT JOIN dim_user u ON j.user_id = u.id
  LEFT JOIN dim_province pr ON j.province_id = pr.id
  LEFT JOIN dim_sku s ON j.sku_id = s.id
  LEFT JOIN dim_spu sp ON s.spu_id = sp.id
  LEFT JOIN dim_tm t ON s.tm_id = t.id
  LEFT JOIN dim_cat c ON s.category3_id = c.id)
"""

PAYMENT_INFO = """
payment_info AS (
  SELECT o_orderkey AS id, o_orderkey AS order_id, o_custkey AS user_id,
    CAST(o_totalprice AS DECIMAL(16,2)) AS total_amount,
    'order ' || CAST(o_orderkey AS VARCHAR) AS subject,
    CASE o_orderkey % 3 WHEN 0 THEN '1101' WHEN 1 THEN '1102' ELSE '1103' END AS payment_type,
    strftime(o_orderdate + to_minutes(CAST(o_orderkey % 20 AS BIGINT)), '%Y-%m-%d %H:%M:%S')
      AS create_time,
    strftime(o_orderdate + to_minutes(CAST(o_orderkey % 20 AS BIGINT)) + INTERVAL 30 SECOND,
             '%Y-%m-%d %H:%M:%S') AS callback_time,
    o_orderdate + to_minutes(CAST(o_orderkey % 20 AS BIGINT)) AS prt
  FROM orders)
"""

PAYMENT_WIDE = """
payment_wide AS (
  SELECT p.id AS payment_id, p.subject, p.payment_type, p.create_time AS payment_create_time,
    p.callback_time, p.order_id, w.sku_id, w.order_price, w.sku_num, w.sku_name,
    w.province_id, w.order_status, p.user_id, p.total_amount, w.activity_reduce_amount,
    w.coupon_reduce_amount, w.original_total_amount, w.feight_fee, w.split_feight_fee,
    w.split_activity_amount, w.split_coupon_amount, w.split_total_amount,
    w.create_time AS order_create_time, w.province_name, w.province_area_code,
    w.province_iso_code, w.province_3166_2_code, w.user_age, w.user_gender, w.spu_id,
    w.tm_id, w.category3_id, w.spu_name, w.tm_name, w.category3_name
  FROM payment_info p JOIN order_wide w
    ON p.order_id = w.order_id
   AND CAST(w.create_time AS TIMESTAMP) >= p.prt - INTERVAL 15 MINUTE
   AND CAST(w.create_time AS TIMESTAMP) <= p.prt + INTERVAL 5 SECOND)
"""


def _event_fact(name: str, event_type: str) -> str:
    return f"""
{name} AS (
  SELECT event_id AS id, user_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS sku_id,
    value, strftime(ts, '%Y-%m-%d %H:%M:%S') AS create_time,
    epoch_ms(date_trunc('second', ts)) AS ts_ms
  FROM events WHERE event_type = '{event_type}')"""


FACTS = ",".join([_event_fact("favor_info", "signup"), _event_fact("cart_info", "purchase"),
                  _event_fact("refund_info", "error"), _event_fact("comment_info", "view")])

_ZERO_METRICS = {
    "display_ct": "0", "click_ct": "0", "favor_ct": "0", "cart_ct": "0", "order_sku_num": "0",
    "comment_ct": "0", "good_comment_ct": "0", "order_amount": "0", "payment_amount": "0",
    "refund_amount": "0", "order_oid": "NULL", "paid_oid": "NULL", "refund_oid": "NULL",
}


def _metric(src: str, sku: str, ts: str, where: str = "", **over: str) -> str:
    cols = [f"CAST({sku} AS BIGINT) AS sku_id"]
    for k, v in _ZERO_METRICS.items():
        val = over.get(k, v)
        if k.endswith("_amount"):
            cols.append(f"CAST({val} AS DECIMAL(16,2)) AS {k}")
        else:
            cols.append(f"CAST({val} AS BIGINT) AS {k}")
    cols.append(f"CAST({ts} AS BIGINT) AS ts")
    return f"SELECT {', '.join(cols)} FROM {src} {where}"


M_CLICK = _metric("page_rows", "item", "ts", "WHERE page_id = 'good_detail' AND item_type = 'sku_id'",
                  click_ct="1")
M_DISPLAY = _metric("page_rows", "k", "ts", "WHERE event_type = 'view'", display_ct="1")
M_FAVOR = _metric("favor_info", "sku_id", "ts_ms", favor_ct="1")
M_CART = _metric("cart_info", "sku_id", "ts_ms", cart_ct="1")
M_ORDER = _metric("order_wide", "sku_id", "epoch_ms(CAST(create_time AS TIMESTAMP))",
                  order_sku_num="sku_num", order_amount="split_total_amount",
                  order_oid="order_id")
M_PAYMENT = _metric("payment_wide", "sku_id",
                    "epoch_ms(CAST(payment_create_time AS TIMESTAMP))",
                    payment_amount="split_total_amount", paid_oid="order_id")
M_REFUND = _metric("refund_info", "sku_id", "ts_ms", refund_amount="value", refund_oid="id")
M_COMMENT = _metric("comment_info", "sku_id", "ts_ms", comment_ct="1",
                    good_comment_ct="CASE WHEN value >= 20 THEN 1 ELSE 0 END")

METRIC_COLS = ("sku_id, display_ct, click_ct, favor_ct, cart_ct, order_sku_num, comment_ct, "
               "good_comment_ct, CAST(order_amount AS DOUBLE) AS order_amount, "
               "CAST(payment_amount AS DOUBLE) AS payment_amount, "
               "CAST(refund_amount AS DOUBLE) AS refund_amount, order_oid, paid_oid, "
               "refund_oid, ts")

ALL_METRICS = f"""
metrics AS (
  {M_CLICK} UNION ALL {M_DISPLAY} UNION ALL {M_FAVOR} UNION ALL {M_CART}
  UNION ALL {M_ORDER} UNION ALL {M_PAYMENT} UNION ALL {M_REFUND} UNION ALL {M_COMMENT})
"""


def _stt(ts: str) -> str:
    return f"strftime(epoch_ms(({ts} // {WIN}) * {WIN}), '%Y-%m-%d %H:%M:%S')"


def _edt(ts: str) -> str:
    return f"strftime(epoch_ms(({ts} // {WIN}) * {WIN} + {WIN}), '%Y-%m-%d %H:%M:%S')"


PRODUCT_STATS = f"""
pstats0 AS (
  SELECT {_stt('ts')} AS stt, {_edt('ts')} AS edt, sku_id,
    CAST(sum(display_ct) AS BIGINT) AS display_ct, CAST(sum(click_ct) AS BIGINT) AS click_ct,
    CAST(sum(favor_ct) AS BIGINT) AS favor_ct, CAST(sum(cart_ct) AS BIGINT) AS cart_ct,
    CAST(sum(order_sku_num) AS BIGINT) AS order_sku_num,
    CAST(sum(order_amount) AS DECIMAL(16,2)) AS order_amount,
    count(DISTINCT order_oid) AS order_ct,
    CAST(sum(payment_amount) AS DECIMAL(16,2)) AS payment_amount,
    count(DISTINCT paid_oid) AS paid_order_ct, count(DISTINCT refund_oid) AS refund_order_ct,
    CAST(sum(refund_amount) AS DECIMAL(16,2)) AS refund_amount,
    CAST(sum(comment_ct) AS BIGINT) AS comment_ct,
    CAST(sum(good_comment_ct) AS BIGINT) AS good_comment_ct, min(ts) AS ts
  FROM metrics GROUP BY 1, 2, 3),
product_stats AS (
  SELECT a.stt, a.edt, a.sku_id, s.sku_name, s.price AS sku_price, s.spu_id, sp.spu_name,
    s.tm_id, t.tm_name, s.category3_id, c.name AS category3_name, a.display_ct, a.click_ct,
    a.favor_ct, a.cart_ct, a.order_sku_num, a.order_amount, a.order_ct, a.payment_amount,
    a.paid_order_ct, a.refund_order_ct, a.refund_amount, a.comment_ct, a.good_comment_ct, a.ts
  FROM pstats0 a
  LEFT JOIN dim_sku s ON a.sku_id = s.id
  LEFT JOIN dim_spu sp ON s.spu_id = sp.id
  LEFT JOIN dim_cat c ON s.category3_id = c.id
  LEFT JOIN dim_tm t ON s.tm_id = t.id)
"""

GMV_BRAND = """
gmv_brand AS (
  SELECT CAST(strftime(CAST(stt AS TIMESTAMP), '%Y%m%d') AS INTEGER) AS dt, tm_name,
    CAST(sum(order_amount) AS DECIMAL(16,2)) AS order_amount
  FROM product_stats GROUP BY 1, 2),
gmv_ranked AS (
  SELECT *, row_number() OVER (PARTITION BY dt ORDER BY order_amount DESC, tm_name ASC NULLS FIRST)
    AS rk
  FROM gmv_brand)
"""

SEARCH_ROWS = """
search_rows AS (
  SELECT doc_id, text AS full_word,
    epoch_ms(TIMESTAMP '2024-01-01 00:00:00') + doc_id * 1000 AS ts
  FROM documents)
"""

CHANGES = """
user_changes AS (
  SELECT c_custkey, c_name, c_nationkey, c_acctbal,
    CASE WHEN c_custkey % 2 = 0 THEN 'F' ELSE 'M' END AS gender,
    strftime(DATE '1960-01-01' + CAST(c_custkey % 14600 AS INTEGER), '%Y-%m-%d') AS birthday,
    1700000000000 + c_custkey * 10 AS base
  FROM customer),
env AS (
  SELECT base AS seq, 'shop' AS database, 'user_info' AS table_name, 'insert' AS type,
    CAST(NULL AS VARCHAR) AS before_id, CAST(c_custkey AS VARCHAR) AS after_id,
    0 AS before_n, 5 AS after_n, CAST(NULL AS VARCHAR) AS after_status, base AS ts_ms,
    c_name AS after_name, gender, birthday
  FROM user_changes
  UNION ALL
  SELECT base + 5, 'shop', 'user_info', 'update', CAST(c_custkey AS VARCHAR),
    CAST(c_custkey AS VARCHAR), 5, 5, NULL, base + 5, upper(c_name), gender, birthday
  FROM user_changes WHERE c_acctbal < 0
  UNION ALL
  SELECT base + 7, 'shop', 'user_info', 'delete', CAST(c_custkey AS VARCHAR), NULL, 5, 0,
    NULL, base + 7, NULL, gender, birthday
  FROM user_changes WHERE c_acctbal < -500
  UNION ALL
  SELECT epoch_ms(o_orderdate) + o_orderkey, 'shop', 'order_info', 'insert', NULL,
    CAST(o_orderkey AS VARCHAR), 0, 5,
    CASE WHEN o_orderstatus = 'F' THEN 'O' ELSE o_orderstatus END,
    epoch_ms(o_orderdate) + o_orderkey, NULL, NULL, NULL
  FROM orders
  UNION ALL
  SELECT epoch_ms(o_orderdate) + o_orderkey + 60000, 'shop', 'order_info', 'update',
    CAST(o_orderkey AS VARCHAR), CAST(o_orderkey AS VARCHAR), 5, 5, o_orderstatus,
    epoch_ms(o_orderdate) + o_orderkey + 60000, NULL, NULL, NULL
  FROM orders WHERE o_orderstatus = 'F'),
config AS (
  SELECT * FROM (VALUES
    ('user_info', 'insert', 'hbase', 'dim_user_info', 'id,gender,birthday,name'),
    ('user_info', 'update', 'hbase', 'dim_user_info', 'birthday,gender,id,name'),
    ('order_info', 'insert', 'kafka', 'dwd_order_info',
     'create_time,id,order_status,total_amount,user_id'),
    ('payment_info', 'insert', 'clickhouse', 'payment_archive', 'id'))
    AS t(source_table, operate_type, sink_type, sink_table, kept_keys)),
image_keys AS (
  SELECT * FROM (VALUES
    ('user_info', 'birthday,gender,id,name,nation_id'),
    ('order_info', 'create_time,id,order_status,total_amount,user_id'))
    AS t(table_name, all_keys))
"""

ENV_COLS = ("seq, database, table_name, type, before_id, after_id, before_n, after_n, "
            "after_status, ts_ms")


def _with(*ctes: str) -> str:
    return "WITH " + ",".join(c.strip().rstrip(",") for c in ctes) + "\n"


LOG_Q = _with(LOGS)
ORDERS_Q = _with(ORDER_INFO, ORDER_DETAIL, ORDER_JOIN, DIMS)
WIDE_Q = _with(ORDER_INFO, ORDER_DETAIL, ORDER_JOIN, DIMS, ORDER_WIDE)
PAY_Q = _with(ORDER_INFO, ORDER_DETAIL, ORDER_JOIN, DIMS, ORDER_WIDE, PAYMENT_INFO,
              PAYMENT_WIDE)
PRODUCT_Q = _with(LOGS, ORDER_INFO, ORDER_DETAIL, ORDER_JOIN, DIMS, ORDER_WIDE, PAYMENT_INFO,
                  PAYMENT_WIDE, FACTS, ALL_METRICS, PRODUCT_STATS)
ENV_Q = _with(CHANGES)

PAGE_FLAT = ("seq, ar, ba, ch, is_new, md, mid, os, uid, vc, during_time, item, item_type, "
             "last_page_id, page_id, source_type, ts")
VISIT = "seq, mid, is_new, page_id, last_page_id, ts"

UNIQUE_VISIT = f"""
uv AS (
  SELECT * FROM (
    SELECT *, row_number() OVER (PARTITION BY mid, CAST(epoch_ms(ts) AS DATE)
                                 ORDER BY ts, seq) AS rn
    FROM page_rows WHERE is_entry) WHERE rn = 1)
"""


def _jump(times: int) -> str:
    leads = ", ".join(f"lead(ts, {i}) OVER w AS nts{i}, lead(is_entry, {i}) OVER w AS nen{i}"
                      for i in range(1, times))
    case = "CASE"
    for i in range(1, times):
        case += (f" WHEN nts{i} IS NULL OR nts{i} - ts >= {JUMP_WITHIN_MS} THEN TRUE"
                 f" WHEN NOT nen{i} THEN FALSE")
    case += " ELSE TRUE END"
    return f"""
uj{times} AS (
  SELECT * FROM (
    SELECT *, {leads} FROM page_rows
    WINDOW w AS (PARTITION BY mid ORDER BY ts, seq))
  WHERE is_entry AND {case})
"""


VISITOR_ROWS = f"""
vrows AS (
  SELECT vc, ch, ar, is_new, 1 AS uv_ct, 0 AS pv_ct, 0 AS sv_ct, 0 AS uj_ct, 0 AS dur_sum, ts
  FROM uv
  UNION ALL
  SELECT vc, ch, ar, is_new, 0, 0, 0, 1, 0, ts FROM uj2
  UNION ALL
  SELECT vc, ch, ar, is_new, 0, 1, CASE WHEN is_entry THEN 1 ELSE 0 END, 0,
    coalesce(during_time, 0), ts
  FROM page_rows)
"""
VROW_COLS = ("vc, ch, ar, is_new, CAST(uv_ct AS BIGINT) AS uv_ct, CAST(pv_ct AS BIGINT) AS pv_ct, "
             "CAST(sv_ct AS BIGINT) AS sv_ct, CAST(uj_ct AS BIGINT) AS uj_ct, "
             "CAST(dur_sum AS BIGINT) AS dur_sum, ts")

ROUTED = """
routed AS (
  SELECT e.seq, e.table_name, e.type, c.sink_type, c.sink_table, e.after_id,
    c.kept_keys, i.all_keys
  FROM env e JOIN config c ON e.table_name = c.source_table AND e.type = c.operate_type
  JOIN image_keys i ON e.table_name = i.table_name
  WHERE e.type IS DISTINCT FROM 'delete')
"""


def _sorted_keys(expr: str) -> str:
    return f"array_to_string(list_sort(string_split({expr}, ',')), ',')"


def _kept_keys() -> str:
    """Keys of the image that are listed in the config (sorted, comma-joined)."""
    return ("array_to_string(list_sort(list_filter(string_split(all_keys, ','), "
            "lambda x: list_contains(string_split(kept_keys, ','), x))), ',')")


SQL: dict[str, str] = {
    "log_parse_dirty": "SELECT 1000000000000 + page_id AS seq, html AS value FROM pages",
    "log_split_start": LOG_Q + """
SELECT seq, mid, uid, ar, ch, vc, is_new,
  to_json({'entry': 'icon', 'loading_time': during_time, 'open_ad_id': k,
           'open_ad_ms': 0, 'open_ad_skip_ms': 0})::VARCHAR AS start, ts
FROM logs WHERE event_type = 'error'""",
    "log_split_page": LOG_Q + f"SELECT {PAGE_FLAT} FROM page_rows",
    "log_split_display": LOG_Q + """
SELECT 'promotion' AS display_type, CAST(k AS VARCHAR) AS item, 'sku_id' AS item_type,
  1 AS "order", CAST(k % 5 + 1 AS INTEGER) AS pos_id, page_id
FROM page_rows WHERE event_type = 'view'
UNION ALL
SELECT 'activity', CAST(user_id % 3 + 1 AS VARCHAR), 'activity_id', 2, 1, page_id
FROM page_rows WHERE event_type = 'view'""",
    "is_new_repair": LOG_Q + "SELECT seq, mid, ts, is_new_raw, is_new FROM logs",
    "is_entry_page": LOG_Q + "SELECT seq, mid, page_id, is_entry FROM page_rows",
    "unique_visit": _with(LOGS, UNIQUE_VISIT) + f"SELECT {VISIT} FROM uv",
    "jump_detail": _with(LOGS, _jump(2)) + f"SELECT {VISIT} FROM uj2",
    "jump_detail_looped": _with(LOGS, _jump(3)) + f"SELECT {VISIT} FROM uj3",
    "visitor_uv_metric": _with(LOGS, UNIQUE_VISIT) + f"""
SELECT vc, ch, ar, is_new, CAST(1 AS BIGINT) AS uv_ct, CAST(0 AS BIGINT) AS pv_ct,
  CAST(0 AS BIGINT) AS sv_ct, CAST(0 AS BIGINT) AS uj_ct, CAST(0 AS BIGINT) AS dur_sum, ts
FROM uv""",
    "visitor_uj_metric": _with(LOGS, _jump(2)) + """
SELECT vc, ch, ar, is_new, CAST(0 AS BIGINT) AS uv_ct, CAST(0 AS BIGINT) AS pv_ct,
  CAST(0 AS BIGINT) AS sv_ct, CAST(1 AS BIGINT) AS uj_ct, CAST(0 AS BIGINT) AS dur_sum, ts
FROM uj2""",
    "visitor_pv_metric": LOG_Q + """
SELECT vc, ch, ar, is_new, CAST(0 AS BIGINT) AS uv_ct, CAST(1 AS BIGINT) AS pv_ct,
  CAST(CASE WHEN is_entry THEN 1 ELSE 0 END AS BIGINT) AS sv_ct, CAST(0 AS BIGINT) AS uj_ct,
  CAST(coalesce(during_time, 0) AS BIGINT) AS dur_sum, ts
FROM page_rows""",
    "union_visitor": _with(LOGS, UNIQUE_VISIT, _jump(2), VISITOR_ROWS)
    + f"SELECT {VROW_COLS} FROM vrows",
    "visitor_stats": _with(LOGS, UNIQUE_VISIT, _jump(2), VISITOR_ROWS) + f"""
SELECT {_stt('ts')} AS stt, {_edt('ts')} AS edt, vc, ch, ar, is_new,
  CAST(sum(uv_ct) AS BIGINT) AS uv_ct, CAST(sum(pv_ct) AS BIGINT) AS pv_ct,
  CAST(sum(sv_ct) AS BIGINT) AS sv_ct, CAST(sum(uj_ct) AS BIGINT) AS uj_ct,
  CAST(sum(dur_sum) AS BIGINT) AS dur_sum, min(ts) AS ts
FROM vrows GROUP BY 1, 2, 3, 4, 5, 6""",
    "tumbling_10s": f"""
SELECT {_stt('(epoch_us(ts) // 1000)')} AS stt, {_edt('(epoch_us(ts) // 1000)')} AS edt, count(*) AS ct
FROM events GROUP BY 1, 2""",
    "src_topic_table": LOG_Q + """
SELECT mid, page_id, last_page_id, ts,
  strftime(epoch_ms((ts // 1000) * 1000), '%Y-%m-%d %H:%M:%S') AS rt
FROM page_rows""",
    "src_csv_lines": """
SELECT CAST(user_id AS VARCHAR) AS id, event_type AS name,
  CAST(epoch_us(ts) // 1000000 AS VARCHAR) AS ts
FROM events""",
    "src_dim_table": _with(DIMS) + """
SELECT CAST(id AS VARCHAR) AS "ID", sku_name AS "SKU_NAME", CAST(price AS VARCHAR) AS "PRICE",
  CAST(category3_id AS VARCHAR) AS "CATEGORY3_ID", CAST(spu_id AS VARCHAR) AS "SPU_ID",
  CAST(tm_id AS VARCHAR) AS "TM_ID"
FROM dim_sku""",
    "snake_to_camel": _with(DIMS) + """
SELECT CAST(id AS VARCHAR) AS id, sku_name AS "skuName", CAST(price AS VARCHAR) AS price,
  CAST(category3_id AS VARCHAR) AS "category3Id", CAST(spu_id AS VARCHAR) AS "spuId",
  CAST(tm_id AS VARCHAR) AS "tmId"
FROM dim_sku""",
    "user_age": _with(DIMS) + f"""
SELECT CAST(id AS VARCHAR) AS "ID", birthday AS "BIRTHDAY",
  CAST(floor(datediff('day', CAST(birthday AS DATE), DATE '{AGE_AS_OF}') / 365) AS INTEGER)
    AS age
FROM dim_user""",
    "dictionary_segments": f"""
WITH words AS (
  SELECT DISTINCT word FROM (SELECT unnest(regexp_extract_all(lower(text), '{WORD_RE}')) AS word FROM benchmark) WHERE length(word) >= 5),
sizes AS (SELECT DISTINCT length(word) AS n FROM words),
places AS (
  SELECT doc_id, lower(text) AS t, n, unnest(range(1, length(text) - n + 2)) AS i FROM documents, sizes WHERE length(text) >= n)
SELECT word, count(*) AS n, count(DISTINCT doc_id) AS docs
FROM (SELECT doc_id, substr(t, i, n) AS piece FROM places) JOIN words ON word = piece GROUP BY word""",
    "order_sketches": ORDERS_Q + """
SELECT strftime(CAST(create_time AS TIMESTAMP), '%Y-%m-%d') AS dt, count(DISTINCT order_id) AS exact_ct, TRUE AS within_bound
FROM od_join GROUP BY 1""",
    "order_time_parts": _with(ORDER_INFO) + """
SELECT id, create_time, create_date, create_hour, epoch_ms(ort) AS create_ts FROM order_info""",
    "order_interval_join": ORDERS_Q + """
SELECT order_id, sku_id, create_time AS order_time, detail_time,
  CAST(split_total_amount AS DOUBLE) AS split_total_amount
FROM od_join""",
    "order_wide_coalesce": ORDERS_Q + """,
full_rows AS (SELECT concat_ws('/', order_id, detail_time, sku_id, order_price, sku_num, split_activity_amount) AS detail_id, order_id, sku_id, create_time, CAST(total_amount AS DOUBLE) AS total_amount,
                CAST(split_total_amount AS DOUBLE) AS split_total_amount FROM od_join),
part_rows AS (SELECT detail_id, order_id, sku_id, create_time, CASE WHEN sku_id % 2 = 0 THEN total_amount END AS total_amount,
                CASE WHEN sku_id % 2 = 0 THEN split_total_amount END AS split_total_amount FROM full_rows),
one AS (SELECT detail_id, min(order_id) AS order_id, min(sku_id) AS sku_id, min(create_time) AS create_time,
          min(total_amount) AS total_amount FROM full_rows GROUP BY detail_id)
SELECT coalesce(a.order_id, b.order_id) AS order_id, coalesce(a.sku_id, b.sku_id) AS sku_id,
  coalesce(a.create_time, b.create_time) AS create_time, coalesce(a.total_amount, b.total_amount) AS total_amount,
  a.split_total_amount
FROM part_rows a LEFT JOIN one b ON a.detail_id = b.detail_id""",
    "dim_table_schema": ENV_Q + """,
users AS (SELECT * FROM env WHERE table_name = 'user_info' AND type IN ('insert', 'update'))
SELECT sink_table, position, name, type, is_key, extend, n_changes, n_values
FROM (VALUES
  ('dim_user_info', 1, 'ID', 'string', TRUE, ''), ('dim_user_info', 2, 'NAME', 'string', FALSE, ''),
  ('dim_user_info', 3, 'GENDER', 'string', FALSE, ''), ('dim_user_info', 4, 'BIRTHDAY', 'string', FALSE, ''))
  AS t(sink_table, position, name, type, is_key, extend)
JOIN (SELECT 'ID' AS col, count(*) AS n_changes, count(after_id) AS n_values FROM users
      UNION ALL SELECT 'NAME', count(*), count(after_name) FROM users
      UNION ALL SELECT 'GENDER', count(*), count(gender) FROM users
      UNION ALL SELECT 'BIRTHDAY', count(*), count(birthday) FROM users) n ON n.col = t.name""",
    "src_change_log_snapshot": """
SELECT table_name, pk, last_type, n_keys, order_status FROM (
  SELECT 'order_info' AS table_name, CAST(o_orderkey AS VARCHAR) AS pk,
    CASE WHEN o_orderstatus = 'F' THEN 'update' ELSE 'read' END AS last_type, 5 AS n_keys,
    o_orderstatus AS order_status
  FROM orders)""",
    "sink_topic_per_row": ENV_Q + """
SELECT 'dwd_order_info' AS topic, after_id,
  '{"id":"' || after_id || '","user_id":"' || o_custkey || '","order_status":"' || after_status || '"}' AS image
FROM env JOIN orders ON after_id = CAST(o_orderkey AS VARCHAR)
WHERE table_name = 'order_info' AND type = 'insert'""",
    "dim_upsert_existing": ENV_Q + """
SELECT CAST(c_custkey AS VARCHAR) AS "ID", CASE WHEN c_acctbal < 0 THEN upper(c_name) ELSE c_name END AS "NAME",
  CASE WHEN c_custkey % 2 = 0 THEN 'F' ELSE 'M' END AS "GENDER",
  strftime(DATE '1960-01-01' + CAST(c_custkey % 14600 AS INTEGER), '%Y-%m-%d') AS "BIRTHDAY"
FROM customer""",
    "order_wide_merge": ORDERS_Q + """
SELECT order_id, sku_id, CAST(order_price AS DOUBLE) AS order_price, sku_num, sku_name,
  province_id, order_status, user_id, CAST(total_amount AS DOUBLE) AS total_amount,
  CAST(activity_reduce_amount AS DOUBLE) AS activity_reduce_amount,
  CAST(coupon_reduce_amount AS DOUBLE) AS coupon_reduce_amount,
  CAST(original_total_amount AS DOUBLE) AS original_total_amount,
  CAST(feight_fee AS DOUBLE) AS feight_fee, CAST(split_feight_fee AS DOUBLE) AS split_feight_fee,
  CAST(split_activity_amount AS DOUBLE) AS split_activity_amount,
  CAST(split_coupon_amount AS DOUBLE) AS split_coupon_amount,
  CAST(split_total_amount AS DOUBLE) AS split_total_amount, expire_time, create_time,
  operate_time, create_date, create_hour
FROM od_join""",
    "dim_user": WIDE_Q + "SELECT order_id, sku_id, user_id, user_gender, user_age FROM order_wide",
    "dim_province": WIDE_Q + """
SELECT order_id, sku_id, province_id, province_name, province_area_code, province_iso_code,
  province_3166_2_code FROM order_wide""",
    "dim_sku": WIDE_Q + """
SELECT order_id, sku_id, sku_name, spu_id, tm_id, category3_id FROM order_wide""",
    "dim_spu": WIDE_Q + "SELECT order_id, sku_id, spu_id, spu_name FROM order_wide",
    "dim_tm": WIDE_Q + "SELECT order_id, sku_id, tm_id, tm_name FROM order_wide",
    "dim_category3": WIDE_Q + """
SELECT order_id, sku_id, category3_id, category3_name FROM order_wide""",
    "order_wide": WIDE_Q + """
SELECT * REPLACE (CAST(order_price AS DOUBLE) AS order_price,
  CAST(total_amount AS DOUBLE) AS total_amount,
  CAST(activity_reduce_amount AS DOUBLE) AS activity_reduce_amount,
  CAST(coupon_reduce_amount AS DOUBLE) AS coupon_reduce_amount,
  CAST(original_total_amount AS DOUBLE) AS original_total_amount,
  CAST(feight_fee AS DOUBLE) AS feight_fee, CAST(split_feight_fee AS DOUBLE) AS split_feight_fee,
  CAST(split_activity_amount AS DOUBLE) AS split_activity_amount,
  CAST(split_coupon_amount AS DOUBLE) AS split_coupon_amount,
  CAST(split_total_amount AS DOUBLE) AS split_total_amount)
FROM order_wide""",
    "payment_interval_join": PAY_Q + """
SELECT p.id AS payment_id, j.order_id, j.sku_id, p.create_time AS payment_time,
  j.create_time AS order_time
FROM payment_info p JOIN od_join j ON p.order_id = j.order_id
 AND CAST(j.create_time AS TIMESTAMP) >= p.prt - INTERVAL 15 MINUTE
 AND CAST(j.create_time AS TIMESTAMP) <= p.prt + INTERVAL 5 SECOND""",
    "payment_wide": PAY_Q + """
SELECT * REPLACE (CAST(order_price AS DOUBLE) AS order_price,
  CAST(total_amount AS DOUBLE) AS total_amount,
  CAST(activity_reduce_amount AS DOUBLE) AS activity_reduce_amount,
  CAST(coupon_reduce_amount AS DOUBLE) AS coupon_reduce_amount,
  CAST(original_total_amount AS DOUBLE) AS original_total_amount,
  CAST(feight_fee AS DOUBLE) AS feight_fee, CAST(split_feight_fee AS DOUBLE) AS split_feight_fee,
  CAST(split_activity_amount AS DOUBLE) AS split_activity_amount,
  CAST(split_coupon_amount AS DOUBLE) AS split_coupon_amount,
  CAST(split_total_amount AS DOUBLE) AS split_total_amount)
FROM payment_wide""",
    "csv_interval_join": f"""
WITH a AS (SELECT user_id AS id, event_type AS name, epoch_us(ts) // 1000000 AS ts
           FROM events),
     b AS (SELECT user_id AS id, CASE WHEN user_id % 2 = 0 THEN 'F' ELSE 'M' END AS sex,
                  epoch_us(ts) // 1000000 AS ts
           FROM events)
SELECT a.id, a.name, a.ts, b.sex, b.ts AS ts2
FROM a JOIN b ON a.id = b.id AND b.ts BETWEEN a.ts - {CSV_BAND_S} AND a.ts + {CSV_BAND_S}""",
    "cdc_normalize": ENV_Q + f"SELECT {ENV_COLS} FROM env",
    "cdc_drop_deletes": ENV_Q + f"SELECT {ENV_COLS} FROM env WHERE type <> 'delete'",
    "cdc_current_image": ENV_Q + """
SELECT table_name, pk, last_type, n_keys, order_status, name, ts_ms FROM (
  SELECT table_name, coalesce(after_id, before_id) AS pk, type AS last_type,
    after_n AS n_keys, after_status AS order_status, after_name AS name, ts_ms,
    row_number() OVER (PARTITION BY table_name, coalesce(after_id, before_id)
                       ORDER BY ts_ms DESC, seq DESC) AS rn
  FROM env) WHERE rn = 1 AND last_type <> 'delete'""",
    "retract_rows": ENV_Q + """
SELECT seq, table_name, type, FALSE AS is_add, before_id AS id, before_n AS n_keys,
  CASE WHEN type = 'update' AND table_name = 'order_info' THEN 'O' END AS order_status
FROM env WHERE before_n > 0
UNION ALL
SELECT seq, table_name, type, TRUE, after_id, after_n, after_status
FROM env WHERE after_n > 0""",
    "route_join": _with(CHANGES, ROUTED) + f"""
SELECT seq, table_name, type, sink_type, sink_table, after_id,
  CAST(len(string_split(all_keys, ',')) AS INTEGER) AS after_n,
  {_sorted_keys('all_keys')} AS after_keys
FROM routed""",
    "route_columns": _with(CHANGES, ROUTED) + f"""
SELECT seq, table_name, type, sink_type, sink_table, after_id,
  CAST(len(string_split({_kept_keys()}, ',')) AS INTEGER) AS after_n,
  {_kept_keys()} AS after_keys
FROM routed""",
    "route_sink_type": _with(CHANGES, ROUTED) + f"""
SELECT seq, table_name, type, sink_type, sink_table, after_id,
  CAST(len(string_split({_kept_keys()}, ',')) AS INTEGER) AS after_n,
  {_kept_keys()} AS after_keys
FROM routed WHERE sink_type = 'kafka'""",
    "route_unmatched": ENV_Q + f"""
SELECT {ENV_COLS} FROM env e
WHERE type <> 'delete'
  AND NOT EXISTS (SELECT 1 FROM config c WHERE c.source_table = e.table_name
                                           AND c.operate_type = e.type)""",
    "sink_dim_upsert": ENV_Q + """
SELECT after_id AS "ID", arg_max(after_name, ts_ms) AS "NAME",
  arg_max(gender, ts_ms) AS "GENDER", arg_max(birthday, ts_ms) AS "BIRTHDAY"
FROM env WHERE table_name = 'user_info' AND type IN ('insert', 'update')
GROUP BY after_id""",
    "page_click_metric": _with(LOGS) + f"SELECT {METRIC_COLS} FROM ({M_CLICK})",
    "page_display_metric": _with(LOGS) + f"SELECT {METRIC_COLS} FROM ({M_DISPLAY})",
    "favor_metric": _with(FACTS) + f"SELECT {METRIC_COLS} FROM ({M_FAVOR})",
    "cart_metric": _with(FACTS) + f"SELECT {METRIC_COLS} FROM ({M_CART})",
    "refund_metric": _with(FACTS) + f"SELECT {METRIC_COLS} FROM ({M_REFUND})",
    "comment_metric": _with(FACTS) + f"SELECT {METRIC_COLS} FROM ({M_COMMENT})",
    "order_metric": WIDE_Q + f"SELECT {METRIC_COLS} FROM ({M_ORDER})",
    "payment_metric": PAY_Q + f"SELECT {METRIC_COLS} FROM ({M_PAYMENT})",
    "union_product": _with(LOGS, ORDER_INFO, ORDER_DETAIL, ORDER_JOIN, DIMS, ORDER_WIDE,
                           PAYMENT_INFO, PAYMENT_WIDE, FACTS, ALL_METRICS)
    + f"SELECT {METRIC_COLS} FROM metrics",
    "product_stats": PRODUCT_Q + """
SELECT * REPLACE (CAST(sku_price AS DOUBLE) AS sku_price,
  CAST(order_amount AS DOUBLE) AS order_amount, CAST(payment_amount AS DOUBLE) AS payment_amount,
  CAST(refund_amount AS DOUBLE) AS refund_amount)
FROM product_stats""",
    "province_from_order": WIDE_Q + """
SELECT province_id, province_name, province_area_code, province_iso_code, province_3166_2_code,
  CAST(split_total_amount AS DOUBLE) AS order_amount, CAST(1 AS BIGINT) AS order_count,
  order_id, create_time
FROM order_wide""",
    "province_stats": WIDE_Q + f"""
SELECT {_stt('epoch_ms(CAST(create_time AS TIMESTAMP))')} AS stt,
  {_edt('epoch_ms(CAST(create_time AS TIMESTAMP))')} AS edt,
  province_id, province_name, province_area_code, province_iso_code, province_3166_2_code,
  CAST(CAST(sum(split_total_amount) AS DECIMAL(16,2)) AS DOUBLE) AS order_amount,
  count(DISTINCT order_id) AS order_count,
  (epoch_ms(CAST(create_time AS TIMESTAMP)) // {WIN}) * {WIN} + {WIN} AS ts
FROM order_wide GROUP BY 1, 2, 3, 4, 5, 6, 7, 10""",
    "search_term_filter": _with(SEARCH_ROWS) + """
SELECT sha256(full_word) AS term_sha256, CAST(length(full_word) AS INTEGER) AS term_len,
  strftime(epoch_ms((ts // 1000) * 1000), '%Y-%m-%d %H:%M:%S') AS rt
FROM search_rows WHERE full_word IS NOT NULL""",
    "split_words_lateral": _with(SEARCH_ROWS) + """
SELECT word, strftime(epoch_ms((ts // 1000) * 1000), '%Y-%m-%d %H:%M:%S') AS rt
FROM (SELECT unnest(regexp_extract_all(lower(full_word), '[\\p{L}\\p{N}]+')) AS word, ts
      FROM search_rows WHERE full_word IS NOT NULL)""",
    "split_words": """
SELECT word, count(*) AS n, count(DISTINCT doc_id) AS docs
FROM (SELECT doc_id, unnest(regexp_extract_all(lower(text), '[\\p{L}\\p{N}]+')) AS word
      FROM documents)
GROUP BY word""",
    "keyword_stats": _with(SEARCH_ROWS) + f"""
SELECT word AS keyword, count(*) AS ct, 'search' AS source,
  {_stt('(ts // 1000) * 1000')} AS stt, {_edt('(ts // 1000) * 1000')} AS edt,
  ((ts // 1000) * 1000 // {WIN}) * {WIN} + {WIN} AS ts
FROM (SELECT unnest(regexp_extract_all(lower(full_word), '{WORD_RE}')) AS word, ts
      FROM search_rows WHERE full_word IS NOT NULL)
GROUP BY word, 4, 5, 6""",
    "gmv_total": PRODUCT_Q + """
SELECT CAST(strftime(CAST(stt AS TIMESTAMP), '%Y%m%d') AS INTEGER) AS dt,
  CAST(CAST(sum(order_amount) AS DECIMAL(16,2)) AS DOUBLE) AS order_amount
FROM product_stats GROUP BY 1""",
    "gmv_by_brand": _with(PRODUCT_Q[5:], GMV_BRAND) + """
SELECT dt, tm_name, CAST(order_amount AS DOUBLE) AS order_amount, CAST(rk AS INTEGER) AS rk
FROM gmv_ranked WHERE rk <= 5""",
    "gmv_by_brand_series": _with(PRODUCT_Q[5:], GMV_BRAND) + """
SELECT dt, string_agg(coalesce(tm_name, ''), '|' ORDER BY rk) AS categories,
  string_agg(printf('%.2f', order_amount), '|' ORDER BY rk) AS data
FROM gmv_ranked WHERE rk <= 5 GROUP BY dt""",
    "code_labels": _with(FACTS) + """
SELECT id, CASE WHEN value >= 20 THEN '1201' WHEN value >= 5 THEN '1202' ELSE '1203' END
    AS appraise,
  CASE WHEN value >= 20 THEN 'good' WHEN value >= 5 THEN 'neutral' ELSE 'bad' END
    AS appraise_name
FROM comment_info""",
}

SEGMENT_RE = r"\p{Han}+|(?:[^\P{L}\p{Han}]|[^\P{N}\p{Han}])+"

RAW_LOG = LOG_Q + """
SELECT seq,
  '{"common":{"ar":"' || ar || '","ba":"Kestrel","ch":"' || ch || '","is_new":"' || is_new_raw
  || '","md":"Kestrel K2","mid":"' || mid || '","os":"TinyOS 4","uid":"' || uid
  || '","vc":"' || vc || '"}'
  || CASE WHEN event_type <> 'error' THEN
       ',"page":{"during_time":' || CAST(during_time AS VARCHAR)
       || coalesce(',"item":"' || item || '"', '')
       || coalesce(',"item_type":"' || item_type || '"', '')
       || coalesce(',"last_page_id":"' || last_page_id || '"', '')
       || ',"page_id":"' || page_id || '"}' ELSE '' END
  || CASE WHEN event_type = 'view' THEN
       ',"displays":[{"display_type":"promotion","item":"' || CAST(k AS VARCHAR)
       || '","item_type":"sku_id","order":1,"pos_id":' || CAST(k % 5 + 1 AS VARCHAR)
       || '},{"display_type":"activity","item":"' || CAST(user_id % 3 + 1 AS VARCHAR)
       || '","item_type":"activity_id","order":2,"pos_id":1}]' ELSE '' END
  || CASE WHEN event_type = 'error' THEN
       ',"start":{"entry":"icon","loading_time":' || CAST(during_time AS VARCHAR)
       || ',"open_ad_id":' || CAST(k AS VARCHAR) || ',"open_ad_ms":0,"open_ad_skip_ms":0}'
     ELSE '' END
  || ',"ts":' || CAST(ts AS VARCHAR) || '}' AS value
FROM logs
UNION ALL
SELECT 1000000000000 + page_id, html FROM pages"""

SQL["src_raw_log"] = RAW_LOG
SQL["word_segments"] = f"""
SELECT word, count(*) AS n FROM (
  SELECT unnest(CASE WHEN regexp_full_match(run, '\\p{{Han}}+') AND length(run) > 1
                     THEN [substr(run, i, 2) for i in range(1, length(run))]
                     ELSE [run] END) AS word
  FROM (SELECT unnest(regexp_extract_all(lower(text), '{SEGMENT_RE}')) AS run
        FROM documents))
GROUP BY word"""

SQL["keyword_stats_sql"] = SQL["keyword_stats"]
SQL["province_stats_sql"] = SQL["province_stats"]
