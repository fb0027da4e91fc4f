"""DuckDB oracle SQL for every registered query.

The oracle repeats the adapter recipes of ``sources/driver_tables.py`` in SQL over the
driver's views and computes each result the straightforward way (plain windows), so it
checks the Spark plans independently. Shared CTE fragments live here as text.
"""

from __future__ import annotations

ORACLE: dict[str, str] = {}


def win(ms_expr: str, length_ms: int) -> str:
    """stt, edt text of the tumbling window containing epoch-ms ``ms_expr``."""
    start = f"(({ms_expr}) // {length_ms}) * {length_ms}"
    return (f"strftime(epoch_ms({start}), '%Y-%m-%d %H:%M:%S') AS stt, "
            f"strftime(epoch_ms({start} + {length_ms}), '%Y-%m-%d %H:%M:%S') AS edt")


def day(ms_expr: str) -> str:
    return f"strftime(epoch_ms({ms_expr}), '%Y-%m-%d')"


# ---------------------------------------------------------------- click log

EV = """ev AS (
  SELECT event_id, epoch_us(ts) // 1000 AS ts_ms, user_id, event_type, value,
         CAST(props->>'$.k' AS INTEGER) AS k
  FROM events)"""

CLOG = EV + """,
clog AS (
  SELECT event_id AS "offset", ts_ms AS ts, k, event_type,
    CAST(user_id AS VARCHAR) AS mid,
    CASE WHEN k % 5 = 0 THEN NULL ELSE CAST(user_id AS VARCHAR) END AS uid,
    CASE WHEN k % 3 = 0 THEN '1' ELSE '0' END AS is_new_raw,
    'v' || CAST(k % 3 AS VARCHAR) AS vc,
    'ch' || CAST(k % 4 AS VARCHAR) AS ch,
    CAST(k % 7 AS VARCHAR) AS ar,
    (k % 10 = 7) AS is_start,
    CASE event_type WHEN 'view' THEN 'home' WHEN 'click' THEN 'good_detail'
      WHEN 'purchase' THEN 'payment' WHEN 'signup' THEN 'login' WHEN 'error' THEN 'search'
    END AS page_id,
    CASE WHEN k < 40 THEN NULL WHEN k >= 90 THEN 'search' ELSE 'home' END AS last_page_id,
    CAST(floor(value * 10) AS BIGINT) AS during_time,
    CASE WHEN event_type = 'error' AND k % 2 = 0 THEN CAST(1000 + k AS BIGINT) END AS error_code,
    CASE WHEN event_type = 'error' AND k % 2 = 0 THEN 'error ' || CAST(k AS VARCHAR) END AS msg
  FROM ev
  WHERE NOT (k = 13 OR k = 14 OR (k = 15 AND event_type = 'view'))),
anchor AS (
  SELECT mid, CASE WHEN is_new_raw = '1' THEN """ + day("ts") + """
                   ELSE """ + day("ts - 86400000") + """ END AS anchor_dt
  FROM (SELECT *, row_number() OVER (PARTITION BY mid ORDER BY ts, "offset") AS rn FROM clog)
  WHERE rn = 1),
flog AS (
  SELECT c.*, CASE WHEN c.is_new_raw = '1' AND """ + day("c.ts") + """ <> a.anchor_dt
                   THEN '0' ELSE c.is_new_raw END AS is_new,
         """ + day("c.ts") + """ AS dt
  FROM clog c LEFT JOIN anchor a ON c.mid = a.mid),
plog AS (SELECT * FROM flog WHERE NOT is_start)"""


def with_clog(body: str) -> str:
    return "WITH " + CLOG + "\n" + body


ORACLE["split_dirty"] = "WITH " + EV + """
SELECT CASE WHEN dirty THEN 'dirty' ELSE 'clean' END AS kind, event_id AS "offset",
       CASE WHEN dirty THEN NULL ELSE CAST(user_id AS VARCHAR) END AS mid,
       CASE WHEN dirty THEN NULL ELSE ts_ms END AS ts,
       CASE WHEN k = 13 THEN '{"common":{"mid":"' || CAST(user_id AS VARCHAR)
            WHEN k = 14 THEN ''
            WHEN dirty THEN '[' || CAST(event_id AS VARCHAR) || ']' END AS raw
FROM (SELECT *, (k = 13 OR k = 14 OR (k = 15 AND event_type = 'view')) AS dirty FROM ev)"""

ORACLE["fan_out_page"] = with_clog("""
SELECT "offset", ts, mid, uid, is_new, vc, ch, ar, page_id, last_page_id, during_time,
       error_code FROM plog""")

ORACLE["fan_out_start"] = with_clog("""
SELECT "offset", ts, mid, is_new, CASE WHEN k % 2 = 0 THEN 'icon' ELSE 'notice' END AS entry,
       CAST(k * 100 AS BIGINT) AS loading_time, CAST(k % 4 AS VARCHAR) AS open_ad_id,
       error_code
FROM flog WHERE is_start""")

ORACLE["fan_out_error"] = with_clog("""
SELECT "offset", ts, mid, error_code, msg FROM flog WHERE error_code IS NOT NULL""")

ORACLE["explode_displays"] = with_clog("""
SELECT mid, page_id, ts, CASE WHEN i = 0 THEN 'promotion' ELSE 'query' END AS display_type,
       CAST("offset" * 10 + i AS VARCHAR) AS item, 'sku_id' AS item_type,
       CAST(i + 1 AS BIGINT) AS "order", CAST((k + i) % 5 AS BIGINT) AS pos_id
FROM (SELECT *, unnest(range(k % 3)) AS i FROM plog WHERE page_id IN ('home', 'good_detail'))""")

ORACLE["explode_actions"] = with_clog("""
SELECT mid, page_id, ts, 'favor_add' AS action_id, CAST("offset" AS VARCHAR) AS item,
       'sku_id' AS item_type
FROM plog WHERE page_id = 'good_detail' AND k % 2 = 1""")

ORACLE["fix_new_flag"] = with_clog("""
SELECT "offset", mid, ts, is_new, is_new_raw FROM flog""")

# ---------------------------------------------------------------- visitors

ORACLE["session_starts"] = with_clog("""
SELECT "offset", mid, ts, page_id FROM plog WHERE last_page_id IS NULL""")

UV = """uvr AS (
  SELECT * FROM (
    SELECT *, row_number() OVER (PARTITION BY mid, dt ORDER BY ts, "offset") AS rn
    FROM plog WHERE last_page_id IS NULL) WHERE rn = 1)"""

ORACLE["daily_unique_visitor"] = with_clog(", " + UV + """
SELECT "offset", mid, ts, is_new FROM uvr""")


def jump_sql(within_ms: int) -> str:
    return with_clog(""",
nx AS (
  SELECT *, lead(ts) OVER w AS nts, lead(last_page_id) OVER w AS nlp,
         lead(1) OVER w AS nex
  FROM plog WINDOW w AS (PARTITION BY mid ORDER BY ts, "offset"))
SELECT "offset", mid, ts FROM nx
WHERE last_page_id IS NULL
  AND NOT (nex IS NOT NULL AND nts - ts < """ + str(within_ms) + """ AND nlp IS NOT NULL)""")


ORACLE["user_jump"] = jump_sql(10_000)
ORACLE["user_jump_10m"] = jump_sql(600_000)

PDU = """pdu AS (
  SELECT *, CAST(page_id = 'home' AS BIGINT) AS home_uv_ct,
         CAST(page_id = 'good_detail' AS BIGINT) AS good_detail_uv_ct
  FROM (SELECT *, row_number() OVER (PARTITION BY mid, page_id, dt ORDER BY ts, "offset") AS rn
        FROM plog WHERE page_id IN ('home', 'good_detail')) WHERE rn = 1)"""

ORACLE["page_daily_unique"] = with_clog(", " + PDU + """
SELECT "offset", mid, ts, home_uv_ct, good_detail_uv_ct FROM pdu""")

LOGIN = """lg AS (
  SELECT "offset", uid, ts, dt, CAST(1 AS BIGINT) AS uu_ct,
         CAST(CASE WHEN prev_dt IS NOT NULL
                    AND date_diff('day', CAST(prev_dt AS DATE), CAST(dt AS DATE)) >= 8
              THEN 1 ELSE 0 END AS BIGINT) AS back_ct
  FROM (SELECT *, lag(dt) OVER (PARTITION BY uid ORDER BY dt) AS prev_dt
        FROM (SELECT *, row_number() OVER (PARTITION BY uid, dt ORDER BY ts, "offset") AS rn
              FROM plog WHERE uid IS NOT NULL AND last_page_id IS NULL) WHERE rn = 1))"""

ORACLE["login_unique_and_back"] = with_clog(", " + LOGIN + """
SELECT * FROM lg""")

# ---------------------------------------------------------------- traffic metrics


def channel_sql(length_ms: int) -> str:
    return with_clog(", " + UV + """,
nx AS (
  SELECT *, lead(ts) OVER w AS nts, lead(last_page_id) OVER w AS nlp,
         lead(1) OVER w AS nex
  FROM plog WINDOW w AS (PARTITION BY mid ORDER BY ts, "offset")),
r AS (
  SELECT ts, vc, ch, ar, is_new, 0 AS uv, CAST(last_page_id IS NULL AS BIGINT) AS sv, 1 AS pv,
         during_time AS dur,
         CAST(last_page_id IS NULL AND NOT (nex IS NOT NULL AND nts - ts < 10000
                                            AND nlp IS NOT NULL) AS BIGINT) AS uj
  FROM nx
  UNION ALL
  SELECT ts, vc, ch, ar, is_new, 1, 0, 0, 0, 0 FROM uvr)
SELECT """ + win("ts", length_ms) + """, vc, ch, ar, is_new,
       CAST(sum(uv) AS BIGINT) AS uv_ct, CAST(sum(sv) AS BIGINT) AS sv_ct,
       CAST(sum(pv) AS BIGINT) AS pv_ct, CAST(coalesce(sum(dur), 0) AS BIGINT) AS dur_sum,
       CAST(sum(uj) AS BIGINT) AS uj_ct
FROM r GROUP BY ALL""")


ORACLE["channel_metrics"] = channel_sql(10_000)
ORACLE["channel_metrics_1h"] = channel_sql(3_600_000)

ORACLE["page_uv_metrics"] = with_clog(", " + PDU + """
SELECT """ + win("ts", 10_000) + """, CAST(sum(home_uv_ct) AS BIGINT) AS home_uv_ct,
       CAST(sum(good_detail_uv_ct) AS BIGINT) AS good_detail_uv_ct
FROM pdu GROUP BY ALL""")

ORACLE["login_metrics"] = with_clog(", " + LOGIN + """
SELECT """ + win("ts", 10_000) + """, CAST(sum(back_ct) AS BIGINT) AS back_ct,
       CAST(sum(uu_ct) AS BIGINT) AS uu_ct
FROM lg GROUP BY ALL""")

SEARCH = """srch AS (
  SELECT p."offset", p.ts, d.text AS item
  FROM plog p JOIN documents d ON p."offset" % (SELECT count(*) FROM documents) = d.doc_id
  WHERE p.last_page_id = 'search'),
words AS (
  SELECT "offset", ts, unnest(regexp_extract_all(lower(item), '[\\p{L}\\p{N}]+')) AS word
  FROM srch)"""

ORACLE["keyword_metrics"] = with_clog(", " + SEARCH + """
SELECT """ + win("(ts // 1000) * 1000", 10_000) + """, 'search' AS source, word AS keyword,
       count(*) AS keyword_count
FROM words GROUP BY ALL""")

# All splits of a name into listed words; the fewest words win, then the longer first word.
ORACLE["segment_names"] = """
WITH RECURSIVE names AS (
  SELECT p_partkey, lower(replace(p_name, ' ', '')) AS s FROM part),
words AS (SELECT DISTINCT unnest(string_split(lower(p_name), ' ')) AS w FROM part),
runs AS (SELECT DISTINCT s FROM names),
splits AS (
  SELECT s, 0 AS pos, CAST([] AS VARCHAR[]) AS ws FROM runs
  UNION ALL
  SELECT s, pos + length(w), list_append(ws, w)
  FROM splits JOIN words ON starts_with(substr(s, pos + 1), w) WHERE pos < length(s)),
best AS (
  SELECT s, array_to_string(ws, ' ') AS words,
         row_number() OVER (PARTITION BY s ORDER BY len(ws),
                            list_transform(ws, lambda x: -length(x))) AS rn
  FROM splits WHERE pos = length(s))
SELECT p_partkey, words FROM names JOIN best USING (s) WHERE rn = 1"""

ORACLE["tokenize"] = with_clog(", " + SEARCH + """
SELECT "offset", word, count(*) AS n FROM words GROUP BY ALL""")


# ================================================================ change log


def fmt_s(sec_expr: str) -> str:
    return f"strftime(epoch_ms(({sec_expr}) * 1000), '%Y-%m-%d %H:%M:%S')"


def day_s(sec_expr: str) -> str:
    return f"strftime(epoch_ms(({sec_expr}) * 1000), '%Y-%m-%d')"


DIC = """dic(dic_code, dic_name) AS (VALUES
  ('2401', 'user search'), ('2402', 'promotion'), ('2403', 'recommendation'),
  ('2404', 'activity'), ('1101', 'alipay'), ('1102', 'wechat'), ('1103', 'union pay'),
  ('1501', 'refund money only'), ('1502', 'return goods and money'),
  ('1301', 'quality problem'), ('1302', 'not as described'), ('1303', 'no longer needed'),
  ('1201', 'good'), ('1202', 'medium'), ('1203', 'bad'), ('1204', 'automatic'))"""

ORD = """ob AS (
  SELECT o_orderkey AS k, o_custkey, o_orderstatus, o_orderpriority,
         epoch_us(o_orderdate) // 1000000 + o_orderkey % 86400 AS ots,
         CAST(o_totalprice AS DECIMAL(16,2)) AS total,
         CAST(o_orderkey % 7 AS DECIMAL(16,2)) AS act,
         CAST(o_orderkey % 5 AS DECIMAL(16,2)) AS cou
  FROM orders),
oi0 AS (
  SELECT 'insert' AS type, ots AS change_ts, '1001' AS order_status,
         CAST(NULL AS VARCHAR) AS operate_time, CAST(NULL AS VARCHAR) AS old_status,
         false AS has_old_status, * FROM ob
  UNION ALL
  SELECT 'update', ots + 3600, '1003', """ + fmt_s("ots + 3600") + """,
         CASE WHEN k % 5 = 0 THEN NULL ELSE '1001' END, true, * FROM ob
  WHERE o_orderstatus = 'F'
  UNION ALL
  SELECT 'update', ots + 7200, '1005', """ + fmt_s("ots + 7200") + """,
         CASE WHEN k % 4 IN (0, 1) THEN NULL ELSE '1004' END, k % 4 <> 1, * FROM ob
  WHERE o_orderstatus = 'P'),
oi AS (
  SELECT CAST(k AS VARCHAR) AS id, type, change_ts, order_status, operate_time, old_status,
         has_old_status, CAST(o_custkey AS VARCHAR) AS user_id,
         CAST(o_custkey % 25 AS VARCHAR) AS province_id,
         CAST(total AS VARCHAR) AS total_amount, CAST(act AS VARCHAR) AS activity_reduce_amount,
         CAST(cou AS VARCHAR) AS coupon_reduce_amount,
         CASE WHEN k % 11 <> 0 THEN CAST(total + act + cou AS VARCHAR) END
           AS original_total_amount,
         k, ots, o_orderstatus AS process_status, o_orderpriority || ' order' AS trade_body
  FROM oi0),
pay AS (
  SELECT CAST(o_custkey AS VARCHAR) AS user_id, CAST(k AS VARCHAR) AS order_id,
         CASE o_orderpriority WHEN '1-URGENT' THEN '1101' WHEN '2-HIGH' THEN '1102'
              WHEN '3-MEDIUM' THEN '1103' ELSE '1104' END AS payment_type,
         """ + fmt_s("ots + 1800") + """ AS callback_time, ots + 1800 AS ts
  FROM ob WHERE o_orderstatus = 'F' AND k % 5 <> 0)"""

LINES = """lb AS (
  SELECT l_orderkey AS ok, l_linenumber, l_partkey, l_suppkey, l_returnflag, l_discount, l_tax,
         epoch_us(l_shipdate) // 1000000 + l_orderkey % 86400 AS lts,
         CAST(l_orderkey * 100 + l_linenumber AS VARCHAR) AS detail_id,
         CAST(l_extendedprice AS DECIMAL(16,2)) AS price,
         CAST(floor(l_discount * 100 + 0.5) AS DECIMAL(16,2)) AS act,
         CAST(floor(l_tax * 100 + 0.5) AS DECIMAL(16,2)) AS cou,
         CAST(l_quantity AS INTEGER) AS qty,
         '240' || CAST(l_linenumber % 5 + 1 AS VARCHAR) AS source_type
  FROM lineitem),
od AS (
  SELECT detail_id AS order_detail_id, CAST(ok AS VARCHAR) AS order_id,
         CAST(l_partkey AS VARCHAR) AS sku_id, 'sku ' || CAST(l_partkey AS VARCHAR) AS sku_name,
         CAST(price AS VARCHAR) AS order_price, CAST(qty AS VARCHAR) AS sku_num,
         """ + fmt_s("lts") + """ AS order_create_time, source_type,
         CAST(l_suppkey AS VARCHAR) AS source_id,
         CAST(price - act - cou AS VARCHAR) AS split_total_amount,
         CAST(act AS VARCHAR) AS split_activity_amount, CAST(cou AS VARCHAR) AS split_coupon_amount,
         lts AS detail_ts,
         CAST(price * CAST(qty AS DECIMAL(16,2)) AS VARCHAR) AS split_original_amount
  FROM lb),
oa AS (
  SELECT detail_id AS order_detail_id,
         CAST(CAST(floor(l_discount * 100 + 0.5) AS BIGINT) AS VARCHAR) AS activity_id,
         CAST(CAST(floor(l_discount * 100 + 0.5) AS BIGINT) AS VARCHAR) || '-1' AS activity_rule_id,
         """ + fmt_s("lts") + """ AS activity_create_time
  FROM lb WHERE l_discount >= 0.05),
oc AS (
  SELECT detail_id AS order_detail_id,
         CAST(CAST(floor(l_tax * 100 + 0.5) AS BIGINT) AS VARCHAR) AS coupon_id,
         detail_id AS coupon_use_id, """ + fmt_s("lts") + """ AS coupon_create_time
  FROM lb WHERE l_tax >= 0.05)"""

WIDE = """wide AS (
  SELECT od.*, oa.activity_id, oa.activity_rule_id, oa.activity_create_time, oc.coupon_id,
         oc.coupon_use_id, oc.coupon_create_time, dic.dic_name AS source_type_name,
         oi.type, oi.change_ts, oi.order_status, oi.operate_time, oi.old_status,
         oi.has_old_status, oi.user_id, oi.province_id, oi.total_amount,
         oi.activity_reduce_amount, oi.coupon_reduce_amount, oi.original_total_amount,
         oi.k, oi.ots, oi.process_status, oi.trade_body
  FROM od JOIN dic ON od.source_type = dic.dic_code
  LEFT JOIN oa ON od.order_detail_id = oa.order_detail_id
  LEFT JOIN oc ON od.order_detail_id = oc.order_detail_id
  JOIN oi ON od.order_id = oi.id)"""

WIDE_COLS = """order_detail_id, order_id, user_id, province_id, sku_id, sku_num, order_price,
  split_original_amount, split_total_amount, split_activity_amount, split_coupon_amount,
  activity_id, activity_rule_id, coupon_id, coupon_use_id, source_type, source_type_name,
  order_create_time, order_status, type, total_amount, original_total_amount,
  activity_reduce_amount, coupon_reduce_amount, operate_time, change_ts"""

TIE = """sku_id DESC, source_id DESC, order_price DESC, sku_num DESC,
  split_activity_amount DESC, split_coupon_amount DESC, activity_id DESC NULLS LAST,
  coupon_id DESC NULLS LAST"""


def settled(delay_s: float) -> str:
    return """settled AS (
  SELECT * EXCLUDE (rn, first_ts) FROM (
    SELECT *, row_number() OVER (PARTITION BY order_detail_id
                                 ORDER BY detail_ts DESC, """ + TIE + """) AS rn
    FROM (SELECT *, min(detail_ts) OVER (PARTITION BY order_detail_id) AS first_ts
          FROM wide WHERE type = 'insert')
    WHERE detail_ts * 1000 <= first_ts * 1000 + """ + str(int(delay_s * 1000)) + """)
  WHERE rn = 1)"""


PROD = """prod AS (
  SELECT CAST(p_partkey AS VARCHAR) AS sku_id, split_part(p_name, ' ', 1) AS spu_id,
         split_part(p_name, ' ', 1) AS spu_name, p_brand AS tm_id, 'tm ' || p_brand AS tm_name,
         p_type || '-' || CAST(p_size % 5 AS VARCHAR) AS category3_id,
         lower(p_type) || ' ' || CAST(p_size % 5 AS VARCHAR) AS category3_name,
         p_type AS category2_id, lower(p_type) AS category2_name,
         substr(p_type, 1, 1) AS category1_id, 'group ' || substr(p_type, 1, 1) AS category1_name
  FROM part)"""

CART = """cart AS (
  SELECT detail_id AS id, CAST(l_suppkey AS VARCHAR) AS user_id,
         CAST(l_partkey AS VARCHAR) AS sku_id,
         CASE WHEN l_returnflag = 'N' THEN qty ELSE CAST(ok % 3 AS INTEGER) END AS sku_num,
         """ + fmt_s("lts") + """ AS create_time,
         CASE WHEN l_returnflag = 'A' THEN """ + fmt_s("lts + 60") + """ END AS operate_time,
         source_type, CASE WHEN l_returnflag = 'N' THEN lts ELSE lts + 60 END AS ts,
         'sku ' || CAST(l_partkey AS VARCHAR) AS sku_name,
         CAST(l_linenumber % 2 AS VARCHAR) AS is_checked, CAST(ok % 2 AS VARCHAR) AS is_ordered,
         CASE WHEN ok % 2 = 1 THEN """ + fmt_s("lts + 30") + """ END AS order_time
  FROM lb WHERE l_returnflag = 'N' OR (l_returnflag = 'A' AND ok % 3 > 0))"""

REFUNDS = """refunds AS (
  SELECT detail_id AS id, CAST(l_suppkey AS VARCHAR) AS user_id, CAST(ok AS VARCHAR) AS order_id,
         CAST(l_partkey AS VARCHAR) AS sku_id,
         '150' || CAST(l_linenumber % 2 + 1 AS VARCHAR) AS refund_type,
         CAST(qty AS VARCHAR) AS refund_num, CAST(price AS VARCHAR) AS refund_amount,
         '130' || CAST(ok % 4 + 1 AS VARCHAR) AS refund_reason_type,
         'reason' AS refund_reason_txt, """ + fmt_s("lts") + """ AS create_time, lts AS ts
  FROM lb WHERE l_returnflag = 'R'),
refund_orders AS (
  SELECT CAST(k AS VARCHAR) AS id, CAST(o_custkey % 25 AS VARCHAR) AS province_id,
         """ + fmt_s("ots + 7200") + """ AS operate_time, ots + 7200 AS ts
  FROM ob WHERE o_orderstatus = 'P' AND k % 4 <> 1)"""

EVC = """evc AS (
  SELECT event_id, user_id, event_type, epoch_us(ts) // 1000000 AS ts_s,
         CAST(props->>'$.k' AS INTEGER) AS k
  FROM events)"""


def with_cdc(body: str) -> str:
    return ("WITH " + DIC + ",\n" + ORD + ",\n" + LINES + ",\n" + WIDE + ",\n" + PROD + ",\n"
            + CART + ",\n" + REFUNDS + ",\n" + EVC + body)


ORACLE["change_rows"] = with_cdc("""
SELECT order_detail_id AS id, order_id, sku_id, sku_num, source_type,
       order_create_time AS create_time, 'insert' AS type, detail_ts AS ts FROM od""")

ORACLE["cart_add"] = with_cdc("""
SELECT id, user_id, sku_id, sku_num, create_time, operate_time, source_type, ts, sku_name,
       is_checked, is_ordered, order_time FROM cart""")

ORACLE["favor_add"] = with_cdc("""
SELECT CAST(event_id AS VARCHAR) AS id, CAST(user_id AS VARCHAR) AS user_id,
       CAST(event_id % 2000 AS VARCHAR) AS sku_id, """ + day_s("ts_s") + """ AS date_id,
       """ + fmt_s("ts_s") + """ AS create_time, ts_s AS ts
FROM evc WHERE event_type = 'click' AND (k % 2 = 0 OR k % 3 = 0)""")

ORACLE["coupon_get"] = with_cdc("""
SELECT CAST(event_id AS VARCHAR) AS id, CAST(k % 10 AS VARCHAR) AS coupon_id,
       CAST(user_id AS VARCHAR) AS user_id, """ + day_s("ts_s") + """ AS date_id,
       """ + fmt_s("ts_s") + """ AS get_time, ts_s AS ts
FROM evc WHERE event_type = 'purchase' AND k % 2 = 0""")


def coupon_step(rem: int, out: str) -> str:
    return with_cdc("""
SELECT CAST(event_id AS VARCHAR) AS id, CAST(k % 10 AS VARCHAR) AS coupon_id,
       CAST(user_id AS VARCHAR) AS user_id, CAST(event_id % 1000 AS VARCHAR) AS order_id,
       """ + day_s("ts_s") + """ AS date_id, """ + fmt_s("ts_s") + """ AS """ + out + """,
       ts_s AS ts
FROM evc WHERE event_type = 'purchase' AND k % 2 = 1 AND k % 3 = """ + str(rem))


ORACLE["coupon_order"] = coupon_step(0, "order_time")
ORACLE["coupon_pay"] = coupon_step(1, "payment_time")

REG = """reg AS (
  SELECT CAST(c_custkey AS VARCHAR) AS user_id,
         1704067200 + (c_custkey * 7919) % 2592000 AS ts FROM customer)"""

ORACLE["user_register"] = with_cdc(", " + REG + """
SELECT user_id, """ + day_s("ts") + """ AS date_id, """ + fmt_s("ts") + """ AS create_time, ts
FROM reg""")

ORACLE["payment_success_rows"] = with_cdc("""
SELECT user_id, order_id, payment_type, callback_time, ts FROM pay""")

ORACLE["refund_order_rows"] = with_cdc("""
SELECT id, province_id, operate_time, ts FROM refund_orders""")

ORACLE["order_wide"] = with_cdc("""
SELECT """ + WIDE_COLS + """, old_status AS old_order_status FROM wide""")

ORACLE["order_fact_typed"] = with_cdc("""
SELECT order_detail_id, order_id, sku_id, sku_name, order_price, CAST(sku_num AS INTEGER) AS sku_num,
       order_create_time, source_type, source_id,
       CAST(CAST(split_original_amount AS DECIMAL(33,4)) AS VARCHAR) AS split_original_amount,
       split_total_amount, split_activity_amount, split_coupon_amount,
       """ + fmt_s("detail_ts") + """ AS pt, 'customer ' || user_id AS consignee,
       '1' || lpad(user_id, 10, '0') AS consignee_tel, total_amount, order_status, user_id,
       '110' || CAST(k % 3 + 1 AS VARCHAR) AS payment_way, 'T' || order_id AS out_trade_no,
       trade_body, operate_time, """ + fmt_s("ots + 900") + """ AS expire_time, process_status,
       CASE WHEN k % 3 = 0 THEN 'N' || order_id END AS tracking_no,
       CASE WHEN k % 10 = 0 THEN CAST(k - 1 AS VARCHAR) END AS parent_order_id, province_id,
       activity_reduce_amount, coupon_reduce_amount, original_total_amount,
       CASE WHEN k % 17 <> 0 THEN CAST(CAST(k % 13 AS DECIMAL(16,2)) AS VARCHAR) END AS feight_fee,
       CAST(CAST(k % 3 AS DECIMAL(16,2)) AS VARCHAR) AS feight_fee_reduce, type, activity_id,
       activity_rule_id, activity_create_time, coupon_id, coupon_use_id, coupon_create_time,
       source_type_name AS dic_name, """ + fmt_s("greatest(detail_ts, change_ts)") + """ AS ts,
       old_status AS old_order_status, CAST(NULL AS VARCHAR) AS bad_record,
       CASE WHEN k % 17 = 0 THEN 'n/a' END AS bad_feight_fee,
       CAST(k % 17 = 0 AS INTEGER) AS n_bad
FROM wide""")

ORACLE["order_add"] = with_cdc("""
SELECT """ + WIDE_COLS + """ FROM wide WHERE type = 'insert'""")

ORACLE["order_cancel"] = with_cdc("""
SELECT """ + WIDE_COLS + """ FROM wide
WHERE type = 'update' AND order_status = '1003' AND old_status IS NOT NULL""")

PDETAIL = """pdetail AS (
  SELECT w.order_detail_id, w.order_id, w.user_id, w.sku_id, w.province_id, w.activity_id,
         w.activity_rule_id, w.coupon_id, p.payment_type AS payment_type_code,
         dic.dic_name AS payment_type_name, p.callback_time, w.source_id, w.source_type,
         w.sku_num, w.split_original_amount, w.split_activity_amount, w.split_coupon_amount,
         w.split_total_amount AS split_payment_amount, p.ts
  FROM pay p JOIN dic ON p.payment_type = dic.dic_code
  JOIN wide w ON w.type = 'insert' AND p.order_id = w.order_id)"""

ORACLE["payment_detail"] = with_cdc(", " + PDETAIL + """
SELECT * FROM pdetail""")

ORACLE["refund_wide"] = with_cdc("""
SELECT r.id, r.user_id, r.order_id, r.sku_id, ro.province_id, """ + day_s("r.ts") + """ AS date_id,
       r.create_time, r.refund_type, t.dic_name AS refund_type_name, r.refund_reason_type,
       rr.dic_name AS refund_reason_type_name, r.refund_reason_txt, r.refund_num,
       r.refund_amount, r.ts
FROM refunds r LEFT JOIN refund_orders ro ON r.order_id = ro.id
LEFT JOIN dic t ON r.refund_type = t.dic_code
LEFT JOIN dic rr ON r.refund_reason_type = rr.dic_code""")

ORACLE["comment_wide"] = with_cdc("""
SELECT CAST(event_id AS VARCHAR) AS id, CAST(user_id AS VARCHAR) AS user_id,
       CAST(event_id % 2000 AS VARCHAR) AS sku_id, CAST(event_id % 1000 AS VARCHAR) AS order_id,
       """ + day_s("ts_s") + """ AS date_id, """ + fmt_s("ts_s") + """ AS create_time,
       '120' || CAST(k % 5 + 1 AS VARCHAR) AS appraise, dic.dic_name AS appraise_name,
       ts_s AS ts
FROM evc LEFT JOIN dic ON '120' || CAST(k % 5 + 1 AS VARCHAR) = dic.dic_code
WHERE event_type = 'view' AND k % 2 = 0""")

ORACLE["cart_wide"] = with_cdc("""
SELECT id, user_id, sku_id, sku_num, source_type, dic.dic_name AS source_type_name, ts,
       sku_name, is_checked, is_ordered, order_time
FROM cart JOIN dic ON cart.source_type = dic.dic_code""")

ORACLE["lookup_join"] = with_cdc("""
SELECT order_detail_id AS id, source_type, detail_ts AS ts, dic.dic_name
FROM od LEFT JOIN dic ON od.source_type = dic.dic_code""")

ORACLE["enrich_product"] = with_cdc(", " + settled(2) + """
SELECT s.order_detail_id, s.sku_id, s.split_total_amount, p.spu_id, p.spu_name, p.tm_id,
       p.tm_name, p.category3_id, p.category3_name, p.category2_id, p.category2_name,
       p.category1_id, p.category1_name
FROM settled s LEFT JOIN prod p ON s.sku_id = p.sku_id""")

ORACLE["latest_per_key"] = with_cdc("""
SELECT order_detail_id, detail_ts, sku_id, order_price, sku_num FROM (
  SELECT *, row_number() OVER (PARTITION BY order_detail_id ORDER BY detail_ts DESC,
    sku_id DESC, source_id DESC, order_price DESC, sku_num DESC, split_activity_amount DESC,
    split_coupon_amount DESC) AS rn FROM od) WHERE rn = 1""")

ORACLE["settle_latest"] = with_cdc(", " + settled(30 * 86400) + """
SELECT order_detail_id, detail_ts, sku_id, split_total_amount, activity_id, coupon_id
FROM settled""")

ORACLE["first_per_key_gap"] = with_cdc("""
SELECT order_detail_id, detail_ts, sku_id, order_price FROM (
  SELECT *, lag(detail_ts) OVER (PARTITION BY order_detail_id ORDER BY detail_ts, sku_id,
    source_id, order_price, sku_num, split_activity_amount, split_coupon_amount) AS prev_ts
  FROM od)
WHERE prev_ts IS NULL OR (detail_ts - prev_ts) * 1000 >= """ + str(30 * 86_400_000))

ORACLE["latest_by_key"] = with_cdc(""",
cart_all AS (
  SELECT detail_id AS id, CASE WHEN l_returnflag = 'N' THEN lts ELSE lts + 60 END AS ts,
         CASE WHEN l_returnflag = 'N' THEN 'insert' ELSE 'update' END AS type,
         CAST(qty AS VARCHAR) AS sku_num, CAST(l_partkey AS VARCHAR) AS sku_id
  FROM lb)
SELECT id, ts, type, sku_num FROM (
  SELECT *, row_number() OVER (PARTITION BY id ORDER BY ts DESC, type DESC, sku_num DESC,
                                                        sku_id DESC) AS rn
  FROM cart_all) WHERE rn = 1""")

# ---------------------------------------------------------------- trade metrics

ORACLE["register_metrics"] = with_cdc(", " + REG + """
SELECT """ + win("ts * 1000", 10_000) + """, count(*) AS register_ct FROM reg GROUP BY ALL""")

ORACLE["cart_user_metrics"] = with_cdc("""
SELECT """ + win("ets * 1000", 10_000) + """, count(*) AS cart_add_uu_ct FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id, substr(et, 1, 10) ORDER BY et, id) AS rn
  FROM (SELECT *, coalesce(operate_time, create_time) AS et,
               CASE WHEN operate_time IS NULL THEN ts ELSE ts END AS ets FROM cart))
WHERE rn = 1 GROUP BY ALL""")


def money(c: str) -> str:
    return f"CAST(coalesce(sum(CAST({c} AS DECIMAL(16,2))), 0) AS DOUBLE)"


ORACLE["order_metrics"] = with_cdc(", " + settled(2) + """,
fd AS (
  SELECT *, row_number() OVER (PARTITION BY user_id, substr(order_create_time, 1, 10)
                               ORDER BY order_create_time, order_detail_id) AS rn_day
  FROM settled),
fu AS (
  SELECT order_detail_id,
         row_number() OVER (PARTITION BY user_id ORDER BY substr(order_create_time, 1, 10)) AS rn_user
  FROM fd WHERE rn_day = 1),
fl AS (
  SELECT s.*, CAST(CASE WHEN fu.order_detail_id IS NOT NULL THEN 1 ELSE 0 END AS BIGINT) AS uu,
         CAST(CASE WHEN fu.rn_user = 1 THEN 1 ELSE 0 END AS BIGINT) AS nu
  FROM settled s LEFT JOIN fu ON s.order_detail_id = fu.order_detail_id)
SELECT """ + win("detail_ts * 1000", 10_000) + """,
       CAST(sum(uu) AS BIGINT) AS order_unique_user_count,
       CAST(sum(nu) AS BIGINT) AS order_new_user_count,
       """ + money("activity_reduce_amount") + """ AS order_activity_reduce_amount,
       """ + money("coupon_reduce_amount") + """ AS order_coupon_reduce_amount,
       """ + money("original_total_amount") + """ AS order_original_total_amount
FROM fl GROUP BY ALL""")

ORACLE["payment_metrics"] = with_cdc(", " + PDETAIL + """,
one AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY order_detail_id ORDER BY ts) AS rn
                 FROM pdetail) WHERE rn = 1),
fd AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY user_id, substr(callback_time, 1, 10)
                                              ORDER BY callback_time, order_detail_id) AS rn2
                 FROM one) WHERE rn2 = 1),
fl AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY user_id ORDER BY substr(callback_time, 1, 10)) = 1
                 AS BIGINT) AS nu
  FROM fd)
SELECT """ + win("ts * 1000", 10_000) + """,
       count(*) AS payment_suc_unique_user_count,
       CAST(sum(nu) AS BIGINT) AS payment_suc_new_user_count
FROM fl GROUP BY ALL""")

ORACLE["province_order_metrics"] = with_cdc(", " + settled(2) + """,
agg AS (
  SELECT """ + win("detail_ts * 1000", 10_000) + """, province_id,
         count(DISTINCT order_id) AS order_count,
         """ + money("split_total_amount") + """ AS order_amount
  FROM settled GROUP BY ALL)
SELECT agg.stt, agg.edt, agg.province_id, n.n_name AS province_name, order_count, order_amount
FROM agg LEFT JOIN nation n ON agg.province_id = CAST(n.n_nationkey AS VARCHAR)""")

PRODUCT_OUT = """p.tm_id AS trademark_id, p.tm_name AS trademark_name, p.category1_id,
  p.category1_name, p.category2_id, p.category2_name, p.category3_id, p.category3_name"""

ORACLE["spu_order_metrics"] = with_cdc(", " + settled(2) + """
SELECT """ + win("s.detail_ts * 1000", 10_000) + """, s.user_id, p.spu_id, p.spu_name,
       """ + PRODUCT_OUT + """, count(*) AS order_count,
       """ + money("s.split_total_amount") + """ AS order_amount
FROM settled s LEFT JOIN prod p ON s.sku_id = p.sku_id GROUP BY ALL""")

ORACLE["refund_metrics"] = with_cdc(""",
kept AS (
  SELECT * FROM (
    SELECT *, lag(ts) OVER (PARTITION BY id ORDER BY ts, sku_id, refund_amount, refund_num)
             AS prev_ts FROM refunds)
  WHERE prev_ts IS NULL OR (ts - prev_ts) * 1000 >= 5000)
SELECT """ + win("r.ts * 1000", 10_000) + """, r.user_id, """ + PRODUCT_OUT + """,
       count(*) AS refund_count
FROM kept r LEFT JOIN prod p ON r.sku_id = p.sku_id GROUP BY ALL""")


# ================================================================ joins of the samples

def interval_sql(bound_ms: int) -> str:
    return """WITH s AS (SELECT user_id, event_id, event_type, epoch_us(ts) // 1000 AS t FROM events)
SELECT l.user_id, l.event_id AS l_id, l.t AS l_ts, r.event_id AS r_id, r.t AS r_ts
FROM s l JOIN s r ON l.user_id = r.user_id
 AND r.t BETWEEN l.t - """ + str(bound_ms) + """ AND l.t + """ + str(bound_ms) + """
WHERE l.event_type = 'view' AND r.event_type = 'purchase'"""


ORACLE["interval_join"] = interval_sql(5_000)
ORACLE["interval_join_10m"] = interval_sql(600_000)

for _how in ("left", "right", "full"):
    ORACLE[f"interval_join_10m_{_how}"] = f"""
WITH s AS (SELECT user_id, event_id, event_type, epoch_us(ts) // 1000 AS t FROM events)
SELECT coalesce(l.user_id, r.user_id) AS user_id, l.event_id AS l_id, l.t AS l_ts,
       r.event_id AS r_id, r.t AS r_ts
FROM (SELECT * FROM s WHERE event_type = 'view') l {_how.upper()} JOIN
     (SELECT * FROM s WHERE event_type = 'purchase') r
ON l.user_id = r.user_id AND r.t BETWEEN l.t - 600000 AND l.t + 600000"""

for _how, _kw in (("inner", "JOIN"), ("left", "LEFT JOIN"), ("right", "RIGHT JOIN"),
                  ("full", "FULL OUTER JOIN")):
    ORACLE[f"equi_join_{_how}"] = """
SELECT c.c_custkey, c.c_name, o.o_orderkey, o.customer_ref
FROM customer c
""" + _kw + """ (SELECT o_orderkey, o_custkey * 2 AS customer_ref FROM orders) o
ON c.c_custkey = o.customer_ref"""

ORACLE["latest_left_join"] = """
WITH l AS (
  SELECT * FROM (
    SELECT l_orderkey, l_linenumber, strftime(l_shipdate, '%Y-%m-%d') AS ship_day,
           row_number() OVER (PARTITION BY l_orderkey ORDER BY strftime(l_shipdate, '%Y-%m-%d') DESC,
             l_linenumber DESC, l_partkey DESC, l_suppkey DESC, l_extendedprice DESC) AS rn
    FROM lineitem) WHERE rn = 1)
SELECT l.l_orderkey, l.l_linenumber, l.ship_day, o.o_orderstatus
FROM l LEFT JOIN (
  SELECT * FROM (
    SELECT o_orderkey + o_orderkey // 2 AS order_ref, o_orderstatus,
           row_number() OVER (PARTITION BY o_orderkey + o_orderkey // 2) AS rn FROM orders)
  WHERE rn = 1) o
ON l.l_orderkey = o.order_ref"""

# ================================================================ dims
ROUTED = """routed AS (
  SELECT 'dim_user_info' AS sink_table, 'user_info' AS "table", 'insert' AS type,
         1704067200 + (c_custkey * 7919) % 2592000 AS ts, CAST(c_custkey AS VARCHAR) AS id,
         NULL AS k
  FROM customer
  UNION ALL
  SELECT 'dim_coupon_use', 'coupon_use', CASE WHEN k % 2 = 0 THEN 'insert' ELSE 'update' END,
         ts_s, CAST(event_id AS VARCHAR), k
  FROM evc WHERE event_type = 'purchase'
  UNION ALL
  SELECT 'dim_favor_info', 'favor_info', CASE WHEN k % 2 = 0 THEN 'insert' ELSE 'update' END,
         ts_s, CAST(event_id AS VARCHAR), k
  FROM evc WHERE event_type = 'click'),
pruned AS (
  SELECT sink_table, id AS pk, r.ts, type, 'id' AS "column", id AS value FROM routed r
  UNION ALL
  SELECT sink_table, id, r.ts, type, 'create_time', """ + fmt_s("r.ts") + """ FROM routed r
  WHERE sink_table = 'dim_user_info'
  UNION ALL
  SELECT r.sink_table, r.id, r.ts, r.type, c.col, c.val
  FROM routed r JOIN evc e ON r.sink_table <> 'dim_user_info' AND CAST(e.event_id AS VARCHAR) = r.id,
  LATERAL (VALUES
    ('coupon_id', CASE WHEN r.sink_table = 'dim_coupon_use' THEN CAST(e.k % 10 AS VARCHAR) END),
    ('user_id', CAST(e.user_id AS VARCHAR)),
    ('coupon_status', CASE WHEN r.sink_table = 'dim_coupon_use' THEN '1401' END),
    ('using_time', CASE WHEN r.sink_table = 'dim_coupon_use' AND e.k % 2 = 1 AND e.k % 3 = 0
                        THEN """ + fmt_s("e.ts_s") + """ END),
    ('sku_id', CASE WHEN r.sink_table = 'dim_favor_info' THEN CAST(e.event_id % 2000 AS VARCHAR) END),
    ('is_cancel', CASE WHEN r.sink_table = 'dim_favor_info' THEN
                    CASE WHEN e.k % 2 = 1 AND e.k % 3 = 1 THEN '1' ELSE '0' END END)
  ) AS c(col, val)
  WHERE c.val IS NOT NULL)"""

ORACLE["apply_rules"] = with_cdc(", " + ROUTED + """
SELECT sink_table, "table", type, ts, id FROM routed""")

ORACLE["prune_columns"] = with_cdc(", " + ROUTED + """
SELECT sink_table, pk, ts, type, "column", value FROM pruned""")

ORACLE["maintain_dims"] = with_cdc(", " + ROUTED + """
SELECT DISTINCT sink_table, pk, "column", value FROM pruned""")

# ================================================================ reports

ORACLE["gmv_report"] = ORACLE["province_order_metrics"].replace(
    "SELECT agg.stt, agg.edt, agg.province_id, n.n_name AS province_name, order_count, order_amount\n"
    "FROM agg LEFT JOIN nation n ON agg.province_id = CAST(n.n_nationkey AS VARCHAR)",
    "SELECT CAST(sum(CAST(order_amount AS DECIMAL(18,2))) AS DOUBLE) AS gmv FROM agg\n"
    "WHERE CAST(replace(substr(stt, 1, 10), '-', '') AS INTEGER) = 19970315")

_CH = ORACLE["channel_metrics"]
_CH_REPORT = _CH[:_CH.rindex("SELECT ")].rstrip() + """,
cm AS (""" + _CH[_CH.rindex("SELECT "):] + """)
SELECT ch, CAST(sum(uv_ct) AS BIGINT) AS uv_ct, CAST(sum(uj_ct) AS BIGINT) AS uj_ct FROM cm
WHERE CAST(replace(substr(stt, 1, 10), '-', '') AS INTEGER) = 20240115 GROUP BY ch"""
ORACLE["uv_by_channel_report"] = _CH_REPORT

ORACLE["count_by_key"] = with_cdc(""",
cart_all AS (
  SELECT detail_id AS id, CASE WHEN l_returnflag = 'N' THEN lts ELSE lts + 60 END AS ts,
         CASE WHEN l_returnflag = 'N' THEN 'insert' ELSE 'update' END AS type,
         CAST(l_suppkey AS VARCHAR) AS user_id
  FROM lb),
cur AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY ts DESC, type DESC,
                                                             user_id DESC) AS rn
                 FROM cart_all) WHERE rn = 1)
SELECT user_id, count(*) AS cnt FROM cur GROUP BY user_id""")

ORACLE["chart_json"] = _CH_REPORT.replace(
    "SELECT ch, CAST(sum(uv_ct) AS BIGINT) AS uv_ct, CAST(sum(uj_ct) AS BIGINT) AS uj_ct FROM cm",
    "SELECT CAST(to_json({'status': 0, 'msg': '', 'data': {"
    "'categories': list(ch ORDER BY ch), 'series': ["
    "{'name': 'uv', 'data': list(uv_ct ORDER BY ch)}, "
    "{'name': 'uj', 'data': list(uj_ct ORDER BY ch)}]}}) AS VARCHAR) AS json FROM (\n"
    "SELECT ch, CAST(sum(uv_ct) AS BIGINT) AS uv_ct, CAST(sum(uj_ct) AS BIGINT) AS uj_ct FROM cm"
).replace("GROUP BY ch", "GROUP BY ch)")

ORACLE["change_log_json"] = ORACLE["order_cancel"]

# ================================================================ day-long windows

for _name in ("login_metrics", "page_uv_metrics", "register_metrics", "cart_user_metrics",
              "order_metrics", "province_order_metrics", "spu_order_metrics"):
    ORACLE[f"{_name}_1d"] = (ORACLE[_name].replace("// 10000) * 10000", "// 86400000) * 86400000")
                             .replace("* 86400000 + 10000)", "* 86400000 + 86400000)"))

# ================================================================ streams
#
# A stream gives out what lies before its last watermark: the largest event time of its rows
# less the delay. Rows wait until the watermark has passed them; windows until their end.


def _passed(cond: str = "TRUE", table: str = "plog", delay: int = 2000) -> str:
    return f"(SELECT max(ts) FROM {table} WHERE {cond}) - {delay}"


_START = "last_page_id IS NULL"

ORACLE["stream_unique_visitor"] = with_clog(", " + UV + f"""
SELECT "offset", mid, ts, is_new FROM uvr WHERE ts < {_passed(_START)}""")

ORACLE["stream_user_jump"] = with_clog(f""",
nx AS (
  SELECT *, lead(ts) OVER w AS nts, lead(last_page_id) OVER w AS nlp
  FROM plog WINDOW w AS (PARTITION BY mid ORDER BY ts, "offset"))
SELECT "offset", mid, ts FROM nx
WHERE {_START} AND ts < {_passed()} AND CASE WHEN nts IS NOT NULL AND nts < {_passed()}
  THEN nlp IS NULL OR nts - ts >= 10000 ELSE ts + 10000 <= {_passed()} END""")

ORACLE["stream_fix_new_flag"] = with_clog(f"""
SELECT "offset", mid, ts, is_new FROM flog WHERE ts < {_passed(table='clog')}""")

# The routing job waits for nothing: its outputs are whole.
ORACLE["stream_fan_out_page"] = ORACLE["fan_out_page"]
ORACLE["stream_fan_out_start"] = ORACLE["fan_out_start"]

ORACLE["stream_login_unique_and_back"] = with_clog(", " + LOGIN + f"""
SELECT "offset", uid, ts, dt, uu_ct, back_ct FROM lg
WHERE ts < {_passed("uid IS NOT NULL AND " + _START)}""")

ORACLE["stream_first_per_key_gap"] = (
    "SELECT * FROM (" + ORACLE["first_per_key_gap"] + ") WHERE detail_ts * 1000 < ("
    + with_cdc(" SELECT max(detail_ts) FROM od") + ") * 1000 - 2000")

ORACLE["stream_channel_metrics"] = channel_sql(10_000).replace(
    "0, 0, 0, 0 FROM uvr)", f"0, 0, 0, 0 FROM uvr WHERE ts < {_passed(_START)})").replace(
    "FROM r GROUP BY ALL",
    f"FROM r WHERE (ts // 10000) * 10000 + 10000 <= {_passed(delay=13000)} GROUP BY ALL")

ORACLE["stream_keyword_metrics"] = ORACLE["keyword_metrics"].replace(
    "FROM words GROUP BY ALL",
    "FROM words WHERE (ts // 10000) * 10000 + 10000 <= "
    "(SELECT max(ts // 1000) * 1000 - 2000 FROM srch) GROUP BY ALL")

# Changes join a line within three days. A line without activity (coupon) comes out when the
# watermark, the smallest of the four topics', is three (six) days past it.
_TOPICS = ("least((SELECT max(detail_ts) FROM od), (SELECT max(change_ts) FROM oi), "
           "(SELECT max(lts) FROM lb WHERE l_discount >= 0.05), "
           "(SELECT max(lts) FROM lb WHERE l_tax >= 0.05)) - 2")
ORACLE["stream_order_wide"] = with_cdc(f"""
SELECT {WIDE_COLS}, old_status AS old_order_status FROM wide
WHERE abs(change_ts - detail_ts) <= 3 * 86400
  AND (activity_id IS NOT NULL OR detail_ts < {_TOPICS} - 3 * 86400)
  AND (coupon_id IS NOT NULL OR detail_ts < {_TOPICS} - 6 * 86400)""")
for _tag, _time in (("oa", "activity_create_time"), ("oc", "coupon_create_time")):
    _line = f"LEFT JOIN {_tag} ON od.order_detail_id = {_tag}.order_detail_id"
    ORACLE["stream_order_wide"] = ORACLE["stream_order_wide"].replace(_line, _line + f"""
    AND abs(epoch(strptime({_tag}.{_time}, '%Y-%m-%d %H:%M:%S')) - od.detail_ts) <= 3 * 86400""")

ORACLE["stream_settle_latest"] = with_cdc("""
SELECT order_detail_id, detail_ts, sku_id, order_price, sku_num FROM (
  SELECT *, row_number() OVER (PARTITION BY order_detail_id ORDER BY detail_ts DESC,
      sku_id DESC, source_id DESC, order_price DESC, sku_num DESC, split_activity_amount DESC,
      split_coupon_amount DESC) AS rn
  FROM (SELECT *, min(detail_ts) OVER (PARTITION BY order_detail_id) AS first_ts FROM od)
  WHERE detail_ts <= first_ts + 30 * 86400
    AND first_ts + 30 * 86400 < (SELECT max(detail_ts) FROM od) - 2)
WHERE rn = 1""")

for _name, _ms in (("province_order_metrics", 10_000), ("province_order_metrics_1d", 86_400_000)):
    ORACLE[f"stream_{_name}"] = ORACLE[_name].replace(
        "FROM settled GROUP BY ALL", f"""FROM settled
  WHERE (detail_ts * 1000 // {_ms} + 1) * {_ms} <= (SELECT max(detail_ts) FROM settled) * 1000 - 2000
  GROUP BY ALL""")

# A view without a purchase comes out when both topics are ten minutes past it.
ORACLE["stream_interval_join"] = ORACLE["interval_join_10m_left"] + """
WHERE r.event_id IS NOT NULL OR l.t + 600000 < least(
  (SELECT max(t) FROM s WHERE event_type = 'view'),
  (SELECT max(t) FROM s WHERE event_type = 'purchase'))"""

ORACLE["stream_maintain_dims"] = """
WITH changes AS (
  SELECT c_custkey AS id, 694224000 AS ts, c_custkey AS pos, c_name AS name,
         c_mktsegment AS level FROM customer
  UNION ALL
  SELECT o_custkey, epoch_us(o_orderdate) // 1000000, 1000000000 + o_orderkey,
         'customer ' || CAST(o_custkey AS VARCHAR), o_orderpriority
  FROM orders WHERE o_orderkey % 13 <> 0),
latest AS (
  SELECT CAST(id AS VARCHAR) AS id, name, level FROM (
    SELECT *, row_number() OVER (PARTITION BY id ORDER BY ts DESC, pos DESC) AS rn FROM changes)
  WHERE rn = 1)
SELECT 'dim_user_info' AS sink_table, id AS pk, unnest(['id', 'name', 'level']) AS "column",
       unnest([id, name, level]) AS value FROM latest
UNION ALL
SELECT 'dim_base_province', CAST(n_nationkey AS VARCHAR), unnest(['id', 'name', 'region_id']),
       unnest([CAST(n_nationkey AS VARCHAR), n_name, CAST(n_regionkey AS VARCHAR)]) FROM nation"""

# A replayed change log is the batch join.
for _how in ("inner", "left", "right", "full"):
    ORACLE[f"stream_changelog_{_how}"] = ORACLE[f"equi_join_{_how}"]
ORACLE["stream_changelog_latest"] = ORACLE["latest_left_join"]
