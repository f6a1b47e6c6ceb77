"""DuckDB oracle SQL for every registered query, written independently of the Spark code from the same rules

The test tables are views named as in TESTDATA.md.  Staged tables are CTEs; each query pulls in the CTEs it needs.
"""

from __future__ import annotations

from shoplens.plans import queries as P

_AREAS = "['beijing','shanghai','guangdong','hebei','heilongjiang','shandong','tianjin','shan3xi','shan1xi','sichuan']"
_CHANNELS = "['xiaomi','huawei','wandoujia','360','tencent','baidu','website']"
_VERSIONS = "['1.2.0','1.1.2','1.1.3','1.1.1']"
_TOKENS = r"string_split_regex(lower({c}), '[^\p{{L}}\p{{N}}]+')"

_DEVICE = f"""
    'app1' AS appid,
    {_AREAS}[user_id % 10 + 1] AS area,
    CASE WHEN user_id % 10 < 3 THEN 'ios' ELSE 'android' END AS os"""

CTES: dict[str, str] = {}

CTES["startup"] = f"""
  SELECT 'mid_' || CAST(user_id AS VARCHAR) AS mid, CAST(user_id AS VARCHAR) AS uid, {_DEVICE},
    CASE WHEN user_id % 10 < 3 THEN 'appstore' ELSE {_CHANNELS}[user_id % 7 + 1] END AS ch,
    'startup' AS type, {_VERSIONS}[user_id % 4 + 1] AS vs, epoch_us(ts) // 1000 AS ts
  FROM events"""

_EVENT_COLS = f"""
    'mid_' || CAST(CAST(json_extract_string(props, '$.k') AS BIGINT) % 10 AS VARCHAR) AS mid,
    CAST(user_id AS VARCHAR) AS uid, {_DEVICE}, 'event' AS type,
    CASE WHEN event_type = 'error' AND event_id % 3 = 0 THEN 'share' WHEN event_type = 'error' THEN 'addComment'
      WHEN event_type = 'signup' THEN 'coupon' WHEN event_type = 'click' THEN 'clickItem'
      WHEN event_type = 'view' THEN 'addFavor' WHEN event_type = 'purchase' THEN 'addCart' END AS evid,
    CAST(event_id % 50 + 1 AS VARCHAR) AS pgid, CAST(event_id * 7 % 50 + 1 AS VARCHAR) AS npgid,
    CAST(event_id % 50 AS VARCHAR) AS itemid, epoch_us(ts) // 1000 AS ts"""

CTES["event_log"] = f"SELECT {_EVENT_COLS} FROM events"

CTES["raw_logs"] = f"""
  SELECT type, mid, uid, appid, area, os, ch, vs, NULL::VARCHAR AS evid, NULL::VARCHAR AS pgid,
         NULL::VARCHAR AS npgid, NULL::VARCHAR AS itemid, ts FROM startup
  UNION ALL
  SELECT CASE WHEN event_type <> 'error' THEN type END AS type, mid, uid, appid, area, os, NULL AS ch, NULL AS vs,
         evid, pgid, npgid, itemid, ts
  FROM (SELECT event_type, {_EVENT_COLS} FROM events)"""

CTES["order_info"] = """
  SELECT CAST(o_orderkey AS VARCHAR) AS id, CAST(c_nationkey AS VARCHAR) AS province_id, c_name AS consignee,
    NULL::VARCHAR AS order_comment,
    '1' || lpad(CAST((c_custkey * 7919 + 3456789) % 10000000000 AS VARCHAR), 10, '0') AS consignee_tel,
    o_orderstatus AS order_status, CAST(o_orderkey % 3 + 1 AS VARCHAR) AS payment_way,
    CAST(o_custkey AS VARCHAR) AS user_id, NULL::VARCHAR AS img_url, o_totalprice AS total_amount,
    NULL::VARCHAR AS expire_time, NULL::VARCHAR AS delivery_address,
    strftime(o_orderdate + to_seconds((o_orderkey * 7919) % 86400), '%Y-%m-%d %H:%M:%S') AS create_time,
    NULL::VARCHAR AS operate_time, NULL::VARCHAR AS tracking_no, NULL::VARCHAR AS parent_order_id,
    NULL::VARCHAR AS out_trade_no, NULL::VARCHAR AS trade_body
  FROM orders LEFT JOIN customer ON o_custkey = c_custkey"""

CTES["order_detail"] = """
  SELECT concat_ws('-', CAST(l_orderkey AS VARCHAR), CAST(l_linenumber AS VARCHAR), CAST(l_partkey AS VARCHAR),
           CAST(l_suppkey AS VARCHAR), CAST(CAST(l_quantity AS BIGINT) AS VARCHAR)) AS id,
    CAST(l_orderkey AS VARCHAR) AS order_id, p_name AS sku_name, CAST(l_partkey AS VARCHAR) AS sku_id,
    CAST(CAST(l_extendedprice AS DECIMAL(18,2)) AS VARCHAR) AS order_price, NULL::VARCHAR AS img_url,
    CAST(CAST(l_quantity AS BIGINT) AS VARCHAR) AS sku_num,
    strftime(o_orderdate + to_seconds((o_orderkey * 7919) % 86400)
             + to_seconds((l_partkey * 31 + l_linenumber * 17) % 300 - 150), '%Y-%m-%d %H:%M:%S') AS detail_time
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey LEFT JOIN part ON l_partkey = p_partkey"""

CTES["user_log"] = """
  SELECT CAST(c_custkey AS VARCHAR) AS id, c_name AS login_name,
    CAST((c_custkey + seq) % 5 + 1 AS VARCHAR) AS user_level,
    strftime(DATE '1960-01-01' + CAST((c_custkey * 37) % 18000 AS INTEGER), '%Y-%m-%d') AS birthday,
    CASE WHEN c_custkey % 2 = 0 THEN 'F' ELSE 'M' END AS gender, seq
  FROM (SELECT c_custkey, c_name, unnest(generate_series(1, 1 + c_custkey % 3)) AS seq FROM customer)"""

CTES["user_latest"] = """
  SELECT id, login_name, user_level, birthday, gender, seq FROM (
    SELECT *, row_number() OVER (PARTITION BY id ORDER BY seq DESC) AS rn FROM user_log) WHERE rn = 1"""

CTES["dau"] = """
  SELECT mid, uid, appid, area, os, ch, type, vs, ts, logdate, loghour FROM (
    SELECT *, row_number() OVER (PARTITION BY mid, logdate ORDER BY ts) AS rn FROM (
      SELECT *, strftime(epoch_ms(ts), '%Y-%m-%d') AS logdate, strftime(epoch_ms(ts), '%H') AS loghour
      FROM startup)) WHERE rn = 1"""

CTES["orders_clean"] = """
  SELECT id, province_id, consignee, order_comment,
    CASE WHEN consignee_tel IS NOT NULL THEN substr(consignee_tel, 1, 4) || '*******' END AS consignee_tel,
    order_status, payment_way, user_id, img_url, total_amount, expire_time, delivery_address, create_time,
    operate_time, tracking_no, parent_order_id, out_trade_no, trade_body,
    split_part(create_time, ' ', 1) AS create_date,
    split_part(split_part(create_time, ' ', 2), ':', 1) AS create_hour
  FROM order_info"""

_SALE = """
  SELECT d.id AS order_detail_id, o.id AS order_id, o.order_status, o.create_time, o.user_id, d.sku_id, d.sku_name,
    CAST(d.order_price AS DOUBLE) AS sku_price, split_part(o.create_time, ' ', 1) AS dt
  FROM order_info o JOIN order_detail d ON o.id = d.order_id"""


def _within(ttl: int) -> str:
    return f"""
    AND strptime(d.detail_time, '%Y-%m-%d %H:%M:%S')
        BETWEEN strptime(o.create_time, '%Y-%m-%d %H:%M:%S') - INTERVAL {ttl} SECOND
            AND strptime(o.create_time, '%Y-%m-%d %H:%M:%S') + INTERVAL {ttl} SECOND"""


CTES["sale_detail"] = _SALE + _within(100)
CTES["sale_detail_ttl1000"] = _SALE + _within(1000)
CTES["sale_detail_ttl120"] = _SALE + _within(120)

CTES["sale_detail_user"] = f"""
  SELECT s.order_detail_id, s.order_id, s.order_status, s.create_time, s.user_id, s.sku_id,
    u.gender AS user_gender,
    CAST(coalesce(date_diff('day', CAST(u.birthday AS DATE), DATE '{P.AS_OF}') // 365, 0) AS INTEGER) AS user_age,
    u.user_level, s.sku_price, s.sku_name, s.dt
  FROM sale_detail s LEFT JOIN user_latest u ON s.user_id = u.id"""

CTES["search_hits"] = f"""
  SELECT * FROM sale_detail_user
  WHERE dt = '{P.SEARCH_DATE}' AND list_has_any({_TOKENS.format(c='sku_name')}, ['{P.SEARCH_KEYWORD}'])"""

_AFTER = "'{{' || array_to_string(list_transform(after, lambda x: '\"' || x.name || '\":' || " \
         "CASE WHEN x.value IS NULL THEN 'null' ELSE '\"' || x.value || '\"' END), ',') || '}}'"


def _after(*cols: str, **render: str) -> str:
    items = ", ".join(f"{{'name': '{c}', 'value': CAST({render.get(c, c)} AS VARCHAR)}}" for c in cols)
    return f"[{items}]"


CTES["change_log"] = f"""
  SELECT 'shop.' || table_name AS db_table, * FROM (
    SELECT 'order_info' AS table_name,
      CASE WHEN CAST(id AS BIGINT) % 20 = 7 THEN 'TRANSACTIONEND' ELSE 'ROWDATA' END AS entry_type,
      CASE WHEN CAST(id AS BIGINT) % 10 = 0 THEN 'UPDATE' ELSE 'INSERT' END AS event_type,
      {_after('id', 'province_id', 'consignee', 'consignee_tel', 'order_status', 'payment_way', 'user_id',
              'total_amount', 'create_time', total_amount='CAST(total_amount AS DECIMAL(18,2))')} AS after
    FROM order_info
    UNION ALL
    SELECT 'order_detail',
      CASE WHEN (CAST(order_id AS BIGINT) + CAST(split_part(id, '-', 2) AS BIGINT)) % 20 = 7
           THEN 'TRANSACTIONEND' ELSE 'ROWDATA' END,
      'INSERT',
      {_after('id', 'order_id', 'sku_name', 'sku_id', 'order_price', 'sku_num')}
    FROM order_detail
    UNION ALL
    SELECT 'user_info',
      CASE WHEN (CAST(id AS BIGINT) * 3 + seq) % 20 = 7 THEN 'TRANSACTIONEND' ELSE 'ROWDATA' END,
      CASE WHEN CAST(id AS BIGINT) % 25 = 0 AND seq = 1 + CAST(id AS BIGINT) % 3 THEN 'DELETE'
           WHEN seq > 1 THEN 'UPDATE' ELSE 'INSERT' END,
      {_after('id', 'login_name', 'user_level', 'birthday', 'gender')}
    FROM user_log)"""

CTES["doc_versions"] = """
  SELECT concat_ws('-', mid, CAST(ts // 60000 AS VARCHAR)) AS doc_id, batch_id, ts, mid, uid, evid,
    evid || '#' || CAST(batch_id AS VARCHAR) AS note
  FROM (SELECT *, unnest(generate_series(1, 2 + event_id % 2)) AS batch_id FROM (
    SELECT event_id, """ + _EVENT_COLS + """ FROM events))"""

# every CTE's dependencies, in definition order
_DEPS = {
    "startup": [], "event_log": [], "raw_logs": ["startup"], "order_info": [], "order_detail": [],
    "user_log": [], "user_latest": ["user_log"], "dau": ["startup"], "orders_clean": ["order_info"],
    "sale_detail": ["order_info", "order_detail"], "sale_detail_ttl1000": ["order_info", "order_detail"],
    "sale_detail_ttl120": ["order_info", "order_detail"],
    "sale_detail_user": ["sale_detail", "user_latest"], "search_hits": ["sale_detail_user"],
    "change_log": ["order_info", "order_detail", "user_log"], "doc_versions": [],
}


def _with(*names: str) -> str:
    order: list[str] = []

    def visit(n: str) -> None:
        for d in _DEPS[n]:
            visit(d)
        if n not in order:
            order.append(n)
    for n in names:
        visit(n)
    return "WITH " + ",\n".join(f"{n} AS ({CTES[n]})" for n in order) + "\n"


def _compare(cte: str, day: str, hour: str, date: str, value: str | None, typ: str) -> str:
    from shoplens.operators.dashboard import _yesterday
    y = _yesterday(date)
    if value is None:
        t, yv = f"count(*) FILTER (WHERE {day} = '{date}')", f"count(*) FILTER (WHERE {day} = '{y}')"
    else:
        t = f"CAST(sum(CASE WHEN {day} = '{date}' THEN CAST({value} AS DECIMAL(18,2)) END) AS DOUBLE)"
        yv = f"CAST(sum(CASE WHEN {day} = '{y}' THEN CAST({value} AS DECIMAL(18,2)) END) AS DOUBLE)"
    return _with(cte) + f""",
  axis AS (SELECT lpad(CAST(h AS VARCHAR), 2, '0') AS hour FROM range(24) t(h)),
  agg AS (SELECT {hour} AS hour, {t} AS today, {yv} AS yesterday FROM {cte}
          WHERE {day} IN ('{date}', '{y}') GROUP BY {hour})
SELECT axis.hour, CAST(coalesce(agg.today, 0) AS {typ}) AS today, CAST(coalesce(agg.yesterday, 0) AS {typ}) AS yesterday
FROM axis LEFT JOIN agg ON axis.hour = agg.hour"""


def _hour_map(cte: str, day: str, hour: str, date: str, value: str | None) -> str:
    from shoplens.operators.dashboard import _yesterday
    y = _yesterday(date)
    v = "CAST(count(*) AS DECIMAL(18,2))" if value is None else f"sum(CAST({value} AS DECIMAL(18,2)))"
    return _with(cte) + f""",
  per AS (SELECT {day} AS day, {hour} AS hour, {v} AS v FROM {cte} WHERE {day} IN ('{date}', '{y}') GROUP BY 1, 2)
SELECT CASE WHEN day = '{date}' THEN 'today' ELSE 'yesterday' END AS which, day,
  string_agg(hour || ':' || CAST(v AS VARCHAR), ',' ORDER BY hour) AS hour_text, count(*) AS n_hours
FROM per GROUP BY day"""


_ALERT_EVENT_IDS = ("addCart", "addComment", "addFavor", "clickItem", "coupon", "share")


def _alert(min_uids: int, window: int = 300, slide: int = 5) -> str:
    counts = ", ".join(f"count(*) FILTER (WHERE evid = '{e}') AS n_{e}" for e in _ALERT_EVENT_IDS)
    text = ", ".join(f"CASE WHEN n_{e} > 0 THEN '{e}:' || CAST(n_{e} AS VARCHAR) END" for e in _ALERT_EVENT_IDS)
    return _with("event_log") + f""",
  win AS (SELECT mid, uid, evid, itemid, (ts // {slide * 1000}) * {slide * 1000} - k * {slide * 1000} AS wstart
          FROM event_log, range(0, {window // slide}) r(k)),
  folded AS (
    SELECT mid, wstart, wstart + {window * 1000} AS wend,
      string_agg(DISTINCT uid, ',' ORDER BY uid) FILTER (WHERE evid = 'coupon') AS uids,
      string_agg(DISTINCT itemid, ',' ORDER BY itemid) FILTER (WHERE evid = 'coupon') AS item_ids,
      count(DISTINCT uid) FILTER (WHERE evid = 'coupon') AS n_uids,
      coalesce(bool_or(evid = 'clickItem'), false) AS has_click,
      count(*) AS n_events, {counts}
    FROM win GROUP BY mid, wstart),
  fired AS (
    SELECT concat_ws('-', mid, CAST(wend // 60000 AS VARCHAR)) AS doc_id,
      'coupon_alert-' || strftime(epoch_ms(wend), '%Y-%m-%d') AS index_name,
      mid, wstart AS window_start, wend AS ts, uids, item_ids, n_uids, concat_ws(',', {text}) AS events, n_events
    FROM folded WHERE n_uids >= {min_uids} AND NOT has_click)
SELECT doc_id, index_name, mid, window_start, ts, uids, item_ids, n_uids, events, n_events FROM (
  SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY ts DESC) AS rn FROM fired) WHERE rn = 1"""


_ORDER_COLS = ("id", "province_id", "consignee", "order_comment", "consignee_tel", "order_status", "payment_way",
               "user_id", "img_url", "total_amount", "expire_time", "delivery_address", "create_time", "operate_time",
               "tracking_no", "parent_order_id", "out_trade_no", "trade_body")


def _orders_upper(mask: str) -> str:
    masks = {"prefix4": "substr(consignee_tel, 1, 4) || '*******'",
             "middle4": "substr(consignee_tel, 1, 3) || '****' || substr(consignee_tel, 8)"}
    derived = {
        "consignee_tel": f"CASE WHEN consignee_tel IS NOT NULL THEN {masks[mask]} END",
        "create_date": "split_part(create_time, ' ', 1)",
        "create_hour": "split_part(split_part(create_time, ' ', 2), ':', 1)",
    }
    cols = [f'{derived.get(c, c)} AS "{c.upper()}"' for c in _ORDER_COLS + ("create_date", "create_hour")]
    return _with("order_info") + "SELECT " + ", ".join(cols) + " FROM order_info"


def _page() -> str:
    return _with("search_hits") + f"""
SELECT *, (SELECT count(*) FROM search_hits) AS total FROM search_hits
ORDER BY dt, order_detail_id LIMIT {P.PAGE_SIZE} OFFSET {P.PAGE_START}"""


def _ranked() -> str:
    """BM25 of every document, k1 = 1.2 and b = 0.75."""
    asked = ", ".join(f"'{t}'" for t in P.RANKED_QUERY.split())
    return f"""
WITH words AS (SELECT doc_id, list_filter({_TOKENS.format(c='text')}, lambda w: w <> '') AS words FROM documents WHERE text IS NOT NULL),
docs AS (SELECT doc_id, words, len(words) AS length FROM words WHERE len(words) > 0),
totals AS (SELECT count(*) AS n_docs, sum(length) / count(*) AS mean FROM docs),
asked AS (SELECT unnest([{asked}]) AS token),
hits AS (SELECT doc_id, token, length, len(list_filter(words, lambda w: w = token)) AS tf FROM docs CROSS JOIN asked WHERE list_contains(words, token)),
dfs AS (SELECT token, count(*) AS df FROM hits GROUP BY token),
scores AS (
  SELECT doc_id, CAST(sum(ln(1 + (n_docs - df + 0.5::DOUBLE) / (df + 0.5::DOUBLE))
    * (tf * 2.2::DOUBLE / (tf + 1.2::DOUBLE * (0.25::DOUBLE + 0.75::DOUBLE * length / mean)))) AS DECIMAL(18,6)) AS score
  FROM hits JOIN dfs USING (token) CROSS JOIN totals GROUP BY doc_id)
SELECT row_number() OVER (ORDER BY score DESC, doc_id) AS rank, doc_id, CAST(score AS DOUBLE) AS score
FROM scores ORDER BY score DESC, doc_id LIMIT {P.TOP_N}"""


def _share(key_expr: str, key: str) -> str:
    return _with("sale_detail_user") + f"""
SELECT {key}, n, n / sum(n) OVER () AS share FROM (
  SELECT {key_expr} AS {key}, count(*) AS n FROM sale_detail_user GROUP BY 1)"""


_RAW_LOG_COLS = ("type", "mid", "uid", "appid", "area", "os", "ch", "vs", "evid", "pgid", "npgid", "itemid")


def _archive() -> str:
    # a JSON object of the non-null fields in column order, as Spark's to_json writes it
    fields = ", ".join(f"""CASE WHEN {c} IS NOT NULL THEN '"{c}":' || CAST(to_json({c}) AS VARCHAR) END"""
                       for c in _RAW_LOG_COLS)
    return _with("raw_logs") + f"""
SELECT strftime(epoch_ms(ts), '%Y-%m-%d') AS dt,
  '{{' || concat_ws(',', {fields}, '"ts":' || CAST(ts AS VARCHAR)) || '}}' AS value
FROM raw_logs"""


def _order_json() -> str:
    """An order as one JSON object of its non-null fields, as Spark's to_json writes it."""
    fields = ", ".join(f"""CASE WHEN {c} IS NOT NULL THEN '"{c}":' || CAST(to_json({c}) AS VARCHAR) END""" for c in _ORDER_COLS)
    return f"('{{{{' || concat_ws(',', {fields}) || '}}}}')".replace("{{", "{").replace("}}", "}")


def oracle_sql() -> dict[str, str]:
    d, nd, od = P.EVENT_DATE, P.NEW_DEVICE_DATE, P.ORDER_DATE
    out = {
        "dau_first_log": _with("dau") + "SELECT * FROM dau",
        "dau_first_log_window": _with("dau") + "SELECT * FROM dau",
        "dau_total": _with("dau") + f"SELECT '{d}' AS logdate, count(*) AS dau FROM dau WHERE logdate = '{d}'",
        "dau_hours": _with("dau") + f"SELECT loghour, count(*) AS dau FROM dau WHERE logdate = '{d}' GROUP BY loghour",
        "dau_seen_filter": _with("startup") + """,
  logs AS (SELECT *, strftime(epoch_ms(ts), '%Y-%m-%d') AS logdate, strftime(epoch_ms(ts), '%H') AS loghour
           FROM startup),
  afternoon AS (SELECT * FROM logs l WHERE loghour >= '12' AND NOT EXISTS (
    SELECT 1 FROM logs m WHERE m.loghour < '12' AND m.mid = l.mid AND m.logdate = l.logdate))
SELECT mid, logdate, loghour, ts, uid FROM (
  SELECT *, row_number() OVER (PARTITION BY mid, logdate ORDER BY ts) AS rn FROM afternoon) WHERE rn = 1""",
        "dau_new_devices": _with("dau") + f"""
SELECT '{nd}' AS logdate, count(*) AS new_mid FROM (
  SELECT mid, min(logdate) AS first_day FROM dau WHERE logdate <= '{nd}' GROUP BY mid) WHERE first_day = '{nd}'""",
        "dau_compare_hours": _compare("dau", "logdate", "loghour", d, None, "BIGINT"),
        "dau_hour_map": _hour_map("dau", "logdate", "loghour", d, None),
        "orders_clean": _orders_upper("prefix4"),
        "orders_clean_middle4": _orders_upper("middle4"),
        "gmv_total": _with("orders_clean") + f"""
SELECT '{od}' AS create_date, CAST(sum(CAST(total_amount AS DECIMAL(18,2))) AS DOUBLE) AS gmv
FROM orders_clean WHERE create_date = '{od}'""",
        "gmv_hours": _with("orders_clean") + f"""
SELECT create_hour, CAST(sum(CAST(total_amount AS DECIMAL(18,2))) AS DOUBLE) AS gmv
FROM orders_clean WHERE create_date = '{od}' GROUP BY create_hour""",
        "gmv_compare_hours": _compare("orders_clean", "create_date", "create_hour", od, "total_amount", "DOUBLE"),
        "gmv_hour_map": _hour_map("orders_clean", "create_date", "create_hour", od, "total_amount"),
        "kpi_total": _with("dau", "orders_clean") + f"""
SELECT 'dau' AS id, '新增日活' AS name, CAST(count(*) AS DOUBLE) AS value FROM dau WHERE logdate = '{d}'
UNION ALL
SELECT 'new_mid', '新增设备', CAST(count(*) AS DOUBLE) FROM (
  SELECT mid, min(logdate) AS first_day FROM dau WHERE logdate <= '{d}' GROUP BY mid) WHERE first_day = '{d}'
UNION ALL
SELECT 'order_amount', 'GMV', CAST(sum(CAST(total_amount AS DECIMAL(18,2))) AS DOUBLE)
FROM orders_clean WHERE create_date = '{od}'""",
        "coupon_alert": _alert(3),
        "coupon_alert_naive": _alert(3),
        "coupon_alert_panes": _alert(3),
        "coupon_alert_two_phase": _alert(3),
        "coupon_alert_strict": _alert(4),
        "alert_preview": f"SELECT * FROM ({_alert(3)}) ORDER BY doc_id LIMIT {P.PREVIEW_ROWS}",
        "order_detail_pairs": _with("order_info", "order_detail") + """
SELECT coalesce(o.id, d.order_id) AS order_id, d.id AS order_detail_id,
  CASE WHEN o.id IS NOT NULL AND d.order_id IS NOT NULL THEN 'both'
       WHEN o.id IS NOT NULL THEN 'order_only' ELSE 'detail_only' END AS match_state
FROM order_info o FULL JOIN order_detail d ON o.id = d.order_id""",
        "sale_detail": _with("sale_detail") + "SELECT * FROM sale_detail",
        "sale_detail_ttl1000": _with("sale_detail_ttl1000") + "SELECT * FROM sale_detail_ttl1000",
        "sale_detail_all": _with("order_info", "order_detail") + _SALE,
        "user_latest": _with("user_latest") + "SELECT * FROM user_latest",
        "sale_detail_user": _with("sale_detail_user") + "SELECT * FROM sale_detail_user",
        "sale_search": _with("search_hits") + "SELECT * FROM search_hits",
        "sale_search_page": _page(),
        "gender_share": _share("user_gender", "user_gender"),
        "age_share": _share("CASE WHEN user_age < 20 THEN 'under_20' WHEN user_age <= 30 THEN '20_30' "
                            "ELSE 'over_30' END", "age_band"),
        "region_sales": _with("order_info") + """,
  per AS (SELECT province_id, count(*) AS n_orders,
                 CAST(sum(CAST(total_amount AS DECIMAL(18,2))) AS DOUBLE) AS amount
          FROM order_info GROUP BY province_id),
  dim AS (SELECT CAST(n_nationkey AS VARCHAR) AS province_id, n_name, r_name
          FROM nation LEFT JOIN region ON n_regionkey = r_regionkey)
SELECT per.province_id, dim.n_name, dim.r_name, per.n_orders, per.amount,
  CAST(floor(per.n_orders / 100) * 100 AS BIGINT) AS class_lo
FROM per LEFT JOIN dim ON per.province_id = dim.province_id""",
        "product_top": _with("order_detail") + f"""
SELECT sku_name, CAST(sum(CAST(sku_num AS BIGINT)) AS BIGINT) AS num FROM order_detail
GROUP BY sku_name ORDER BY num DESC, sku_name ASC LIMIT {P.TOP_N}""",
        "match_search": f"""
WITH hits AS (SELECT * FROM customer
  WHERE list_has_any({_TOKENS.format(c='c_mktsegment')}, ['building', 'machinery']))
SELECT *, (SELECT count(*) FROM hits) AS total FROM hits ORDER BY c_custkey LIMIT {P.TOP_N}""",
        "match_max": f"""
SELECT count(*) AS total, max(c_acctbal) AS max_c_acctbal FROM customer
WHERE list_has_any({_TOKENS.format(c='c_mktsegment')}, ['building', 'machinery'])""",
        "route_logs": _with("raw_logs") + """
SELECT CASE WHEN type = 'startup' THEN 'TOPIC_START' ELSE 'TOPIC_EVENT' END AS topic, type, mid, uid, evid, ts
FROM raw_logs""",
        "raw_archive": _archive(),
        "route_changes": _with("change_log") + f""",
  routed AS (
    SELECT CASE WHEN table_name = 'order_info' AND event_type = 'INSERT' THEN 'TOPIC_ORDER_INFO'
                WHEN table_name = 'order_detail' AND event_type = 'INSERT' THEN 'TOPIC_ORDER_DETAIL'
                WHEN table_name = 'user_info' AND event_type IN ('INSERT', 'UPDATE') THEN 'TOPIC_USER_INFO'
           END AS topic, table_name, event_type, after
    FROM change_log WHERE entry_type = 'ROWDATA' AND starts_with(db_table, 'shop.'))
SELECT topic, table_name, event_type, after[1].value AS row_id, {_AFTER.format()} AS value
FROM routed WHERE topic IS NOT NULL""",
        "parse_json": _with("order_info") + "SELECT * FROM order_info WHERE CAST(id AS BIGINT) % 100 <> 0",
        "parse_json_quarantine": _with("order_info") + f"""
SELECT CAST(length({_order_json()}) // 2 AS BIGINT) AS n_chars, substr({_order_json()}, 1, 20) AS head
FROM order_info WHERE CAST(id AS BIGINT) % 100 = 0""",
        "latest_documents": _with("doc_versions") + """
SELECT doc_id, batch_id, ts, mid, uid, evid, note FROM (
  SELECT *, row_number() OVER (PARTITION BY doc_id
    ORDER BY batch_id DESC, ts DESC, mid DESC, uid DESC, evid DESC, note DESC) AS rn FROM doc_versions) WHERE rn = 1""",
    }
    wide = (P.WIDE_WINDOW_SECONDS, P.WIDE_SLIDE_SECONDS)
    out["coupon_alert_strict_wide"] = _alert(4, *wide)
    out["alert_preview_wide"] = f"SELECT * FROM ({_alert(3, *wide)}) ORDER BY doc_id LIMIT {P.PREVIEW_ROWS}"
    out["order_detail_pairs_since"] = _with("order_info", "order_detail") + f"""
SELECT coalesce(o.id, d.order_id) AS order_id, d.id AS order_detail_id,
  CASE WHEN o.id IS NOT NULL AND d.order_id IS NOT NULL THEN 'both'
       WHEN o.id IS NOT NULL THEN 'order_only' ELSE 'detail_only' END AS match_state
FROM (SELECT * FROM order_info WHERE split_part(create_time, ' ', 1) >= '{P.PAIRS_FROM}') o
FULL JOIN order_detail d ON o.id = d.order_id"""
    out["sale_detail_ttl120"] = _with("sale_detail_ttl120") + "SELECT * FROM sale_detail_ttl120"
    out["sale_search_level"] = _with("sale_detail_user") + f"""
SELECT * FROM sale_detail_user WHERE user_level = '{P.SEARCH_LEVEL}'
  AND list_has_any({_TOKENS.format(c='sku_name')}, ['{P.SEARCH_KEYWORD}'])"""
    routed = "CAST(id AS BIGINT) % 20 <> 7 AND CAST(id AS BIGINT) % 10 <> 0"
    out["chain_gmv"] = _with("orders_clean") + f"""
SELECT create_hour, CAST(sum(CAST(total_amount AS DECIMAL(18,2))) AS DOUBLE) AS gmv
FROM orders_clean WHERE create_date = '{od}' AND {routed} GROUP BY create_hour"""
    routed_pair = """
  AND CAST(o.id AS BIGINT) % 20 <> 7 AND CAST(o.id AS BIGINT) % 10 <> 0
  AND (CAST(d.order_id AS BIGINT) + CAST(split_part(d.id, '-', 2) AS BIGINT)) % 20 <> 7"""
    out["chain_sale_detail"] = _with("order_info", "order_detail") + _SALE + _within(100) + routed_pair
    routed_users = """
  SELECT *, row_number() OVER (PARTITION BY id ORDER BY seq DESC) AS rn FROM user_log
  WHERE (CAST(id AS BIGINT) * 3 + seq) % 20 <> 7 AND NOT (CAST(id AS BIGINT) % 25 = 0 AND seq = 1 + CAST(id AS BIGINT) % 3)
"""
    out["chain_user_latest"] = _with("user_log") + f"""
SELECT id, login_name, user_level, birthday, gender, seq FROM ({routed_users}) WHERE rn = 1"""
    # the same two chains, joined
    out["chain_sale_detail_user"] = _with("order_info", "order_detail", "user_log") + f""", sale_detail AS ({_SALE}{_within(100)}{routed_pair}
), user_latest AS (SELECT * FROM ({routed_users}) WHERE rn = 1)
""" + CTES["sale_detail_user"]
    out["sale_search_deep_page"] = f"""
WITH hits AS ({out["sale_search_level"]})
SELECT *, (SELECT count(*) FROM hits) AS total FROM hits ORDER BY dt, order_detail_id LIMIT {P.PAGE_SIZE} OFFSET {P.DEEP_START}"""
    out["match_ranked"] = _ranked()
    # the publisher's questions over the stored tables answer exactly what the same questions answer over the
    # tables they were written from
    out["stored_kpi_total"] = out["kpi_total"]
    out["stored_dau_hours"] = out["dau_compare_hours"]
    out["stored_gmv_hours"] = out["gmv_compare_hours"]
    out["rollup_kpi_total"] = out["kpi_total"]
    out["rollup_gmv_hours"] = out["gmv_compare_hours"]
    return out
