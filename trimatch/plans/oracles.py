"""SQL twins of the driver queries, for DuckDB over the benchmark tables.

Written independently of the DataFrame code (plain SQL over the same leg
derivation of FIXTURES.md §3) and used as the correctness oracle: same
column names, measures as DOUBLE, timestamps as ``%Y-%m-%d %H:%M:%S`` text.
"""

from __future__ import annotations

NORM = r"regexp_replace({c}, '\.0$', '')"
TS = "strftime({c}, '%Y-%m-%d %H:%M:%S')"


def _norm(c: str) -> str:
    return NORM.format(c=c)


def _ts(c: str, alias: str | None = None) -> str:
    return f"{TS.format(c=c)} AS {alias or c.split('.')[-1]}"


def _fn(col: str, alias: str | None = None) -> str:
    """First non-NULL value by source position."""
    return f"arg_min({col}, src_pos) FILTER (WHERE {col} IS NOT NULL) AS {alias or col}"


BASE = """
base AS (
  SELECT l.l_orderkey AS k, l.l_partkey AS p, l.l_linenumber AS ln, l.l_suppkey AS sk,
         l.l_returnflag AS rf, l.l_linestatus AS ls, l.l_shipdate AS sd, o.o_orderdate AS od,
         o.o_orderstatus AS st, o.o_orderpriority AS pr, c.c_mktsegment AS seg, c.c_name AS cname,
         lpad(CAST(l.l_orderkey AS VARCHAR), 10, '0') AS kk,
         c.c_mktsegment IN ('BUILDING', 'MACHINERY') AS dms,
         CAST(l.l_quantity AS DECIMAL(18,2)) AS qty,
         CAST(round(CAST(l.l_extendedprice AS DECIMAL(12,2)) * (1 - CAST(l.l_discount AS DECIMAL(4,2))), 2) AS DECIMAL(18,2)) AS amt,
         CAST(l.l_extendedprice AS DECIMAL(18,2)) AS price,
         CAST(l.l_linenumber AS BIGINT) * 1000000000000000 + l.l_suppkey * 100000
           + CAST(CAST(l.l_quantity AS DECIMAL(18,2)) * 100 AS BIGINT) AS src_pos
  FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
  JOIN customer c ON o.o_custkey = c.c_custkey),
ord AS (
  SELECT CAST(k AS VARCHAR) AS platform_order_no, CAST(NULL AS VARCHAR) AS main_order_no,
         'DD' || kk AS sale_order_no, CASE WHEN dms THEN CAST(k AS VARCHAR) END AS external_order_no,
         CASE WHEN pr = '1-URGENT' THEN 'liquid_milk_order' WHEN pr = '2-HIGH' THEN 'factory_item'
              WHEN pr = '3-MEDIUM' THEN 'oem_order' WHEN pr = '4-NOT SPECIFIED' THEN 'oem_order'
              ELSE 'gift_order' END AS order_type,
         CASE WHEN st = 'P' THEN CASE WHEN k % 5 = 0 THEN 'CANCEL' WHEN k % 5 = 1 THEN 'OBSOLETE'
              WHEN k % 5 = 2 THEN NULL ELSE st END ELSE st END AS order_status,
         od AS create_time, sd AS update_time,
         CASE WHEN seg = 'BUILDING' THEN 'DMS-BUILDING' WHEN seg = 'MACHINERY' THEN 'dms-machinery'
              ELSE 'OMS-' || seg END AS channel_name,
         CAST(p AS VARCHAR) || CASE WHEN ln % 2 = 0 THEN '.0' ELSE '' END AS item_code,
         CASE WHEN month(od) > 9 THEN price END AS line_amount,
         amt AS pay_amount, qty AS item_num, CAST(NULL AS VARCHAR) AS channel_name2,
         CASE WHEN month(od) > 9 THEN 'orders_10_12.sql' ELSE 'orders_01_09.sql' END AS src_file, src_pos
  FROM base),
dlv AS (
  SELECT CASE WHEN rf = 'R' THEN 'RETURN' ELSE 'SHIP' END AS business_type,
         CASE WHEN k % 2 = 0 THEN 'DD' || kk END AS main_no,
         CASE WHEN k % 2 = 0 THEN 'SUB' || kk ELSE 'DD' || kk END AS order_no,
         CASE WHEN dms THEN CAST(k AS VARCHAR) END AS external_order_no,
         sd AS biz_time, CAST(p AS VARCHAR) AS item_code, 'part-' || CAST(p AS VARCHAR) AS item_name,
         CAST(CASE WHEN p % 17 = 0 THEN qty - 1 ELSE qty END AS DECIMAL(18,2)) AS shipped_qty,
         CASE WHEN month(sd) > 9 THEN 'delivery_10_12.sql' ELSE 'delivery_01_09.sql' END AS src_file, src_pos
  FROM base WHERE (k + p) % 10 <> 0),
{inv_name} AS (
  SELECT CASE WHEN NOT dms THEN 'DD' || kk END AS oms_order_no,
         CASE WHEN dms THEN CAST(k AS VARCHAR) END AS dms_order_no,
         CAST(p AS VARCHAR) AS item_code,
         CASE WHEN rf = 'A' THEN '{A}' WHEN rf = 'N' THEN '{N}' WHEN rf = 'R' THEN '{R}' END AS invoice_type,
         CAST(1240 + 10 * (sk % 5) AS VARCHAR) AS sales_org,
         CAST(1000 + sk % 3 AS VARCHAR) AS company_code,
         'INV' || kk || '-' || CAST(ln AS VARCHAR) AS invoice_no,
         cname AS customer_name, 'part-' || CAST(p AS VARCHAR) AS item_name,
         CASE WHEN rf = 'N' THEN 'return' END AS remark, sd AS invoice_date,
         CAST(CASE WHEN p % 7 = 0 THEN amt + 5 WHEN p % 11 = 0 THEN amt + 0.50 ELSE amt END AS DECIMAL(18,2)) AS amount,
         qty, qty AS qty_sales_unit, qty AS qty_base_unit,
         'invoice_' || strftime(sd, '%Y-%m') AS src_file, src_pos
  FROM base WHERE (k + 2 * p) % 13 <> 0)"""

TEXT_TYPES = dict(A="标准发票（2B)", N="标准退货发票", R="标准发票（2C)")
CODE_TYPES = dict(A="ZA01", N="ZB02", R="ZC09")
LEGS = BASE.replace("{inv_name}", "inv").format(**TEXT_TYPES)
CODE_INV = BASE[BASE.index("{inv_name} AS ("):].replace("{inv_name}", "inv_code").format(**CODE_TYPES)


def adaptive_type_filter(src: str, name: str) -> str:
    return f"""
{name} AS (
  SELECT * FROM {src}
  WHERE CASE WHEN (SELECT avg(CASE WHEN regexp_full_match(invoice_type, '[A-Z]{{2}}[0-9]{{2}}') THEN 1.0 ELSE 0.0 END) FROM {src}) > 0.5
             THEN invoice_type IN ('ZA01', 'ZB02', 'ZB06')
             ELSE regexp_matches(invoice_type, '标准发票\\s*[（(]?\\s*2B') OR contains(invoice_type, '标准退货发票') END)"""


def oms_ctes(p: str = "oms", normalize: bool = True, period: tuple[str, str] | None = None) -> str:
    item = _norm("item_code") if normalize else "item_code"
    o_win = d_win = ""
    if period:
        o_win = f" AND create_time >= TIMESTAMP '{period[0]}' AND create_time < TIMESTAMP '{period[1]}'"
        d_win = f" WHERE biz_time >= TIMESTAMP '{period[0]}' AND biz_time < TIMESTAMP '{period[1]}'"
    return f"""
{p}_of AS (
  SELECT * FROM ord
  WHERE (order_status IS NULL OR order_status NOT IN ('OBSOLETE', 'CANCEL'))
    AND order_type IN ('liquid_milk_order', 'factory_item', 'oem_order'){o_win}),
{p}_o AS (
  SELECT k_order AS order_no, k_item AS item_code,
         COALESCE(SUM(pay_amount), 0) AS order_amount, COALESCE(SUM(item_num), 0) AS order_qty,
         {_fn('order_status', 'ord_order_status')}, {_fn('create_time', 'ord_create_time')}
  FROM (SELECT *, sale_order_no AS k_order, {item} AS k_item FROM {p}_of) t
  WHERE k_order IS NOT NULL AND k_item IS NOT NULL GROUP BY k_order, k_item),
{p}_d AS (
  SELECT k_order AS order_no, k_item AS item_code, COALESCE(SUM(shipped_qty), 0) AS shipped_qty,
         {_fn('order_no', 'dlv_order_no')}, {_fn('biz_time', 'dlv_biz_time')}
  FROM (SELECT *, CASE WHEN starts_with(main_no, 'DD') THEN main_no ELSE order_no END AS k_order,
               {item} AS k_item FROM dlv{d_win}) t
  WHERE k_order IS NOT NULL AND k_item IS NOT NULL GROUP BY k_order, k_item),
{p}_i AS (
  SELECT k_order AS order_no, k_item AS item_code,
         COALESCE(SUM(amount), 0) AS invoice_amount, COALESCE(SUM(qty), 0) AS invoice_qty,
         {_fn('sales_org', 'inv_sales_org')}, {_fn('invoice_no', 'inv_invoice_no')},
         {_fn('dms_order_no', 'inv_dms_order_no')}
  FROM (SELECT *, oms_order_no AS k_order, {item} AS k_item FROM inv_f WHERE oms_order_no IS NOT NULL) t
  WHERE k_item IS NOT NULL GROUP BY k_order, k_item),
{p}_j AS (
  SELECT i.*, d.shipped_qty, d.dlv_order_no, d.dlv_biz_time,
         o.order_amount, o.order_qty, o.ord_order_status, o.ord_create_time,
         o.order_qty - d.shipped_qty AS order_minus_shipped_qty,
         o.order_qty - i.invoice_qty AS order_minus_invoice_qty,
         d.shipped_qty - i.invoice_qty AS shipped_minus_invoice_qty,
         round(o.order_amount - i.invoice_amount, 2) AS order_minus_invoice_amount
  FROM {p}_i i LEFT JOIN {p}_d d USING (order_no, item_code) LEFT JOIN {p}_o o USING (order_no, item_code)),
{p}_c AS (
  SELECT *, CASE
    WHEN order_amount IS NULL OR order_qty IS NULL OR shipped_qty IS NULL OR invoice_amount IS NULL OR invoice_qty IS NULL THEN '2.Not test'
    WHEN order_minus_invoice_qty = 0 AND shipped_minus_invoice_qty = 0 AND abs(order_minus_invoice_amount) < 1 THEN '1.1完全匹配'
    WHEN order_minus_invoice_qty = 0 AND shipped_minus_invoice_qty = 0 THEN '1.2金额不一致'
    WHEN abs(order_minus_invoice_amount) < 1 THEN '1.3数量不一致'
    ELSE '1.4均不一致' END AS category
  FROM {p}_j)"""


def dms_ctes(p: str = "dms", normalize: bool = False) -> str:
    item = _norm("item_code") if normalize else "item_code"
    return f"""
{p}_o AS (
  SELECT k_order AS order_no, k_item AS item_code,
         round(COALESCE(SUM(pay_amount), 0), 2) AS order_amount, round(COALESCE(SUM(item_num), 0), 2) AS order_qty,
         {_fn('sale_order_no', 'ord_sale_order_no')}, {_fn('channel_name', 'ord_channel_name')}
  FROM (SELECT *, platform_order_no AS k_order, {item} AS k_item FROM ord
        WHERE contains(upper(channel_name), 'DMS')) t
  WHERE k_order IS NOT NULL AND k_item IS NOT NULL GROUP BY k_order, k_item),
{p}_d AS (
  SELECT k_order AS order_no, k_item AS item_code, round(COALESCE(SUM(shipped_qty), 0), 2) AS shipped_qty,
         {_fn('order_no', 'dlv_order_no')}
  FROM (SELECT *, external_order_no AS k_order, {item} AS k_item FROM dlv WHERE external_order_no IS NOT NULL) t
  WHERE k_item IS NOT NULL GROUP BY k_order, k_item),
{p}_i AS (
  SELECT k_order AS order_no, k_item AS item_code,
         round(COALESCE(SUM(amount), 0), 2) AS invoice_amount,
         round(COALESCE(SUM(qty_sales_unit), 0), 2) AS invoice_qty_sales,
         round(COALESCE(SUM(qty_base_unit), 0), 2) AS invoice_qty,
         {_fn('sales_org', 'inv_sales_org')}, {_fn('invoice_no', 'inv_invoice_no')}, {_fn('src_file', 'inv_src_file')}
  FROM (SELECT *, dms_order_no AS k_order, {item} AS k_item FROM inv
        WHERE contains(invoice_type, '标准发票') AND contains(invoice_type, '2B')
          AND NOT contains(invoice_type, '退货') AND dms_order_no IS NOT NULL) t
  WHERE k_item IS NOT NULL GROUP BY k_order, k_item),
{p}_j AS (
  SELECT i.*, o.order_amount, o.order_qty, o.ord_sale_order_no, o.ord_channel_name,
         d.shipped_qty, d.dlv_order_no,
         round(i.invoice_amount - o.order_amount, 2) AS invoice_minus_order_amount,
         round(i.invoice_qty - o.order_qty, 2) AS invoice_minus_order_qty,
         round(i.invoice_qty - d.shipped_qty, 2) AS invoice_minus_shipped_qty
  FROM {p}_i i LEFT JOIN {p}_o o USING (order_no, item_code) LEFT JOIN {p}_d d USING (order_no, item_code)),
{p}_c AS (
  SELECT *, CASE
    WHEN order_amount IS NULL OR shipped_qty IS NULL THEN '2.Not test'
    WHEN abs(invoice_minus_shipped_qty) < 0.01 AND abs(invoice_minus_order_amount) < 1 THEN '1.1完全匹配'
    WHEN abs(invoice_minus_shipped_qty) < 0.01 THEN '1.2金额不一致'
    WHEN abs(invoice_minus_order_amount) < 1 THEN '1.3数量不一致'
    ELSE '1.4均不一致' END AS category
  FROM {p}_j)"""


INV_F = adaptive_type_filter("inv", "inv_f")


def with_(*ctes: str) -> str:
    return "WITH " + ",".join(c.strip("\n") for c in (LEGS,) + ctes) + "\n"


def summary(src: str, by: str | None = None) -> str:
    sets = f"GROUPING SETS (({by}, category), ({by}))" if by else "ROLLUP (category)"
    lead = f"{by}, " if by else ""
    return f"""SELECT {lead}CASE WHEN GROUPING(category) = 1 THEN '全部数据' ELSE category END AS category,
       COUNT(*) AS n_rows, CAST(COALESCE(SUM(invoice_amount), 0) AS DOUBLE) AS invoice_amount
FROM {src} GROUP BY {sets}"""


def d(c: str, alias: str | None = None) -> str:
    return f"CAST({c} AS DOUBLE) AS {alias or c.split('.')[-1]}"


OMS = oms_ctes()
DMS = dms_ctes()
DMS_NORM = dms_ctes("dmsn", normalize=True)
TO_MAP = """
to_map AS (SELECT * FROM inv_f WHERE oms_order_no IS NULL AND dms_order_no IS NOT NULL),
omap AS (SELECT DISTINCT external_order_no AS ext, regexp_replace(item_code, '\\.0$', '') AS item, sale_order_no AS sale
         FROM oms_of WHERE external_order_no IS NOT NULL),
mapped AS (SELECT t.*, m.sale AS mapped_oms_order_no FROM to_map t
           JOIN omap m ON t.dms_order_no = m.ext AND regexp_replace(t.item_code, '\\.0$', '') = m.item)"""
SCENE = """CASE WHEN invoice_type IN ('标准发票（2C)') THEN 'To C'
     WHEN invoice_type IN ('取消传统贸易发票', '期货贸易发票') THEN '期货'
     WHEN invoice_type IN ('标准发票（2B)', '标准退货发票', '取消标准发票（2B)', '取消标准退货发票') AND dms_order_no IS NULL THEN 'To B (OMS)'
     WHEN invoice_type IN ('标准发票（2B)', '标准退货发票', '取消标准发票（2B)', '取消标准退货发票') THEN 'To B (DMS)'
     ELSE '其他' END"""
ORG_GROUP = ("CASE WHEN regexp_replace(CAST(inv_sales_org AS VARCHAR), '\\.0$', '') IN ('1240', '1250', '1260') "
             "THEN '1240/1250/1260' ELSE 'other' END")

Q: dict[str, str] = {}

Q["oms_category_summary"] = with_(INV_F, OMS) + summary("oms_c")

Q["oms_match_detail"] = with_(INV_F, OMS) + f"""SELECT order_no, item_code, {d('invoice_amount')}, {d('invoice_qty')},
  {d('shipped_qty')}, {d('order_amount')}, {d('order_qty')}, {d('order_minus_shipped_qty')},
  {d('order_minus_invoice_qty')}, {d('shipped_minus_invoice_qty')}, {d('order_minus_invoice_amount')},
  category, ord_order_status, {_ts('ord_create_time')}, dlv_order_no, {_ts('dlv_biz_time')},
  inv_sales_org, inv_invoice_no, inv_dms_order_no FROM oms_c"""

Q["late_months"] = Q["oms_match_detail"]     # kept up to date or matched at once: the same rows

Q["dms_match_detail"] = with_(DMS) + f"""SELECT order_no, item_code, {d('invoice_amount')}, {d('invoice_qty_sales')},
  {d('invoice_qty')}, {d('order_amount')}, {d('order_qty')}, {d('shipped_qty')},
  {d('invoice_minus_order_amount')}, {d('invoice_minus_order_qty')}, {d('invoice_minus_shipped_qty')},
  category, ord_sale_order_no, ord_channel_name, dlv_order_no, inv_sales_org, inv_invoice_no, inv_src_file
FROM dms_c"""

Q["dms_category_summary"] = with_(DMS) + summary("dms_c")
Q["dms_norm_category_summary"] = with_(DMS_NORM) + summary("dmsn_c")

Q["combined_summary"] = with_(INV_F, OMS, DMS, """
both_c AS (SELECT 'OMS' AS source, category, invoice_amount FROM oms_c
           UNION ALL SELECT 'DMS' AS source, category, invoice_amount FROM dms_c)""") + summary("both_c", by="source")

Q["oms_order_agg"] = with_(INV_F, OMS) + f"SELECT order_no, item_code, {d('order_amount')}, {d('order_qty')} FROM oms_o"
Q["oms_delivery_agg"] = with_(INV_F, OMS) + f"SELECT order_no, item_code, {d('shipped_qty')} FROM oms_d"
Q["oms_invoice_agg"] = with_(INV_F, OMS) + f"SELECT order_no, item_code, {d('invoice_amount')}, {d('invoice_qty')} FROM oms_i"
Q["dms_order_agg"] = with_(DMS) + f"SELECT order_no, item_code, {d('order_amount')}, {d('order_qty')} FROM dms_o"
Q["dms_delivery_agg"] = with_(DMS) + f"SELECT order_no, item_code, {d('shipped_qty')} FROM dms_d"
DMS_INV_AGG = f"SELECT order_no, item_code, {d('invoice_amount')}, {d('invoice_qty_sales')}, {d('invoice_qty')} FROM dms_i"
Q["dms_invoice_agg"] = with_(DMS) + DMS_INV_AGG

Q["uninvoiced_lines"] = with_(INV_F, OMS) + f"""SELECT COALESCE(o.order_no, dd.order_no) AS order_no,
  COALESCE(o.item_code, dd.item_code) AS item_code, {d('o.order_amount')}, {d('o.order_qty')}, {d('dd.shipped_qty')},
  CASE WHEN o.order_amount IS NOT NULL AND dd.shipped_qty IS NOT NULL THEN 'order+delivery'
       WHEN dd.shipped_qty IS NOT NULL THEN 'delivery only' ELSE 'order only' END AS legs_present
FROM oms_o o FULL JOIN oms_d dd ON o.order_no = dd.order_no AND o.item_code = dd.item_code
WHERE NOT EXISTS (SELECT 1 FROM oms_i i WHERE i.order_no = COALESCE(o.order_no, dd.order_no)
                                          AND i.item_code = COALESCE(o.item_code, dd.item_code))"""

Q["dms_to_oms_mapping"] = with_(INV_F, OMS, TO_MAP) + f"""SELECT dms_order_no, item_code,
  mapped_oms_order_no AS oms_order_no, invoice_no, {d('amount')}, {d('qty')}, src_pos FROM mapped"""

Q["dms_allocation"] = with_(INV_F, OMS, TO_MAP, """
al_o AS (SELECT CAST(CAST(external_order_no AS BIGINT) // 32 AS VARCHAR) AS ext,
                CAST(CAST(regexp_replace(item_code, '\\.0$', '') AS BIGINT) % 3 AS VARCHAR) AS item, sale_order_no AS sale,
                SUM(item_num) AS r, MIN(src_pos) AS pos
         FROM oms_of WHERE external_order_no IS NOT NULL GROUP BY 1, 2, 3 HAVING SUM(item_num) > 0),
al_oi AS (SELECT *, SUM(r) OVER w - r AS o0, SUM(r) OVER w AS o1 FROM al_o WINDOW w AS (PARTITION BY ext, item ORDER BY pos, sale)),
al_t AS (SELECT ext, item, MAX(o1) AS total FROM al_oi GROUP BY ext, item),
al_i AS (SELECT CAST(CAST(dms_order_no AS BIGINT) // 32 AS VARCHAR) AS ext,
                CAST(CAST(regexp_replace(item_code, '\\.0$', '') AS BIGINT) % 3 AS VARCHAR) AS item, invoice_no, src_pos, amount,
                qty * CASE WHEN src_pos % 5 = 0 THEN -1 WHEN src_pos % 7 = 0 THEN 2 WHEN src_pos % 11 = 0 THEN 0 ELSE 1 END AS qty FROM to_map),
al_iv AS (SELECT *, SUM(abs(qty)) OVER w - abs(qty) AS lo, SUM(abs(qty)) OVER w AS hi FROM al_i WHERE qty <> 0
          WINDOW w AS (PARTITION BY ext, item, sign(qty) ORDER BY src_pos, invoice_no)),
al_p AS (SELECT i.*, o.sale, 'allocated' AS status, greatest(lo, o0) AS a, least(hi, o1) AS b
         FROM al_iv i JOIN al_oi o ON i.ext = o.ext AND i.item = o.item AND lo < o1 AND o0 < hi
         UNION ALL SELECT i.*, NULL, CASE WHEN total IS NULL THEN 'unmapped' ELSE 'over' END, greatest(lo, COALESCE(total, 0)), hi
         FROM al_iv i LEFT JOIN al_t t ON i.ext = t.ext AND i.item = t.item WHERE hi > COALESCE(total, 0)),
al_c AS (SELECT *, CAST(amount * 100 AS HUGEINT) AS c, CAST(abs(qty) * 100 AS HUGEINT) AS q, CAST((a - lo) * 100 AS HUGEINT) AS u,
                CAST((b - lo) * 100 AS HUGEINT) AS v FROM al_p)""") + """SELECT ext AS dms_order_no, item AS item_code, invoice_no, src_pos, sale AS oms_order_no, status,
  CAST((b - a) * sign(qty) AS DOUBLE) AS qty, CAST(CAST(c * v // q - c * u // q AS DECIMAL(18,2)) / 100 AS DOUBLE) AS amount FROM al_c
UNION ALL SELECT ext, item, invoice_no, src_pos, NULL, 'no quantity', 0.0, CAST(amount AS DOUBLE) FROM al_i WHERE COALESCE(qty, 0) = 0"""

Q["invoice_routing"] = with_(INV_F, OMS, TO_MAP) + f"""SELECT route, COUNT(*) AS n_rows, {d('SUM(amount)', 'amount')} FROM (
  SELECT CASE WHEN oms_order_no IS NOT NULL THEN 'direct' WHEN dms_order_no IS NOT NULL THEN 'needs_map'
              ELSE 'unrouted' END AS route, amount FROM inv_f
  UNION ALL SELECT 'mapped' AS route, amount FROM mapped) t GROUP BY route"""

Q["nottest_breakdown"] = with_(INV_F, OMS, """
nt AS (SELECT COUNT(*) FILTER (WHERE (order_amount IS NULL OR order_qty IS NULL) AND shipped_qty IS NOT NULL) AS a,
              COUNT(*) FILTER (WHERE NOT (order_amount IS NULL OR order_qty IS NULL) AND shipped_qty IS NULL) AS b,
              COUNT(*) FILTER (WHERE (order_amount IS NULL OR order_qty IS NULL) AND shipped_qty IS NULL) AS c,
              COUNT(*) AS n
       FROM oms_c WHERE category = '2.Not test')""") + """
SELECT 'order missing' AS missing, a AS n_rows, n AS not_test_rows, CAST(a AS DOUBLE) * 100.0 / CAST(n AS DOUBLE) AS share_pct FROM nt
UNION ALL SELECT 'delivery missing', b, n, CAST(b AS DOUBLE) * 100.0 / CAST(n AS DOUBLE) FROM nt
UNION ALL SELECT 'both missing', c, n, CAST(c AS DOUBLE) * 100.0 / CAST(n AS DOUBLE) FROM nt"""

Q["oms_nottest_rows"] = with_(INV_F, OMS) + f"""SELECT order_no, item_code, {d('invoice_amount')}, {d('invoice_qty')},
  {d('shipped_qty')}, {d('order_amount')}, {d('order_qty')} FROM oms_c WHERE category = '2.Not test'"""

Q["oms_strict_nottest"] = with_(INV_F, oms_ctes("pt", normalize=False, period=("1997-01-01", "1997-10-01")), """
pt_s AS (SELECT *, CASE WHEN order_no IS NULL OR item_code IS NULL OR invoice_amount IS NULL OR invoice_qty IS NULL
    OR shipped_qty IS NULL OR order_amount IS NULL OR order_qty IS NULL OR order_minus_shipped_qty IS NULL
    OR order_minus_invoice_qty IS NULL OR shipped_minus_invoice_qty IS NULL OR order_minus_invoice_amount IS NULL
    THEN '2.Not test' ELSE category END AS category2 FROM pt_c),
pt_x AS (SELECT category2 AS category, invoice_amount FROM pt_s)""") + summary("pt_x")

Q["org_split_summary"] = with_(INV_F, OMS, f"""
org_c AS (SELECT {ORG_GROUP} AS org_group, category, invoice_amount FROM oms_c)""") + summary("org_c", by="org_group")

Q["invoice_scene"] = with_() + f"""SELECT {SCENE} AS scene, COUNT(*) AS n_rows, {d('SUM(amount)', 'amount')}
FROM inv GROUP BY 1"""

Q["invoice_type_counts"] = with_() + """SELECT invoice_type, COUNT(*) AS n_rows FROM inv
WHERE invoice_type IS NOT NULL GROUP BY invoice_type"""

Q["invoice_type_label"] = with_() + """SELECT invoice_type, regexp_replace(invoice_type, '[/\\\\:*?"<>|]', '_', 'g') AS label,
  COUNT(*) AS n_rows FROM inv WHERE invoice_type IS NOT NULL GROUP BY invoice_type"""

Q["order_status_filter"] = with_() + """SELECT order_status, COUNT(*) AS n_rows FROM ord
WHERE order_status IS NULL OR order_status NOT IN ('OBSOLETE', 'CANCEL') GROUP BY order_status"""

Q["order_type_filter"] = with_() + """SELECT order_type, COUNT(*) AS n_rows FROM ord
WHERE order_type IN ('liquid_milk_order', 'factory_item', 'oem_order') GROUP BY order_type"""

Q["period_filter"] = with_() + f"""SELECT leg, month, COUNT(*) AS n_rows, {d('SUM(amount)', 'total')} FROM (
  SELECT 'order' AS leg, CAST(month(create_time) AS BIGINT) AS month, pay_amount AS amount FROM ord
  WHERE create_time >= TIMESTAMP '1998-01-01' AND create_time < TIMESTAMP '1999-01-01'
  UNION ALL
  SELECT 'delivery', CAST(month(biz_time) AS BIGINT), shipped_qty FROM dlv
  WHERE biz_time >= TIMESTAMP '1998-01-01' AND biz_time < TIMESTAMP '1999-01-01') t GROUP BY leg, month"""

Q["dms_order_filter"] = with_() + f"""SELECT channel_name, COUNT(*) AS n_rows, {d('SUM(pay_amount)', 'amount')}
FROM ord WHERE contains(upper(channel_name), 'DMS') GROUP BY channel_name"""

Q["invoice_type_filter_oms"] = with_(INV_F, CODE_INV, adaptive_type_filter("inv_code", "inv_code_f")) + f"""
SELECT variant, invoice_type, COUNT(*) AS n_rows, {d('SUM(amount)', 'amount')} FROM (
  SELECT 'text' AS variant, invoice_type, amount FROM inv_f
  UNION ALL SELECT 'code' AS variant, invoice_type, amount FROM inv_code_f) t GROUP BY variant, invoice_type"""

Q["invoice_type_filter_dms"] = with_() + f"""SELECT invoice_type, COUNT(*) AS n_rows, {d('SUM(amount)', 'amount')}
FROM inv WHERE contains(invoice_type, '标准发票') AND contains(invoice_type, '2B') AND NOT contains(invoice_type, '退货')
GROUP BY invoice_type"""

Q["norm_code"] = with_() + f"""SELECT {_norm('item_code')} AS item_code, COUNT(*) AS n_rows,
  COUNT(*) FILTER (WHERE ends_with(item_code, '.0')) AS rows_with_suffix FROM ord GROUP BY 1"""

Q["delivery_key"] = with_() + f"""SELECT CASE WHEN starts_with(main_no, 'DD') THEN main_no ELSE order_no END AS order_no,
  item_code, {d('shipped_qty')}, src_pos FROM dlv"""

Q["safe_number"] = with_() + f"""SELECT form, COUNT(*) AS n_rows, COUNT(*) FILTER (WHERE v IS NULL) AS null_rows,
  {d('SUM(v)', 'total')} FROM (
  SELECT 'plain' AS form, amount AS v FROM inv
  UNION ALL SELECT 'padded', amount FROM inv
  UNION ALL SELECT 'thousands', CASE WHEN abs(amount) < 1000 THEN amount END FROM inv
  UNION ALL SELECT 'blank', CASE WHEN src_pos % 2 = 0 THEN NULL ELSE amount END FROM inv) t GROUP BY form"""

Q["shift_repair"] = with_("""
sh AS (SELECT CASE WHEN month(biz_time) <= 9 THEN item_code ELSE COALESCE(main_no, order_no) END AS c2,
              CASE WHEN month(biz_time) <= 9 THEN COALESCE(main_no, order_no) ELSE item_code END AS c5,
              CASE WHEN month(biz_time) <= 9 THEN 'early' ELSE 'late' END AS src_file FROM dlv),
fl AS (SELECT src_file, COUNT(*) AS n_rows,
              COUNT(*) FILTER (WHERE regexp_full_match(c2, '[0-9]+')) AS digits_col2,
              COUNT(*) FILTER (WHERE starts_with(c5, 'DD')) AS dd_col5 FROM sh GROUP BY src_file),
fx AS (SELECT fl.*, digits_col2 > n_rows * 0.5 AND dd_col5 > n_rows * 0.5 AS swapped FROM fl)""") + """
SELECT fx.src_file, fx.n_rows, fx.digits_col2, fx.dd_col5, fx.swapped,
       COUNT(*) FILTER (WHERE starts_with(CASE WHEN fx.swapped THEN sh.c5 ELSE sh.c2 END, 'DD')) AS dd_order_no_after
FROM sh JOIN fx ON sh.src_file = fx.src_file
GROUP BY fx.src_file, fx.n_rows, fx.digits_col2, fx.dd_col5, fx.swapped"""

Q["first_value_carry"] = with_() + """SELECT order_no, item_code, first_remark, first_sales_org,
  r.remark AS first_row_remark, r.invoice_no AS first_row_invoice_no FROM (
  SELECT oms_order_no AS order_no, item_code,
         arg_min(remark, src_pos) FILTER (WHERE remark IS NOT NULL) AS first_remark,
         arg_min(sales_org, src_pos) FILTER (WHERE sales_org IS NOT NULL) AS first_sales_org,
         arg_min(struct_pack(remark := remark, invoice_no := invoice_no), src_pos) AS r
  FROM inv WHERE oms_order_no IS NOT NULL GROUP BY oms_order_no, item_code) t"""

Q["order_layout_union"] = with_() + f"""SELECT src_file, COUNT(*) AS n_rows,
  COUNT(*) FILTER (WHERE line_amount IS NOT NULL) AS line_amount_rows,
  COUNT(*) FILTER (WHERE channel_name2 IS NULL) AS channel_name2_null, {d('SUM(pay_amount)', 'pay_amount')}
FROM ord WHERE create_time IS NOT NULL GROUP BY src_file"""

Q["invoice_monthly_union"] = with_() + f"""SELECT src_file, COUNT(*) AS n_rows,
  COUNT(*) FILTER (WHERE month(invoice_date) > 9 OR remark IS NULL) AS remark_null,
  COUNT(*) FILTER (WHERE month(invoice_date) <= 9 OR qty_sales_unit IS NULL) AS qty_sales_unit_null,
  {d('SUM(amount)', 'amount')} FROM inv WHERE invoice_date IS NOT NULL GROUP BY src_file"""

Q["column_resolution"] = with_(DMS) + DMS_INV_AGG

Q["order_ledger"] = with_() + f"""SELECT strftime(create_time, '%Y-%m-%d') AS business_date, platform_order_no,
  sale_order_no, channel_name, item_code, {d('COALESCE(item_num, 0)', 'item_num')},
  {d('round(COALESCE(line_amount, 0), 2)', 'line_amount')}, {d('round(COALESCE(pay_amount, 0), 2)', 'pay_amount')},
  order_type, order_status, {_ts('create_time')}, {_ts('update_time')} FROM ord"""

Q["delivery_ledger"] = with_() + f"""SELECT strftime(biz_time, '%Y-%m-%d') AS business_date, business_type, order_no,
  external_order_no, item_code, item_name, {d('COALESCE(shipped_qty, 0)', 'shipped_qty')}, {_ts('biz_time')} FROM dlv"""

Q["ledger_summary"] = with_("""
ot AS (SELECT COALESCE(SUM(pay_amount), 0) AS amt, COALESCE(SUM(item_num), 0) AS qty, COUNT(*) AS n FROM ord),
dt AS (SELECT COALESCE(SUM(shipped_qty), 0) AS qty, COUNT(*) AS n FROM dlv)""") + """
SELECT '订单总金额' AS item, format('{:,.2f}', CAST(amt AS DOUBLE)) AS value, '元' AS unit FROM ot
UNION ALL SELECT '订单总数量', format('{:,.0f}', CAST(qty AS DOUBLE)), '件' FROM ot
UNION ALL SELECT '订单记录数', format('{:,}', n), '条' FROM ot
UNION ALL SELECT '发货总数量', format('{:,.0f}', CAST(qty AS DOUBLE)), '件' FROM dt
UNION ALL SELECT '发货记录数', format('{:,}', n), '条' FROM dt"""

Q["null_share_by_period"] = with_() + """SELECT period, n_rows, null_rows, CAST(null_rows AS DOUBLE) / CAST(n_rows AS DOUBLE) AS null_share,
  CAST(null_rows AS DOUBLE) / CAST(n_rows AS DOUBLE) > 0.9 AS mostly_null FROM (
  SELECT CASE WHEN month(create_time) <= 9 THEN 'early' ELSE 'late' END AS period, COUNT(*) AS n_rows,
         COUNT(*) FILTER (WHERE line_amount IS NULL) AS null_rows
  FROM ord WHERE create_time IS NOT NULL GROUP BY 1) t"""

Q["match_coverage"] = with_(INV_F, OMS) + """SELECT COUNT(*) AS invoice_keys,
  COUNT(*) FILTER (WHERE order_amount IS NOT NULL) AS with_order,
  COUNT(*) FILTER (WHERE shipped_qty IS NOT NULL) AS with_delivery,
  COUNT(*) FILTER (WHERE category <> '2.Not test') AS tested FROM oms_c"""

Q["oms_flag_counts"] = with_(INV_F, OMS) + """SELECT
  COUNT(*) FILTER (WHERE category = '2.Not test') AS n_not_test,
  COUNT(*) FILTER (WHERE category = '1.1完全匹配') AS n_full_match,
  COUNT(*) FILTER (WHERE category = '1.2金额不一致') AS n_amount_differs,
  COUNT(*) FILTER (WHERE category = '1.3数量不一致') AS n_qty_differs,
  COUNT(*) FILTER (WHERE category = '1.4均不一致') AS n_both_differ FROM oms_c"""

Q["dms_org_split_summary"] = with_(DMS, f"""
dorg_c AS (SELECT {ORG_GROUP} AS org_group, category, invoice_amount FROM dms_c)""") + summary("dorg_c", by="org_group")

Q["dms_match_coverage"] = with_(DMS) + """SELECT COUNT(*) AS invoice_keys,
  COUNT(*) FILTER (WHERE order_amount IS NOT NULL) AS with_order,
  COUNT(*) FILTER (WHERE shipped_qty IS NOT NULL) AS with_delivery,
  COUNT(*) FILTER (WHERE category <> '2.Not test') AS tested FROM dms_c"""

ORD_TEXT = ("platform_order_no, main_order_no, sale_order_no, order_type, order_status, "
            + _ts("create_time") + ", " + _ts("update_time") + ", channel_name, item_code")

Q["dump_orders"] = with_() + f"""SELECT {ORD_TEXT}, {d('line_amount')}, {d('pay_amount')}, {d('item_num')},
  channel_name2, src_file, src_pos FROM ord WHERE month(create_time) <= 9 OR src_pos % 101 <> 0"""

Q["dump_utf16"] = with_() + f"""SELECT {ORD_TEXT.replace('channel_name', "CASE WHEN src_pos % 97 = 0 THEN channel_name || '\u0a05\u4e00' ELSE channel_name END AS channel_name")},
  {d('line_amount')}, {d('pay_amount')}, {d('item_num')}, channel_name2, src_file FROM ord WHERE month(create_time) <= 9 OR src_pos % 101 <> 0"""

Q["dump_rejected"] = with_() + """SELECT 'orders' AS leg, src_file, 12 AS n_values, 'fewer than 13 values' AS reason,
  COUNT(*) AS n_rows FROM ord WHERE month(create_time) > 9 AND src_pos % 101 = 0 GROUP BY src_file"""

Q["dump_profile"] = with_("""
wide AS (SELECT src_file, CASE WHEN month(create_time) <= 9 THEN 11 WHEN src_pos % 101 = 0 THEN 12 ELSE 13 END AS n, FALSE AS swapped FROM ord
         UNION ALL SELECT CASE WHEN month(biz_time) <= 9 THEN 'early' ELSE 'late' END, 7, month(biz_time) <= 9 FROM dlv)""") + """
SELECT src_file, COUNT(*) AS n_rows, COUNT(*) FILTER (WHERE n >= 13) AS late, COUNT(*) FILTER (WHERE n IN (11, 12)) AS early,
  COUNT(*) FILTER (WHERE n >= 8) AS eight, COUNT(*) FILTER (WHERE n = 7) AS seven, COUNT(*) FILTER (WHERE n < 7) AS short,
  COUNT(*) FILTER (WHERE swapped) AS digits_col2, COUNT(*) FILTER (WHERE swapped) AS dd_col5
FROM wide GROUP BY src_file"""

Q["dump_deliveries"] = with_() + f"""SELECT business_type, main_no, order_no, external_order_no, {_ts('biz_time')}, item_code,
  item_name, {d('shipped_qty')}, CASE WHEN main_no IS NULL THEN 7 ELSE 8 END AS layout, src_file, src_pos FROM dlv"""

Q["dump_repair"] = with_() + f"""SELECT business_type, COALESCE(main_no, order_no) AS order_no, external_order_no,
  {_ts('biz_time')}, item_code, item_name, {d('shipped_qty')}, 7 AS layout,
  CASE WHEN month(biz_time) <= 9 THEN 'early' ELSE 'late' END AS src_file, src_pos FROM dlv"""

Q["dump_with_header"] = with_() + f"""SELECT {ORD_TEXT}, CAST(NULL AS DOUBLE) AS line_amount, {d('pay_amount')}, {d('item_num')},
  CAST(NULL AS VARCHAR) AS organization_code, src_file, src_pos FROM ord"""

Q["dump_ledger_totals"] = Q["ledger_summary"]

Q["first_value_two_files"] = with_("""
placed AS (SELECT *, row_number() OVER (PARTITION BY oms_order_no ORDER BY month(invoice_date) % 2, src_pos) AS place
           FROM inv WHERE oms_order_no IS NOT NULL)""") + """
SELECT oms_order_no AS order_no, arg_min(remark, place) FILTER (WHERE remark IS NOT NULL) AS first_remark,
  arg_min(sales_org, place) AS first_sales_org, arg_min(invoice_no, place) AS first_invoice_no
FROM placed GROUP BY oms_order_no"""

Q["leg_accounting"] = with_("""
ord_k AS (SELECT * REPLACE (CASE WHEN src_pos % 37 <> 0 THEN item_code END AS item_code,
                            CASE WHEN src_pos % 53 <> 0 THEN sale_order_no END AS sale_order_no) FROM ord),
dlv_k AS (SELECT * REPLACE (CASE WHEN src_pos % 41 <> 0 THEN item_code END AS item_code) FROM dlv),
inv_k AS (SELECT * REPLACE (CASE WHEN src_pos % 43 <> 0 THEN item_code END AS item_code,
                            CASE WHEN src_pos % 59 <> 0 THEN oms_order_no END AS oms_order_no) FROM inv),
fate AS (
  SELECT 'orders' AS leg, CAST(pay_amount AS DECIMAL(18,2)) AS m, CASE
      WHEN order_status IN ('OBSOLETE', 'CANCEL') THEN 'status'
      WHEN order_type NOT IN ('liquid_milk_order', 'factory_item', 'oem_order') THEN 'order type'
      WHEN create_time IS NULL THEN 'no date'
      WHEN create_time < TIMESTAMP '1998-01-01' OR create_time >= TIMESTAMP '1999-01-01' THEN 'outside period'
      WHEN sale_order_no IS NULL THEN 'no order number' WHEN item_code IS NULL THEN 'no item code' ELSE '' END AS reason
  FROM ord_k
  UNION ALL SELECT 'deliveries', CAST(shipped_qty AS DECIMAL(18,2)), CASE
      WHEN biz_time IS NULL THEN 'no date'
      WHEN biz_time < TIMESTAMP '1998-01-01' OR biz_time >= TIMESTAMP '1999-01-01' THEN 'outside period'
      WHEN order_no IS NULL THEN 'no order number' WHEN item_code IS NULL THEN 'no item code' ELSE '' END
  FROM dlv_k
  UNION ALL SELECT 'invoices', CAST(amount AS DECIMAL(18,2)), CASE
      WHEN NOT (regexp_matches(invoice_type, '标准发票\\s*[（(]?\\s*2B') OR contains(invoice_type, '标准退货发票')) THEN 'invoice type'
      WHEN oms_order_no IS NULL AND dms_order_no IS NOT NULL THEN 'needs map'
      WHEN oms_order_no IS NULL THEN 'no order number' WHEN item_code IS NULL THEN 'no item code' ELSE '' END
  FROM inv_k)""") + f"""
SELECT leg, CASE WHEN reason = '' THEN 'used' WHEN reason IN ('no order number', 'no item code') THEN 'set aside'
                 ELSE 'filtered' END AS outcome, reason, COUNT(*) AS n_rows, {d('SUM(m)', 'measure')}, 0 AS unparsed
FROM fate GROUP BY leg, reason"""

# the same rows where an invoice with a DMS number only takes the orders of that number and item
Q["leg_accounting_mapped"] = (Q["leg_accounting"].replace("fate AS (", """xref AS (
  SELECT external_order_no AS ext, regexp_replace(item_code, '\\.0$', '') AS item, COUNT(DISTINCT sale_order_no) AS n
  FROM ord_k WHERE (order_status IS NULL OR order_status NOT IN ('OBSOLETE', 'CANCEL'))
    AND order_type IN ('liquid_milk_order', 'factory_item', 'oem_order') AND external_order_no IS NOT NULL
    AND create_time >= TIMESTAMP '1998-01-01' AND create_time < TIMESTAMP '1999-01-01'
  GROUP BY 1, 2),
fate AS (""", 1)
    .replace("""THEN 'needs map'""", """THEN
        CASE WHEN item_code IS NULL THEN 'no item code' WHEN coalesce(x.n, 0) = 0 THEN 'unmapped'
             WHEN x.n = 1 THEN 'mapped' ELSE 'mapped to several orders' END""")
    .replace("FROM inv_k)", "FROM inv_k LEFT JOIN xref x ON dms_order_no = x.ext AND regexp_replace(item_code, '\\.0$', '') = x.item)")
    .replace("CASE WHEN reason = '' THEN 'used'", "CASE WHEN reason IN ('', 'mapped', 'mapped to several orders') THEN 'used'"))

Q["norm_code_double"] = """SELECT CAST(l_partkey + 10000000 AS VARCHAR) AS item_code, COUNT(*) AS n_rows
FROM lineitem GROUP BY 1"""

Q["text_dates"] = with_() + """SELECT form, COUNT(*) AS n_rows, COUNT(*) FILTER (WHERE t IS NULL) AS null_rows,
  strftime(min(t), '%Y-%m-%d %H:%M:%S') AS earliest, strftime(max(t), '%Y-%m-%d %H:%M:%S') AS latest FROM (
  SELECT 'iso' AS form, date_trunc('second', create_time) AS t FROM ord
  UNION ALL SELECT 'slash', date_trunc('day', create_time) FROM ord
  UNION ALL SELECT 'compact', date_trunc('day', create_time) FROM ord
  UNION ALL SELECT 'day_first', NULL FROM ord) x GROUP BY form"""

# the seven spellings cut an order date to the minute, the day or the month
Q["text_dates_voted"] = with_("""
spelled AS (
  SELECT form, CASE WHEN form = 'month_only' THEN NULL WHEN form IN ('compact', 'day_first') THEN date_trunc('day', create_time)
                    WHEN form = 'dot' THEN date_trunc('minute', create_time) ELSE create_time END AS t
  FROM ord, unnest(['iso', 'dot', 'compact', 'stamp', 'day_first', 'month_first', 'month_only']) AS f(form))""") + """
SELECT form, COUNT(*) AS n_rows, COUNT(t) AS n_read, strftime(min(t), '%Y-%m-%d %H:%M:%S') AS earliest,
  strftime(max(t), '%Y-%m-%d %H:%M:%S') AS latest, CAST(SUM(dayofyear(t)) AS BIGINT) AS days FROM spelled GROUP BY form"""

Q["date_shapes"] = with_() + """SELECT form, 't' AS "column", shape, COUNT(create_time) AS n_rows,
  CASE WHEN form = 'month_only' THEN COUNT(create_time) ELSE 0 END AS unread
FROM ord, (VALUES ('iso', '9999-99-99 99:99:99'), ('dot', '9999.99.99 99:99'), ('compact', '99999999'), ('stamp', '99999999999999'),
  ('day_first', '99-99-9999'), ('month_first', '99/99/9999 99:99:99'), ('month_only', '9999-99')) AS f(form, shape)
GROUP BY form, shape"""

Q["first_value_folder"] = with_("""
filed AS (SELECT *, CASE WHEN src_pos % 97 = 0 THEN 1 WHEN src_pos % 7 = 0 THEN 2 ELSE 3 END * 1000000000000000000 + src_pos AS place FROM ord)""") + """
SELECT sale_order_no AS order_no, arg_min(order_status, place) FILTER (WHERE order_status IS NOT NULL) AS first_status,
  arg_min(item_code, place) AS first_item, COUNT(*) AS n_rows FROM filed GROUP BY sale_order_no"""

Q["subcent_rounding"] = with_() + f"""SELECT order_type,
  {d('SUM(round(pay_amount + 0.004, 2))', 'rounded_lines')}, {d('round(SUM(pay_amount + 0.004), 2)', 'rounded_sum')}
FROM ord GROUP BY order_type"""

Q["oms_strict_carried"] = with_(INV_F, oms_ctes("pt", normalize=False, period=("1997-01-01", "1997-10-01")), f"""
rem AS (SELECT oms_order_no AS order_no, item_code, {_fn('remark', 'inv_remark')} FROM inv_f
        WHERE oms_order_no IS NOT NULL GROUP BY oms_order_no, item_code),
pt_x AS (SELECT CASE WHEN shipped_qty IS NULL OR order_amount IS NULL OR order_qty IS NULL OR inv_remark IS NULL
                     THEN '2.Not test' ELSE category END AS category, invoice_amount
         FROM pt_c LEFT JOIN rem USING (order_no, item_code))""") + summary("pt_x")

Q["column_resolution_oms"] = with_(INV_F) + f"""SELECT oms_order_no AS order_no, {_norm('item_code')} AS item_code,
  {d('COALESCE(SUM(amount), 0)', 'invoice_amount')}, {d('COALESCE(SUM(qty), 0)', 'invoice_qty')},
  {_fn('src_file', 'inv_src_file')}, {_fn('remark', 'inv_remark')}
FROM inv_f WHERE oms_order_no IS NOT NULL GROUP BY 1, 2"""


# The printed headers of the two detail reports.
ORD_HEADERS = {"sale_order_no": "订单-销售订单号", "platform_order_no": "订单-平台订单号", "main_order_no": "订单-主订单号",
               "channel_name": "订单-渠道名称", "order_type": "订单-订单类型", "order_status": "订单-订单状态",
               "create_time": "订单-创建时间", "update_time": "订单-更新时间", "item_code": "订单-商品代码"}
DLV_HEADERS = {"order_no": "发货-订单号", "main_no": "发货-主单号", "external_order_no": "发货-外部订单号",
               "biz_time": "发货-业务时间", "item_code": "发货-料号", "item_name": "发货-商品名称", "business_type": "发货-业务类型"}
INV_HEADERS = {"invoice_no": "发票-SAP发票号", "company_code": "发票-公司代码", "remark": "发票-发票备注",
               "invoice_type": "发票-发票类型", "sales_org": "发票-销售组织", "invoice_date": "发票-开票日期",
               "customer_name": "发票-客户名称", "item_name": "发票-物料名称", "src_file": "发票-数据源文件"}


def _firsts(src: str, key: str, item: str, headers: dict[str, str], where: str) -> str:
    """First non-NULL value of every attribute by key, under printed headers."""
    cols = []
    for c, label in headers.items():
        v = f"strftime({c}, '%Y-%m-%d %H:%M:%S')" if c.endswith(("_time", "_date")) else c
        cols.append(f"arg_min({v}, src_pos) FILTER (WHERE {c} IS NOT NULL) AS \"{label}\"")
    return f"(SELECT {key} AS k_order, {item} AS k_item, {', '.join(cols)} FROM {src} WHERE {where} GROUP BY 1, 2)"


def _report(prefix: str, keys: dict[str, tuple], headers: dict[str, dict], measures: dict[str, str]) -> str:
    shown = ", ".join(f'CAST(c.{m} AS DOUBLE) AS "{label}"' for m, label in measures.items())
    attrs = ", ".join(f'{leg}."{label}"' for leg, h in headers.items() for label in h.values())
    joins = "\n".join(f"LEFT JOIN {_firsts(*keys[leg][:3], headers[leg], keys[leg][3])} {leg}\n  ON c.order_no = {leg}.k_order AND c.item_code = {leg}.k_item"
                      for leg in headers)
    return f"{shown}, category, {attrs} FROM {prefix}_c c\n{joins}"


NORM_ITEM = _norm("item_code")
Q["oms_report"] = with_(INV_F, OMS) + "SELECT c.order_no, c.item_code, i.inv_oms_order_no, i.inv_item_code, " + _report(
    "oms",
    {"o": ("oms_of", "sale_order_no", NORM_ITEM, "TRUE"),
     "l": ("dlv", "CASE WHEN starts_with(main_no, 'DD') THEN main_no ELSE order_no END", NORM_ITEM, "TRUE"),
     "v": ("inv_f", "oms_order_no", NORM_ITEM, "oms_order_no IS NOT NULL")},
    {"o": ORD_HEADERS, "l": DLV_HEADERS, "v": INV_HEADERS | {"dms_order_no": "发票-DMS销售单号"}},
    {"order_amount": "订单金额", "order_qty": "订单数量", "shipped_qty": "发货数量", "invoice_amount": "开票金额",
     "invoice_qty": "开票数量", "order_minus_shipped_qty": "订单-发货数量", "order_minus_invoice_qty": "订单-开票数量",
     "shipped_minus_invoice_qty": "发货-开票数量", "order_minus_invoice_amount": "订单-发票金额"}) + f"""
LEFT JOIN (SELECT oms_order_no AS k_order, {NORM_ITEM} AS k_item, {_fn('oms_order_no', 'inv_oms_order_no')},
                  {_fn('item_code', 'inv_item_code')} FROM inv_f WHERE oms_order_no IS NOT NULL GROUP BY 1, 2) i
  ON c.order_no = i.k_order AND c.item_code = i.k_item"""

Q["dms_report"] = with_(DMS) + "SELECT c.order_no AS \"DMS订单\", c.item_code AS \"物料编码\", " + _report(
    "dms",
    {"o": ("ord", "platform_order_no", "item_code", "contains(upper(channel_name), 'DMS')"),
     "l": ("dlv", "external_order_no", "item_code", "external_order_no IS NOT NULL"),
     "v": ("inv", "dms_order_no", "item_code", "contains(invoice_type, '标准发票') AND contains(invoice_type, '2B') "
           "AND NOT contains(invoice_type, '退货') AND dms_order_no IS NOT NULL")},
    {"o": ORD_HEADERS, "l": DLV_HEADERS | {"item_name": "发货-物料名称"}, "v": INV_HEADERS | {"oms_order_no": "发票-OMS订单号"}},
    {"invoice_amount": "SAP开票含税金额", "invoice_qty_sales": "SAP开票销售数量", "invoice_qty": "SAP开票基本数量",
     "order_amount": "DMS订单金额", "order_qty": "DMS订单数量", "shipped_qty": "DMS发货数量",
     "invoice_minus_order_amount": "SAP-DMS订单金额", "invoice_minus_order_qty": "SAP-DMS订单数量(基本单位)",
     "invoice_minus_shipped_qty": "SAP-DMS发货数量(基本单位)"})

Q["report_parts"] = with_(INV_F, OMS, f"""
parts_c AS (SELECT {ORG_GROUP} AS org_group, * FROM oms_c),
parts_n AS (SELECT *, (row_number() OVER (PARTITION BY org_group, category ORDER BY order_no, item_code) - 1) // 500 + 1 AS part FROM parts_c)""") + """
SELECT org_group, category, part, COUNT(*) AS n_rows, CAST(SUM(invoice_amount) AS DOUBLE) AS invoice_amount,
       arg_min(order_no || '|' || item_code, (order_no, item_code)) AS first_key,
       arg_max(order_no || '|' || item_code, (order_no, item_code)) AS last_key
FROM parts_n GROUP BY org_group, category, part"""

ORACLES = Q
