"""The SQL each query is checked against, for DuckDB over the given tables.

The mapping of the given tables to the raw tables is shared with the queries; everything
after it is written from the rules of the blueprint.
"""

from __future__ import annotations

import re

from quaymart.plans.given_tables import MAPPING

_DEDUPE = """
SELECT * EXCLUDE (_rn) FROM (
  SELECT *, row_number() OVER (PARTITION BY company_id, product_id, id
    ORDER BY write_date DESC, l_suppkey DESC, product_uom_qty DESC, l_extendedprice DESC) AS _rn
  FROM {raw}) WHERE _rn = 1"""

_VIEWS = {name: re.sub(r"[{}]", "", sql).strip() for name, sql in MAPPING.items()}
for _name in ("stock_move", "stock_quant", "stock_valuation_layer"):
    _VIEWS[_name] = _DEDUPE.format(raw=f"{_name}_raw").strip()
_VIEWS["part_company"] = "SELECT part.*, CAST(r_regionkey + 1 AS BIGINT) AS company_id FROM part CROSS JOIN region"
_ORDER = [
    "res_company", "part_company", "res_partner", "stock_location", "product_template", "product_product", "order_company",
    "purchase_order", "stock_move_raw", "stock_quant_raw", "stock_valuation_layer_raw", "ir_property",
    "stock_move", "stock_quant", "stock_valuation_layer",
]

# What follows are views over views, used by several queries.
_VIEWS["usage_of"] = """
SELECT m.company_id, m.location_id, arg_min(l.usage, CASE WHEN l.company_id = m.company_id THEN 0 ELSE 1 END) AS usage
FROM (SELECT DISTINCT company_id, location_id FROM stock_move
      UNION SELECT DISTINCT company_id, location_dest_id FROM stock_move
      UNION SELECT DISTINCT company_id, location_id FROM stock_quant) m
JOIN stock_location l ON l.id = m.location_id AND (l.company_id = m.company_id OR l.company_id = 0)
GROUP BY ALL"""
_VIEWS["keys"] = """
SELECT DISTINCT company_id, product_id FROM stock_move
UNION SELECT DISTINCT company_id, product_id FROM stock_valuation_layer"""
_VIEWS["item"] = """
SELECT k.company_id, k.product_id,
       arg_min(p.default_code, CASE WHEN p.company_id = k.company_id THEN -1 ELSE p.company_id END)
         FILTER (WHERE p.default_code <> '') AS code,
       arg_min(p.product_tmpl_id, CASE WHEN p.company_id = k.company_id THEN -1 ELSE p.company_id END) AS tmpl
FROM keys k LEFT JOIN product_product p ON p.id = k.product_id GROUP BY ALL"""
_VIEWS["cost"] = """
SELECT i.company_id, i.product_id, coalesce(i.code, '') AS code, i.tmpl,
       coalesce(arg_min(pt.standard_price,
         CASE WHEN pt.company_id = i.company_id THEN -1 ELSE pt.company_id END), 0.0) AS price
FROM item i LEFT JOIN product_template pt ON pt.id = i.tmpl GROUP BY ALL"""
_VIEWS["done"] = "SELECT * FROM stock_move WHERE state = 'done' AND company_id <> 1"
_VIEWS["routed"] = """
SELECT m.*, s.usage AS src_usage, d.usage AS dst_usage, CAST(date_trunc('month', m.date_done) AS DATE) AS month
FROM done m
LEFT JOIN usage_of s ON s.company_id = m.company_id AND s.location_id = m.location_id
LEFT JOIN usage_of d ON d.company_id = m.company_id AND d.location_id = m.location_dest_id"""
_VIEWS["on_hand_qty"] = """
SELECT q.company_id, q.product_id, sum(q.quantity) AS on_hand_qty
FROM stock_quant q JOIN usage_of u ON u.company_id = q.company_id AND u.location_id = q.location_id
WHERE u.usage = 'internal' AND q.company_id <> 1 GROUP BY ALL"""
_VIEWS["year_moves"] = """
SELECT * FROM done
WHERE date_done >= TIMESTAMP '1998-06-15' - INTERVAL 12 MONTH AND date_done < TIMESTAMP '1998-06-16'"""
_VIEWS["abc_totals"] = """
SELECT m.company_id, m.product_id,
       CAST(sum(m.quantity_done * c.price) AS DECIMAL(28,4)) AS total
FROM year_moves m JOIN cost c USING (company_id, product_id) GROUP BY ALL"""
_VIEWS["abc_shares"] = """
SELECT *, CAST(sum(total) OVER (PARTITION BY company_id ORDER BY total DESC, product_id
                 ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS DOUBLE)
       / nullif(CAST(sum(total) OVER (PARTITION BY company_id) AS DOUBLE), 0) AS share
FROM abc_totals"""
_VIEWS["abc_mart"] = """
SELECT DATE '1998-06-15' AS snapshot_date, a.company_id, coalesce(rc.name, '') AS company_name, a.product_id,
       c.code AS product_default_code, round(CAST(a.total AS DOUBLE), 6) AS total_value_moved,
       round(a.share, 6) AS cumulative_share,
       CASE WHEN a.share <= CAST(0.80 AS DOUBLE) THEN 'A'
            WHEN a.share <= CAST(0.80 AS DOUBLE) + CAST(0.15 AS DOUBLE) THEN 'B' ELSE 'C' END AS abc_class
FROM abc_shares a JOIN cost c USING (company_id, product_id) LEFT JOIN res_company rc ON rc.id = a.company_id"""
_VIEWS["receipts"] = """
SELECT CAST(date_trunc('month', m.date_done) AS DATE) AS month, m.company_id, coalesce(po.partner_id, 0) AS partner_id,
       CASE WHEN m.date_done <= po.date_planned THEN 1.0 ELSE 0.0 END AS on_time,
       CASE WHEN m.quantity_done >= m.product_uom_qty THEN 1.0 ELSE 0.0 END AS in_full
FROM done m
JOIN stock_location s ON s.id = m.location_id AND s.company_id = m.company_id AND s.usage = 'supplier'
JOIN stock_location d ON d.id = m.location_dest_id AND d.company_id = m.company_id AND d.usage = 'internal'
LEFT JOIN purchase_order po ON po.name = m.origin AND po.company_id = m.company_id"""
_VIEWS["rating"] = """
SELECT month, company_id, partner_id, avg(on_time) AS on_time_pct, avg(in_full) AS in_full_pct,
       0.5 * avg(on_time) + 0.5 * avg(in_full) AS overall_score
FROM receipts GROUP BY ALL"""
_VIEWS["unit_costs"] = """
SELECT company_id, product_id,
       avg(value / quantity) FILTER (WHERE CAST(create_date AS DATE) = DATE '1998-06-15') AS today_cost,
       avg(value / quantity) AS avg_cost
FROM stock_valuation_layer
WHERE quantity > 0 AND company_id <> 1 AND create_date >= TIMESTAMP '1998-06-15' - INTERVAL 30 DAY
  AND create_date < TIMESTAMP '1998-06-16' GROUP BY ALL"""
_VIEWS["anomalies"] = """
SELECT company_id, product_id, today_cost, avg_cost,
       CASE WHEN avg_cost = 0 THEN 0.0 ELSE (today_cost - avg_cost) / avg_cost END AS deviation
FROM unit_costs
WHERE abs(CASE WHEN avg_cost = 0 THEN 0.0 ELSE (today_cost - avg_cost) / avg_cost END) > 0.2"""
_VIEWS["monthly"] = """
SELECT company_id, product_id, CAST(date_trunc('month', date_done) AS DATE) AS month, sum(quantity_done) AS qty,
       row_number() OVER (PARTITION BY company_id, product_id ORDER BY date_trunc('month', date_done)) AS i,
       count(*) OVER (PARTITION BY company_id, product_id) AS n
FROM year_moves GROUP BY company_id, product_id, date_trunc('month', date_done)"""
_VIEWS["series"] = """
SELECT * FROM monthly WHERE (company_id, product_id) IN (
  SELECT (company_id, product_id) FROM abc_shares WHERE share <= CAST(0.80 AS DOUBLE))"""
_VIEWS["report_move"] = """
SELECT origin, company_id, CASE WHEN location_dest_id = 2 THEN 'OUT' WHEN location_id % 10 = 1 THEN 'IN' ELSE 'INT' END
         AS kind, date_done AS scheduled_date, product_id AS product, product_uom_qty AS qty_requested,
       quantity_done AS qty_done, location_id AS source_location_id, location_dest_id AS dest_location_id
FROM stock_move_raw WHERE state = 'done'"""
_VIEWS["headers"] = """
SELECT DISTINCT origin, company_id, kind, scheduled_date, source_location_id, dest_location_id FROM report_move"""
_VIEWS["rates"] = """
SELECT product, sum(qty_done) / 30 AS rate FROM report_move
WHERE kind = 'OUT' AND scheduled_date >= TIMESTAMP '1998-05-17' AND scheduled_date < TIMESTAMP '1998-06-16'
GROUP BY ALL"""
_VIEWS["stocks"] = """
SELECT product, sum(balance) AS stock FROM (
  SELECT location, product, sum(qty) AS balance FROM (
    SELECT source_location_id AS location, product, -qty_done AS qty FROM report_move WHERE qty_done > 0
    UNION ALL SELECT dest_location_id, product, qty_done FROM report_move WHERE qty_done > 0)
  GROUP BY ALL) WHERE balance > 0 GROUP BY ALL"""
_VIEWS["covers"] = """
SELECT r.product, coalesce(s.stock, 0.0) AS stock, r.rate, coalesce(s.stock, 0.0) / r.rate AS days_of_cover
FROM rates r LEFT JOIN stocks s USING (product) WHERE r.rate > 0"""
_VIEWS["tops"] = """
SELECT product, sum(qty_done) AS qty FROM report_move WHERE kind = 'OUT' GROUP BY ALL ORDER BY qty DESC, product LIMIT 10"""
_VIEWS["landing"] = """
SELECT l_orderkey * 10 + l_linenumber AS id,
       CASE WHEN l_returnflag = 'R' THEN 0 ELSE l_suppkey % 5 + 1 END AS company_id,
       CASE WHEN l_partkey % 17 = 0 THEN 0 ELSE l_partkey END AS product_id,
       CASE WHEN l_discount > CAST(0.02 AS DOUBLE) THEN l_quantity ELSE 0.0 END AS qty_done,
       CAST(8 AS BIGINT) AS location_id, CAST(0 AS BIGINT) AS location_dest_id,
       CASE WHEN l_returnflag = 'A' THEN '' ELSE 'done' END AS state,
       CASE WHEN l_linestatus = 'F' THEN date_trunc('second', l_shipdate)
            WHEN l_returnflag = 'N' THEN date_trunc('day', l_shipdate) END AS date_done,
       date_trunc('second', l_shipdate) AS write_date, CAST(NULL AS TIMESTAMP) AS create_date
FROM lineitem"""
_VIEWS["props"] = """
SELECT id, company_id, split_part(res_id, ',', 1) AS model,
       TRY_CAST(split_part(res_id, ',', 2) AS BIGINT) AS record_id, value_float
FROM ir_property WHERE name = 'standard_price' AND value_float IS NOT NULL AND res_id LIKE '%,%'"""
_VIEWS["template_company"] = "SELECT DISTINCT id, company_id FROM product_template"
_VIEWS["seen_props"] = """
SELECT c.company_id, p.model, p.record_id, p.value_float,
       row_number() OVER (PARTITION BY c.company_id, p.model, p.record_id
         ORDER BY CASE WHEN p.company_id = c.company_id AND c.company_id <> 0 THEN 0 ELSE 1 END,
                  CASE WHEN p.company_id = c.company_id AND c.company_id <> 0 THEN -p.id ELSE p.id END) AS rn
FROM (SELECT DISTINCT company_id FROM product_template) c
JOIN props p ON p.company_id = c.company_id OR p.company_id = 0"""
_VIEWS["product_ids"] = "SELECT id, min(product_tmpl_id) AS tmpl FROM product_product GROUP BY id"
_VIEWS["prop_costs"] = """
SELECT t.id, t.company_id, coalesce(tp.value_float, v.value_float) AS cost
FROM template_company t
LEFT JOIN seen_props tp ON tp.company_id = t.company_id AND tp.model = 'product.template'
  AND tp.record_id = t.id AND tp.rn = 1
LEFT JOIN (
  SELECT s.company_id, p.tmpl, arg_min(s.value_float, p.id) AS value_float
  FROM seen_props s JOIN product_ids p ON p.id = s.record_id
  WHERE s.model = 'product.product' AND s.rn = 1 GROUP BY ALL) v
  ON v.company_id = t.company_id AND v.tmpl = t.id"""
_VIEWS["event"] = """
SELECT user_id AS id, user_id % 5 + 1 AS company_id, event_id, event_type, CAST(floor(value / 50) AS BIGINT) AS amount,
       ts AS write_date FROM events"""
_VIEWS["mark"] = """
SELECT company_id, max(write_date) AS watermark FROM event
WHERE write_date < TIMESTAMP '2024-01-20' AND company_id < 5 GROUP BY ALL"""
_VIEWS["fresh"] = """
SELECT e.* FROM event e LEFT JOIN mark m USING (company_id)
WHERE e.write_date > coalesce(m.watermark, TIMESTAMP '1970-01-01')"""
_VIEWS["stats"] = """
SELECT company_id, count(*) FILTER (WHERE id <> 0 AND amount <> 0) AS n_ok,
       count(*) FILTER (WHERE id = 0 OR amount = 0) AS n_bad, max(write_date) AS last_seen
FROM fresh GROUP BY ALL"""
_VIEWS["copies"] = """
SELECT id, c.company_id, product_id, qty_done, location_id, location_dest_id, state, date_done, write_date, create_date
FROM landing l JOIN (VALUES (CAST(2 AS BIGINT)), (CAST(3 AS BIGINT))) c(company_id)
  ON l.company_id = 0 OR l.company_id = c.company_id
WHERE state = 'done' AND id <> 0 AND product_id <> 0 AND date_done IS NOT NULL AND write_date IS NOT NULL"""
_VIEWS["loaded"] = """
SELECT * EXCLUDE (rn), strftime(date_done, '%Y%m') AS p_month FROM (
  SELECT *, row_number() OVER (PARTITION BY company_id, product_id, id
    ORDER BY write_date DESC, qty_done DESC, location_id DESC, state DESC, date_done DESC) AS rn FROM copies)
WHERE rn = 1"""
_VIEWS["windows"] = """
SELECT CASE o_orderstatus WHEN 'F' THEN 'STOCKOUT' WHEN 'O' THEN 'SUPPLIER_DELAY' ELSE 'SHRINKAGE' END AS kind,
       company_id, CAST(o_orderdate AS DATE) AS d0,
       CASE WHEN o_custkey % 10 > 0 THEN CAST(o_orderdate AS DATE) + CAST(o_custkey % 10 AS INTEGER) END AS d1
FROM order_company"""
_VIEWS["both_landings"] = """
SELECT * FROM landing
UNION ALL
SELECT id, company_id, product_id, CASE WHEN qty_done > 0 THEN qty_done + 1 ELSE 0.0 END, location_id, location_dest_id,
       state, date_done + INTERVAL 40 DAY, TIMESTAMP '1999-06-01', create_date
FROM landing WHERE (id // 10) % 10 = 0 AND write_date < TIMESTAMP '1996-01-01'"""
_VIEWS["copies_of_both"] = """
SELECT id, c.company_id, product_id, qty_done, location_id, location_dest_id, state, date_done, write_date, create_date
FROM both_landings l JOIN (VALUES (CAST(2 AS BIGINT)), (CAST(3 AS BIGINT))) c(company_id)
  ON l.company_id = 0 OR l.company_id = c.company_id
WHERE state = 'done'"""
_VIEWS["twice"] = """
SELECT * EXCLUDE (rn), strftime(date_done, '%Y%m') AS p_month FROM (
  SELECT *, row_number() OVER (PARTITION BY company_id, product_id, id
    ORDER BY write_date DESC, qty_done DESC, location_id DESC, state DESC, date_done DESC) AS rn FROM copies_of_both
  WHERE id <> 0 AND product_id <> 0 AND date_done IS NOT NULL AND write_date IS NOT NULL)
WHERE rn = 1"""
_VIEWS["merged"] = """
SELECT id, company_id, product_id, CASE WHEN id % 20 = 1 THEN quantity_done + 1 ELSE quantity_done END AS quantity_done,
       CASE WHEN id % 20 = 1 THEN date_done + INTERVAL 60 DAY ELSE date_done END AS date_done,
       CASE WHEN id % 20 = 1 THEN write_date + INTERVAL 400 DAY ELSE write_date END AS write_date, origin
FROM stock_move"""
_ORDER += [name for name in _VIEWS if name not in _ORDER]


def _needs(sql: str) -> set[str]:
    words = set(re.findall(r"[a-z_]+", sql))
    return {name for name in _ORDER if name in words}


def _query(sql: str, extra: str = "") -> str:
    """Put the views the text uses, directly or through one another, in front of it."""
    wanted, todo = set(), [sql + extra]
    while todo:
        for name in _needs(todo.pop()) - wanted:
            wanted.add(name)
            todo.append(_VIEWS[name])
    ctes = [f"{name} AS ({_VIEWS[name]})" for name in _ORDER if name in wanted]
    ctes += [extra] if extra else []
    recursive = "RECURSIVE " if "UNION ALL SELECT f." in extra else ""
    return (f"WITH {recursive}" + ",\n".join(ctes) + "\n" if ctes else "") + sql.strip()


_PULSE = """
CASE WHEN {d} < 0 THEN 0.0 WHEN {d} <= c.ramp THEN CAST({d} AS DOUBLE) / c.ramp
     WHEN {d} <= c.ramp + c.peak THEN 1.0
     WHEN {d} <= c.ramp + c.peak + c.decay THEN 1.0 - CAST({d} - c.ramp - c.peak AS DOUBLE) / c.decay ELSE 0.0 END"""

_NAMED = "LEFT JOIN res_company rc ON rc.id = x.company_id"

_TREND = f"""
SELECT CAST(x.last_month + INTERVAL 1 MONTH AS DATE) AS forecast_month, x.company_id,
       coalesce(rc.name, '') AS company_name, x.product_id, c.code AS product_default_code,
       round(coalesce(b.q, x.q), 6) AS forecast_qty, round(coalesce(b.q, x.q) * 0.85, 6) AS lower_ci,
       round(coalesce(b.q, x.q) * 1.15, 6) AS upper_ci
FROM (SELECT company_id, product_id, max(month) AS last_month, avg(qty) FILTER (WHERE i > n - 3) AS q
      FROM series GROUP BY ALL) x
LEFT JOIN best b ON b.company_id = x.company_id AND b.product_id = x.product_id
JOIN cost c ON c.company_id = x.company_id AND c.product_id = x.product_id {_NAMED}"""


def _fitted_factors() -> str:
    """Least squared errors over a grid of factors, then around the best pair in halved steps; the start state is solved for."""
    key = "company_id, product_id"
    text = f"""
points AS MATERIALIZED (SELECT *, coalesce(qty / nullif(top, 0), 0) AS y FROM (
  SELECT *, max(abs(qty)) OVER (PARTITION BY {key}) AS top FROM series WHERE n >= 4))"""
    for level, step in enumerate((16, 8, 4, 2, 1)):
        pairs = (f"best{level - 1}, generate_series(-1, 1) g(i), generate_series(-1, 1) h(i)" if level else
                 f"(SELECT DISTINCT {key}, n, 0 AS a, 0 AS b, top FROM points), generate_series(1, 9) g(i), generate_series(1, 9) h(i)")
        zero = "CAST(0 AS DOUBLE)"
        text += f""",
run{level} AS (
  SELECT {key}, n, top, a + {step} * g.i AS a, b + {step} * h.i AS b, CAST(0 AS BIGINT) AS i, {zero} AS l, {zero} AS t,
         CAST(1 AS DOUBLE) AS ul, {zero} AS ut, {zero} AS vl, CAST(1 AS DOUBLE) AS vt,
         {zero} AS yy, {zero} AS yu, {zero} AS yv, {zero} AS uu, {zero} AS uv, {zero} AS vv
  FROM {pairs}
  UNION ALL SELECT f.company_id, f.product_id, f.n, f.top, f.a, f.b, p.i,
         f.l + f.t + f.a / 160 * (p.y - (f.l + f.t)), f.t + f.a / 160 * (f.b / 160) * (p.y - (f.l + f.t)),
         f.ul + f.ut - f.a / 160 * (f.ul + f.ut), f.ut - f.a / 160 * (f.b / 160) * (f.ul + f.ut),
         f.vl + f.vt - f.a / 160 * (f.vl + f.vt), f.vt - f.a / 160 * (f.b / 160) * (f.vl + f.vt),
         f.yy + (p.y - (f.l + f.t)) * (p.y - (f.l + f.t)), f.yu - (p.y - (f.l + f.t)) * (f.ul + f.ut),
         f.yv - (p.y - (f.l + f.t)) * (f.vl + f.vt), f.uu + (f.ul + f.ut) * (f.ul + f.ut),
         f.uv + (f.ul + f.ut) * (f.vl + f.vt), f.vv + (f.vl + f.vt) * (f.vl + f.vt)
  FROM run{level} f JOIN points p ON p.company_id = f.company_id AND p.product_id = f.product_id AND p.i = f.i + 1),
best{level} AS (
  SELECT * FROM (
    SELECT {key}, n, top, a, b, (l + t + l0 * (ul + ut) + t0 * (vl + vt)) * top AS q, row_number() OVER (
      PARTITION BY {key} ORDER BY round(greatest(yy + l0 * yu + t0 * yv, 0), 9), a, b) AS rn
    FROM (SELECT *, (uv * yv - vv * yu) / (uu * vv - uv * uv) AS l0, (uv * yu - uu * yv) / (uu * vv - uv * uv) AS t0
          FROM run{level} WHERE i = n)) WHERE rn = 1)"""
    return text + ",\nbest AS (SELECT company_id, product_id, q FROM best4)"


ORACLE: dict[str, str] = {
    "latest_moves": _query(
        "SELECT company_id, product_id, id, write_date, product_uom_qty, quantity_done, state, origin FROM stock_move"),
    "scoped_lookup": _query("""
SELECT m.company_id, m.product_id, count(*) AS moves, coalesce(any_value(i.code), '') AS product_default_code,
       any_value(i.tmpl) AS product_tmpl_id
FROM stock_move m JOIN item i USING (company_id, product_id) GROUP BY m.company_id, m.product_id"""),
    "template_price": _query("""
SELECT m.company_id, m.product_id, count(*) AS moves, any_value(c.tmpl) AS product_tmpl_id,
       round(any_value(c.price), 6) AS standard_price
FROM stock_move m JOIN cost c USING (company_id, product_id) GROUP BY m.company_id, m.product_id"""),
    "role_locations": _query("""
SELECT m.company_id, s.usage AS src_usage, d.usage AS dst_usage, count(*) AS moves
FROM stock_move m
LEFT JOIN usage_of s ON s.company_id = m.company_id AND s.location_id = m.location_id
LEFT JOIN usage_of d ON d.company_id = m.company_id AND d.location_id = m.location_dest_id
GROUP BY ALL"""),
    "order_join": _query("""
SELECT m.company_id, po.partner_id, count(*) AS moves, max(po.date_planned) AS last_planned
FROM stock_move m LEFT JOIN purchase_order po ON po.name = m.origin AND po.company_id = m.company_id
GROUP BY ALL"""),
    "liquidation": _query(f"""
SELECT DATE '1998-06-15' AS snapshot_date, x.company_id, coalesce(rc.name, '') AS company_name, x.product_id,
       c.code AS product_default_code, x.last_day AS last_movement_date,
       CAST(DATE '1998-06-15' - x.last_day AS INTEGER) AS days_since_last_move,
       round(coalesce(q.on_hand_qty, 0.0), 6) AS on_hand_qty, round(c.price, 6) AS standard_price,
       round(coalesce(q.on_hand_qty, 0.0) * c.price, 6) AS value_at_risk
FROM (SELECT company_id, product_id, max(CAST(date_done AS DATE)) AS last_day FROM done
      WHERE date_done < TIMESTAMP '1998-06-16' GROUP BY ALL) x
JOIN cost c USING (company_id, product_id)
LEFT JOIN on_hand_qty q ON q.company_id = x.company_id AND q.product_id = x.product_id {_NAMED}
WHERE DATE '1998-06-15' - x.last_day > 90"""),
    "vendor_rating": _query(f"""
SELECT x.month, x.company_id, coalesce(rc.name, '') AS company_name, x.partner_id,
       round(x.on_time_pct, 6) AS on_time_pct, round(x.in_full_pct, 6) AS in_full_pct,
       round(x.overall_score, 6) AS overall_score
FROM rating x {_NAMED}"""),
    "touch_ratio": _query(f"""
SELECT x.*, coalesce(rc.name, '') AS company_name, c.code AS product_default_code,
       round(CASE WHEN outgoing_moves = 0 THEN 0.0 ELSE internal_moves / outgoing_moves END, 6) AS touch_ratio
FROM (SELECT month, company_id, product_id,
             count(*) FILTER (WHERE src_usage = 'internal' AND dst_usage = 'internal') AS internal_moves,
             count(*) FILTER (WHERE dst_usage = 'customer') AS outgoing_moves
      FROM routed GROUP BY ALL) x JOIN cost c USING (company_id, product_id) {_NAMED}"""),
    "stockout_risk": _query(f"""
SELECT x.*, coalesce(rc.name, '') AS company_name, c.code AS product_default_code,
       round(stockout_moves / move_count, 6) AS stockout_rate
FROM (SELECT month, company_id, product_id, round(sum(product_uom_qty), 6) AS demand_qty,
             round(sum(quantity_done), 6) AS fulfilled_qty,
             round(coalesce(sum(product_uom_qty - quantity_done) FILTER (WHERE quantity_done < product_uom_qty), 0), 6)
               AS unmet_qty,
             count(*) AS move_count, count(*) FILTER (WHERE quantity_done < product_uom_qty) AS stockout_moves
      FROM routed WHERE src_usage = 'internal' AND dst_usage = 'customer' GROUP BY ALL) x
JOIN cost c USING (company_id, product_id) {_NAMED}"""),
    "turnover": _query(f"""
SELECT x.month, x.company_id, coalesce(rc.name, '') AS company_name, x.product_id, c.code AS product_default_code,
       round(x.qty, 6) AS moved_qty, round(x.val, 6) AS moved_value, round(coalesce(q.on_hand_qty, 0.0), 6) AS on_hand_qty,
       round(coalesce(q.on_hand_qty, 0.0) * c.price, 6) AS on_hand_value,
       round(CASE WHEN coalesce(q.on_hand_qty, 0.0) * c.price = 0 THEN 0.0
                  ELSE x.val / (q.on_hand_qty * c.price) END, 9) AS turnover_ratio
FROM (SELECT m.month, m.company_id, m.product_id, sum(m.quantity_done) AS qty, sum(m.quantity_done * k.price) AS val
      FROM routed m JOIN cost k USING (company_id, product_id)
      WHERE src_usage = 'internal' AND dst_usage = 'customer' GROUP BY ALL) x
JOIN cost c USING (company_id, product_id)
LEFT JOIN on_hand_qty q ON q.company_id = x.company_id AND q.product_id = x.product_id {_NAMED}"""),
    "cost_anomalies": _query(f"""
SELECT DATE '1998-06-15' AS snapshot_date, x.company_id, coalesce(rc.name, '') AS company_name, x.product_id,
       coalesce(i.code, '') AS product_default_code, round(x.today_cost, 6) AS unit_cost,
       round(x.avg_cost, 6) AS avg_30d_cost, round(x.deviation, 6) AS deviation_pct
FROM anomalies x JOIN item i USING (company_id, product_id) {_NAMED}"""),
    "abc": _query("SELECT * FROM abc_mart"),
    "abc_in_slices": _query("SELECT * FROM abc_mart"),
    "forecast_ma": _query(f"""
SELECT CAST(x.last_month + INTERVAL 1 MONTH AS DATE) AS forecast_month, x.company_id,
       coalesce(rc.name, '') AS company_name, x.product_id, c.code AS product_default_code,
       round(x.q, 6) AS forecast_qty, round(x.q * 0.85, 6) AS lower_ci, round(x.q * 1.15, 6) AS upper_ci
FROM (SELECT company_id, product_id, max(month) AS last_month, avg(qty) FILTER (WHERE i > n - 3) AS q
      FROM series GROUP BY ALL) x JOIN cost c USING (company_id, product_id) {_NAMED}"""),
    "forecast_holt": _query(_TREND, extra="""
grid AS (SELECT i / 10 AS factor FROM generate_series(1, 9) g(i)),
points AS MATERIALIZED (SELECT * FROM series WHERE n >= 4),
fit AS (
  SELECT p.company_id, p.product_id, a.factor AS alpha, b.factor AS beta, p.n, p.i AS i, p.qty AS level,
         q.qty - p.qty AS trend, CAST(0 AS DOUBLE) AS sse
  FROM points p JOIN points q ON q.company_id = p.company_id AND q.product_id = p.product_id AND q.i = 2,
       grid a, grid b
  WHERE p.i = 1
  UNION ALL SELECT f.company_id, f.product_id, f.alpha, f.beta, f.n, p.i,
         f.alpha * p.qty + (1 - f.alpha) * (f.level + f.trend),
         f.beta * (f.alpha * p.qty + (1 - f.alpha) * (f.level + f.trend) - f.level) + (1 - f.beta) * f.trend,
         f.sse + (p.qty - (f.level + f.trend)) * (p.qty - (f.level + f.trend))
  FROM fit f JOIN points p ON p.company_id = f.company_id AND p.product_id = f.product_id AND p.i = f.i + 1),
best AS (
  SELECT company_id, product_id, level + trend AS q FROM (
    SELECT *, row_number() OVER (PARTITION BY company_id, product_id ORDER BY round(coalesce(sse / nullif(top * top, 0), 0), 9), alpha, beta) AS rn
    FROM fit JOIN (SELECT company_id, product_id, max(abs(qty)) AS top FROM points GROUP BY ALL)
      USING (company_id, product_id) WHERE i = n) WHERE rn = 1)"""),
    "forecast_holt_fit": _query(_TREND, extra=_fitted_factors()),
    "otif_alert": _query("""
SELECT DATE '1998-06-01' AS month, round(min(overall_score), 6) AS min_score,
       coalesce(min(overall_score) < 0.8, false) AS alert
FROM rating WHERE month = DATE '1998-06-01'"""),
    "tickets": _query("""
SELECT 'COGS anomaly product ' || product_id AS name,
       printf('Check item %d. Cost deviated %.2f%% from 30-day average.', product_id, 100 * deviation) AS description,
       CAST(1 AS BIGINT) AS team_id
FROM (SELECT product_id, arg_min(deviation, company_id) AS deviation FROM anomalies GROUP BY ALL)
WHERE product_id NOT IN (SELECT p_partkey FROM part WHERE p_size > 25)"""),
    "abc_writeback": _query("""
SELECT p.product_tmpl_id, min(a.abc_class) AS abc_class
FROM abc_mart a JOIN product_product p ON p.id = a.product_id
WHERE p.product_tmpl_id <> 0 GROUP BY ALL"""),
    "daily_outbound": _query("""
SELECT CAST(scheduled_date AS DATE) AS day, product, round(sum(qty_done), 6) AS qty
FROM report_move WHERE kind = 'OUT' GROUP BY ALL"""),
    "avg_outbound": _query("SELECT product, round(rate, 6) AS rate FROM rates"),
    "ending_stock": _query("SELECT product, round(stock, 6) AS stock FROM stocks"),
    "days_of_cover": _query("""
SELECT product, round(stock, 6) AS stock, round(rate, 6) AS rate, round(days_of_cover, 9) AS days_of_cover FROM covers"""),
    "movement_counts": _query("SELECT kind, count(*) AS pickings FROM headers GROUP BY ALL"),
    "movement_summary": _query("""
SELECT 'picking_count' AS section, kind AS item, CAST(count(*) AS DOUBLE) AS amount FROM headers GROUP BY kind
UNION ALL SELECT 'top_outbound', CAST(product AS VARCHAR), round(qty, 6) FROM tops
UNION ALL SELECT * FROM (SELECT 'lowest_days_of_cover', CAST(product AS VARCHAR), round(days_of_cover, 6) FROM covers
                         ORDER BY days_of_cover, product LIMIT 10)"""),
    "merge_summaries": _query("""
SELECT 'picking_count' AS section, kind AS item, CAST(count(*) AS DOUBLE) AS amount FROM headers GROUP BY kind
UNION ALL SELECT 'top_outbound', CAST(product AS VARCHAR), round(qty, 6) FROM tops"""),
    "on_hand": _query("""
SELECT location_id, product_id, round(sum(quantity), 6) AS qty FROM stock_quant GROUP BY ALL"""),
    "active_companies": _query("SELECT id FROM res_company WHERE id <> 1"),
    "domain_filter": _query("""
SELECT id, company_id, product_tmpl_id, default_code FROM product_product
WHERE lower(default_code) LIKE '%brand#1%' AND company_id IN (0, 2, 3) AND id >= 10"""),
    "normalize": _query("SELECT * FROM landing"),
    "required_gate": _query("""
SELECT * FROM landing WHERE id <> 0 AND product_id <> 0 AND date_done IS NOT NULL AND write_date IS NOT NULL"""),
    "property_price": _query("""
SELECT record_id, round(coalesce(arg_max(value_float, id) FILTER (WHERE company_id = 2),
                                 arg_min(value_float, id)), 6) AS price
FROM props WHERE model = 'product.template' AND company_id IN (0, 2) GROUP BY ALL"""),
    "template_property_price": _query("""
SELECT t.id AS template_id, round(coalesce(tp.price, vp.price), 6) AS price
FROM (SELECT DISTINCT id FROM product_template) t
LEFT JOIN own_or_shared tp ON tp.model = 'product.template' AND tp.record_id = t.id
LEFT JOIN (SELECT p.tmpl, arg_min(o.price, p.id) AS price FROM own_or_shared o JOIN product_ids p ON p.id = o.record_id
           WHERE o.model = 'product.product' GROUP BY ALL) vp ON vp.tmpl = t.id
WHERE coalesce(tp.price, vp.price) IS NOT NULL""", extra="""
own_or_shared AS (
  SELECT model, record_id, coalesce(arg_max(value_float, id) FILTER (WHERE company_id = 2),
                                    arg_min(value_float, id)) AS price
  FROM props WHERE company_id IN (0, 2) GROUP BY ALL)"""),
    "price_repair": _query("""
SELECT t.id, t.company_id, t.list_price,
       round(CASE WHEN coalesce(c.cost, t.standard_price) = 0 AND t.list_price <> 0 THEN t.list_price * 0.7
                  ELSE coalesce(c.cost, t.standard_price) END, 6) AS standard_price
FROM product_template t LEFT JOIN prop_costs c USING (id, company_id)"""),
    "price_ladder": _query("""
SELECT id, company_id,
       round(CASE WHEN list_price > 0 THEN list_price WHEN standard_price > 0 THEN standard_price * 1.35 ELSE 10.0 END, 6)
         AS sale_price,
       round(CASE WHEN standard_price > 0 THEN standard_price WHEN list_price > 0 THEN list_price * 0.8 ELSE 10.0 END, 6)
         AS purchase_price
FROM product_template"""),
    "incremental": _query("SELECT * FROM fresh"),
    "watermark": _query("""
SELECT 'events' AS model, company_id,
       CASE WHEN coalesce(s.n_ok, 0) > 0 THEN greatest(m.watermark, s.last_seen) ELSE m.watermark END AS watermark
FROM mark m FULL JOIN stats s USING (company_id)
WHERE m.watermark IS NOT NULL OR s.n_ok > 0"""),
    "full_refresh": _query("SELECT id, company_id, event_id, TIMESTAMP '2024-02-01 06:00:00' AS write_date FROM event"),
    "merge_batch": _query("""
SELECT id, company_id, event_id, event_type, amount, write_date FROM (
  SELECT *, row_number() OVER (PARTITION BY company_id, id
    ORDER BY write_date DESC, event_id DESC, event_type DESC, amount DESC) AS rn FROM event) WHERE rn = 1"""),
    "load_model": _query("SELECT * FROM loaded"),
    "stream_load": _query("SELECT * FROM loaded"),
    "load_stats": _query("""
SELECT 'events' AS model, company_id, n_ok AS rows, n_bad AS invalid_rows, last_seen AS watermark FROM stats"""),
    "window_tag": _query("""
SELECT o_orderkey, company_id AS company, CAST(o_orderdate AS DATE) AS date,
       EXISTS (SELECT 1 FROM windows w WHERE w.company_id = o.company_id AND w.kind = 'STOCKOUT'
               AND CAST(o.o_orderdate AS DATE) BETWEEN w.d0 AND w.d1) AS is_stockout,
       CASE WHEN EXISTS (SELECT 1 FROM windows w WHERE w.company_id = o.company_id AND w.kind = 'SUPPLIER_DELAY'
               AND CAST(o.o_orderdate AS DATE) BETWEEN w.d0 AND w.d1) THEN 15 ELSE 0 END AS delay_add,
       EXISTS (SELECT 1 FROM windows w WHERE w.company_id = o.company_id AND w.kind = 'SHRINKAGE'
               AND CAST(o.o_orderdate AS DATE) = w.d0) AS is_shrinkage
FROM order_company o"""),
    "category_vendors": """
SELECT DISTINCT p_type || '/' || p_brand AS category, l_suppkey AS partner_id
FROM lineitem JOIN part ON p_partkey = l_partkey WHERE l_suppkey % 3 IN (0, 2) AND l_suppkey <> 0 AND p_partkey <> 0""",
    "vendors_by_category": _query("""
SELECT c.category, count(v.vendor) AS vendors, coalesce(string_agg(CAST(v.vendor AS VARCHAR), ',' ORDER BY v.vendor), '')
         AS vendor_ids
FROM (SELECT DISTINCT p_type || '/' || p_brand AS category FROM part
      UNION SELECT DISTINCT 'No ' || p_type FROM part) c
LEFT JOIN (SELECT DISTINCT p_type || '/' || p_brand AS category, l_suppkey AS vendor
           FROM lineitem JOIN part ON p_partkey = l_partkey
           WHERE l_suppkey % 3 IN (0, 2) AND l_suppkey <> 0 AND p_partkey <> 0) v USING (category)
GROUP BY c.category"""),
    "top_n_scope": _query("""
SELECT m.company_id, m.product_id, CAST(count(*) AS INTEGER) AS months
FROM monthly m JOIN (SELECT company_id, product_id FROM abc_totals
                     ORDER BY total DESC, company_id, product_id LIMIT 50) USING (company_id, product_id)
GROUP BY ALL"""),
    "slug": """
SELECT p_partkey, trim(regexp_replace(regexp_replace(upper(regexp_replace(regexp_replace(
         trim('  ' || p_name || ' / ' || p_brand || ' - (x)  '), '\\s+', '_', 'g'), '[-/]+', '_', 'g')),
         '[^A-Z0-9_]+', '', 'g'), '_+', '_', 'g'), '_') AS slug
FROM part""",
    "place_name": """
SELECT p_partkey,
       CASE WHEN p_partkey % 2 = 1 THEN trim(regexp_replace(p_name || ' ' || p_type, '\\s+', ' ', 'g'))
            ELSE (SELECT string_agg(upper(w[1]) || lower(w[2:]), '' ORDER BY i)
                  FROM (SELECT unnest(words) AS w, generate_subscripts(words, 1) AS i
                        FROM (SELECT regexp_extract_all(p_name || '-o''' || p_type, '[A-Za-z]+|[^A-Za-z]+') AS words)))
       END AS place
FROM part""",
    "location_parse": """
SELECT p_partkey,
       CASE WHEN ok THEN kind END AS kind, CASE WHEN ok THEN base END AS base
FROM (SELECT p_partkey, kind, concat_ws('-', brand, east) AS base,
             p_partkey % 9 <> 0 AND kind <> 'OTHER' AND (brand IS NOT NULL OR east IS NOT NULL) AS ok
      FROM (SELECT p_partkey,
                   CASE WHEN p_size < 15 THEN 'GOOD' WHEN p_size < 30 THEN 'TRANSIT' WHEN p_size < 40 THEN 'DAMAGED'
                        ELSE 'OTHER' END AS kind,
                   CASE WHEN p_partkey % 10 <> 0 THEN p_brand END AS brand,
                   CASE WHEN p_partkey % 3 = 0 THEN 'EAST' END AS east FROM part))""",
    "document_key": _query("""
SELECT o_orderkey, 'SEED17/d1/KE/WH' || company_id || '/OUT/' || strftime(o_orderdate, '%Y-%m-%d') || '/'
         || CASE WHEN o_orderkey < 10000 THEN lpad(CAST(o_orderkey AS VARCHAR), 4, '0')
                 ELSE CAST(o_orderkey AS VARCHAR) END AS document,
       'KE' AS country, 'WH' || company_id AS warehouse, CAST(o_orderdate AS DATE) AS day,
       CAST(o_orderkey AS INTEGER) AS seq
FROM order_company"""),
    "stable_id": """
SELECT p_partkey, CAST(h AS VARCHAR) AS stable_int, CAST(h % 900000000 + 100000000 AS BIGINT) AS stable_id
FROM (SELECT p_partkey, CAST('0x' || substr(sha256('product.product:' || p_brand || ':' || p_partkey), 1, 16) AS UBIGINT)
               AS h FROM part)""",
    "seasonal": _query("""
SELECT d.country, d.category, d.day, round(1.0 + c.amplitude * least(sum(""" + _PULSE.format(
        d="(d.day - make_date(CAST(year(d.day) - y.back AS BIGINT), s.m, s.dd) - c.lag)") + """), 1.25), 6) AS multiplier
FROM (SELECT DISTINCT (['rw', 'KE', 'ug'])[company_id % 3 + 1] AS country,
        (['Seeds', 'Fertilizer', 'Pesticides', 'Tools', 'Spare Parts', 'Packaging'])[product_id % 6 + 1] AS category,
        CAST(date_done AS DATE) AS day FROM stock_move_raw) d
JOIN (VALUES ('rw', 2, 10), ('rw', 9, 10), ('ke', 3, 15), ('ke', 10, 10), ('ug', 3, 15), ('ug', 9, 10)) s(cc, m, dd)
  ON s.cc = lower(d.country)
JOIN (VALUES ('Seeds', 0, 2.2, 14, 28, 14), ('Fertilizer', 18, 1.6, 14, 28, 14), ('Pesticides', 35, 1.2, 10, 28, 10),
             ('Tools', 7, 0.35, 10, 35, 10), ('Spare Parts', 7, 0.30, 10, 35, 10), ('Packaging', 75, 0.9, 14, 28, 14))
     c(category, lag, amplitude, ramp, peak, decay) ON c.category = d.category
CROSS JOIN (VALUES (0), (1)) y(back)
GROUP BY d.country, d.category, d.day, c.amplitude"""),
    "weekday": _query("""
SELECT day, kind,
       CASE kind WHEN 'outbound' THEN CASE isodow(day) WHEN 7 THEN 0.15 WHEN 6 THEN 0.65 ELSE 1.0 END
                 WHEN 'inbound' THEN CASE WHEN isodow(day) >= 6 THEN 0.25 ELSE 1.0 END
                 ELSE CASE WHEN isodow(day) BETWEEN 2 AND 4 THEN 1.2 WHEN isodow(day) = 7 THEN 0.4 ELSE 0.9 END
       END :: DOUBLE AS multiplier
FROM (SELECT DISTINCT CAST(scheduled_date AS DATE) AS day,
             CASE kind WHEN 'OUT' THEN 'outbound' WHEN 'IN' THEN 'inbound' ELSE 'internal' END AS kind FROM report_move)"""),
    "calendar": """
SELECT CAST(o_orderdate AS DATE) - CAST(k AS INTEGER) AS day, count(*) AS orders
FROM orders JOIN (VALUES (0), (1), (2)) b(k) ON b.k < o_orderkey % 5 - 1
GROUP BY ALL""",
    "month_partition": _query("""
SELECT strftime(date_done, '%Y%m') AS p_month, CAST(date_trunc('month', date_done) + INTERVAL 1 MONTH AS DATE) AS next_month,
       count(*) AS moves FROM stock_move GROUP BY ALL"""),
    "geo_json": """
SELECT p_partkey, 'ke' AS country, place AS warehouse_name, upper(replace(place, ' ', '_')) AS slug,
       CAST(u.ord AS INTEGER) AS ord, CASE u.ord WHEN 0 THEN p_brand WHEN 1 THEN upper(p_type[1]) || lower(p_type[2:]) END AS base_unit
FROM (SELECT *, CASE WHEN p_partkey % 2 = 0 THEN p_name
                     ELSE upper(split_part(p_name, ' ', 1)[1]) || lower(split_part(p_name, ' ', 1)[2:]) || ' ' ||
                          upper(split_part(p_name, ' ', 2)[1]) || lower(split_part(p_name, ' ', 2)[2:]) END AS place FROM part)
JOIN (VALUES (0), (1), (NULL)) u(ord) ON (p_size > 5 AND u.ord IS NOT NULL) OR (p_size <= 5 AND u.ord IS NULL)""",
    "geo_text": """
SELECT p_partkey, 'rw' AS country, p_name AS warehouse_name, upper(replace(p_name, ' ', '_')) AS slug,
       CAST(u.ord AS INTEGER) AS ord, CASE u.ord WHEN 0 THEN p_brand WHEN 1 THEN upper(p_type[1]) || lower(p_type[2:]) END AS base_unit
FROM part JOIN (VALUES (0), (1), (NULL)) u(ord)
  ON (p_size > 3 AND u.ord IS NOT NULL) OR (p_size = 3 AND u.ord IS NULL)""",
    "base_units": """
SELECT s_suppkey, (['Sector', 'Sub-county', 'County'])[s_nationkey % 3 + 1] || ' ' || lpad(CAST(k AS VARCHAR), 3, '0')
         AS base_unit
FROM supplier JOIN (VALUES (1), (2), (3)) b(k) ON b.k <= s_suppkey % 4""",
}
ORACLE |= {
    "load_twice": _query("SELECT * FROM twice"),
    "load_twice_log": _query("""
SELECT company_id, CAST(count(*) FILTER (WHERE ok) AS BIGINT) AS rows, CAST(count(*) FILTER (WHERE NOT ok) AS BIGINT) AS invalid_rows
FROM (SELECT company_id, id <> 0 AND product_id <> 0 AND date_done IS NOT NULL AND write_date IS NOT NULL AS ok
      FROM copies_of_both) GROUP BY ALL
UNION ALL SELECT NULL, 0, count(*) FROM orders WHERE o_orderkey % 50 = 0 HAVING count(*) > 0"""),
    "load_all": _query("""
SELECT 'stock.move.line' AS model, company_id, count(*) FILTER (WHERE ok) AS rows, count(*) FILTER (WHERE NOT ok) AS invalid_rows,
       CAST(NULL AS TIMESTAMP) AS restamped, CAST(NULL AS BIGINT) AS companies
FROM (SELECT company_id, id <> 0 AND product_id <> 0 AND date_done IS NOT NULL AND write_date IS NOT NULL AS ok
      FROM landing WHERE state = 'done' AND company_id IN (0, 2, 3)) GROUP BY ALL
UNION ALL SELECT 'res.company', 0, count(*), 0, TIMESTAMP '2024-02-01 06:00:00', count(*) FROM region"""),
    "merge_stored": _query("SELECT *, strftime(date_done, '%Y%m') AS p_month FROM merged"),
    "append_read": _query("SELECT id, company_id, name, supplier_rank FROM res_partner"),
    "mart_rerun": _query("""
SELECT month, company_id, coalesce(rc.name, '') AS company_name, partner_id, round(on_time_pct, 6) AS on_time_pct,
       round(in_full_pct, 6) AS in_full_pct,
       CASE WHEN year(month) = 1995 THEN 0.5 ELSE round(overall_score, 6) END AS overall_score, strftime(month, '%Y%m') AS p_month
FROM rating x LEFT JOIN res_company rc ON rc.id = x.company_id WHERE month < DATE '1997-07-01'"""),
    "forecast_rerun": f"""
SELECT * REPLACE (CASE WHEN product_id % 2 = 0 THEN forecast_qty + 1 ELSE forecast_qty END AS forecast_qty)
FROM ({ORACLE["forecast_ma"]})""",
    "named_tables": _query("""
SELECT rc.name, strftime(m.date_done, '%Y%m') AS p_month, count(*) AS moves, sum(m.quantity_done) AS qty
FROM merged m JOIN res_company rc ON rc.id = m.company_id WHERE m.date_done >= TIMESTAMP '1995-01-01' GROUP BY ALL"""),
    "liquidation_stored": _query("""
SELECT x.company_id, x.product_id, x.last_day AS last_movement_date,
       CAST(DATE '1998-06-15' - x.last_day AS INTEGER) AS days_since_last_move, round(coalesce(q.on_hand_qty, 0.0), 6) AS on_hand_qty
FROM (SELECT company_id, product_id, max(CAST(date_done AS DATE)) AS last_day FROM twice
      WHERE date_done < TIMESTAMP '1998-06-16' GROUP BY ALL) x
LEFT JOIN on_hand_qty q ON q.company_id = x.company_id AND q.product_id = x.product_id
WHERE DATE '1998-06-15' - x.last_day > 90"""),
    "reset_marks": _query("""
SELECT 'events' AS model, company_id,
       CASE WHEN company_id = 3 THEN watermark ELSE TIMESTAMP '1970-01-01' END AS watermark FROM mark"""),
    "report_csv": _query("""
SELECT country, dataset, count(*) AS pickings, CAST(sum(n) AS BIGINT) AS lines, sum(q) AS qty FROM (
  SELECT 'c/' || company_id AS country, 'd ' || kind AS dataset, origin, scheduled_date, source_location_id, dest_location_id,
         count(*) AS n, sum(qty_done) AS q
  FROM report_move WHERE NOT (company_id = 2 AND kind = 'OUT') OR qty_done > 10 GROUP BY ALL)
GROUP BY ALL"""),
    "named_parameters": _query("""
SELECT product_id, count(*) AS moves, max(date_done) AS last FROM stock_move WHERE date_done < DATE '1998-06-15'
GROUP BY product_id HAVING date_diff('day', CAST(max(date_done) AS DATE), DATE '1998-06-15') > 90"""),
}
ORACLE["touch_ratio_by_route"] = ORACLE["touch_ratio"]
