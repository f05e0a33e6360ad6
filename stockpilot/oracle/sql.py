"""Independent SQL specification of the job, for DuckDB.

It runs on the driver's pre-registered views of the TPC-H-style tables
(``part nation supplier orders lineitem``) and derives the fixture tables and
every stage with plain row-level SQL, the way the reference computes: orders
are joined row by row, duplicates are counted as rows, nothing is
pre-aggregated.  The Spark plan is built differently (pre-aggregated orders,
weights, windows), so agreement between the two is a real check.

Type notes: DuckDB sums integers to HUGEINT, so integer sums are cast back to
BIGINT; ``round_even`` pairs with Spark's ``bround``; ``trunc`` comes before
every cast to an integer (DuckDB's cast rounds); ``nullif`` guards division.
"""

from __future__ import annotations

import re

from stockpilot.config import Quirks

# Fixed values of the fixture definition (same as stockpilot.sources.fixtures).
AS_OF = "DATE '1998-06-01'"
EPOCH = "DATE '1995-01-01'"
REQUEST_DAY = "DATE '1998-06-15'"
REQUEST_ID = "fixture_run"

WH_POS = (
    "input_source_store, parent_sku, baby_sku, parent_oh, baby_oh, ppk_qty, lt_days, num_of_store, sku, style, color, coverage_date"
)
ST_POS = (
    "input_source_store, parent_sku, baby_sku, sku, style, color, store, sks_ord_level, store_oh, ppk_qty, "
    "provided_date, received_date, coverage_date, num_of_store"
)
ST_POS_OO = ST_POS + ", first_period_store_oo, second_period_store_oo"


def _cols(cols: str, alias: str) -> str:
    return ", ".join(f"{alias}.{c.strip()}" for c in cols.split(","))


def _not_null(cols: str, alias: str = "") -> str:
    pre = f"{alias}." if alias else ""
    return " AND ".join(f"{pre}{c.strip()} IS NOT NULL" for c in cols.split(","))


def _order_feed(odd: int, location: str) -> str:
    def shifted(day: str) -> str:
        return f"{AS_OF} + CAST(date_diff('day', {EPOCH}, {day}) % 120 - 30 + CASE WHEN l_partkey % 20 = 7 THEN 400 ELSE 0 END AS INTEGER)"

    return f"""
    SELECT l_partkey AS sku, CAST({location} AS INTEGER) AS store,
           CAST(trunc(l_quantity) AS INTEGER) AS ord_units,
           CASE WHEN l_linestatus = 'F' THEN CAST(trunc(l_quantity / 2) AS INTEGER) ELSE 0 END AS rcvd_units,
           {shifted('order_day')} AS first_ship_date,
           CASE WHEN l_returnflag = 'N' THEN NULL ELSE {shifted('ship_day')} END AS transit_date,
           CASE l_returnflag WHEN 'A' THEN 'Y' WHEN 'R' THEN '' WHEN 'N' THEN 'N' END AS promo_fl
    FROM (SELECT * FROM order_lines UNION ALL SELECT * FROM order_lines WHERE l_partkey % 40 = 0)
    WHERE l_linenumber % 2 = {odd}"""


FIXTURE_TABLES = (
    "request", "catalog", "inventory", "order_lines", "warehouse_feed", "store_feed", "warehouse_orders", "store_orders", "forecast",
)


def ctes(
    q: Quirks | None = None,
    request_id: str = REQUEST_ID,
    as_of: str | None = None,
    given_tables: bool = False,
    fractional: bool = False,
    text_keys: bool = False,
) -> list[tuple[str, str]]:
    """The CTE chain.  With ``given_tables`` the six inputs are expected as
    tables of those names instead of being derived from the TPC-H tables; with
    ``fractional`` their quantities are doubles.  ``text_keys`` turns the SKUs
    of the fixture tables into zero-padded text."""
    q = q or Quirks()

    def as_quantity(total: str) -> str:
        return total if fractional else f"CAST({total} AS BIGINT)"

    run_day = f"DATE '{as_of}'" if as_of else AS_OF
    store_window = "calculated_date + lt_days <= coverage_date" if q.store_extra_lead else "calculated_date <= coverage_date"
    second_lower = ">=" if q.include_received_day else ">"
    both_join = "JOIN" if q.require_both_periods else "LEFT JOIN"
    pack_keys = ["parent_sku"] if q.pack_max_scope == "parent" else ["parent_sku", "input_source_store"]
    pack_on = " AND ".join(f"s.{k} = r.{k}" for k in pack_keys)
    zero_copies = "CAST(1 AS BIGINT)" if q.dedupe_zero_fill else "count(*)"

    def zero_filter(alias: str, pos_cte: str, window_cte: str, pos_cols: str) -> str:
        if q.zero_fill_grain == "sku":
            return f"NOT EXISTS (SELECT 1 FROM {pos_cte} w WHERE w.parent_sku = {alias}.parent_sku)"
        cond = " AND ".join(f"w.{c.strip()} IS NOT DISTINCT FROM {alias}.{c.strip()}" for c in pos_cols.split(","))
        return f"NOT EXISTS (SELECT 1 FROM {window_cte} w WHERE {cond})"

    chain = [
        # ---- fixture tables -------------------------------------------------
        ("request", f"""
    SELECT p_name AS style, p_brand AS color,
           strftime({REQUEST_DAY} + CAST(7 * (min(p_partkey) % 3) AS INTEGER), '%Y-%m-%d') AS provided_date,
           CAST(28 + 7 * (min(p_partkey) % 4) AS INTEGER) AS coverage_day
    FROM part WHERE p_size <= 10 GROUP BY p_name, p_brand
    UNION ALL SELECT 'no such style', 'Brand#0', '1998-06-15', 28"""),
        ("catalog", "SELECT p_name AS style, p_brand AS color, p_partkey AS sku, p_partkey * 10 AS item_id FROM part"),
        ("inventory", """
    SELECT n_regionkey AS input_source_store, n_nationkey AS store, p_partkey AS parent_sku,
           CASE WHEN promo THEN 1000000 + p_partkey * 10 + j ELSE p_partkey END AS baby_sku,
           (p_partkey * 7 + n_regionkey * 13) % 50 AS parent_oh,
           (p_partkey * 3 + j * 11 + n_regionkey * 5) % 40 AS baby_oh,
           (p_partkey + n_nationkey * 3 + j) % 20 AS store_oh,
           CAST(CASE WHEN promo THEN 12 ELSE 1 + p_size % 3 END AS BIGINT) AS ppk_qty,
           CAST(7 + 2 * n_regionkey AS DOUBLE) AS lt_days,
           5 + p_partkey % 11 AS sks_ord_level
    FROM (SELECT p_partkey, p_size, p_type = 'PROMO' AS promo,
                 unnest(CASE WHEN p_type = 'PROMO' THEN [1, 2, 3] ELSE [1] END) AS j
          FROM part WHERE p_partkey % 10 <> 0) p
    JOIN nation ON (p_partkey + n_nationkey) % 4 = 0"""),
        ("order_lines", """
    SELECT l_partkey, l_linenumber, l_quantity, l_returnflag, l_linestatus,
           CAST(l_shipdate AS DATE) AS ship_day, CAST(o_orderdate AS DATE) AS order_day, n_nationkey, n_regionkey
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey
    JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey"""),
        ("warehouse_feed", _order_feed(0, "n_regionkey")),
        ("store_feed", _order_feed(1, "n_nationkey")),
        ("warehouse_orders", "SELECT DISTINCT * FROM warehouse_feed"),
        ("store_orders", "SELECT DISTINCT * FROM store_feed"),
        ("forecast", f"""
    SELECT sku, store, {AS_OF} + CAST(7 * k AS INTEGER) AS cal_date,
           CAST((sku + store * 3 + k) % 9 AS DOUBLE) * 2.5 AS forecast
    FROM (SELECT baby_sku AS sku, store, unnest(range(0, 18)) AS k
          FROM (SELECT DISTINCT baby_sku, store FROM inventory))
    WHERE NOT (((sku + store) % 13 = 0 AND k < 5) OR ((sku + store) % 17 = 0 AND k >= 3))"""),
        # ---- request and extracts -----------------------------------------
        ("looked_up", """
    SELECT * FROM catalog c
    WHERE EXISTS (SELECT 1 FROM request r WHERE r.style = c.style AND r.color = c.color)"""),
        ("isku", """
    SELECT COALESCE(c.style, r.style) AS style, COALESCE(c.color, r.color) AS color, c.sku, c.item_id,
           CAST(r.provided_date AS DATE) AS provided_date, r.coverage_day
    FROM looked_up c FULL OUTER JOIN request r ON c.style = r.style AND c.color = r.color"""),
        ("sku_list", "SELECT DISTINCT sku FROM isku WHERE sku IS NOT NULL"),
        ("wo", """
    SELECT sku, store AS input_source_store, ord_units, rcvd_units, first_ship_date, transit_date, promo_fl
    FROM warehouse_orders WHERE sku IN (SELECT sku FROM sku_list)"""),
        ("so", "SELECT * FROM store_orders WHERE sku IN (SELECT sku FROM sku_list)"),
        ("inv0", "SELECT * FROM inventory WHERE parent_sku IN (SELECT sku FROM sku_list)"),
        ("store_counts", """
    SELECT input_source_store, count(DISTINCT store) AS num_of_store FROM inv0 GROUP BY input_source_store"""),
        ("inv", "SELECT inv0.*, sc.num_of_store FROM inv0 LEFT JOIN store_counts sc USING (input_source_store)"),
        ("missing", """
    SELECT DISTINCT i.sku FROM isku i WHERE NOT EXISTS (SELECT 1 FROM inv WHERE inv.parent_sku = i.sku)"""),
        # ---- warehouse positions ------------------------------------------
        ("whse_oh", f"""
    SELECT input_source_store, parent_sku, baby_sku, parent_oh, baby_oh,
           min(ppk_qty) AS ppk_qty, min(lt_days) AS lt_days, min(num_of_store) AS num_of_store
    FROM inv WHERE {_not_null('input_source_store, parent_sku, baby_sku, parent_oh, baby_oh')}
    GROUP BY input_source_store, parent_sku, baby_sku, parent_oh, baby_oh"""),
        ("whse_oo", """
    SELECT h.*, o.ord_units, o.rcvd_units, o.first_ship_date, o.transit_date, o.promo_fl
    FROM whse_oh h LEFT JOIN wo o ON o.sku = h.parent_sku AND o.input_source_store = h.input_source_store"""),
        ("whx", """
    SELECT h.*, h.parent_sku AS sku, i.style, i.color, i.item_id, i.provided_date, i.coverage_day
    FROM whse_oo h JOIN isku i ON i.sku = h.parent_sku"""),
        ("whx_d", """
    SELECT * REPLACE (CAST(trunc(lt_days) AS INTEGER) AS lt_days),
           provided_date + CAST(trunc(lt_days) AS INTEGER) AS received_date,
           provided_date + CAST(trunc(lt_days) AS INTEGER) + coverage_day AS coverage_date,
           COALESCE(transit_date, first_ship_date) + CAST(trunc(lt_days) AS INTEGER) AS calculated_date
    FROM whx"""),
        ("whx_in", "SELECT * FROM whx_d WHERE calculated_date <= coverage_date"),
        ("wh_tot", """
    SELECT sku, input_source_store,
           CAST(COALESCE(sum(CASE WHEN calculated_date <= received_date THEN ord_units END), 0)
              - COALESCE(sum(CASE WHEN calculated_date <= received_date THEN rcvd_units END), 0) AS BIGINT) AS first_units,
           CAST(COALESCE(sum(CASE WHEN calculated_date > received_date THEN ord_units END), 0) AS BIGINT) AS second_units
    FROM whx_in GROUP BY sku, input_source_store"""),
        ("wh_in", f"""
    SELECT DISTINCT {_cols(WH_POS, 'd')},
           t.first_units * d.ppk_qty AS first_period_short_term_oo,
           t.second_units * d.ppk_qty AS second_period_short_term_oo,
           CAST(1 AS BIGINT) AS copies
    FROM whx_in d JOIN wh_tot t ON t.sku = d.sku AND t.input_source_store = d.input_source_store
    WHERE {_not_null(WH_POS, 'd')}"""),
        ("wh_zero", f"""
    SELECT {WH_POS}, CAST(0 AS BIGINT) AS first_period_short_term_oo, CAST(0 AS BIGINT) AS second_period_short_term_oo,
           {zero_copies} AS copies
    FROM whx_d d WHERE {zero_filter('d', 'wh_in', 'whx_in', WH_POS)}
    GROUP BY {WH_POS}"""),
        ("warehouse_position", "SELECT * FROM wh_in UNION ALL SELECT * FROM wh_zero"),
        # ---- store positions ------------------------------------------------
        ("store_oo", """
    SELECT v.*, o.ord_units, o.rcvd_units, o.first_ship_date, o.transit_date, o.promo_fl
    FROM inv v LEFT JOIN so o ON o.sku = v.parent_sku AND o.store = v.store"""),
        ("stx", """
    SELECT v.*, v.parent_sku AS sku, i.style, i.color, i.item_id, i.provided_date, i.coverage_day
    FROM store_oo v JOIN isku i ON i.sku = v.parent_sku"""),
        ("stx_d", """
    SELECT * REPLACE (CAST(trunc(lt_days) AS INTEGER) AS lt_days),
           provided_date + CAST(trunc(lt_days) AS INTEGER) AS received_date,
           provided_date + CAST(trunc(lt_days) AS INTEGER) + coverage_day AS coverage_date,
           COALESCE(transit_date, first_ship_date) + CAST(trunc(lt_days) AS INTEGER) AS calculated_date
    FROM stx"""),
        ("stx_in", f"SELECT * FROM stx_d WHERE {store_window}"),
        ("st_tot", """
    SELECT sku, store,
           CAST(COALESCE(sum(CASE WHEN calculated_date <= received_date THEN ord_units END), 0)
              - COALESCE(sum(CASE WHEN calculated_date <= received_date THEN rcvd_units END), 0) AS BIGINT) AS first_units,
           CAST(COALESCE(sum(CASE WHEN calculated_date > received_date THEN ord_units END), 0) AS BIGINT) AS second_units
    FROM stx_in GROUP BY sku, store"""),
        ("st_in", f"""
    SELECT DISTINCT {_cols(ST_POS, 'd')},
           t.first_units * d.ppk_qty AS first_period_store_oo,
           t.second_units * d.ppk_qty AS second_period_store_oo,
           CAST(1 AS BIGINT) AS copies
    FROM stx_in d JOIN st_tot t ON t.sku = d.sku AND t.store = d.store
    WHERE {_not_null(ST_POS, 'd')}"""),
        ("st_zero", f"""
    SELECT {ST_POS}, CAST(0 AS BIGINT) AS first_period_store_oo, CAST(0 AS BIGINT) AS second_period_store_oo,
           {zero_copies} AS copies
    FROM stx_d d WHERE {zero_filter('d', 'st_in', 'stx_in', ST_POS)}
    GROUP BY {ST_POS}"""),
        ("store_position", "SELECT * FROM st_in UNION ALL SELECT * FROM st_zero"),
        # ---- forecast ---------------------------------------------------------
        ("max_cov", "SELECT max(coverage_date) AS max_coverage_date FROM stx_d"),
        ("first_day_needed", f"SELECT least({run_day}, min(received_date)) AS first_day FROM stx_d"),
        ("fc", """
    SELECT * FROM forecast
    WHERE sku IN (SELECT baby_sku FROM inv) AND cal_date <= (SELECT max_coverage_date FROM max_cov)
      AND cal_date >= (SELECT first_day FROM first_day_needed)"""),
        ("sp_rows", """
    SELECT p.*, f.cal_date, f.forecast FROM store_position p
    LEFT JOIN fc f ON f.sku = p.baby_sku AND f.store = p.store"""),
        ("f1", f"""
    SELECT parent_sku, baby_sku, store, COALESCE(sum(copies * forecast), 0) AS first_period_total_forecast
    FROM sp_rows WHERE cal_date >= {run_day} AND cal_date < received_date GROUP BY parent_sku, baby_sku, store"""),
        ("f2", f"""
    SELECT parent_sku, baby_sku, store, COALESCE(sum(copies * forecast), 0) AS second_period_total_forecast
    FROM sp_rows WHERE cal_date {second_lower} received_date AND cal_date <= coverage_date GROUP BY parent_sku, baby_sku, store"""),
        ("spf", f"""
    SELECT DISTINCT {_cols(ST_POS_OO, 'p')},
           COALESCE(f1.first_period_total_forecast, 0) AS first_period_total_forecast,
           COALESCE(f2.second_period_total_forecast, 0) AS second_period_total_forecast
    FROM store_position p
    {both_join} f1 ON f1.parent_sku = p.parent_sku AND f1.baby_sku = p.baby_sku AND f1.store = p.store
    {both_join} f2 ON f2.parent_sku = p.parent_sku AND f2.baby_sku = p.baby_sku AND f2.store = p.store"""),
        # ---- replenishment ----------------------------------------------------
        ("need", """
    SELECT *,
           CASE WHEN store_oh - expected_demand < sks_ord_level THEN 'Y' ELSE 'N' END AS replenishment_order,
           greatest(CASE WHEN store_oh - expected_demand < sks_ord_level
                         THEN sks_ord_level - (store_oh + first_period_store_oo - expected_demand) ELSE 0 END, 0)
               AS replenishment_order_qty
    FROM (SELECT *, round_even(first_period_total_forecast, 0) AS expected_demand FROM spf)"""),
        ("wneed", """
    SELECT parent_sku, baby_sku, input_source_store, sum(q) AS total_replenishment_order_qty
    FROM (SELECT parent_sku, baby_sku, input_source_store, store, min(replenishment_order_qty) AS q
          FROM need WHERE parent_sku IS NOT NULL AND baby_sku IS NOT NULL
                      AND input_source_store IS NOT NULL AND store IS NOT NULL
          GROUP BY parent_sku, baby_sku, input_source_store, store)
    GROUP BY parent_sku, baby_sku, input_source_store"""),
        ("proj_rows", """
    SELECT w.*, COALESCE(n.total_replenishment_order_qty, 0) AS total_replenishment_order_qty,
           greatest(w.baby_oh + w.first_period_short_term_oo - COALESCE(n.total_replenishment_order_qty, 0), 0)
               AS projected_warehouse_oh
    FROM warehouse_position w LEFT JOIN wneed n
      ON n.parent_sku = w.parent_sku AND n.baby_sku = w.baby_sku AND n.input_source_store = w.input_source_store"""),
        ("projection", f"""
    SELECT parent_sku, baby_sku, ppk_qty, input_source_store, num_of_store, coverage_date,
           {as_quantity('sum(second_period_short_term_oo * copies)')} AS total_second_period_short_term_oo,
           sum(projected_warehouse_oh * copies) AS total_projected_warehouse_oh
    FROM proj_rows WHERE {_not_null('parent_sku, baby_sku, ppk_qty, input_source_store, num_of_store, coverage_date')}
    GROUP BY parent_sku, baby_sku, ppk_qty, input_source_store, num_of_store, coverage_date"""),
        ("wfc", f"""
    SELECT parent_sku, baby_sku, input_source_store,
           {as_quantity('sum(second_period_store_oo)')} AS second_period_store_oo,
           sum(second_period_total_forecast) AS second_period_total_forecast
    FROM spf GROUP BY parent_sku, baby_sku, input_source_store"""),
        ("recommended", """
    SELECT p.*, w.second_period_store_oo, w.second_period_total_forecast,
           greatest((w.second_period_total_forecast - w.second_period_store_oo)
                    - (p.total_second_period_short_term_oo + p.total_projected_warehouse_oh), 0) AS recomended_order_qty
    FROM projection p LEFT JOIN wfc w
      ON w.parent_sku = p.parent_sku AND w.baby_sku = p.baby_sku AND w.input_source_store = p.input_source_store"""),
        ("pack_stats", f"""
    SELECT {', '.join(pack_keys)}, count(DISTINCT baby_sku) = 1 AS single_baby,
           max(recomended_order_qty) AS max_order_qty, max(ppk_qty) AS max_ppk_qty
    FROM recommended GROUP BY {', '.join(pack_keys)}"""),
        ("packed", f"""
    SELECT r.*, s.single_baby, s.max_order_qty, s.max_ppk_qty,
           CAST(CASE WHEN s.single_baby THEN round_even(r.recomended_order_qty / nullif(r.ppk_qty, 0), 0)
                     ELSE round_even(s.max_order_qty / nullif(s.max_ppk_qty, 0), 0) END AS BIGINT) AS recomended_order_units
    FROM recommended r JOIN pack_stats s ON {pack_on}"""),
        ("recommendations", f"""
    SELECT input_source_store, parent_sku, baby_sku, recomended_order_units, num_of_store,
           coverage_date AS next_ship_date, '{request_id}' AS request_id
    FROM packed"""),
        ("missing_skus", f"SELECT sku, '{request_id}' AS request_id FROM missing"),
    ]
    if given_tables:
        chain = [(n, b) for n, b in chain if n not in FIXTURE_TABLES]
    if text_keys:
        keys = {"catalog": ["sku"], "inventory": ["parent_sku", "baby_sku"], "forecast": ["sku"],
                "warehouse_orders": ["sku"], "store_orders": ["sku"]}
        renamed = [(f"{n}_by_number" if n in keys else n, b) for n, b in chain]
        chain = []
        for (n, b), (old, _) in zip(renamed, ctes(q, request_id, as_of)):
            # A fixture table reads the numbered form of another one.
            chain.append((n, re.sub(r"\binventory\b", "inventory_by_number", b) if old == "forecast" else b))
            if old in keys:
                text = ", ".join(f"lpad(CAST({k} AS VARCHAR), 12, '0') AS {k}" for k in keys[old])
                chain.append((old, f"SELECT * REPLACE ({text}) FROM {n}"))
    return chain


_WORD = re.compile(r"[A-Za-z_][A-Za-z0-9_]*")


def with_ctes(
    select: str,
    q: Quirks | None = None,
    request_id: str = REQUEST_ID,
    as_of: str | None = None,
    given_tables: bool = False,
    fractional: bool = False,
    text_keys: bool = False,
) -> str:
    """``select`` preceded by the CTEs it needs, directly or through others."""
    defs = ctes(q, request_id, as_of, given_tables, fractional, text_keys)
    names = {n for n, _ in defs}
    needed: set[str] = set()
    todo = [w for w in _WORD.findall(select) if w in names]
    body = dict(defs)
    while todo:
        n = todo.pop()
        if n in needed:
            continue
        needed.add(n)
        todo.extend(w for w in _WORD.findall(body[n]) if w in names and w not in needed)
    parts = [f"{n} AS ({b}\n)" for n, b in defs if n in needed]
    return ("WITH " + ",\n".join(parts) + "\n" if parts else "") + select
