"""SQL oracles: the same results written independently for DuckDB.

``STEPS`` are shared sub-queries; a step or view is pulled in as a CTE where its name occurs.
"""

from __future__ import annotations

import math
import re

from larder.functions.fixed import (
    BAD_DISCOUNT, BAD_PRICE, BAD_QUANTITY, BAD_RATING, EXACT_DUPLICATES, IMPLAUSIBLE_DATE, IMPOSSIBLE_WASTE,
    INVALID_BRANCH, INVALID_LOCATION, MISSING_CUSTOMER, MISSING_ITEM, NEGATIVE_STOCK, ORPHAN_LINES, ORPHAN_RATING,
    Q_CHANNEL, Q_FUTURE, Q_OLD, Q_ORPHAN_LINE, Q_ORPHAN_RATING, Q_STATUS, Q_STOCK, Q_UNIT, Q_UNKNOWN_ITEM,
    Q_UNPARSEABLE, Q_WASTE, UNKNOWN_ITEM, UNPARSEABLE_DATE,
)
from larder.plans.queries import DISCOUNT_GRID, MINIMUMS, PREP_GRID, PRICE_GRID
from larder.plans.sales import SETTINGS as S
from larder.sources.fixtures import RAW_TABLES, with_clause

# cumulative Poisson probabilities of mean 1 as eight hexadecimal digits
POISSON = str([f"{int(sum(math.exp(-1) / math.factorial(i) for i in range(k + 1)) * 2 ** 32):08x}" for k in range(12)])
LOCS = "(" + ", ".join(f"'L{n:02d}'" for n in range(1, 21)) + ")"
DAY = "CASE WHEN try_cast(order_date AS date) IS NOT NULL THEN cast(order_date AS date) END"


def rnd(x: str, k: int) -> str:
    return f"cast(round(cast({x} AS decimal(38,{k + 4})), {k}) AS double)"


def money(x: str) -> str:
    return f"sum(cast({x} AS decimal(18,6)))"


def initcap(x: str) -> str:
    return (f"array_to_string(list_transform(string_split(lower(trim({x})), ' '), "
            "lambda w: upper(substr(w, 1, 1)) || substr(w, 2)), ' ')")


def pct(x: str, k: int = 1) -> str:
    return f"cast(cast(round(cast({x} AS decimal(18,6)) * 100, {k}) AS decimal(20,{k})) AS varchar) || '%'"


def dec(x: str, k: int) -> str:
    return f"cast(cast(round(cast({x} AS decimal(28,8)), {k}) AS decimal(24,{k})) AS varchar)"


def union(parts) -> str:
    return "\nUNION ALL\n".join(parts)


COLUMNS = {
    "menu_categories": "category_id category_name",
    "menu_items": "item_id item_name brand category_id base_cost is_active introduced_date",
    "restaurants": "location_id restaurant_name city area region",
    "customers": "customer_id home_city age_bracket signup_date",
    "pricing_history": "item_id price effective_from effective_to",
    "promotions": "promo_id promo_name discount_pct start_date end_date scope applicable_items category_id location_id",
    "orders": "order_id customer_id location_id order_date channel payment_method status promo_id",
    "order_items": "order_id item_id line_no quantity unit_price discount_pct line_total",
    "ratings": "order_id item_id customer_id rating_date rating_value",
    "inventory": "item_id location_id week_start opening_stock replenished_qty prepared_qty consumed_qty "
                 "closing_stock unit",
    "wastage": "item_id location_id waste_date quantity_wasted",
}
TYPES = {
    "menu_categories": "string string", "menu_items": "bigint string string string double boolean date",
    "restaurants": "string string string string string", "customers": "bigint string string date",
    "pricing_history": "bigint double date date",
    "promotions": "string string double date date string string string string",
    "orders": "bigint bigint string string string string string string",
    "order_items": "bigint bigint int int double double double", "ratings": "bigint bigint bigint date int",
    "inventory": "bigint string date bigint bigint bigint bigint bigint string", "wastage": "bigint string date int",
}

LINES_KNOWN = "item_id IN (SELECT item_id FROM fx_menu_items)"
ORDER_FAIL = f"""CASE WHEN customer_id IS NULL THEN '{MISSING_CUSTOMER}'
    WHEN location_id IS NULL OR location_id NOT IN {LOCS} THEN '{INVALID_BRANCH}'
    WHEN try_cast(order_date AS date) IS NULL THEN '{UNPARSEABLE_DATE}'
    WHEN try_cast(order_date AS date) NOT BETWEEN date '1990-01-01' AND date '2026-09-28' THEN '{IMPLAUSIBLE_DATE}'
    END"""
LINE_FAIL = f"""CASE WHEN item_id IS NULL THEN '{MISSING_ITEM}' WHEN NOT {LINES_KNOWN} THEN '{UNKNOWN_ITEM}'
    WHEN NOT quantity > 0 THEN '{BAD_QUANTITY}' WHEN NOT unit_price > 0 THEN '{BAD_PRICE}'
    WHEN discount_pct NOT BETWEEN 0 AND 100 THEN '{BAD_DISCOUNT}'
    WHEN order_id NOT IN (SELECT order_id FROM st_orders) THEN '{ORPHAN_LINES}' END"""
RATING_FAIL = f"""CASE WHEN rating_value NOT BETWEEN 1 AND 5 THEN '{BAD_RATING}'
    WHEN order_id NOT IN (SELECT order_id FROM st_orders) THEN '{ORPHAN_RATING}' END"""
WASTE_FAIL = f"""CASE WHEN quantity_wasted NOT BETWEEN 1 AND 1000 THEN '{IMPOSSIBLE_WASTE}'
    WHEN location_id NOT IN {LOCS} THEN '{INVALID_LOCATION}' WHEN item_id IS NULL THEN '{MISSING_ITEM}'
    WHEN NOT {LINES_KNOWN} THEN '{UNKNOWN_ITEM}' END"""
STOCK_FAIL = f"""CASE WHEN NOT closing_stock >= 0 THEN '{NEGATIVE_STOCK}'
    WHEN location_id NOT IN {LOCS} THEN '{INVALID_LOCATION}' END"""
FAILS = {"orders": ORDER_FAIL, "order_items": LINE_FAIL, "ratings": RATING_FAIL, "wastage": WASTE_FAIL,
         "inventory": STOCK_FAIL}
RULE_NAMES = {
    "orders": [MISSING_CUSTOMER, INVALID_BRANCH, UNPARSEABLE_DATE, IMPLAUSIBLE_DATE],
    "order_items": [MISSING_ITEM, UNKNOWN_ITEM, BAD_QUANTITY, BAD_PRICE, BAD_DISCOUNT, ORPHAN_LINES],
    "ratings": [BAD_RATING, ORPHAN_RATING],
    "wastage": [IMPOSSIBLE_WASTE, INVALID_LOCATION, MISSING_ITEM, UNKNOWN_ITEM],
    "inventory": [NEGATIVE_STOCK, INVALID_LOCATION],
}

WIN = S.collapse_window
REF = S.collapse_reference
DROP = S.rating_drop_window
BURST = S.burst_window


def between(column: str, window) -> str:
    return f"{column} BETWEEN date '{window[0]}' AND date '{window[1]}'"


STEPS: dict[str, str] = {
    # cleaning
    "st_orders": f"SELECT DISTINCT order_id FROM raw_orders WHERE {ORDER_FAIL} IS NULL",
    **{f"st_audit_{t}": f"SELECT *, {FAILS.get(t, 'NULL')} AS failed FROM "
       f"(SELECT {', '.join(COLUMNS[t].split())}, count(*) AS n_copies FROM {v} GROUP BY ALL) AS once"
       for t, v in RAW_TABLES.items()},
    # features
    "st_rated": f"""SELECT order_id, item_id, {rnd('avg(rating_value)', 2)} AS avg_rating, count(*) AS n_ratings
        FROM fx_ratings GROUP BY order_id, item_id""",
    "st_sales": """SELECT i.*, o.customer_id, o.location_id, o.order_date, o.channel, o.status, o.promo_id,
            unit_price * quantity * (1 - discount_pct / 100) AS net, status = 'Completed' AS done,
            isodow(order_date) IN (6, 7) AS weekend
        FROM fx_order_items AS i LEFT JOIN fx_orders AS o ON i.order_id = o.order_id""",
    "st_named": """SELECT s.*, m.item_name, m.brand, m.category_id, m.base_cost, c.category_name,
            net - base_cost * quantity AS profit
        FROM st_sales AS s LEFT JOIN fx_menu_items AS m ON s.item_id = m.item_id
        LEFT JOIN fx_menu_categories AS c ON m.category_id = c.category_id""",
    "st_waste_item": f"""SELECT item_id, CASE WHEN made > 0 THEN {rnd('coalesce(lost, 0) / made', 4)} END
            AS wastage_percent
        FROM (SELECT item_id, sum(prepared_qty) AS made FROM fx_stock_moves GROUP BY item_id) AS p
        LEFT JOIN (SELECT item_id, sum(quantity_wasted) AS lost FROM fx_wastage GROUP BY item_id) AS w
        USING (item_id)""",
    "st_sold": f"""SELECT s.item_id, cast(sum(quantity) AS bigint) AS total_quantity_sold,
            count(DISTINCT s.order_id) AS n_orders, {money('net')} AS net,
            {money('base_cost * quantity')} AS cost, {rnd('avg(r.avg_rating)', 3)} AS avg_rating,
            {rnd('avg(discount_pct)', 2)} AS avg_discount_pct,
            {rnd('avg(CASE WHEN weekend THEN 1.0 ELSE 0 END)', 3)} AS weekend_share
        FROM st_named AS s LEFT JOIN st_rated AS r ON s.order_id = r.order_id AND s.item_id = r.item_id
        WHERE done GROUP BY s.item_id""",
    "st_items": f"""SELECT q.item_id, item_name, category_id, category_name, base_cost, total_quantity_sold,
            n_orders, net_revenue, total_cost, total_profit, avg_rating, avg_discount_pct, weekend_share,
            {rnd('total_profit / net_revenue', 4)} AS profit_margin, wastage_percent
        FROM (SELECT *, cast(round(net, 2) AS double) AS net_revenue, cast(round(cost, 2) AS double) AS total_cost,
                     cast(round(net - cost, 2) AS double) AS total_profit FROM st_sold) AS q
        JOIN fx_menu_items USING (item_id) LEFT JOIN fx_menu_categories USING (category_id)
        LEFT JOIN st_waste_item USING (item_id)""",
    "st_rfm": f"""SELECT customer_id, count(DISTINCT order_id) AS frequency,
            cast(round({money('net')}, 2) AS double) AS monetary,
            cast((SELECT max(order_date) FROM st_sales WHERE done) - max(order_date) AS int) AS recency_days
        FROM st_sales WHERE done GROUP BY customer_id""",
    # classification
    **{f"st_{name}": f"""SELECT i.*, CASE WHEN profit_margin >= m AND total_quantity_sold >= u THEN 'Profit Driver'
            WHEN profit_margin < m AND total_quantity_sold >= u THEN 'Volume Driver'
            WHEN profit_margin >= m AND total_quantity_sold < u THEN 'Hidden Opportunity'
            ELSE 'Low Performer' END AS {label}
        FROM st_items AS i, (SELECT {fn}(profit_margin, 0.5) AS m, {fn}(total_quantity_sold, 0.5) AS u
                             FROM st_items) AS cut"""
       for name, label, fn in (("approx", "spark_label", "quantile_disc"), ("exact", "python_label", "quantile_cont"))},
    "st_compared": """SELECT a.item_id, a.item_name, spark_label, python_label,
            spark_label = python_label AS agree,
            CASE WHEN spark_label = python_label THEN 'Match' ELSE 'Disagreement' END AS match_status
        FROM st_approx AS a JOIN st_exact AS e ON a.item_id = e.item_id""",
    "st_places": f"""SELECT item_id, location_id, units, {rnd('profit / net', 4)} AS profit_margin, avg_rating,
            repeat_purchase_rate, {rnd('coalesce(lost, 0) / made', 4)} AS wastage_percent, history_days,
            units < 20 OR history_days < 60 AS insufficient_history
        FROM (SELECT s.item_id, location_id, cast(sum(quantity) AS bigint) AS units, {money('net')} AS net,
                     {money('profit')} AS profit, {rnd('avg(r.avg_rating)', 3)} AS avg_rating,
                     cast(max(order_date) - min(order_date) AS int) AS history_days
              FROM st_named AS s LEFT JOIN st_rated AS r ON s.order_id = r.order_id AND s.item_id = r.item_id
              WHERE done GROUP BY s.item_id, location_id) AS a
        JOIN (SELECT item_id, location_id, {rnd('avg(CASE WHEN n > 1 THEN 1.0 ELSE 0 END)', 4)}
                     AS repeat_purchase_rate
              FROM (SELECT item_id, location_id, customer_id, count(DISTINCT order_id) AS n FROM st_sales
                    WHERE done GROUP BY item_id, location_id, customer_id) AS c
              GROUP BY item_id, location_id) AS b USING (item_id, location_id)
        LEFT JOIN (SELECT item_id, location_id, sum(prepared_qty) AS made FROM fx_stock_moves
                   GROUP BY item_id, location_id) AS p USING (item_id, location_id)
        LEFT JOIN (SELECT item_id, location_id, sum(quantity_wasted) AS lost FROM fx_wastage
                   GROUP BY item_id, location_id) AS w USING (item_id, location_id)""",
    # customers
    "st_fr": "SELECT *, row_number() OVER (ORDER BY frequency, customer_id) AS rf, "
             "row_number() OVER (ORDER BY monetary, customer_id) AS rm, count(*) OVER () AS n FROM st_rfm",
    "st_scored": """SELECT customer_id, frequency, monetary, recency_days, r_score, f_score, m_score,
            r_score + f_score + m_score AS rfm_score
        FROM (SELECT f.*, CASE WHEN recency_days <= e[1] THEN 5 WHEN recency_days <= e[2] THEN 4
                     WHEN recency_days <= e[3] THEN 3 WHEN recency_days <= e[4] THEN 2 ELSE 1 END AS r_score,
                     cast(greatest(1, ceil(5 * (rf - 1) / (n - 1))) AS int) AS f_score,
                     cast(greatest(1, ceil(5 * (rm - 1) / (n - 1))) AS int) AS m_score
              FROM st_fr AS f, (SELECT quantile_cont(recency_days, [0.2, 0.4, 0.6, 0.8]) AS e FROM st_rfm) AS q) AS x""",
    "st_segmented": """SELECT *, CASE WHEN rfm_score >= 12 THEN 'Loyal High Spender'
            WHEN r_score <= 2 AND f_score >= 3 THEN 'At Risk' WHEN f_score <= 2 AND r_score >= 4 THEN 'New Customer'
            ELSE 'Regular' END AS segment FROM st_scored""",
    "st_profile": f"""SELECT r.*, tenure_days, promo_order_share FROM st_rfm AS r JOIN
        (SELECT customer_id, cast(max(order_date) - min(order_date) AS int) AS tenure_days,
                {rnd('avg(CASE WHEN promo_id IS NOT NULL THEN 1.0 ELSE 0 END)', 4)} AS promo_order_share
         FROM fx_orders WHERE status = 'Completed' AND order_id IN (SELECT order_id FROM fx_order_items)
         GROUP BY customer_id) AS h USING (customer_id)""",
    "st_quantiles": """SELECT quantile_cont(monetary, 0.75) AS monetary_75, quantile_cont(monetary, 0.5) AS monetary_50,
            quantile_cont(frequency, 0.75) AS frequency_75, quantile_cont(frequency, 0.66) AS frequency_66,
            quantile_cont(frequency, 0.5) AS frequency_50, quantile_cont(recency_days, 0.5) AS recency_50,
            quantile_cont(recency_days, 0.66) AS recency_66, quantile_cont(tenure_days, 0.2) AS tenure_20
        FROM st_profile""",
    # baskets
    "st_several": "SELECT order_id FROM st_sales WHERE done GROUP BY order_id HAVING count(*) > 1",
    "st_pairs": """SELECT DISTINCT order_id, brand FROM st_named WHERE done
        AND order_id IN (SELECT order_id FROM st_several)""",
    "st_n": "SELECT count(*) AS n FROM st_several",
    "st_one": "SELECT brand AS a, count(*) AS freq FROM st_pairs GROUP BY brand "
              "HAVING count(*) >= 0.01 * (SELECT n FROM st_n)",
    "st_two": """SELECT x.brand AS a, y.brand AS b, count(*) AS freq FROM st_pairs AS x JOIN st_pairs AS y
        ON x.order_id = y.order_id AND x.brand < y.brand GROUP BY x.brand, y.brand
        HAVING count(*) >= 0.01 * (SELECT n FROM st_n)""",
    "st_three": """SELECT x.brand AS a, y.brand AS b, z.brand AS c, count(*) AS freq
        FROM st_pairs AS x JOIN st_pairs AS y ON x.order_id = y.order_id AND x.brand < y.brand
        JOIN st_pairs AS z ON y.order_id = z.order_id AND y.brand < z.brand GROUP BY x.brand, y.brand, z.brand
        HAVING count(*) >= 0.01 * (SELECT n FROM st_n)""",
    "st_sets": """SELECT a AS items, freq FROM st_one UNION ALL SELECT a || ',' || b, freq FROM st_two
        UNION ALL SELECT a || ',' || b || ',' || c, freq FROM st_three""",
    "st_splits": """SELECT a || ',' || b AS w, a AS ante, b AS cons FROM st_two
        UNION ALL SELECT a || ',' || b, b, a FROM st_two
        UNION ALL SELECT a || ',' || b || ',' || c, a, b || ',' || c FROM st_three
        UNION ALL SELECT a || ',' || b || ',' || c, b, a || ',' || c FROM st_three
        UNION ALL SELECT a || ',' || b || ',' || c, c, a || ',' || b FROM st_three
        UNION ALL SELECT a || ',' || b || ',' || c, a || ',' || b, c FROM st_three
        UNION ALL SELECT a || ',' || b || ',' || c, a || ',' || c, b FROM st_three
        UNION ALL SELECT a || ',' || b || ',' || c, b || ',' || c, a FROM st_three""",
    "st_rules": """SELECT ante, cons, s, s / sa AS confidence, s / sa / sc AS lift FROM
        (SELECT p.*, w.freq / n AS s, x.freq / n AS sa, y.freq / n AS sc FROM st_splits AS p
         JOIN st_sets AS w ON p.w = w.items JOIN st_sets AS x ON p.ante = x.items
         JOIN st_sets AS y ON p.cons = y.items, st_n) AS q WHERE s / sa / sc >= 1.0""",
    "st_named_rules": f"""SELECT ante AS antecedents, cons AS consequents,
            replace(replace(ante, 'Brand#', 'Brand '), ',', ', ') AS antecedent_names,
            replace(replace(cons, 'Brand#', 'Brand '), ',', ', ') AS consequent_names,
            s AS support, confidence, lift FROM st_rules""",
    # forecast
    "st_weekly": """SELECT category_name, date_trunc('week', order_date - 1)::date + 1 AS week_start,
            cast(sum(quantity) AS bigint) AS quantity
        FROM st_named WHERE done GROUP BY ALL""",
    "st_series": """SELECT *, t < n_weeks - n_test_weeks AS is_train FROM
        (SELECT *, greatest(4, cast(floor(n_weeks * 0.2::double) AS bigint)) AS n_test_weeks FROM
         (SELECT *, cast(row_number() OVER (PARTITION BY category_name ORDER BY week_start) - 1 AS int) AS t,
                 count(*) OVER (PARTITION BY category_name) AS n_weeks FROM st_weekly) AS a) AS b""",
    "st_fit": """SELECT category_name, count(*) AS n_train_weeks, max(n_weeks) AS n_weeks,
            max(n_test_weeks) AS n_test_weeks, regr_slope(quantity, t) AS slope,
            regr_intercept(quantity, t) AS intercept, arg_max(quantity, t) AS naive
        FROM st_series WHERE is_train GROUP BY category_name HAVING count(*) >= 10""",
    "st_tested": """SELECT s.category_name, week_start, quantity, t, f.n_train_weeks, f.n_test_weeks, naive,
            greatest(0, intercept + slope * t) AS prediction
        FROM st_series AS s JOIN st_fit AS f ON s.category_name = f.category_name WHERE NOT is_train""",
    "st_metrics": """SELECT category_name, max(n_train_weeks) AS n_train_weeks, max(n_test_weeks) AS n_test_weeks,
            avg(abs(quantity - naive)) AS mae_baseline, avg(abs(quantity - prediction)) AS mae_model,
            sqrt(avg((quantity - prediction) * (quantity - prediction))) AS rmse_model,
            avg(abs(quantity - prediction) / nullif(quantity, 0)) * 100 AS mape_model_pct
        FROM st_tested GROUP BY category_name""",
    "st_forecast": """SELECT s.category_name, week_start, quantity AS actual_quantity,
            cast(NULL AS double) AS forecast_quantity, 'actual' AS row_type
        FROM st_series AS s JOIN st_fit AS f ON s.category_name = f.category_name WHERE is_train
        UNION ALL SELECT category_name, week_start, quantity, prediction, 'test' FROM st_tested
        UNION ALL SELECT f.category_name, last_week + cast(7 * k AS int), NULL,
            greatest(0, intercept + slope * (n_weeks + k - 1)), 'forecast'
        FROM st_fit AS f JOIN (SELECT category_name, max(week_start) AS last_week FROM st_series
                               GROUP BY category_name) AS l ON f.category_name = l.category_name,
             (SELECT unnest([1, 2, 3, 4]) AS k) AS ahead""",
    # the forest: every tree is grown and walked level by level, with all items, of which those it did not draw weigh 0
    "st_risk_rows": f"""SELECT tree, item_id, coalesce(total_quantity_sold, 0)::double AS units, coalesce(avg_rating, 0.0)::double AS rating,
            coalesce(category_name, '') AS cat, cast(round(wastage_percent * 10000) AS bigint) AS y,
            len(list_filter({POISSON}, lambda step: step <= substr(md5('42:' || tree // 4 || ':' || item_id), 8 * (tree % 4) + 1, 8))) AS w
        FROM st_items, range(200) AS t(tree) WHERE wastage_percent IS NOT NULL""",
    "st_risk_walk": """WITH RECURSIVE walk AS (
          SELECT tree, item_id, units, rating, cat, y, w, 1::hugeint AS node, NULL::double AS gain, NULL::varchar AS feature, 0 AS level FROM st_risk_rows
        UNION ALL (
          WITH drawn AS (SELECT * FROM walk WHERE w > 0),
          whole AS (SELECT tree, node, sum(w)::double AS n, sum(w * y)::double AS s FROM drawn GROUP BY tree, node HAVING min(y) < max(y)),
          by_units AS (SELECT tree, node, units AS x, sum(w)::double AS n, sum(w * y)::double AS s FROM drawn GROUP BY tree, node, units),
          by_rating AS (SELECT tree, node, rating AS x, sum(w)::double AS n, sum(w * y)::double AS s FROM drawn GROUP BY tree, node, rating),
          sorted AS (
            SELECT 0 AS feature, tree, node, x, lead(x) OVER v AS next_x, sum(n) OVER v AS n, sum(s) OVER v AS s FROM by_units WINDOW v AS (PARTITION BY tree, node ORDER BY x)
            UNION ALL
            SELECT 1, tree, node, x, lead(x) OVER v, sum(n) OVER v, sum(s) OVER v FROM by_rating WINDOW v AS (PARTITION BY tree, node ORDER BY x)),
          cuts AS (
            SELECT feature, tree, node, (x + next_x) / 2 AS cut, '' AS cat, n, s FROM sorted WHERE next_x IS NOT NULL
            UNION ALL SELECT 2, tree, node, 0, cat, sum(w)::double, sum(w * y)::double FROM drawn GROUP BY tree, node, cat),
          best AS (
            SELECT tree, node, arg_min({'feature': feature, 'cut': cut, 'cat': cat, 'gain': gain - whole_s * whole_s / whole_n},
                                       {'gain': -gain, 'feature': feature, 'cut': cut, 'cat': cat}) AS b
            FROM (SELECT tree, node, feature, cut, cat, whole.n AS whole_n, whole.s AS whole_s,
                         cuts.s * cuts.s / cuts.n + (whole.s - cuts.s) * (whole.s - cuts.s) / (whole.n - cuts.n) AS gain
                  FROM cuts JOIN whole USING (tree, node) WHERE cuts.n < whole.n) AS c GROUP BY tree, node)
          SELECT tree, item_id, units, rating, walk.cat, y, w,
            2 * node + CASE b.feature WHEN 0 THEN (units > b.cut)::int WHEN 1 THEN (rating > b.cut)::int ELSE (walk.cat = b.cat)::int END,
            b.gain, CASE b.feature WHEN 0 THEN 'total_quantity_sold' WHEN 1 THEN 'avg_rating' ELSE 'category_name_' || b.cat END, level + 1
          FROM walk JOIN best USING (tree, node)))
        SELECT * FROM walk""",
    "st_risk": """SELECT item_id, cast(sum(value) AS double) / 2e10 AS predicted_wastage_risk FROM
          (SELECT tree, item_id, max(level) AS level FROM st_risk_walk GROUP BY tree, item_id) AS last
        JOIN st_risk_walk USING (tree, item_id, level)
        JOIN (SELECT tree, node, (2 * cast(sum(w * y) AS bigint) * 10000 + cast(sum(w) AS bigint)) // (2 * cast(sum(w) AS bigint)) AS value
              FROM st_risk_walk WHERE w > 0 GROUP BY tree, node) AS leaf USING (tree, node) GROUP BY item_id""",
    "st_risk_shares": """SELECT tree, feature, sum(gain) / sum(sum(gain)) OVER (PARTITION BY tree) AS share FROM
          (SELECT DISTINCT tree, node // 2 AS parent, feature, gain FROM st_risk_walk WHERE w > 0 AND feature IS NOT NULL) AS cut
        GROUP BY tree, feature""",
    # recommendations
    "st_cuts": """SELECT quantile_cont(profit_margin, 0.5) AS margin_median, quantile_cont(profit_margin, 0.9) AS margin_p90,
            quantile_cont(wastage_percent, 0.85) AS wastage_p85, quantile_cont(wastage_percent, 0.95) AS wastage_p95,
            quantile_cont(avg_discount_pct, 0.5) AS discount_median, quantile_cont(avg_rating, 0.5) AS rating_median
        FROM st_exact""",
    "st_r1": f"""SELECT 1 AS rule_no, item_id::varchar AS item_id, item_name, 'Promote ' || item_name AS recommended_action,
            {pct('profit_margin')} || ' profit margin (dataset median is ' || {pct('margin_median')} || ') | only '
            || format('{{:,}}', total_quantity_sold)
            || ' units sold in the period -- under-ordered for how profitable it is'
            || coalesce(' | ' || {dec('avg_rating', 1)} || '/5 average rating', '') AS reason,
            CASE WHEN profit_margin >= margin_p90 THEN 'High' ELSE 'Medium' END AS priority, profit_margin AS k
        FROM st_exact, st_cuts WHERE python_label = 'Hidden Opportunity'
        ORDER BY profit_margin DESC, st_exact.item_id LIMIT 15""",
    "st_r2": f"""SELECT 2 AS rule_no, item_id::varchar AS item_id, item_name,
            'Reduce preparation quantity of ' || item_name AS recommended_action,
            {pct('wastage_percent')} || ' of prepared units go to waste' AS reason,
            CASE WHEN wastage_percent >= wastage_p95 THEN 'Critical' ELSE 'High' END AS priority, wastage_percent AS k
        FROM st_exact, st_cuts WHERE wastage_percent >= wastage_p85
        ORDER BY wastage_percent DESC, st_exact.item_id LIMIT 15""",
    "st_r3": f"""SELECT 3 AS rule_no, item_id::varchar AS item_id, item_name,
            'Review pricing or positioning of ' || item_name AS recommended_action,
            'Low Performer on both volume and margin | already discounted ' || {dec('avg_discount_pct', 1)}
            || '% on average with no volume payoff to show for it' AS reason, 'Medium' AS priority, avg_discount_pct AS k
        FROM st_exact, st_cuts WHERE python_label = 'Low Performer' AND avg_discount_pct > discount_median
        ORDER BY avg_discount_pct DESC, st_exact.item_id LIMIT 15""",
    "st_r4": f"""SELECT 4 AS rule_no, item_id::varchar AS item_id, item_name,
            'Consider removing or redesigning ' || item_name AS recommended_action,
            'Low Performer on volume and margin | ' || {dec('avg_rating', 1)} || '/5 average rating -- below the '
            || {dec('rating_median', 1)} || ' median, so this isn''t a hidden gem being underpriced, it''s a dish '
            || 'people don''t like' AS reason, 'Medium' AS priority, -avg_rating AS k
        FROM st_exact, st_cuts WHERE python_label = 'Low Performer' AND avg_rating < rating_median
        ORDER BY avg_rating, st_exact.item_id LIMIT 10""",
    "st_r5": f"""SELECT 5 AS rule_no, 'BUNDLE' AS item_id, antecedent_names || ' + ' || consequent_names AS item_name,
            'Bundle ' || antecedent_names || ' with ' || consequent_names AS recommended_action,
            'lift ' || {dec('lift', 2)} || ' (bought together ' || {dec('lift', 1)}
            || 'x more often than chance would predict) | confidence ' || {pct('confidence')} || ' | support '
            || {pct('support')} || ' of all multi-item orders' AS reason, 'Medium' AS priority, lift AS k
        FROM st_named_rules ORDER BY lift DESC, confidence DESC, antecedents, consequents LIMIT 10""",
    "st_r6": f"""SELECT 6 AS rule_no, 'CATEGORY' AS item_id, category_name AS item_name,
            'Increase stock/prep for ' || category_name || ' ahead of forecast demand' AS recommended_action,
            'forecast demand is ' || CASE WHEN rise >= 0 THEN '+' ELSE '' END || {pct('rise', 0)}
            || ' vs. this category''s historical weekly average' AS reason,
            CASE WHEN rise > 0.2 THEN 'High' ELSE 'Medium' END AS priority, rise AS k
        FROM (SELECT category_name, avg(forecast_quantity) FILTER (row_type = 'forecast')
                     / avg(actual_quantity) FILTER (row_type = 'actual') - 1 AS rise
              FROM st_forecast GROUP BY category_name ORDER BY rise DESC, category_name LIMIT 5) AS q
        WHERE rise > 0.05""",
    "st_segs": "SELECT count(*) AS n, count(*) FILTER (segment = 'At Risk') AS r, "
               "count(*) FILTER (segment = 'Loyal High Spender') AS l FROM st_segmented",
    "st_r7": f"""SELECT 7 AS rule_no, 'SEGMENT' AS item_id, 'At Risk customers' AS item_name,
            'Launch a win-back campaign for At Risk customers' AS recommended_action,
            format('{{:,}}', r) || ' customers scored ''At Risk'' -- ordered often before but haven''t recently' AS reason,
            CASE WHEN r > 0.15 * n THEN 'High' ELSE 'Medium' END AS priority, 2.0 AS k FROM st_segs
        UNION ALL SELECT 7, 'SEGMENT', 'Loyal High Spenders', 'Build a loyalty/rewards tier for Loyal High Spenders',
            format('{{:,}}', l) || ' customers (' || {pct('l / n')} || ' of the base) already score as loyal, high-value',
            'Medium', 1.0 FROM st_segs""",
    "st_recs": union(f"SELECT rule_no, item_id, item_name, recommended_action, reason, priority FROM st_r{i}"
                     for i in range(1, 8)),
    # patterns
    "st_checked_orders": f"""SELECT *, cast(order_date AS date) AS day FROM
        (SELECT DISTINCT order_id, customer_id, location_id, order_date, channel, {initcap('status')} AS status, promo_id
         FROM raw_orders WHERE try_cast(order_date AS date) IS NOT NULL) AS o
        WHERE {between('cast(order_date AS date)', (S.start, S.end))}
          AND location_id IN (SELECT location_id FROM fx_restaurants)""",
    "st_valid_lines": """SELECT DISTINCT order_id, item_id, line_no, quantity, unit_price, discount_pct, line_total
        FROM raw_order_items WHERE quantity > 0 AND unit_price > 0
          AND item_id IN (SELECT item_id FROM fx_menu_items) AND order_id IN (SELECT order_id FROM st_checked_orders)""",
    "st_checked": """SELECT *, net - quantity * base_cost AS profit FROM
        (SELECT l.*, o.day, o.location_id, o.promo_id, o.customer_id, m.base_cost,
                quantity * unit_price * (1 - least(greatest(discount_pct, 0.0::double), 100.0::double) / 100) AS net
         FROM st_valid_lines AS l JOIN st_checked_orders AS o ON l.order_id = o.order_id AND o.status = 'Completed'
         JOIN fx_menu_items AS m ON l.item_id = m.item_id) AS x""",
    "st_cwaste": """SELECT * FROM raw_wastage WHERE quantity_wasted BETWEEN 1 AND 1000
        AND location_id IN (SELECT location_id FROM fx_restaurants) AND item_id IN (SELECT item_id FROM fx_menu_items)""",
    "st_cstock": "SELECT * FROM raw_inventory WHERE location_id IN (SELECT location_id FROM fx_restaurants)",
    "st_item_waste": f"""SELECT item_id, {rnd('lost / made', 6)} AS waste_ratio FROM
        (SELECT item_id, sum(quantity_wasted) AS lost FROM st_cwaste GROUP BY item_id) AS w JOIN
        (SELECT item_id, sum(prepared_qty) AS made FROM st_cstock GROUP BY item_id) AS p USING (item_id)""",
    "st_place_waste": f"""SELECT location_id, {rnd('lost / made', 6)} AS waste_ratio FROM
        (SELECT location_id, sum(quantity_wasted) AS lost FROM st_cwaste GROUP BY location_id) AS w JOIN
        (SELECT location_id, sum(prepared_qty) AS made FROM st_cstock GROUP BY location_id) AS p USING (location_id)""",
    "st_item_profile": f"""SELECT item_id, units, profit / net AS margin, promo_share, weekend_share, december_share,
            first_sale, rating, waste_ratio,
            (rank() OVER (ORDER BY units DESC) + (count(*) OVER (PARTITION BY units) - 1) / 2)::double AS sales_rank,
            count(*) OVER () AS n_items
        FROM (SELECT item_id, cast(sum(quantity) AS bigint) AS units, {money('net')}::double AS net,
                     {money('profit')}::double AS profit,
                     avg(CASE WHEN promo_id IS NOT NULL AND promo_id <> '' THEN 1.0 ELSE 0 END) AS promo_share,
                     avg(CASE WHEN isodow(day) >= 6 THEN 1.0 ELSE 0 END) AS weekend_share,
                     avg(CASE WHEN month(day) = 12 THEN 1.0 ELSE 0 END) AS december_share, min(day) AS first_sale
              FROM st_checked GROUP BY item_id) AS i
        LEFT JOIN (SELECT item_id, avg(rating_value) AS rating FROM raw_ratings WHERE rating_value BETWEEN 1 AND 5
                   GROUP BY item_id) AS r USING (item_id)
        LEFT JOIN st_item_waste USING (item_id)""",
    "st_events": f"""SELECT item_id, effective_from, rise FROM
        (SELECT *, price / lag(price) OVER (PARTITION BY item_id ORDER BY effective_from) - 1 AS rise
         FROM fx_pricing_history WHERE price > 0) AS p WHERE rise > {S.min_price_rise}""",
    "st_study": f"""SELECT *, units_after / units_before - 1 AS change FROM
        (SELECT e.item_id, effective_from, rise,
                cast(coalesce(sum(quantity) FILTER (day < effective_from), 0) AS bigint) AS units_before,
                cast(coalesce(sum(quantity) FILTER (day >= effective_from), 0) AS bigint) AS units_after
         FROM st_events AS e JOIN st_checked AS c ON e.item_id = c.item_id
          AND day >= effective_from - {S.study_days} AND day < effective_from + {S.study_days}
         GROUP BY e.item_id, effective_from, rise) AS q WHERE units_before > {S.min_units_before}""",
    "st_defects": f"""
        SELECT 'duplicate orders' AS defect, cast(count(*) - (SELECT count(*) FROM (SELECT DISTINCT * FROM raw_orders) AS d)
            AS bigint) AS n_rows FROM raw_orders
        UNION ALL SELECT 'missing customer_id', count(*) FROM raw_orders WHERE customer_id IS NULL
        UNION ALL SELECT 'invalid location_id', count(*) FROM raw_orders WHERE location_id IS NULL OR location_id NOT IN {LOCS}
        UNION ALL SELECT 'cancelled orders', count(*) FROM raw_orders WHERE lower(trim(status)) = 'cancelled'
        UNION ALL SELECT 'negative/zero quantity', count(*) FROM raw_order_items WHERE quantity <= 0
        UNION ALL SELECT 'price <= 0', count(*) FROM raw_order_items WHERE unit_price <= 0
        UNION ALL SELECT 'missing item_id', count(*) FROM raw_order_items WHERE item_id IS NULL
        UNION ALL SELECT 'invalid discount', count(*) FROM raw_order_items WHERE discount_pct < 0 OR discount_pct > 100
        UNION ALL SELECT 'ratings outside 1-5', count(*) FROM raw_ratings WHERE rating_value NOT BETWEEN 1 AND 5
        UNION ALL SELECT 'impossible wastage qty', count(*) FROM raw_wastage WHERE quantity_wasted < 0 OR quantity_wasted > 1000""",
}


def check(no: int, name: str, passed: str, a: str, b: str = "NULL", source: str = "") -> str:
    return (f"SELECT {no} AS check_no, '{name}' AS check_name, coalesce({passed}, false) AS passed, "
            f"{rnd(a, 4)} AS measured, {rnd(b, 4)} AS compared {source}")


def _of(case: str) -> str:
    return f"FROM (SELECT 1) AS one LEFT JOIN (SELECT * FROM st_item_profile WHERE item_id = {S.cases[case]}) AS p ON true"


CHECKS = union([
    check(1, "High-selling but LOSS-MAKING dish", "margin < 0 AND sales_rank <= 10", "margin", "sales_rank",
          _of("loss_making_popular")),
    check(2, "Highly profitable but RARELY bought dish", "margin > 0.55 AND sales_rank > n_items * 0.5", "margin",
          "sales_rank", _of("hidden_high_margin")),
    check(3, "Popular dish with EXCESSIVE WASTAGE",
          "coalesce(waste_ratio, 0) > (SELECT quantile_cont(waste_ratio, 0.95) FROM st_item_waste) AND sales_rank <= 15",
          "coalesce(waste_ratio, 0)", "sales_rank", _of("popular_high_wastage")),
    check(4, "Highly RATED dish with POOR profitability", "rating >= 4.5 AND margin < 0.2", "rating", "margin",
          _of("highly_rated_low_margin")),
    check(5, "Low-RATED dish with HIGH SALES", "rating < 3.2 AND sales_rank <= 10", "rating", "sales_rank",
          _of("low_rated_high_sales")),
    check(6, "PROMOTION-DEPENDENT dish", "promo_share > 0.6", "promo_share", source=_of("promo_dependent")),
    check(7, "Dish that sells only at WEEKENDS", "weekend_share > 0.7", "weekend_share", source=_of("weekend_only")),
    check(8, "SEASONAL dish", "december_share > 0.6", "december_share", source=_of("seasonal")),
    check(9, "NEW item with little history", f"first_sale > date '{S.new_since}'",
          f"first_sale - date '{S.new_since}'", "units", _of("new_item")),
    check(10, "Dish performing DIFFERENTLY across locations", "max(share) > 2.5 * median(share)", "max(share)",
          "median(share)", f"""FROM (SELECT sum(quantity) FILTER (item_id = {S.cases['weekend_only']}) / sum(quantity) AS share
          FROM st_checked JOIN fx_restaurants USING (location_id) GROUP BY region) AS q"""),
    check(11, "MULTI-LOCATION differences", "max(net) > 2 * min(net)", "max(net)", "min(net)",
          f"FROM (SELECT cast({money('net')} AS double) AS net FROM st_checked GROUP BY location_id) AS q"),
    check(12, "PEAK-HOUR pattern", "peak > 0.45", "peak", source="""FROM (SELECT sum(quantity) FILTER (
          hour(order_datetime) BETWEEN 12 AND 14 OR hour(order_datetime) BETWEEN 18 AND 21) / sum(quantity) AS peak
          FROM st_checked JOIN fx_orders USING (order_id)) AS q"""),
    check(13, "SEASONAL demand (December)", "max(n) FILTER (m = 12) / avg(n) > 1.2", "max(n) FILTER (m = 12) / avg(n)",
          source="""FROM (SELECT month(day) AS m, count(*) AS n FROM st_checked_orders WHERE status = 'Completed'
          GROUP BY month(day)) AS q"""),
    check(14, "WEEKEND pattern", "sum(n) FILTER (d >= 6) / 2 > 1.3 * avg(n) FILTER (d <= 4)",
          "sum(n) FILTER (d >= 6) / 2", "avg(n) FILTER (d <= 4)", """FROM (SELECT isodow(day) AS d, count(*) AS n
          FROM st_checked_orders WHERE status = 'Completed' GROUP BY isodow(day)) AS q"""),
    check(15, "PRICE-SENSITIVE items", "count(*) > 0 AND median(c) < -0.15", "median(c)", "count(*)",
          f"FROM (SELECT {rnd('change', 6)} AS c FROM st_study WHERE item_id IN ({', '.join(map(str, S.price_sensitive))})) AS q"),
    check(16, "MISLEADING promotion (sales up, profit down)", f"count(*) > 0 AND {money('profit')} < 0",
          money("profit"), "sum(quantity)", f"""FROM st_checked WHERE item_id = {S.cases['loss_making_popular']}
          AND promo_id IN ({', '.join(repr(p) for p in S.promo_traps)})"""),
    check(17, "CHURNED and NEW customers", "c > 0 AND w > 0", "c", "w", f"""FROM (SELECT
          count(*) FILTER (l < date '{S.churned_before}' AND n >= 3) AS c,
          count(*) FILTER (f > date '{S.customers_new_since}') AS w
          FROM (SELECT min(day) AS f, max(day) AS l, count(*) AS n FROM st_checked_orders
                WHERE status = 'Completed' AND customer_id IS NOT NULL GROUP BY customer_id) AS x) AS q"""),
    check(18, "SALES anomaly (location collapse)", "a < 0.6 * b", "a", "b", f"""FROM (SELECT
          count(*) FILTER ({between('day', WIN)}) / 21 AS a, count(*) FILTER ({between('day', REF)}) / 21 AS b
          FROM st_checked_orders WHERE status = 'Completed' AND location_id = '{S.collapse_location}') AS q"""),
    check(19, "RATING anomaly (sudden drop)", "a < b - 1", "a", "b", f"""FROM (SELECT
          avg(rating_value) FILTER ({between('rating_date', DROP)}) AS a, avg(rating_value) AS b FROM raw_ratings
          WHERE rating_value BETWEEN 1 AND 5 AND item_id IN (SELECT item_id FROM fx_menu_items
          WHERE item_name LIKE '{S.rating_drop_prefix}%')) AS q"""),
    check(20, "RATING anomaly (5-star burst)", "a > 4 * b", "a", "b", f"""FROM (SELECT
          count(*) FILTER ({between('rating_date', BURST)}) AS a, count(*) / (2500 / 6) AS b FROM raw_ratings
          WHERE item_id IN (SELECT item_id FROM fx_menu_items WHERE item_name = '{S.burst_item_name}')) AS q"""),
    check(21, "EXTREME wastage location",
          f"arg_max(location_id, waste_ratio) = '{S.waste_location}' AND max(waste_ratio) > 1.8 * median(waste_ratio)",
          "max(waste_ratio)", "median(waste_ratio)", "FROM st_place_waste"),
    check(22, "Very large / bulk orders", f"count(*) FILTER (n > {S.bulk_lines}) > 0",
          f"count(*) FILTER (n > {S.bulk_lines})", "max(n)",
          "FROM (SELECT count(*) AS n FROM st_valid_lines GROUP BY order_id) AS q"),
    check(23, "UNUSUAL discounts outside promotions", "count(*) > 0", "count(*)",
          source=f"FROM st_valid_lines WHERE discount_pct BETWEEN {S.odd_discounts[0]} AND {S.odd_discounts[1]}"),
    check(24, "DATA-QUALITY defects planted", "min(n_rows) > 0", "min(n_rows)", "count(*)", "FROM st_defects"),
])


def _counts_sql(table: str) -> str:
    return f"SELECT '{table}' AS table_name, count(*) AS n_rows FROM {RAW_TABLES[table]}"


def _rule_sql(table: str, rules: dict[str, str]) -> str:
    return union(f"SELECT '{table}' AS table_name, '{n}' AS rule, count(*) AS n_rows FROM {RAW_TABLES[table]} WHERE {c}"
                 for n, c in rules.items())


def _audit(no: int, step: str, keys: str, left: str, right: str, full: bool = True) -> str:
    cols = [k.strip() for k in keys.split(",")]
    on = " AND ".join(f"l.{c} = r.{c}" for c in cols)
    unmatched = "CASE WHEN unmatched > 0 THEN 'UNMATCHED (' || format('{:,}', unmatched) || ' rows found no partner)' END" \
        if full else "NULL"
    return f"""SELECT {no} AS step_no, '{step}' AS step, '{keys}' AS join_key, rows_before, rows_after, duplicate_keys,
        unmatched, CASE WHEN rows_after = rows_before AND {unmatched} IS NULL THEN 'ok' ELSE concat_ws(', ',
        CASE WHEN rows_after > rows_before THEN 'BALLOON (+' || format('{{:,}}', rows_after - rows_before) || ' rows)' END,
        {unmatched}) END AS result
    FROM (SELECT (SELECT count(*) FROM {left}) AS rows_before,
                 (SELECT count(*) FROM {left} AS l LEFT JOIN {right} AS r ON {on}) AS rows_after,
                 (SELECT count(*) FROM (SELECT 1 FROM {right} GROUP BY {keys} HAVING count(*) > 1) AS d) AS duplicate_keys,
                 (SELECT count(*) FROM {left} AS l WHERE NOT EXISTS (SELECT 1 FROM {right} AS r WHERE {on})) AS unmatched
         ) AS a"""


def _audit_sql(t: dict[str, str], prefix: str) -> str:
    """All seven steps; steps keep the join keys of everything joined before."""
    price = f"(SELECT DISTINCT item_id FROM {t['pricing_history']})"
    rated = f"(SELECT DISTINCT order_id, item_id FROM {t['ratings']})"
    lefts = {
        1: f"SELECT order_id, item_id FROM {t['order_items']}",
        2: f"SELECT l.*, r.customer_id, r.location_id FROM ({{1}}) AS l LEFT JOIN {t['orders']} AS r ON l.order_id = r.order_id",
        3: f"SELECT l.*, r.category_id FROM ({{2}}) AS l LEFT JOIN {t['menu_items']} AS r ON l.item_id = r.item_id",
        4: f"SELECT l.* FROM ({{3}}) AS l LEFT JOIN {t['menu_categories']} AS r ON l.category_id = r.category_id",
        5: f"SELECT l.* FROM ({{4}}) AS l LEFT JOIN {t['customers']} AS r ON l.customer_id = r.customer_id",
        6: f"SELECT l.* FROM ({{5}}) AS l LEFT JOIN {t['restaurants']} AS r ON l.location_id = r.location_id",
        7: f"SELECT l.* FROM ({{6}}) AS l LEFT JOIN {price} AS r ON l.item_id = r.item_id",
    }
    for i in range(2, 8):
        lefts[i] = lefts[i].replace(f"{{{i - 1}}}", lefts[i - 1])
    steps = [("orders", "order_id", t["orders"]), ("menu_items", "item_id", t["menu_items"]),
             ("menu_categories", "category_id", t["menu_categories"]), ("customers", "customer_id", t["customers"]),
             ("restaurants", "location_id", t["restaurants"]), ("pricing", "item_id", price),
             ("ratings", "order_id, item_id", rated)]
    return union(_audit(i, name, keys, f"({lefts[i]})", right, name != "ratings")
                 for i, (name, keys, right) in enumerate(steps, 1))


def _grid(grid: list[dict[str, float]]) -> str:
    names = list(grid[0])
    rows = ", ".join("(" + ", ".join(f"{float(r[n])}::double" for n in names) + ")" for r in grid)
    return f"(VALUES {rows}) AS g({', '.join(names)})"


def _scenario(parameters: list[str], inner: str) -> str:
    out = ", ".join(f"{rnd(x, 4)} AS {n}" for n, x in (
        ("new_quantity", "q"), ("new_revenue", "rev"), ("new_profit", "prof"),
        ("new_margin", "coalesce(prof / nullif(rev, 0), 0)"), ("revenue_change", "rev - net_revenue"),
        ("profit_change", "prof - total_profit"),
        ("margin_change", "coalesce(prof / nullif(rev, 0), 0) - profit_margin")))
    return f"SELECT item_id, item_name, {', '.join(parameters)}, {out} FROM ({inner}) AS s"


def _sold(grid, demand: str, factor: str) -> str:
    return f"""SELECT *, rev - base_cost * q AS prof FROM (SELECT *, net_revenue / total_quantity_sold * ({factor}) * q AS rev
        FROM (SELECT *, greatest(0, total_quantity_sold * (1 + {demand} / 100)) AS q FROM st_items, {_grid(grid)}) AS a) AS b"""


FIGURES = f"""SELECT cast(round(coalesce(sum(CASE WHEN done THEN cast(net AS decimal(18,6)) END), 0), 2) AS double) AS total_revenue,
        cast(round(coalesce(sum(CASE WHEN done THEN cast(profit AS decimal(18,6)) END), 0), 2) AS double) AS total_profit,
        count(DISTINCT order_id) FILTER (done) AS total_orders,
        {rnd("coalesce(cast(sum(CASE WHEN done THEN cast(net AS decimal(18,6)) END) AS double) / nullif(count(DISTINCT order_id) FILTER (done), 0), 0)", 2)} AS avg_order_value,
        count(DISTINCT customer_id) FILTER (done) AS active_customers,
        (SELECT count(*) FROM (SELECT customer_id FROM SRC AS r WHERE done GROUP BY customer_id
                               HAVING count(DISTINCT order_id) > 1) AS x) AS repeat_customers,
        count(DISTINCT order_id) FILTER (status = 'Cancelled') AS cancelled_orders,
        (SELECT count(DISTINCT item_id) FROM fx_menu_items) AS live_items
    FROM SRC AS l"""
FILTERED = ("(SELECT * FROM st_named WHERE order_date BETWEEN date '1997-01-01' AND date '1998-12-31' "
            "AND channel = 'Takeaway')")
ITEM_COLUMNS = ("item_id, item_name, category_id, category_name, base_cost, total_quantity_sold, n_orders, net_revenue, "
                "total_cost, total_profit, avg_rating, avg_discount_pct, weekend_share, profit_margin, wastage_percent")
PRIORITY = "CASE priority WHEN 'Critical' THEN 1 WHEN 'High' THEN 2 WHEN 'Medium' THEN 3 ELSE 4 END"
RULE_OUT = (f"antecedents, consequents, antecedent_names, consequent_names, {rnd('support', 6)} AS support, "
            f"{rnd('confidence', 6)} AS confidence, {rnd('lift', 6)} AS lift")
RANKED = ("_units", "_margin", "_rating", "_repeat", "_waste")


def _queries() -> dict[str, str]:
    raw = RAW_TABLES
    q: dict[str, str] = {}
    q["ingest_profile"] = union(
        f"SELECT '{t}' AS table_name, {i} AS position, '{c}' AS column_name, '{ty}' AS column_type, "
        f"(SELECT count(*) FROM {raw[t]}) AS n_rows"
        for t in raw for i, (c, ty) in enumerate(zip(COLUMNS[t].split(), TYPES[t].split())))
    q["row_minimums"] = union(
        f"SELECT '{t}' AS table_name, count(*) AS n_rows, cast({m} AS bigint) AS minimum, count(*) >= {m} AS passed "
        f"FROM {raw[t]}" for t, m in MINIMUMS.items())
    q["write_and_verify"] = union(
        f"SELECT '{n}' AS table_name, count(*) AS written, count(*) AS reloaded, true AS ok FROM {t}"
        for n, t in (("item_features", "st_items"), ("customer_rfm", "st_rfm")))
    q["csv_rescan"] = """SELECT count(*) AS n_rows, cast(sum(quantity) AS bigint) AS quantity,
        cast(round(sum(cast(line_total AS decimal(18,2))), 2) AS double) AS line_total FROM fx_order_items"""

    q["dq_row_counts"] = union(_counts_sql(t) for t in raw)
    q["dq_duplicates"] = union(
        f"SELECT '{t}' AS table_name, cast(sum(n_copies - 1) AS bigint) AS n_duplicates FROM st_audit_{t}" for t in raw)
    q["dq_nulls"] = "SELECT * FROM (" + union(
        f"SELECT '{t}' AS table_name, '{c}' AS column_name, count(*) FILTER ({c} IS NULL) AS n_missing, "
        f"{rnd(f'count(*) FILTER ({c} IS NULL) * 100.0 / count(*)', 2)} AS pct_missing FROM {raw[t]}"
        for t in raw for c in COLUMNS[t].split()) + ") AS n WHERE n_missing > 0"
    q["dq_rules"] = union([
        _rule_sql("orders", {
            Q_UNPARSEABLE: "order_date IS NOT NULL AND try_cast(order_date AS date) IS NULL",
            Q_FUTURE: "try_cast(order_date AS date) > date '2026-12-31'",
            Q_OLD: "try_cast(order_date AS date) < date '1990-01-01'",
            INVALID_BRANCH: f"location_id NOT IN {LOCS}",
            Q_CHANNEL: f"channel <> {initcap('channel')}", Q_STATUS: f"status <> {initcap('status')}"}),
        _rule_sql("order_items", {BAD_QUANTITY: "quantity <= 0", BAD_PRICE: "unit_price <= 0",
                                  BAD_DISCOUNT: "discount_pct < 0 OR discount_pct > 100"}),
        _rule_sql("ratings", {BAD_RATING: "rating_value < 1 OR rating_value > 5"}),
        _rule_sql("wastage", {Q_WASTE: "quantity_wasted <= 0 OR quantity_wasted > 1000"}),
        _rule_sql("inventory", {Q_STOCK: "closing_stock < 0", Q_UNIT: "unit <> lower(unit)"})])
    q["dq_referential"] = union([
        _rule_sql("order_items", {Q_UNKNOWN_ITEM: f"item_id IS NOT NULL AND NOT {LINES_KNOWN}",
                                  Q_ORPHAN_LINE: "order_id NOT IN (SELECT order_id FROM raw_orders)"}),
        _rule_sql("ratings", {Q_ORPHAN_RATING: "order_id NOT IN (SELECT order_id FROM raw_orders)"})])
    q["dq_defect_summary"] = "SELECT * FROM st_defects"

    q["clean_orders"] = f"""SELECT order_id, customer_id, location_id, order_date, {initcap('channel')} AS channel,
        payment_method, {initcap('status')} AS status, promo_id FROM st_audit_orders WHERE failed IS NULL"""
    for table, replaced in (("order_items", ""), ("ratings", ""), ("wastage", ""),
                            ("inventory", "lower(trim(unit)) AS unit")):
        columns = [c if not replaced.endswith(f" AS {c}") else replaced for c in COLUMNS[table].split()]
        columns = [f"cast({c} AS varchar) AS {c}" if c in ("rating_date", "waste_date", "week_start") else c
                   for c in columns]
        q[f"clean_{table}"] = f"SELECT {', '.join(columns)} FROM st_audit_{table} WHERE failed IS NULL"
    q["clean_customers"] = f"""SELECT customer_id, {initcap('home_city')} AS home_city, age_bracket,
        cast(signup_date AS varchar) AS signup_date FROM st_audit_customers"""
    q["clean_summary"] = union(
        f"SELECT '{t}' AS table_name, 0 AS rule_no, '{EXACT_DUPLICATES}' AS rule, "
        f"cast(sum(n_copies - 1) AS bigint) AS removed FROM st_audit_{t}" + "".join(
            f"\nUNION ALL SELECT '{t}', {i}, '{r}', count(*) FILTER (failed = '{r}') FROM st_audit_{t}"
            for i, r in enumerate(RULE_NAMES.get(t, []), 1)) for t in raw)
    q["clean_row_counts"] = union(
        f"SELECT '{t}' AS table_name, cast(sum(n_copies) AS bigint) AS n_raw, "
        f"count(*) FILTER (failed IS NULL) AS n_clean FROM st_audit_{t}" for t in raw)
    q["clean_rejects_orders"] = ("SELECT order_id, failed AS first_failed_rule, n_copies FROM st_audit_orders "
                                 "WHERE failed IS NOT NULL")
    q["clean_rejects_order_items"] = ("SELECT order_id, item_id, line_no, failed AS first_failed_rule, n_copies "
                                      "FROM st_audit_order_items WHERE failed IS NOT NULL")
    q["clean_rejects_ratings"] = ("SELECT order_id, item_id, failed AS first_failed_rule, n_copies FROM st_audit_ratings "
                                  "WHERE failed IS NOT NULL")
    for table, day in (("wastage", "waste_date"), ("inventory", "week_start")):
        q[f"clean_rejects_{table}"] = (f"SELECT item_id, location_id, cast({day} AS varchar) AS {day}, failed AS first_failed_rule, "
                                       f"n_copies FROM st_audit_{table} WHERE failed IS NOT NULL")
    q["quarantine"] = union(
        f"""SELECT '{t}' AS table_name, CASE WHEN {bad} THEN 'malformed record' ELSE failed END AS rule, count(*) AS n_rows,
            cast(sum(n_copies) AS bigint) AS n_copies FROM st_audit_{t} WHERE {bad} OR failed IS NOT NULL GROUP BY 1, 2"""
        for t, bad in (("order_items", "order_id % 97 = 5"), ("ratings", "order_id % 89 = 3")))
    q["cleaned_item_revenue"] = f"""SELECT item_id, cast(sum(quantity) AS bigint) AS total_quantity_sold,
            count(DISTINCT i.order_id) AS n_orders,
            cast(round({money('unit_price * quantity * (1 - discount_pct / 100)')}, 2) AS double) AS net_revenue,
            {rnd('avg(discount_pct)', 2)} AS avg_discount_pct,
            {rnd('avg(CASE WHEN isodow(cast(order_date AS date)) >= 6 THEN 1.0 ELSE 0 END)', 3)} AS weekend_share
        FROM st_audit_order_items AS i JOIN st_audit_orders AS o ON i.order_id = o.order_id AND o.failed IS NULL
        WHERE i.failed IS NULL AND lower(trim(status)) = 'completed' GROUP BY item_id"""

    q["chain_item_features"] = "SELECT " + ITEM_COLUMNS + " FROM st_chain_items"
    q["chain_customer_rfm"] = "SELECT customer_id, frequency, monetary, recency_days FROM st_chain_rfm"
    q["chain_labels"] = "SELECT item_id, total_quantity_sold, profit_margin, python_label FROM st_chain_exact"

    q["join_wide"] = """SELECT i.*, o.customer_id, o.location_id, cast(order_datetime AS varchar) AS order_datetime,
            cast(order_date AS varchar) AS order_date, channel, payment_method, status, item_name, m.category_id,
            base_cost, is_active, cast(introduced_date AS varchar) AS introduced_date, category_name,
            home_city AS customer_city, age_bracket, cast(signup_date AS varchar) AS signup_date, restaurant_name,
            city AS location_city, area, current_price, first_price, price_changes, avg_rating, n_ratings
        FROM fx_order_items AS i LEFT JOIN fx_orders AS o ON i.order_id = o.order_id
        LEFT JOIN fx_menu_items AS m ON i.item_id = m.item_id
        LEFT JOIN fx_menu_categories AS c ON m.category_id = c.category_id
        LEFT JOIN fx_customers AS u ON o.customer_id = u.customer_id
        LEFT JOIN fx_restaurants AS r ON o.location_id = r.location_id
        LEFT JOIN (SELECT item_id, arg_max(price, effective_from) AS current_price,
                          arg_min(price, effective_from) AS first_price, count(*) - 1 AS price_changes
                   FROM fx_pricing_history GROUP BY item_id) AS p ON i.item_id = p.item_id
        LEFT JOIN st_rated AS a ON i.order_id = a.order_id AND i.item_id = a.item_id"""
    q["join_audit"] = _audit_sql({
        "order_items": "fx_order_items", "orders": "fx_orders", "menu_items": "fx_menu_items",
        "menu_categories": "fx_menu_categories", "customers": "fx_customers", "restaurants": "fx_restaurants",
        "pricing_history": "fx_pricing_history", "ratings": "fx_ratings"}, "fx")
    q["join_audit_raw"] = _audit_sql(raw, "raw")
    q["join_reconcile"] = """SELECT count(*) AS rows_in, count(*) AS rows_out, true AS unchanged FROM fx_order_items"""
    q["duplicate_keys"] = """SELECT 'pricing_history' AS table_name, count(*) AS n_duplicate_keys FROM
        (SELECT 1 FROM fx_pricing_history GROUP BY item_id HAVING count(*) > 1) AS a
        UNION ALL SELECT 'ratings', count(*) FROM
        (SELECT 1 FROM fx_ratings GROUP BY order_id, item_id HAVING count(*) > 1) AS b"""
    q["price_rollup"] = """SELECT item_id, arg_max(price, effective_from) AS current_price,
        arg_min(price, effective_from) AS first_price, count(*) - 1 AS price_changes
        FROM fx_pricing_history GROUP BY item_id"""
    q["rating_rollup"] = "SELECT * FROM st_rated"
    q["semi_anti"] = """SELECT 'with order' AS kind, count(*) AS n_customers FROM fx_customers
        WHERE customer_id IN (SELECT customer_id FROM fx_orders)
        UNION ALL SELECT 'without order', count(*) FROM fx_customers
        WHERE customer_id NOT IN (SELECT customer_id FROM fx_orders)"""
    q["price_as_of"] = """SELECT i.order_id, i.item_id, line_no, unit_price, cast(order_date AS varchar) AS order_date,
            price AS listed_price, unit_price = price AS price_matches
        FROM fx_order_items AS i JOIN fx_orders AS o ON i.order_id = o.order_id
        LEFT JOIN fx_pricing_history AS p ON i.item_id = p.item_id AND effective_from <= order_date
          AND order_date <= coalesce(effective_to, date '9999-12-31')"""
    q["promo_active"] = """SELECT order_id, o.location_id, cast(order_date AS varchar) AS order_date, p.promo_id, discount_pct
        FROM fx_orders AS o JOIN fx_promotions AS p ON order_date BETWEEN start_date AND end_date
          AND p.location_id IN ('ALL', o.location_id)"""
    covered = """CASE scope WHEN 'ITEM' THEN coalesce(list_contains(string_split(applicable_items, '|'),
        cast(i.item_id AS varchar)), false) WHEN 'CATEGORY' THEN coalesce(m.category_id = p.category_id, false)
        ELSE true END"""
    q["promo_active_items"] = f"""SELECT i.order_id, i.item_id, line_no, p.promo_id, scope, p.discount_pct
        FROM fx_order_items AS i JOIN fx_orders AS o ON i.order_id = o.order_id
        JOIN fx_promotions AS p ON order_date BETWEEN start_date AND end_date AND p.location_id IN ('ALL', o.location_id)
        LEFT JOIN fx_menu_items AS m ON i.item_id = m.item_id WHERE {covered}"""
    bits = """list_prepend(4294967295, flatten(list_transform(range(1, length(k) + 1),
        lambda i: [ascii(substr(k, i, 1)), -1, -1, -1, -1, -1, -1, -1, -1])))"""  # each byte, then eight shifts
    q["split_bucket"] = f"""SELECT item_id, location_id, cast(bucket AS integer) AS bucket,
          CASE WHEN bucket < 60 THEN 'train' WHEN bucket < 80 THEN 'validation' ELSE 'test' END AS split
        FROM (SELECT item_id, location_id, xor(list_reduce({bits}, lambda c, x: CASE WHEN x >= 0 THEN xor(c, x)
          ELSE xor(c >> 1, (c & 1) * 3988292384) END), 4294967295) % 100 AS bucket
          FROM (SELECT DISTINCT item_id, location_id, cast(item_id AS varchar) || '|' || location_id AS k
                FROM fx_stock_moves) AS d) AS b"""
    q["promo_coverage"] = f"""SELECT i.order_id, i.item_id, line_no, o.promo_id, {covered} AS covered,
            CASE WHEN {covered} THEN p.discount_pct ELSE 0.0 END AS granted_discount
        FROM fx_order_items AS i JOIN fx_orders AS o ON i.order_id = o.order_id
        JOIN fx_promotions AS p ON o.promo_id = p.promo_id LEFT JOIN fx_menu_items AS m ON i.item_id = m.item_id"""
    q["promo_items"] = """SELECT promo_id, l.item_id, cast(sum(quantity) AS bigint) AS units FROM
        (SELECT promo_id, unnest(string_split(applicable_items, '|')) AS item_id FROM fx_promotions WHERE scope = 'ITEM') AS l
        JOIN fx_order_items AS i ON l.item_id = cast(i.item_id AS varchar) GROUP BY promo_id, l.item_id"""

    q["line_features"] = f"""SELECT s.order_id, s.item_id, item_name, category_id, category_name, customer_id,
            location_id, cast(order_date AS varchar) AS order_date, channel, status, cast(done AS int) AS is_completed,
            quantity, unit_price, discount_pct, {rnd('net', 6)} AS net_revenue,
            {rnd('base_cost * quantity', 6)} AS line_cost, {rnd('net - base_cost * quantity', 6)} AS line_profit,
            cast(isodow(order_date) % 7 + 1 AS int) AS day_of_week, cast(weekend AS int) AS is_weekend, avg_rating
        FROM st_named AS s LEFT JOIN st_rated AS r ON s.order_id = r.order_id AND s.item_id = r.item_id"""
    q["status_histogram"] = "SELECT status, count(*) AS n_lines FROM fx_orders GROUP BY status"
    q["item_features"] = f"SELECT {ITEM_COLUMNS} FROM st_items"
    q["customer_rfm"] = "SELECT * FROM st_rfm"
    q["coverage"] = """SELECT 'customers' AS grain, (SELECT count(*) FROM st_rfm) AS n_featured, count(*) AS n_total
        FROM fx_customers UNION ALL SELECT 'items', (SELECT count(*) FROM st_items), count(*) FROM fx_menu_items"""
    q["null_sanity"] = "SELECT * FROM (" + union(
        f"SELECT 'item_features' AS table_name, '{c.strip()}' AS column_name, count(*) FILTER ({c} IS NULL) AS n_missing, "
        f"{rnd(f'count(*) FILTER ({c} IS NULL) * 100.0 / count(*)', 2)} AS pct_missing FROM st_items"
        for c in ITEM_COLUMNS.split(",")) + ") AS n"
    q["waste_ratio_item"] = "SELECT * FROM st_waste_item"
    q["waste_ratio_location"] = f"""SELECT location_id, {rnd('lost / made', 6)} AS waste_ratio FROM
        (SELECT location_id, sum(quantity_wasted) AS lost FROM fx_wastage GROUP BY location_id) AS w JOIN
        (SELECT location_id, sum(prepared_qty) AS made FROM fx_stock_moves GROUP BY location_id) AS p USING (location_id)"""
    expected = rnd("quantity * unit_price * (1 - discount_pct / 100)", 2)
    q["line_total_check"] = f"""SELECT order_id, item_id, line_no, line_total, {expected} AS expected_total
        FROM fx_order_items WHERE abs(line_total - {expected}) > 0.005"""
    q["merged_lines"] = """SELECT order_id, item_id, cast(sum(quantity) AS bigint) AS quantity, count(*) AS n_lines
        FROM fx_order_items GROUP BY order_id, item_id"""
    q["weekly_consumption"] = """SELECT cast(floor((order_date - date '1995-01-01') / 7) AS bigint) AS week_no, location_id,
        item_id, cast(sum(quantity) AS bigint) AS units FROM st_sales WHERE done GROUP BY ALL"""
    q["stock_roll_forward"] = """SELECT item_id, location_id, cast(week_start AS varchar) AS week_start, opening_stock,
        closing_stock FROM fx_inventory"""
    q["near_duplicate_orders"] = """SELECT b.order_id, b.customer_id, b.location_id,
            arg_max(a.order_id, (a.order_datetime, -a.order_id)) AS repeats_order,
            cast(min(date_diff('second', a.order_datetime, b.order_datetime)) AS bigint) AS seconds_apart
        FROM st_fingers AS a JOIN st_fingers AS b ON a.customer_id = b.customer_id AND a.location_id = b.location_id
          AND a.basket = b.basket AND (a.order_datetime < b.order_datetime
               OR (a.order_datetime = b.order_datetime AND a.order_id < b.order_id))
          AND b.order_datetime <= a.order_datetime + INTERVAL '3' MINUTE
        GROUP BY b.order_id, b.customer_id, b.location_id"""

    q["classify_approx"] = f"SELECT {ITEM_COLUMNS}, spark_label FROM st_approx"
    q["classify_exact"] = f"SELECT {ITEM_COLUMNS}, python_label FROM st_exact"
    q["thresholds_approx"] = """SELECT quantile_disc(profit_margin, 0.5) AS median_margin,
        quantile_disc(total_quantity_sold, 0.5) AS median_units FROM st_items"""
    q["thresholds_exact"] = f"""SELECT {rnd('median(profit_margin)', 6)} AS median_margin,
        {rnd('median(total_quantity_sold)', 6)} AS median_units FROM st_items"""
    q["label_counts"] = "SELECT python_label, count(*) AS n_items FROM st_exact GROUP BY python_label"
    q["label_comparison"] = "SELECT * FROM st_compared"
    q["label_agreement"] = f"""SELECT count(*) AS n_items, count(*) FILTER (agree) AS n_agree,
        count(*) FILTER (NOT agree) AS n_disagree, {rnd('avg(CASE WHEN agree THEN 1.0 ELSE 0 END)', 4)} AS agreement_rate
        FROM st_compared"""
    q["label_disagreements"] = "SELECT item_id, item_name, spark_label, python_label FROM st_compared WHERE NOT agree"
    q["label_distribution"] = """SELECT 'approximate' AS method, spark_label AS label, count(*) AS n_items FROM st_compared
        GROUP BY spark_label UNION ALL SELECT 'exact', python_label, count(*) FROM st_compared GROUP BY python_label"""
    q["named_cases"] = """SELECT case_name, c.item_id, spark_label, python_label, CASE WHEN spark_label IS NULL THEN 'not found'
        WHEN agree THEN 'both agree' ELSE 'they disagree' END AS verdict
        FROM fx_cases AS c LEFT JOIN st_compared AS l ON c.item_id = l.item_id"""
    q["item_location_features"] = "SELECT * FROM st_places"
    ranks = ", ".join(f"(rank() OVER (ORDER BY {c}) - 1) / greatest(n - 1, 1) AS r{c}" for c in RANKED)
    q["multi_indicator_label"] = f"""SELECT item_id, location_id, 'Insufficient History' AS rule_label FROM st_places
            WHERE insufficient_history
        UNION ALL SELECT item_id, location_id, CASE
            WHEN v >= 0.5 AND m >= 0.5 AND _waste <= 0.12 AND quality >= 0.4 THEN 'Profit Driver'
            WHEN v >= 0.5 AND (NOT m >= 0.5 OR _waste > 0.12) THEN 'Volume Driver'
            WHEN NOT v >= 0.5 AND m >= 0.5 AND quality >= 0.55 THEN 'Hidden Opportunity' ELSE 'Low Performer' END
        FROM (SELECT *, r_units AS v, r_margin AS m, 0.5 * r_rating + 0.25 * r_repeat + 0.25 * (1 - r_waste) AS quality
              FROM (SELECT *, {ranks} FROM (SELECT *, units AS _units, profit_margin AS _margin, count(*) OVER () AS n,
                      coalesce(avg_rating, 3.5) AS _rating, coalesce(repeat_purchase_rate, 0) AS _repeat,
                      coalesce(wastage_percent, 0) AS _waste FROM st_places WHERE NOT insufficient_history) AS a) AS b) AS c"""
    q["label_confusion"] = """SELECT python_label AS true_label, spark_label AS predicted_label, count(*) AS n
        FROM st_compared GROUP BY python_label, spark_label"""
    q["label_metrics"] = f"""SELECT cast(sum(actual) AS bigint) AS n, {rnd('sum(hits) / sum(actual)', 4)} AS accuracy,
            {rnd('avg(f1)', 4)} AS macro_f1, {rnd('sum(f1 * actual) / sum(actual)', 4)} AS weighted_f1
        FROM (SELECT *, coalesce(2 * hits / nullif(actual + guessed, 0), 0) AS f1 FROM
              (SELECT label, sum(a) AS actual, sum(g) AS guessed, sum(h) AS hits FROM
               (SELECT python_label AS label, 1 AS a, 0 AS g, CASE WHEN python_label = guess THEN 1 ELSE 0 END AS h FROM st_guess
                UNION ALL SELECT guess, 0, 1, 0 FROM st_guess) AS u GROUP BY label) AS p) AS f"""
    q["regression_metrics"] = f"""SELECT count(*) AS n, {rnd('avg(abs(y - p))', 3)} AS mae,
            {rnd('sqrt(avg((y - p) * (y - p)))', 3)} AS rmse,
            {rnd('avg(abs(y - p) / y) FILTER (y >= 5) * 100', 2)} AS mape,
            {rnd('1 - sum((y - p) * (y - p)) / (var_pop(y) * count(*))', 4)} AS r2
        FROM (SELECT cast(quantity AS double) AS y, prediction AS p FROM st_tested) AS t"""

    q["recency_profile"] = """SELECT min(recency_days) AS min_days, max(recency_days) AS max_days,
        median(recency_days) AS median_days FROM st_rfm"""
    q["rfm_scores"] = "SELECT * FROM st_scored"
    q["rfm_segments"] = "SELECT customer_id, segment FROM st_segmented"
    q["segment_counts"] = "SELECT segment, count(*) AS n_customers FROM st_segmented GROUP BY segment"
    q["customer_profile"] = "SELECT * FROM st_profile"
    q["population_quantiles"] = "SELECT " + ", ".join(f"{rnd(c, 4)} AS {c}" for c in (
        "monetary_75", "monetary_50", "frequency_75", "frequency_66", "frequency_50", "recency_50", "recency_66",
        "tenure_20")) + " FROM st_quantiles"
    q["named_segments"] = """SELECT customer_id, CASE
            WHEN monetary >= monetary_75 AND frequency >= frequency_75 AND recency_days <= recency_50 THEN 'High-Value Loyal'
            WHEN tenure_days <= tenure_20 THEN 'New Customers'
            WHEN recency_days >= recency_66 AND (frequency >= frequency_50 OR monetary >= monetary_50) THEN 'At-Risk'
            WHEN promo_order_share >= 0.5 THEN 'Promotion-Driven' WHEN frequency >= frequency_66 THEN 'Frequent'
            ELSE 'Occasional' END AS segment_name FROM st_profile, st_quantiles"""

    q["basket_split"] = """SELECT count(*) FILTER (n > 1) AS multi_line_orders, count(*) FILTER (n = 1) AS single_line_orders
        FROM (SELECT count(*) AS n FROM st_sales WHERE done GROUP BY order_id) AS b"""
    q["baskets"] = "SELECT order_id, string_agg(brand, ',' ORDER BY brand) AS items FROM st_pairs GROUP BY order_id"
    q["frequent_itemsets"] = f"SELECT items, freq, {rnd('freq / n', 6)} AS support FROM st_sets, st_n"
    q["association_rules"] = f"SELECT {RULE_OUT} FROM st_named_rules"
    q["top_rules"] = (f"SELECT {RULE_OUT} FROM (SELECT * FROM st_named_rules ORDER BY lift DESC, confidence DESC, "
                      "antecedents, consequents LIMIT 10) AS t")
    q["waste_risk_scores"] = f"""SELECT item_id, item_name, wastage_percent, {rnd('predicted_wastage_risk', 6)} AS predicted_wastage_risk
        FROM st_risk JOIN st_items USING (item_id) ORDER BY st_risk.predicted_wastage_risk DESC, item_id LIMIT 10"""
    q["waste_risk_importance"] = f"""SELECT feature, {rnd('coalesce(total / n, 0)', 6)} AS importance
        FROM (SELECT DISTINCT 'category_name_' || cat AS feature FROM st_risk_rows
              UNION ALL SELECT unnest(['total_quantity_sold', 'avg_rating'])) AS f
        LEFT JOIN (SELECT feature, sum(share) AS total FROM st_risk_shares GROUP BY feature) AS t USING (feature),
             (SELECT count(DISTINCT tree) AS n FROM st_risk_shares) AS c ORDER BY importance DESC, feature LIMIT 10"""
    q["recommendations_with_risk"] = f"""SELECT rule_no, item_id, item_name, recommended_action,
        CASE WHEN rule_no = 2 THEN reason || ' | model-predicted wastage risk score ' || (
            SELECT {dec('predicted_wastage_risk', 3)} FROM st_risk r WHERE r.item_id::varchar = st_recs.item_id) ELSE reason END AS reason,
        priority FROM st_recs"""
    q["waste_figures_with_risk"] = f"""SELECT {rnd('avg(wastage_percent)', 4)} AS avg_wastage,
        (SELECT item_name FROM st_items ORDER BY wastage_percent DESC NULLS LAST, item_id LIMIT 1) AS highest_wastage_item,
        (SELECT item_name FROM st_risk JOIN st_items USING (item_id) ORDER BY predicted_wastage_risk DESC, item_id LIMIT 1) AS highest_risk_item
        FROM st_items"""
    q["waste_risk_dropped"] = ("SELECT count(*) AS n_items, count(*) FILTER (wastage_percent IS NULL) AS n_dropped "
                               "FROM st_items")

    q["weekly_demand"] = "SELECT category_name, cast(week_start AS varchar) AS week_start, quantity FROM st_weekly"
    sums = f"""cast(sum(quantity) AS bigint) AS units, cast(round({money('net')}, 2) AS double) AS net_revenue"""
    for name, key, text, table in (("item", "item_id", "item_name", "fx_menu_items"), ("category", "category_id", "category_name", "fx_menu_categories"),
                                   ("location", "location_id", "restaurant_name", "fx_restaurants")):
        q[f"weekly_{name}"] = f"""SELECT s.{key}::varchar AS entity_id, n.{text} AS entity_name, cast(week_start AS varchar) AS week_start, units,
            net_revenue, orders, promo_units FROM
            (SELECT {key}, date_trunc('week', order_date)::date AS week_start, {sums}, count(DISTINCT order_id) AS orders,
                    cast(coalesce(sum(quantity) FILTER (promo_id IS NOT NULL), 0) AS bigint) AS promo_units
             FROM st_named WHERE done GROUP BY ALL) AS s LEFT JOIN {table} AS n ON n.{key} = s.{key}"""
    q["daily_location"] = f"""SELECT cast(order_date AS varchar) AS order_date, location_id, count(DISTINCT order_id) AS orders, {sums},
        cast(round({money('profit')}, 2) AS double) AS profit FROM st_named WHERE done GROUP BY ALL"""
    q["daily_item"] = f"""SELECT cast(order_date AS varchar) AS order_date, item_id, {sums} FROM st_named WHERE done GROUP BY ALL"""
    q["weekly_demand_location"] = """SELECT location_id, cast(date_trunc('week', order_date - 1)::date + 1 AS varchar) AS week_start,
        cast(sum(quantity) AS bigint) AS quantity FROM st_named WHERE done GROUP BY ALL"""
    q["contract_fill"] = union(
        f"SELECT '{n}' AS table_name, '{c.strip()}' AS column_name, count(*) FILTER ({c} IS NULL) AS n_missing, "
        f"{rnd(f'count(*) FILTER ({c} IS NULL) * 100.0 / count(*)', 2)} AS pct_missing FROM {t}"
        for n, t, columns in (("item_features", "st_items", ITEM_COLUMNS), ("customer_rfm", "st_rfm", "customer_id,frequency,monetary,recency_days"))
        for c in columns.split(","))
    q["demand_extent"] = """SELECT count(DISTINCT category_name) AS n_categories, count(DISTINCT week_start) AS n_weeks
        FROM st_weekly"""
    q["forecast_series_split"] = """SELECT category_name, cast(week_start AS varchar) AS week_start, quantity, t, n_weeks,
        n_test_weeks, is_train FROM st_series"""
    metric = ", ".join(f"{rnd(c, 4)} AS {c}" for c in ("mae_baseline", "mae_model", "rmse_model", "mape_model_pct"))
    q["forecast_metrics"] = f"""SELECT category_name, n_train_weeks, n_test_weeks, {metric},
        mae_model < mae_baseline AS beats_baseline FROM st_metrics"""
    q["forecast_metrics_location"] = q["forecast_metrics"].replace("category_name", "location_id").replace(
        "st_metrics", "st_place_metrics")
    q["forecast_wins"] = """SELECT count(*) FILTER (mae_model < mae_baseline) AS n_wins, count(*) AS n_categories
        FROM st_metrics"""
    q["forecast_bands"] = """SELECT category_name, CASE WHEN mae_model < mae_baseline AND mape_model_pct < 20 THEN 'useful'
        WHEN mae_model < mae_baseline THEN 'only moderately useful' ELSE 'not useful' END AS usefulness FROM st_metrics"""
    q["forecast_rows"] = f"""SELECT category_name, cast(week_start AS varchar) AS week_start, actual_quantity,
        {rnd('forecast_quantity', 4)} AS forecast_quantity, row_type FROM st_forecast"""
    q["forecast_series"] = f"""SELECT cast(week_start AS varchar) AS week_start, 'demand' AS series,
            cast(actual_quantity AS double) AS quantity FROM st_forecast
            WHERE category_name = 'Promo' AND row_type IN ('actual', 'test')
        UNION ALL SELECT cast(week_start AS varchar), CASE row_type WHEN 'test' THEN 'prediction' ELSE 'future' END,
            {rnd('forecast_quantity', 4)} FROM st_forecast WHERE category_name = 'Promo' AND row_type IN ('test', 'forecast')"""
    q["forecast_metric_lookup"] = f"""SELECT category_name, {rnd('mae_baseline', 4)} AS mae_baseline,
        {rnd('mae_model', 4)} AS mae_model, {rnd('mae_model - mae_baseline', 4)} AS mae_delta,
        {rnd('rmse_model', 4)} AS rmse_model, mae_model < mae_baseline AS beats_baseline
        FROM st_metrics WHERE category_name = 'Promo'"""

    q["recommendation_thresholds"] = "SELECT " + ", ".join(f"{rnd(c, 6)} AS {c}" for c in (
        "margin_median", "margin_p90", "wastage_p85", "wastage_p95", "discount_median", "rating_median")) + " FROM st_cuts"
    q["recommendations"] = "SELECT * FROM st_recs"
    q["recommendation_counts"] = "SELECT priority, count(*) AS n FROM st_recs GROUP BY priority"
    q["recommendations_by_priority"] = """SELECT priority, count(*) AS n FROM st_recs
        WHERE priority IN ('Critical', 'Medium') GROUP BY priority"""
    q["recommendation_evidence"] = """SELECT rule_no, item_id, item_name, priority,
        cast(unnest(range(len(string_split(reason, ' | ')))) AS int) AS evidence_no,
        unnest(string_split(reason, ' | ')) AS evidence FROM st_recs"""
    q["urgent_recommendations"] = f"""SELECT * FROM st_recs WHERE priority IN ('Critical', 'High')
        ORDER BY {PRIORITY}, rule_no, item_id, item_name LIMIT 8"""

    q["filtered_lines"] = f"""SELECT order_id, item_id, line_no, cast(order_date AS varchar) AS order_date, quantity,
        {rnd('net', 4)} AS net_revenue FROM st_named WHERE order_date BETWEEN date '1996-01-01' AND date '1999-12-31'
        AND location_id = 'L05' AND category_name = 'Promo' AND channel = 'Dine-in'"""
    q["filter_options"] = """SELECT 'location' AS "filter", location_id AS value,
            location_id || ' - ' || coalesce(restaurant_name, location_id) AS label
        FROM (SELECT DISTINCT location_id FROM st_named) AS l LEFT JOIN fx_restaurants USING (location_id)
        UNION ALL SELECT DISTINCT 'category', category_name, category_name FROM st_named
        UNION ALL SELECT DISTINCT 'channel', channel, channel FROM st_named
        UNION ALL SELECT 'date', cast(min(order_date) AS varchar), 'first' FROM st_named
        UNION ALL SELECT 'date', cast(max(order_date) AS varchar), 'last' FROM st_named"""
    q["location_dimension"] = """SELECT location_id, restaurant_name, city, area, region, n_lines FROM fx_restaurants
        LEFT JOIN (SELECT location_id, count(*) AS n_lines FROM st_sales GROUP BY location_id) AS s USING (location_id)"""
    q["key_figures"] = FIGURES.replace("SRC", "st_named")
    q["key_figures_filtered"] = FIGURES.replace("SRC", FILTERED)
    q["repeat_customers"] = """SELECT customer_id, count(DISTINCT order_id) AS n_orders FROM st_sales WHERE done
        GROUP BY customer_id HAVING count(DISTINCT order_id) > 1"""
    q["daily_revenue"] = f"""SELECT cast(order_date AS varchar) AS order_date, cast(round({money('net')}, 2) AS double)
        AS net_revenue FROM st_sales WHERE done GROUP BY order_date"""
    q["revenue_by_category"] = f"""SELECT category_name, cast(round({money('net')}, 2) AS double) AS net_revenue
        FROM st_named WHERE done GROUP BY category_name"""
    q["menu_view"] = f"""SELECT count(*) AS n_items, {rnd('avg(profit_margin)', 4)} AS avg_margin,
        {rnd('avg(avg_rating)', 3)} AS avg_rating, {rnd('avg(wastage_percent)', 4)} AS avg_wastage FROM st_exact
        WHERE python_label IN ('Profit Driver', 'Volume Driver') AND category_name IN ('Promo', 'Small', 'Large')"""
    q["menu_table"] = """SELECT item_id, item_name, category_name, profit_margin, total_quantity_sold, avg_rating,
        avg_discount_pct, wastage_percent, python_label FROM st_exact"""
    q["menu_scatter"] = "SELECT item_name, total_quantity_sold, profit_margin, python_label, net_revenue FROM st_exact"
    q["slow_movers"] = """SELECT item_id, item_name, category_name, total_quantity_sold, profit_margin, avg_rating,
        wastage_percent, python_label FROM st_exact ORDER BY total_quantity_sold, item_id LIMIT 10"""
    q["segment_view"] = """SELECT customer_id, recency_days, frequency, monetary, rfm_score, segment FROM st_segmented
        WHERE segment IN ('Loyal High Spender', 'At Risk')"""
    q["score_histogram"] = "SELECT rfm_score, count(*) AS n_customers FROM st_scored GROUP BY rfm_score"
    q["customer_sample"] = """SELECT customer_id, recency_days, monetary FROM st_rfm
        ORDER BY md5(customer_id || '|42'), customer_id LIMIT 500"""
    q["waste_figures"] = f"""SELECT {rnd('avg(wastage_percent)', 4)} AS avg_wastage,
        (SELECT item_name FROM st_items ORDER BY wastage_percent DESC NULLS LAST, item_id LIMIT 1) AS highest_wastage_item,
        (SELECT item_name FROM st_items ORDER BY wastage_percent DESC NULLS LAST, item_id LIMIT 1) AS highest_risk_item
        FROM st_items"""
    waste = "item_id, item_name, category_name, wastage_percent, total_quantity_sold, avg_rating"
    q["top_waste"] = f"SELECT {waste} FROM st_items ORDER BY wastage_percent DESC NULLS LAST, item_id LIMIT 10"
    q["waste_table"] = f"SELECT {waste} FROM st_items"
    q["waste_by_category"] = f"""SELECT category_name, {rnd('avg(wastage_percent)', 4)} AS avg_wastage
        FROM st_items GROUP BY category_name"""

    q["scenario_price"] = _scenario(["price_change_pct", "elasticity"], _sold(
        PRICE_GRID, "(-elasticity * price_change_pct)", "1 + price_change_pct / 100"))
    q["scenario_discount"] = _scenario(["discount_change", "lift_per_point"], _sold(
        DISCOUNT_GRID, "(lift_per_point * discount_change)", "1 - discount_change / 100"))
    q["scenario_preparation"] = _scenario(["prep_change_pct"], f"""SELECT *, cast(total_quantity_sold AS double) AS q,
        net_revenue AS rev, total_profit - (greatest(0, w * (1 + prep_change_pct / 100)) - w) * base_cost AS prof FROM
        (SELECT *, CASE WHEN wastage_percent < 1 THEN total_quantity_sold * wastage_percent / (1 - wastage_percent)
                   ELSE 0 END AS w FROM st_items, {_grid(PREP_GRID)}) AS a""")

    q["pattern_item_profile"] = f"""SELECT item_id, units, {rnd('margin', 4)} AS margin, {rnd('promo_share', 4)} AS promo_share,
        {rnd('weekend_share', 4)} AS weekend_share, {rnd('december_share', 4)} AS december_share,
        cast(first_sale AS varchar) AS first_sale, {rnd('rating', 4)} AS rating, waste_ratio, sales_rank, n_items
        FROM st_item_profile"""
    q["pattern_checks"] = CHECKS
    q["event_study"] = f"""SELECT item_id, cast(effective_from AS varchar) AS effective_from, {rnd('rise', 6)} AS rise,
        units_before, units_after, {rnd('change', 6)} AS change FROM st_study"""
    q["window_vs_reference"] = f"""SELECT location_id, {rnd(f"count(*) FILTER ({between('day', WIN)}) / 21", 6)} AS per_day,
        {rnd(f"count(*) FILTER ({between('day', REF)}) / 21", 6)} AS reference_per_day
        FROM st_checked_orders WHERE status = 'Completed' GROUP BY location_id"""
    q["rating_shift"] = f"""SELECT item_name, {rnd(f"avg(rating_value) FILTER ({between('rating_date', DROP)})", 4)}
        AS mean_in_window, {rnd('avg(rating_value)', 4)} AS mean FROM fx_ratings JOIN fx_menu_items USING (item_id)
        GROUP BY item_name"""
    q["rating_burst"] = f"""SELECT item_name, count(*) FILTER ({between('rating_date', BURST)}) AS in_window,
        {rnd('count(*) * 6 / 2500', 6)} AS expected FROM fx_ratings JOIN fx_menu_items USING (item_id) GROUP BY item_name"""
    return q


STEPS["st_guess"] = ("SELECT python_label, CASE WHEN profit_margin >= 0.3 THEN 'Profit Driver' ELSE 'Low Performer' END "
                     "AS guess FROM st_exact")
STEPS["st_fingers"] = """SELECT order_id, customer_id, location_id, order_datetime, basket FROM fx_orders_repeated JOIN
    (SELECT order_id, string_agg(item_id || 'x' || quantity, ',' ORDER BY item_id) AS basket FROM
     (SELECT order_id, item_id, sum(quantity) AS quantity FROM fx_order_items_repeated GROUP BY order_id, item_id) AS m
     GROUP BY order_id) AS b USING (order_id)"""


def build() -> dict[str, str]:
    """One SQL text per query that SQL can express; base tables are views named as they are."""
    return {name: with_clause(sql, steps=STEPS) for name, sql in _queries().items()}

# the same steps over the cleaned tables
_CLEANED = {"orders": f"""SELECT order_id, customer_id, location_id, cast(order_date AS date) AS order_date,
                {initcap('channel')} AS channel, payment_method, {initcap('status')} AS status, promo_id
                FROM st_audit_orders WHERE failed IS NULL""",
            **{t: f"SELECT * FROM st_audit_{t} WHERE failed IS NULL" for t in ("order_items", "ratings", "wastage", "inventory")}}
STEPS.update({f"st_chain_{t}": sql for t, sql in _CLEANED.items()})
_ON_CLEANED = {"fx_stock_moves": "st_chain_inventory", **{f"fx_{t}": f"st_chain_{t}" for t in _CLEANED if t != "inventory"}}
_CHAINED = [n for n in STEPS if n in ("st_sales", "st_named", "st_waste_item", "st_sold", "st_rated", "st_items", "st_rfm", "st_exact")]
for _name in _CHAINED:
    STEPS[_name.replace("st_", "st_chain_", 1)] = re.sub(
        r"\b(fx|st)_\w+", lambda m: m[0].replace("st_", "st_chain_", 1) if m[0] in _CHAINED else _ON_CLEANED.get(m[0], m[0]), STEPS[_name])

# the weekly series and the forecast errors by location
_WEEKLY = ("st_weekly", "st_series", "st_fit", "st_tested", "st_metrics")
for _name in _WEEKLY:
    STEPS[_name.replace("st_", "st_place_", 1)] = re.sub(
        r"\bst_\w+", lambda m: m[0].replace("st_", "st_place_", 1) if m[0] in _WEEKLY else m[0], STEPS[_name]).replace(
        "category_name", "location_id")
