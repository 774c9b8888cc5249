"""Sales tables derived from the generic star-schema parquet files.

Each view is one SELECT that Spark and DuckDB both accept, so the same text builds the
input of a Spark query and the first CTEs of its oracle. ``fx_`` views are clean,
``raw_`` views carry planted defects (fixed remainders of a row key), because the parquet
files themselves have none.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

BASE_TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem")

LINE_KEY = "(order_id * 31 + item_id * 7 + line_no)"
RATING_KEY = "(order_id * 31 + item_id * 7)"
WASTE_KEY = "(item_id * 13 + quantity_wasted * 5 + dayofyear(waste_date))"
STOCK_KEY = "(item_id * 13 + dayofyear(week_start))"



def _money(expression: str) -> str:
    """Two places by plain floating-point steps, which every engine computes alike."""
    return f"floor(({expression}) * 100 + 0.5) / 100"


VIEWS: dict[str, str] = {
    "fx_orders": """
        SELECT o_orderkey AS order_id, o_custkey AS customer_id,
               concat('L', lpad(cast(o_custkey % 20 + 1 AS string), 2, '0')) AS location_id,
               o_orderdate + INTERVAL '1' SECOND * cast(36000 + (o_orderkey * 7919) % 43200 AS int)
                   AS order_datetime,
               cast(o_orderdate AS date) AS order_date,
               CASE o_orderpriority WHEN '1-URGENT' THEN 'Dine-in' WHEN '2-HIGH' THEN 'Takeaway'
                    WHEN '3-MEDIUM' THEN 'Website/App' ELSE 'Third-party Delivery' END AS channel,
               CASE o_orderkey % 3 WHEN 0 THEN 'Card' WHEN 1 THEN 'Cash' ELSE 'Transfer' END
                   AS payment_method,
               CASE WHEN o_orderkey % 20 = 7 THEN 'Cancelled' ELSE 'Completed' END AS status,
               CASE WHEN o_orderkey % 6 = 0
                    THEN concat('P', lpad(cast(o_orderkey % 8 + 1 AS string), 3, '0')) END AS promo_id
        FROM {orders}""",
    "fx_order_items": """
        SELECT order_id, item_id, line_no, quantity, unit_price, discount_pct,
               """ + _money("quantity * unit_price * (1 - discount_pct / 100)") + """
                   + CASE WHEN """ + LINE_KEY + """ % 997 = 5 THEN 0.5 ELSE 0 END AS line_total
        FROM (SELECT l_orderkey AS order_id, l_partkey AS item_id, l_linenumber AS line_no,
                     cast(l_quantity AS int) AS quantity,
                     """ + _money("l_extendedprice / l_quantity") + """ AS unit_price,
                     """ + _money("l_discount * 100") + """ AS discount_pct
              FROM {lineitem}) AS priced""",
    "fx_menu_items": """
        SELECT p_partkey AS item_id, p_name AS item_name, p_brand AS brand, p_type AS category_id,
               """ + _money("p_retailprice * (1 + p_size % 6) / 2") + """ AS base_cost,
               p_size % 10 <> 0 AS is_active,
               date '1994-01-01' + cast(p_partkey % 365 AS int) AS introduced_date
        FROM {part}""",
    "fx_menu_categories": """
        SELECT DISTINCT p_type AS category_id,
               concat(substr(p_type, 1, 1), lower(substr(p_type, 2))) AS category_name
        FROM {part}""",
    "fx_customers": """
        SELECT c_custkey AS customer_id,
               concat(upper(substr(c_mktsegment, 1, 1)), lower(substr(c_mktsegment, 2))) AS home_city,
               CASE c_custkey % 4 WHEN 0 THEN '18-24' WHEN 1 THEN '25-34' WHEN 2 THEN '35-49'
                    ELSE '50+' END AS age_bracket,
               date '1995-01-01' + cast(c_custkey % 1500 AS int) AS signup_date
        FROM {customer}""",
    "fx_restaurants": """
        SELECT concat('L', lpad(cast(n_nationkey + 1 AS string), 2, '0')) AS location_id,
               concat('Branch ', n_name) AS restaurant_name, n_name AS city,
               concat('Area ', cast(n_nationkey % 7 AS string)) AS area, r_name AS region
        FROM {nation} JOIN {region} ON n_regionkey = r_regionkey
        WHERE n_nationkey < 20""",
    "fx_promotions": """
        SELECT concat('P', lpad(cast(n_nationkey + 1 AS string), 3, '0')) AS promo_id,
               n_name AS promo_name, cast(5 + (n_nationkey % 6) * 5 AS double) AS discount_pct,
               date '1995-02-01' + cast(n_nationkey * 90 AS int) AS start_date,
               date '1995-02-01' + cast(n_nationkey * 90 + 13 + n_nationkey % 15 AS int) AS end_date,
               CASE n_nationkey % 3 WHEN 0 THEN 'ITEM' WHEN 1 THEN 'CATEGORY' ELSE 'ALL' END AS scope,
               CASE WHEN n_nationkey % 3 = 0 THEN concat(cast(n_nationkey * 7 + 1 AS string), '|',
                    cast(n_nationkey * 7 + 2 AS string), '|', cast(n_nationkey * 7 + 3 AS string))
                    END AS applicable_items,
               CASE WHEN n_nationkey % 3 = 1 THEN CASE n_nationkey % 2 WHEN 0 THEN 'SMALL'
                    ELSE 'ECONOMY' END END AS category_id,
               CASE WHEN n_nationkey % 2 = 0 THEN 'ALL'
                    ELSE concat('L', lpad(cast(n_nationkey % 20 + 1 AS string), 2, '0')) END AS location_id
        FROM {nation}""",
    "fx_ratings": """
        SELECT l_orderkey AS order_id, l_partkey AS item_id, o_custkey AS customer_id,
               cast(l_shipdate AS date) AS rating_date,
               cast(1 + (l_partkey * 7 + l_orderkey + l_linenumber) % 5 AS int) AS rating_value
        FROM {lineitem} JOIN {orders} ON l_orderkey = o_orderkey
        WHERE l_returnflag = 'A'""",
    "fx_wastage": """
        SELECT l_partkey AS item_id,
               concat('L', lpad(cast(o_custkey % 20 + 1 AS string), 2, '0')) AS location_id,
               cast(l_shipdate AS date) AS waste_date,
               1 + cast(l_quantity AS int) % 4 AS quantity_wasted
        FROM {lineitem} JOIN {orders} ON l_orderkey = o_orderkey
        WHERE l_returnflag = 'R' AND l_linestatus = 'F'""",
    "fx_stock_moves": """
        SELECT item_id, location_id, cast(date_trunc('week', order_date) AS date) AS week_start,
               cast(sum(quantity) + item_id % 4 AS bigint) AS replenished_qty,
               cast(sum(quantity) + 2 AS bigint) AS prepared_qty,
               cast(sum(CASE WHEN status = 'Completed' THEN quantity ELSE 0 END) AS bigint) AS consumed_qty,
               'portion' AS unit
        FROM fx_order_items JOIN fx_orders USING (order_id)
        GROUP BY item_id, location_id, cast(date_trunc('week', order_date) AS date)""",
    "fx_inventory": """
        SELECT item_id, location_id, week_start,
               coalesce(lag(closing_stock) OVER (PARTITION BY location_id, item_id ORDER BY week_start), 30)
                   AS opening_stock,
               replenished_qty, prepared_qty, consumed_qty, closing_stock, unit
        FROM (SELECT *, cast(greatest(0, 30 + sum(replenished_qty - prepared_qty)
                         OVER (PARTITION BY location_id, item_id ORDER BY week_start
                               ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)) AS bigint) AS closing_stock
              FROM fx_stock_moves) AS rolled""",
    "fx_pricing_history": """
        SELECT item_id, CASE WHEN (item_id + price_year) % 211 = 0 THEN 0.0 ELSE top_price END AS price,
               make_date(price_year, 1, 1) AS effective_from,
               CASE WHEN price_year < 2001 THEN make_date(price_year, 12, 31) END AS effective_to
        FROM (SELECT item_id, cast(year(order_date) AS int) AS price_year, max(unit_price) AS top_price
              FROM fx_order_items JOIN fx_orders USING (order_id)
              GROUP BY item_id, cast(year(order_date) AS int)) AS yearly""",
    "fx_cases": """
        SELECT 'loss_making_popular' AS case_name, cast(0 AS bigint) AS item_id
        UNION ALL SELECT 'hidden_high_margin', 12
        UNION ALL SELECT 'popular_high_wastage', 25
        UNION ALL SELECT 'highly_rated_low_margin', 38
        UNION ALL SELECT 'low_rated_high_sales', 51
        UNION ALL SELECT 'promo_dependent', -1""",
    # orders with a second copy of some orders three minutes later
    "fx_orders_repeated": """
        SELECT order_id, customer_id, location_id, order_datetime FROM fx_orders
        UNION ALL
        SELECT -order_id - 1, customer_id, location_id, order_datetime + INTERVAL '3' MINUTE
        FROM fx_orders WHERE order_id % 400 = 9""",
    "fx_order_items_repeated": """
        SELECT order_id, item_id, quantity FROM fx_order_items
        UNION ALL
        SELECT -order_id - 1, item_id, quantity FROM fx_order_items WHERE order_id % 400 = 9""",
    "raw_orders": """
        SELECT * FROM raw_orders_once
        UNION ALL SELECT * FROM raw_orders_once WHERE order_id % 125 = 31""",
    "raw_orders_once": """
        SELECT order_id, CASE WHEN order_id % 100 <> 3 THEN customer_id END AS customer_id,
               CASE WHEN order_id % 667 = 5 THEN 'L99' ELSE location_id END AS location_id,
               CASE WHEN order_id % 667 = 11 THEN '2027-03-15' WHEN order_id % 1000 = 13 THEN '1970-01-01'
                    WHEN order_id % 1400 = 17 THEN '2025-13-45' ELSE cast(order_date AS string) END
                   AS order_date,
               CASE WHEN order_id % 333 = 19 THEN NULL WHEN order_id % 67 = 23 THEN lower(channel)
                    ELSE channel END AS channel,
               payment_method,
               CASE WHEN order_id % 83 = 29 THEN concat(upper(status), ' ') ELSE status END AS status,
               promo_id
        FROM fx_orders""",
    "raw_order_items": """
        SELECT order_id, item_id, line_no, quantity, unit_price, discount_pct, line_total
        FROM raw_order_items_once
        UNION ALL
        SELECT order_id, item_id, line_no, quantity, unit_price, discount_pct, line_total
        FROM raw_order_items_once WHERE row_key % 167 = 9""",
    "raw_order_items_once": """
        SELECT """ + LINE_KEY + """ AS row_key,
               CASE WHEN """ + LINE_KEY + """ % 2000 = 10 THEN -1 ELSE order_id END AS order_id,
               CASE WHEN """ + LINE_KEY + """ % 500 = 1 THEN NULL
                    WHEN """ + LINE_KEY + """ % 1000 = 2 THEN -999 ELSE item_id END AS item_id,
               line_no,
               CASE WHEN """ + LINE_KEY + """ % 333 = 4 THEN -1 ELSE quantity END AS quantity,
               CASE WHEN """ + LINE_KEY + """ % 1000 = 5 THEN 0.0
                    WHEN """ + LINE_KEY + """ % 1000 = 6 THEN -500.0 ELSE unit_price END AS unit_price,
               CASE WHEN """ + LINE_KEY + """ % 1000 = 7 THEN 150.0
                    WHEN """ + LINE_KEY + """ % 1000 = 8 THEN -20.0 ELSE discount_pct END AS discount_pct,
               line_total
        FROM fx_order_items""",
    "raw_ratings": """
        SELECT order_id, item_id, customer_id, rating_date, rating_value
        FROM raw_ratings_once
        UNION ALL
        SELECT order_id, item_id, customer_id, rating_date, rating_value
        FROM raw_ratings_once WHERE row_key % 333 = 5""",
    "raw_ratings_once": """
        SELECT """ + RATING_KEY + """ AS row_key,
               CASE WHEN """ + RATING_KEY + """ % 200 = 1 THEN -1 ELSE order_id END AS order_id, item_id,
               CASE WHEN """ + RATING_KEY + """ % 200 <> 2 THEN customer_id END AS customer_id, rating_date,
               CASE WHEN """ + RATING_KEY + """ % 200 = 3 THEN 0
                    WHEN """ + RATING_KEY + """ % 200 = 4 THEN 9 ELSE rating_value END AS rating_value
        FROM fx_ratings""",
    "raw_wastage": """
        SELECT item_id, location_id, waste_date, quantity_wasted
        FROM raw_wastage_once
        UNION ALL
        SELECT item_id, location_id, waste_date, quantity_wasted
        FROM raw_wastage_once WHERE row_key % 500 = 5""",
    "raw_wastage_once": """
        SELECT """ + WASTE_KEY + """ AS row_key,
               CASE WHEN """ + WASTE_KEY + """ % 500 = 1 THEN NULL
                    WHEN """ + WASTE_KEY + """ % 500 = 6 THEN -999 ELSE item_id END AS item_id,
               CASE WHEN """ + WASTE_KEY + """ % 500 = 2 THEN 'L98' ELSE location_id END AS location_id,
               waste_date,
               CASE WHEN """ + WASTE_KEY + """ % 500 = 3 THEN -3
                    WHEN """ + WASTE_KEY + """ % 500 = 4 THEN 5000 ELSE quantity_wasted END AS quantity_wasted
        FROM fx_wastage""",
    "raw_inventory": """
        SELECT item_id,
               CASE WHEN """ + STOCK_KEY + """ % 1000 = 1 THEN 'L97' ELSE location_id END AS location_id,
               week_start, opening_stock, replenished_qty, prepared_qty, consumed_qty,
               CASE WHEN """ + STOCK_KEY + """ % 1000 = 2 THEN -12 ELSE closing_stock END AS closing_stock,
               CASE WHEN """ + STOCK_KEY + """ % 12 = 3 THEN upper(unit) ELSE unit END AS unit
        FROM fx_inventory""",
    "raw_customers": """
        SELECT * FROM raw_customers_once
        UNION ALL SELECT * FROM raw_customers_once WHERE customer_id % 75 = 11""",
    "raw_customers_once": """
        SELECT customer_id,
               CASE WHEN customer_id % 50 = 7 THEN upper(home_city) ELSE home_city END AS home_city,
               age_bracket,
               CASE WHEN customer_id % 60 <> 9 THEN signup_date END AS signup_date
        FROM fx_customers""",
}

# The eleven tables of the data model, in the order reports list them.
RAW_TABLES = {
    "menu_categories": "fx_menu_categories",
    "menu_items": "fx_menu_items",
    "restaurants": "fx_restaurants",
    "customers": "raw_customers",
    "pricing_history": "fx_pricing_history",
    "promotions": "fx_promotions",
    "orders": "raw_orders",
    "order_items": "raw_order_items",
    "ratings": "raw_ratings",
    "inventory": "raw_inventory",
    "wastage": "raw_wastage",
}

_VIEW_NAME = re.compile(r"\b(?:fx|raw|st)_\w+")


def with_clause(sql: str, table_of=lambda name: name, steps: dict[str, str] | None = None) -> str:
    """Prefix ``sql`` with the views it reads, directly or through other views, as CTEs.

    ``table_of`` renders a base table; ``steps`` adds further named queries (``st_``).
    """
    known = {**VIEWS, **(steps or {})}
    done: dict[str, str] = {}

    def rendered(text: str) -> str:
        for name in BASE_TABLES:
            text = text.replace("{" + name + "}", table_of(name))
        return text

    def visit(text: str) -> None:
        for name in _VIEW_NAME.findall(text):
            if name in known and name not in done:
                visit(known[name])
                done[name] = rendered(known[name])

    visit(sql)
    return ("WITH " + ",\n".join(f"{n} AS ({body})" for n, body in done.items()) + "\n" if done else "") + sql


class SalesTables:
    """Lazy access to the views over one parquet folder. Each table and view is analysed once."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = str(sf_dir).rstrip("/")
        self._frames: dict[str, DataFrame] = {}

    def base(self, name: str) -> DataFrame:
        if name not in self._frames:
            self._frames[name] = self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")
        return self._frames[name]

    def view(self, name: str) -> DataFrame:
        if name not in self._frames:
            sql = _VIEW_NAME.sub(lambda m: "{" + m[0] + "}" if m[0] in VIEWS else m[0], VIEWS[name])
            inputs = {n: self.view(n) if n in VIEWS else self.base(n) for n in set(re.findall(r"{(\w+)}", sql))}
            self._frames[name] = self.spark.sql(sql, **inputs)
        return self._frames[name]

    def raw(self) -> dict[str, DataFrame]:
        return {table: self.view(name) for table, name in RAW_TABLES.items()}
