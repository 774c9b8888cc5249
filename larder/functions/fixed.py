"""Texts, thresholds and column lists results must agree on.

Nothing here is computed. They are stated once, so that operators and tests read the same.
"""

# --- labels of the product classification
PROFIT_DRIVER = "Profit Driver"
VOLUME_DRIVER = "Volume Driver"
HIDDEN_OPPORTUNITY = "Hidden Opportunity"
LOW_PERFORMER = "Low Performer"
INSUFFICIENT_HISTORY = "Insufficient History"

# --- settings of the multi-indicator label
HIGH_RANK = 0.50
WASTE_OK = 0.12
QUALITY_PROFIT_DRIVER = 0.40
QUALITY_HIDDEN_OPPORTUNITY = 0.55
MIN_UNITS = 20
MIN_HISTORY_DAYS = 60
NEUTRAL_RATING = 3.5

# --- customer segments by score
LOYAL = "Loyal High Spender"
AT_RISK = "At Risk"
NEW_CUSTOMER = "New Customer"
REGULAR = "Regular"

# --- customer segments by population quantiles
HIGH_VALUE_LOYAL = "High-Value Loyal"
NEW_CUSTOMERS = "New Customers"
AT_RISK_NAMED = "At-Risk"
PROMOTION_DRIVEN = "Promotion-Driven"
FREQUENT = "Frequent"
OCCASIONAL = "Occasional"

# --- order statuses
COMPLETED = "Completed"
CANCELLED = "Cancelled"

# --- valid location codes: L01 to L20
LOCATIONS = [f"L{n:02d}" for n in range(1, 21)]

# --- plausible order dates
FIRST_PLAUSIBLE_DATE = "2015-01-01"
LAST_PLAUSIBLE_DATE = "2026-09-28"

# --- names of the cleaning rules
EXACT_DUPLICATES = "exact duplicate rows"
MISSING_CUSTOMER = "missing customer_id"
INVALID_BRANCH = "invalid location_id (not a real branch)"
INVALID_LOCATION = "invalid location_id"
UNPARSEABLE_DATE = "order_date cannot be parsed"
IMPLAUSIBLE_DATE = "order_date implausible (before 2015 or after today)"
MISSING_ITEM = "missing item_id"
UNKNOWN_ITEM = "unknown item_id (not in menu_items)"
BAD_QUANTITY = "quantity is zero or negative"
BAD_PRICE = "unit_price is zero or negative"
BAD_DISCOUNT = "discount_pct outside 0-100"
ORPHAN_LINES = "orphan lines (order was dropped or never existed)"
BAD_RATING = "rating_value outside 1-5"
ORPHAN_RATING = "orphan rating (order was dropped or never existed)"
IMPOSSIBLE_WASTE = "impossible quantity_wasted (<=0 or >1000)"
NEGATIVE_STOCK = "negative closing_stock"

# --- names of the quality rules that differ from the cleaning rules
Q_UNPARSEABLE = "order_date cannot be parsed as a date"
Q_FUTURE = "order_date is in the future"
Q_OLD = "order_date is implausibly old (before 2015)"
Q_CHANNEL = "channel needs standardising (case/spacing)"
Q_STATUS = "status needs standardising (case/spacing)"
Q_WASTE = "quantity_wasted is impossible (<=0 or >1000)"
Q_STOCK = "closing_stock is negative"
Q_UNIT = "unit is not lower-case"
Q_UNKNOWN_ITEM = "item_id not found in menu_items (unknown dish)"
Q_ORPHAN_LINE = "order_id not found in orders (orphan line)"
Q_ORPHAN_RATING = "order_id not found in orders (orphan rating)"

# --- priorities of recommendations, most urgent first
PRIORITIES = ["Critical", "High", "Medium", "Low"]

# --- raw CSV columns, dates kept as text until they are cleaned
RAW_SCHEMAS = {
    "menu_categories": "category_id STRING, category_name STRING",
    "menu_items": "item_id STRING, item_name STRING, category_id STRING, base_price DOUBLE, base_cost DOUBLE, "
                  "unit STRING, description STRING, is_active STRING, introduced_date STRING",
    "restaurants": "location_id STRING, restaurant_name STRING, city STRING, area STRING, region STRING, "
                   "seats INT, opened_date STRING",
    "customers": "customer_id STRING, home_city STRING, age_bracket STRING, signup_date STRING",
    "pricing_history": "price_id STRING, item_id STRING, price DOUBLE, effective_from STRING, effective_to STRING",
    "promotions": "promo_id STRING, promo_name STRING, promo_type STRING, discount_pct DOUBLE, start_date STRING, "
                  "end_date STRING, scope STRING, applicable_items STRING, category_id STRING, location_id STRING",
    "orders": "order_id STRING, customer_id STRING, location_id STRING, order_datetime STRING, order_date STRING, "
              "channel STRING, payment_method STRING, status STRING, promo_id STRING",
    "order_items": "order_item_id STRING, order_id STRING, item_id STRING, quantity INT, unit_price DOUBLE, "
                   "discount_pct DOUBLE, line_total DOUBLE",
    "ratings": "rating_id STRING, order_id STRING, item_id STRING, customer_id STRING, rating_date STRING, "
               "rating_value INT",
    "inventory": "inventory_id STRING, item_id STRING, location_id STRING, week_start STRING, opening_stock INT, "
                 "replenished_qty INT, prepared_qty INT, consumed_qty INT, closing_stock INT, unit STRING",
    "wastage": "wastage_id STRING, item_id STRING, location_id STRING, waste_date STRING, quantity_wasted INT, "
               "unit_cost DOUBLE, wastage_cost DOUBLE, reason STRING",
}

LINE_FEATURE_COLUMNS = [
    "order_id", "item_id", "item_name", "category_id", "category_name", "customer_id", "location_id",
    "order_date", "channel", "status", "is_completed", "quantity", "unit_price", "discount_pct", "net_revenue",
    "line_cost", "line_profit", "day_of_week", "is_weekend", "avg_rating",
]
ITEM_FEATURE_COLUMNS = [
    "item_id", "item_name", "category_id", "category_name", "base_cost", "total_quantity_sold", "n_orders",
    "net_revenue", "total_cost", "total_profit", "avg_rating", "avg_discount_pct", "weekend_share",
    "profit_margin", "wastage_percent",
]
CUSTOMER_RFM_COLUMNS = ["customer_id", "frequency", "monetary", "recency_days"]
WEEKLY_COLUMNS = ["entity_id", "entity_name", "week_start", "units", "net_revenue", "orders", "promo_units"]

CONTRACTS = {
    "order_lines_features": LINE_FEATURE_COLUMNS,
    "item_features": ITEM_FEATURE_COLUMNS,
    "customer_rfm": CUSTOMER_RFM_COLUMNS,
    "weekly_item": WEEKLY_COLUMNS,
    "weekly_category": WEEKLY_COLUMNS,
    "weekly_location": WEEKLY_COLUMNS,
    "daily_location": ["order_date", "location_id", "orders", "units", "net_revenue", "profit"],
    "daily_item": ["order_date", "item_id", "units", "net_revenue"],
}
