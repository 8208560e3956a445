"""The three input datasets and the two result tables."""

from __future__ import annotations

# Dataset names (also their folder names) and the columns each file must name.
REQUIRED = {
    "orders": ["order_id", "user_id", "created_at", "status"],
    "order_items": ["id", "order_id", "product_id", "sale_price"],
    "products": ["id", "sku", "cost", "category", "retail_price"],
}
DATASETS = list(REQUIRED)

# What the daily figures read, with types. An item's own `status` drives the return rate,
# though the header check does not ask for it.
USED = {
    "orders": {"order_id": "bigint", "user_id": "bigint", "created_at": "string"},
    "order_items": {
        "id": "bigint",
        "order_id": "bigint",
        "product_id": "bigint",
        "sale_price": "string",
        "status": "string",
    },
    "products": {"id": "bigint", "category": "string"},
}

# Result table names and their keys.
CATEGORY_TABLE = "category_metrics_table"
ORDER_TABLE = "order_metrics_table"
TABLE_KEYS = {CATEGORY_TABLE: ["category", "order_date"], ORDER_TABLE: ["order_date"]}
