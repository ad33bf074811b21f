"""Column contracts of the staging layer and the warehouse."""

from __future__ import annotations

# Staging layer: what the files hold once read. Everything is nullable.
STAGING: dict[str, str] = {
    "orders": (
        "order_id string, customer_id string, order_status string, order_purchase_timestamp timestamp_ntz, "
        "order_approved_at timestamp_ntz, order_delivered_carrier_date timestamp_ntz, "
        "order_delivered_customer_date timestamp_ntz, order_estimated_delivery_date timestamp_ntz"
    ),
    "customers": (
        "customer_id string, customer_unique_id string, customer_zip_code_prefix string, "
        "customer_city string, customer_state string"
    ),
    "order_items": (
        "order_id string, order_item_id int, product_id string, seller_id string, "
        "shipping_limit_date timestamp_ntz, price decimal(10,2), freight_value decimal(10,2)"
    ),
    "payments": (
        "order_id string, payment_sequential int, payment_type string, payment_installments int, "
        "payment_value decimal(10,2)"
    ),
    "reviews": (
        "review_id string, order_id string, review_score int, review_comment_title string, "
        "review_comment_message string, review_creation_date timestamp_ntz, review_answer_timestamp timestamp_ntz"
    ),
    "products": (
        "product_id string, product_category_name string, product_name_length int, "
        "product_description_length int, product_photos_qty int, product_weight_g decimal(10,2), "
        "product_length_cm decimal(10,2), product_height_cm decimal(10,2), product_width_cm decimal(10,2)"
    ),
    "sellers": "seller_id string, seller_zip_code_prefix string, seller_city string, seller_state string",
    "geolocation": "zip_code_prefix string, lat decimal(9,6), lng decimal(9,6), city string, state string",
    "category_translation": "product_category_name string, product_category_name_english string",
}

# Warehouse tables. Facts and dim_order also keep the natural keys next to the surrogate ones,
# so reports join on what the sources share and never need the numbering.
WAREHOUSE: dict[str, list[str]] = {
    "dim_date": [
        "date_key", "full_date", "day", "month", "month_name", "quarter", "year", "week_of_year",
        "weekday_name", "is_weekend",
    ],
    "dim_geolocation": ["geolocation_key", "zip_code_prefix", "avg_lat", "avg_lng", "city", "state"],
    "dim_customer": [
        "customer_key", "customer_id", "customer_unique_id", "customer_zip_code_prefix", "customer_city",
        "customer_state", "geolocation_key",
    ],
    "dim_seller": [
        "seller_key", "seller_id", "seller_zip_code_prefix", "seller_city", "seller_state", "geolocation_key",
    ],
    "dim_product": [
        "product_key", "product_id", "product_category_name", "product_category_name_english",
        "product_name_length", "product_description_length", "product_photos_qty", "product_weight_g",
        "product_length_cm", "product_height_cm", "product_width_cm",
    ],
    "dim_order": [
        "order_key", "order_id", "customer_key", "customer_id", "purchase_date_key", "order_status",
        "order_purchase_timestamp", "order_approved_at", "order_delivered_carrier_date",
        "order_delivered_customer_date", "order_estimated_delivery_date",
    ],
    "fact_order_items": [
        "order_item_key", "order_id", "order_item_id", "order_key", "seller_key", "seller_id", "product_key",
        "product_id", "price", "freight_value", "shipping_limit_date",
    ],
    "fact_payments": [
        "payment_key", "order_id", "payment_sequential", "payment_type", "payment_installments", "payment_value",
    ],
    "fact_reviews": [
        "review_key", "review_id", "order_id", "review_score", "review_comment_title", "review_comment_message",
        "review_creation_date", "review_answer_timestamp",
    ],
}

# Load order of the warehouse; clearing runs the other way round.
LOAD_ORDER = list(WAREHOUSE)

# Columns that must hold a value, per table.
REQUIRED: dict[str, list[str]] = {
    "dim_date": ["date_key", "full_date"],
    "dim_geolocation": ["zip_code_prefix", "avg_lat", "avg_lng"],
    "dim_customer": ["customer_id", "customer_unique_id"],
    "dim_seller": ["seller_id"],
    "dim_product": ["product_id"],
    "dim_order": ["order_id", "order_status", "order_purchase_timestamp"],
    "fact_order_items": ["order_id", "price", "freight_value"],
    "fact_payments": ["order_id", "payment_type", "payment_installments", "payment_value"],
    "fact_reviews": ["review_id", "order_id", "review_score"],
}

# Natural keys that must be unique, per table.
UNIQUE: dict[str, list[str]] = {
    "dim_date": ["date_key"],
    "dim_geolocation": ["zip_code_prefix"],
    "dim_customer": ["customer_id"],
    "dim_seller": ["seller_id"],
    "dim_product": ["product_id"],
    "dim_order": ["order_id"],
    "fact_order_items": ["order_id", "order_item_id"],
    "fact_payments": ["order_id", "payment_sequential"],
}

DATE_COLUMNS: dict[str, list[str]] = {
    "orders": [
        "order_purchase_timestamp", "order_approved_at", "order_delivered_carrier_date",
        "order_delivered_customer_date", "order_estimated_delivery_date",
    ],
    "order_items": ["shipping_limit_date"],
    "reviews": ["review_creation_date", "review_answer_timestamp"],
}
