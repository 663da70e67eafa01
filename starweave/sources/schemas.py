"""Declared schemas of the eleven raw retail tables and the star tables,
allowed values (the source ENUMs) and the dimension hierarchies."""

from __future__ import annotations

from pyspark.sql import types as T

S, I, L, D, B = T.StringType(), T.IntegerType(), T.LongType(), T.DateType(), T.BooleanType()
M = T.DecimalType(15, 2)


def _schema(*fields) -> T.StructType:
    return T.StructType([T.StructField(n, t, True) for n, t in fields])


SOURCE_SCHEMAS: dict[str, T.StructType] = {
    "customers": _schema(("customer_id", S), ("customer_name", S), ("gender", S), ("age", I),
                         ("city", S), ("membership_level", S), ("registration_date", D)),
    "stores": _schema(("store_id", S), ("store_name", S), ("store_type", S), ("city", S),
                      ("province", S), ("region", S)),
    "sales_transactions": _schema(("transaction_id", S), ("transaction_date", D), ("store_id", S),
                                  ("customer_id", S), ("employee_id", S), ("payment_method", S),
                                  ("total_amount", M), ("discount_amount", M), ("final_amount", M),
                                  ("transaction_status", S)),
    "sales_transaction_details": _schema(("detail_id", S), ("transaction_id", S), ("product_id", S),
                                         ("quantity", I), ("unit_price", M),
                                         ("discount_per_item", M), ("subtotal", M)),
    "suppliers": _schema(("supplier_id", S), ("supplier_name", S), ("supplier_city", S),
                         ("supplier_category", S), ("contact_person", S), ("supplier_status", S)),
    "products": _schema(("product_id", S), ("product_name", S), ("category", S), ("brand", S),
                        ("supplier_id", S), ("unit_price", M), ("cost_price", M),
                        ("product_status", S)),
    "inventory_stock": _schema(("stock_id", S), ("product_id", S), ("store_id", S), ("stock_date", D),
                               ("beginning_stock", I), ("stock_in", I), ("stock_out", I),
                               ("ending_stock", I), ("stock_status", S)),
    "shipments": _schema(("shipment_id", S), ("shipment_date", D), ("source_location", S),
                         ("destination_store_id", S), ("product_id", S), ("quantity_shipped", I),
                         ("shipping_cost", M), ("shipment_status", S)),
    "marketing_campaigns": _schema(("campaign_id", S), ("campaign_name", S), ("campaign_type", S),
                                   ("start_date", D), ("end_date", D), ("channel", S),
                                   ("campaign_budget", M), ("target_segment", S)),
    "promotion_usage": _schema(("promo_usage_id", S), ("campaign_id", S), ("transaction_id", S),
                               ("customer_id", S), ("promo_code", S), ("discount_value", M),
                               ("usage_date", D)),
    "customer_feedback": _schema(("feedback_id", S), ("customer_id", S), ("transaction_id", S),
                                 ("product_id", S), ("feedback_date", D), ("rating", I),
                                 ("review_text", S), ("sentiment", S), ("feedback_channel", S)),
}

PRIMARY_KEYS: dict[str, tuple[str, ...]] = {
    "customers": ("customer_id",), "stores": ("store_id",),
    "sales_transactions": ("transaction_id",), "sales_transaction_details": ("detail_id",),
    "suppliers": ("supplier_id",), "products": ("product_id",), "inventory_stock": ("stock_id",),
    "shipments": ("shipment_id",), "marketing_campaigns": ("campaign_id",),
    "promotion_usage": ("promo_usage_id",), "customer_feedback": ("feedback_id",),
}

# (child table, child column, parent table, parent column) — declared foreign keys.
FOREIGN_KEYS: tuple[tuple[str, str, str, str], ...] = (
    ("sales_transactions", "store_id", "stores", "store_id"),
    ("sales_transactions", "customer_id", "customers", "customer_id"),
    ("sales_transaction_details", "transaction_id", "sales_transactions", "transaction_id"),
    ("products", "supplier_id", "suppliers", "supplier_id"),
    ("inventory_stock", "product_id", "products", "product_id"),
    ("shipments", "product_id", "products", "product_id"),
    ("promotion_usage", "campaign_id", "marketing_campaigns", "campaign_id"),
)

# The ENUM lists of the source schemas.
ALLOWED_VALUES: dict[tuple[str, str], tuple[str, ...]] = {
    ("customers", "gender"): ("Male", "Female"),
    ("customers", "membership_level"): ("Regular", "Silver", "Gold", "Platinum"),
    ("stores", "store_type"): ("Mall Store", "Standalone Store"),
    ("sales_transactions", "payment_method"): ("Cash", "Debit Card", "Credit Card", "E-Wallet", "Bank Transfer"),
    ("sales_transactions", "transaction_status"): ("Success", "Cancelled", "Returned"),
    ("suppliers", "supplier_status"): ("Active", "Inactive"),
    ("products", "product_status"): ("Active", "Discontinued"),
    ("inventory_stock", "stock_status"): ("Safe", "Low", "Out of Stock"),
    ("shipments", "shipment_status"): ("Delivered", "Delayed", "Cancelled"),
    ("marketing_campaigns", "campaign_type"): ("Discount", "Bundle", "Cashback", "Loyalty"),
    ("marketing_campaigns", "channel"): ("Store", "Instagram", "Website", "Email"),
    ("customer_feedback", "sentiment"): ("Positive", "Neutral", "Negative"),
    ("customer_feedback", "feedback_channel"): ("Website", "App", "Google Review", "Social Media"),
}

# Payment method -> payment type (the reference's inline map).
PAYMENT_TYPES: tuple[tuple[str, str], ...] = (
    ("Cash", "cash"),
    ("Debit Card", "card"),
    ("Credit Card", "card"),
    ("E-Wallet", "digital"),
    ("Bank Transfer", "digital"),
)

# The "no promotion" sentinel row of the promotion dimension.
NO_PROMO = {"campaign_id": "NO_PROMO", "campaign_name": "No Promotion", "campaign_type": "none",
            "channel": "none", "target_segment": "All", "effective_date": "2000-01-01",
            "expiry_date": "2099-12-31", "is_current": True}

# Hierarchies (top to bottom), by convention only (audit Q5 checks them).
HIERARCHIES: dict[str, tuple[str, ...]] = {
    "time": ("year", "quarter", "month", "full_date"),
    "geography": ("region", "province", "city", "store_name"),
    "product": ("category", "brand", "product_name"),
}

STAR_SCHEMAS: dict[str, tuple[str, ...]] = {
    "dim_time": ("time_key", "full_date", "day", "month", "month_name", "quarter", "year",
                 "week_of_year", "day_of_week", "day_name", "is_weekend"),
    "dim_product": ("product_key", "product_id", "product_name", "category", "brand",
                    "unit_price", "cost_price", "product_status"),
    "dim_customer": ("customer_key", "customer_id", "customer_name", "gender", "age", "age_group",
                     "city", "membership_level", "registration_date"),
    "dim_store": ("store_key", "store_id", "store_name", "store_type", "city", "province", "region"),
    "dim_supplier": ("supplier_key", "supplier_id", "supplier_name", "supplier_city",
                     "supplier_category", "supplier_status"),
    "dim_promotion": ("promotion_key", "campaign_id", "campaign_name", "campaign_type", "channel",
                      "target_segment", "effective_date", "expiry_date", "is_current"),
    "dim_payment_method": ("payment_key", "payment_method", "payment_type"),
}
