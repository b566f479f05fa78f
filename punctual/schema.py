"""Table definitions, as column names and types."""

from __future__ import annotations

from pyspark.sql import types as T

TEXT = T.StringType()
INT = T.IntegerType()
LONG = T.LongType()
DATE = T.DateType()
# The raw amounts have no declared precision, so the widest decimal takes them: twenty
# digits before and eighteen after the point. Tables with declared amounts pass their own.
AMOUNT = T.DecimalType(38, 18)

# Sums of the items of late batches, by order, that the order table has not seen yet.
TOUCHED = "touched_orders"
# Bit arrays that tell which folders of the fact cannot hold an item key.
FACT_FILTER = "fact_key_filter"
# Counts of orders by several sets of keys, for every bucket of the order table.
SUMMARY = "order_summary"
# Tables with one folder per hash bucket of a key.
BUCKETED = {"fact_order_items": "order_item_id", "order_grain": "order_id"}

# Column names of the published model.
CUSTOMER_ATTRIBUTES = [
    "customer_segment", "customer_city", "customer_state", "customer_country",
]
PRODUCT_ATTRIBUTES = [
    "product_price", "product_name", "product_status", "category_id",
    "category_name", "department_id", "department_name",
]
GEOGRAPHY = ["order_city", "order_state", "order_country", "order_region", "market"]
DELIVERY = [
    "days_for_shipping_real", "days_for_shipment_sched", "late_delivery_risk",
    "delivery_status", "order_status",
]
MEASURES = [
    "sales", "sales_per_customer", "order_item_quantity", "order_item_discount",
    "order_item_discount_rate", "order_item_product_price", "order_item_profit_ratio",
    "order_item_total", "order_profit_per_order", "benefit_per_order",
]
V_ORDERS = [
    "order_id", "geography_id", "shipping_mode_id", "order_date_id", "shipping_date_id",
    "late_delivery_risk", "delivery_status", "order_status", "payment_type",
]


def staging_schema(
    item_key: T.DataType = LONG, amount: T.DecimalType = AMOUNT
) -> T.StructType:
    """``stg_orders``: one row per order item, no keys.

    Ids are 64-bit. The item key and the amount type follow the source.
    """
    columns = [
        ("row_id", LONG), ("order_id", LONG), ("order_item_id", item_key),
        ("order_date", DATE), ("shipping_date", DATE), ("shipping_mode", TEXT),
        ("days_for_shipping_real", INT), ("days_for_shipment_sched", INT),
        ("late_delivery_risk", INT), ("delivery_status", TEXT), ("order_status", TEXT),
        ("payment_type", TEXT),
        ("customer_id", LONG), ("order_customer_id", LONG), ("customer_segment", TEXT),
        ("customer_city", TEXT), ("customer_state", TEXT), ("customer_country", TEXT),
        ("product_card_id", LONG), ("product_name", TEXT), ("product_price", amount),
        ("product_status", INT), ("category_id", INT), ("category_name", TEXT),
        ("department_id", INT), ("department_name", TEXT),
        ("order_city", TEXT), ("order_state", TEXT), ("order_country", TEXT),
        ("order_region", TEXT), ("market", TEXT),
        ("sales", amount), ("sales_per_customer", amount), ("order_item_quantity", INT),
        ("order_item_discount", amount), ("order_item_discount_rate", amount),
        ("order_item_product_price", amount), ("order_item_profit_ratio", amount),
        ("order_item_total", amount), ("order_profit_per_order", amount),
        ("benefit_per_order", amount),
    ]
    return T.StructType([T.StructField(name, kind) for name, kind in columns])


STAGING_COLUMNS = staging_schema().fieldNames()


def table_schemas(
    item_key: T.DataType = LONG, amount: T.DecimalType = AMOUNT
) -> dict[str, T.StructType]:
    """All tables of the model. ``order_grain`` holds the order view and item sums."""
    staging = staging_schema(item_key, amount)

    def layout(*columns: str, **own: T.DataType) -> T.StructType:
        kinds = {**{f.name: f.dataType for f in staging}, **own}
        return T.StructType([T.StructField(c, kinds[c]) for c in columns])

    keys = {k: LONG for k in [
        "geography_id", "shipping_mode_id", "date_id", "order_date_id", "shipping_date_id",
    ]}
    days = {"full_date": DATE, "year": INT, "month": INT, "day": INT, "weekday": TEXT}
    # A sum has ten more digits than its summands, where there are as many.
    total = T.DecimalType(min(38, amount.precision + 10), amount.scale)
    grain = layout(
        *V_ORDERS, *DELIVERY[:2], "total_sales", "max_days_sched",
        **keys, total_sales=total, max_days_sched=INT,
    )
    return {
        "stg_orders": staging,
        "dim_customer": layout("customer_id", *CUSTOMER_ATTRIBUTES),
        "dim_product": layout("product_card_id", *PRODUCT_ATTRIBUTES),
        "dim_geography": layout("geography_id", *GEOGRAPHY, **keys),
        "dim_shipping_mode": layout("shipping_mode_id", "shipping_mode", **keys),
        "dim_date": layout("date_id", *days, **keys, **days),
        "fact_order_items": layout(
            "order_item_id", "order_id", "customer_id", "product_card_id",
            "geography_id", "shipping_mode_id", "order_date_id", "shipping_date_id",
            *DELIVERY, *MEASURES, "payment_type", **keys,
        ),
        "order_grain": grain,
        TOUCHED: grain,
        SUMMARY: layout(
            "order_bucket", "part", "has_order", "geography_id", "shipping_mode_id",
            "shipping_date_id", "value_bin", "late_delivery_risk", "n",
            "sum_real", "n_real", "sum_sched", "n_sched", "smallest",
            **keys, order_bucket=INT, part=TEXT, has_order=T.BooleanType(),
            value_bin=T.DecimalType(38, 0), n=LONG, sum_real=LONG, n_real=LONG,
            sum_sched=LONG, n_sched=LONG, smallest=total,
        ),
    }
