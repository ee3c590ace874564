"""Silver cleaners DS-1..DS-5: dedup first, then filter (ledger L7), then normalise text.

Each takes the Bronze DataFrame of its entity.  ``tie_cols=None`` means "all other source
columns", which makes the keep-latest pick deterministic without changing which rows can win.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.functions.text import initcap_trim, lower_trim, trimmed, upper_trim
from strata.operators.dedup import default_ties, keep_latest

# Silver column lists of the reference models, in output order.
CUSTOMER_COLUMNS = (
    "customer_id first_name last_name email phone address_line city state country "
    "postal_code signup_date is_active created_at updated_at"
).split()
PRODUCT_COLUMNS = (
    "product_id product_name category sub_category brand price stock_qty is_discontinued created_at updated_at"
).split()
ORDER_COLUMNS = (
    "order_id customer_id order_date status shipping_city shipping_country total_amount created_at updated_at"
).split()
ORDER_ITEM_COLUMNS = "order_item_id order_id product_id quantity unit_price line_total created_at".split()
PAYMENT_COLUMNS = "payment_id order_id amount method status paid_at created_at updated_at".split()


def _latest(df: DataFrame, key: str, columns: Sequence[str], order_col: str, tie_cols) -> DataFrame:
    ties = default_ties(columns, [key], [order_col]) if tie_cols is None else list(tie_cols)
    return keep_latest(df, [key], [order_col], ties)


def silver_customers(bronze: DataFrame, tie_cols: Sequence[str] | None = None) -> DataFrame:
    """DS-1: latest row per customer; rows without email or id dropped after the dedup (L7);
    names and city in ``initcap``, email lower-cased, the other columns passed through (L10)."""
    latest = _latest(bronze, "customer_id", CUSTOMER_COLUMNS, "updated_at", tie_cols)
    return latest.filter(F.col("email").isNotNull() & F.col("customer_id").isNotNull()).select(
        "customer_id",
        initcap_trim("first_name").alias("first_name"),
        initcap_trim("last_name").alias("last_name"),
        lower_trim("email").alias("email"),
        "phone",
        "address_line",
        initcap_trim("city").alias("city"),
        "state",
        "country",
        "postal_code",
        "signup_date",
        "is_active",
        "created_at",
        "updated_at",
    )


def silver_products(bronze: DataFrame, tie_cols: Sequence[str] | None = None) -> DataFrame:
    """DS-2: latest row per product with a non-negative price; text columns trimmed only (L10)."""
    latest = _latest(bronze, "product_id", PRODUCT_COLUMNS, "updated_at", tie_cols)
    return latest.filter(F.col("price") >= 0).select(
        "product_id",
        trimmed("product_name").alias("product_name"),
        trimmed("category").alias("category"),
        trimmed("sub_category").alias("sub_category"),
        trimmed("brand").alias("brand"),
        "price",
        "stock_qty",
        "is_discontinued",
        "created_at",
        "updated_at",
    )


def silver_orders(bronze: DataFrame, tie_cols: Sequence[str] | None = None) -> DataFrame:
    """DS-3: latest row per order with ids and a non-negative amount (NULL fails, L9); status
    upper-cased, shipping city in ``initcap``."""
    latest = _latest(bronze, "order_id", ORDER_COLUMNS, "updated_at", tie_cols)
    valid = F.col("order_id").isNotNull() & F.col("customer_id").isNotNull() & (F.col("total_amount") >= 0)
    return latest.filter(valid).select(
        "order_id",
        "customer_id",
        "order_date",
        upper_trim("status").alias("status"),
        initcap_trim("shipping_city").alias("shipping_city"),
        "shipping_country",
        "total_amount",
        "created_at",
        "updated_at",
    )


def silver_order_items(bronze: DataFrame) -> DataFrame:
    """Insert-only lines: no dedup, only sanity filters; ``line_total`` is decimal(21,2)."""
    return bronze.filter((F.col("quantity") > 0) & (F.col("unit_price") >= 0)).select(
        "order_item_id",
        "order_id",
        "product_id",
        "quantity",
        "unit_price",
        (F.col("quantity") * F.col("unit_price")).alias("line_total"),
        "created_at",
    )


def silver_payments(bronze: DataFrame, tie_cols: Sequence[str] | None = None) -> DataFrame:
    """DS-5: latest row per payment with a non-negative amount; method and status upper-cased."""
    latest = _latest(bronze, "payment_id", PAYMENT_COLUMNS, "updated_at", tie_cols)
    return latest.filter(F.col("amount") >= 0).select(
        "payment_id",
        "order_id",
        "amount",
        upper_trim("method").alias("method"),
        upper_trim("status").alias("status"),
        "paid_at",
        "created_at",
        "updated_at",
    )
