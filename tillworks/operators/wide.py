"""The joined, quality-filtered sales row from which all warehouse and mart tables derive."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..catalog import WIDE_COLUMNS

SECURE_URL = "^https://."


def with_buyers(orders: DataFrame, customer: DataFrame) -> DataFrame:
    """Orders (``customer_id``, …) with their buyer."""
    return orders.join(customer.withColumnRenamed("id", "customer_id"), "customer_id")


def with_places(orders: DataFrame, address: DataFrame) -> DataFrame:
    """Orders (``city_id``, …) with their delivery place."""
    return orders.join(address.withColumnRenamed("id", "city_id"), "city_id")


def attach_buyers(orders: DataFrame, customer: DataFrame, address: DataFrame) -> DataFrame:
    """Orders (``order_id``, ``customer_id``, …) with their buyer and delivery place."""
    return with_places(with_buyers(orders, customer), address)


def stocked(product: DataFrame, inventory: DataFrame) -> DataFrame:
    """Products (``product_id``, …) with their stock."""
    return product.withColumnRenamed("id", "product_id").join(
        inventory.withColumnRenamed("id", "inventory_id"), "inventory_id"
    )


def attach_products(orders: DataFrame, product: DataFrame, inventory: DataFrame) -> DataFrame:
    """Orders with their product and its stock.

    Orders that carry a ``product_id`` join on it; otherwise the product row names its order.
    """
    return orders.join(stocked(product, inventory), "product_id" if "product_id" in orders.columns else "order_id")


def join_sales(
    inventory: DataFrame, product: DataFrame, orders: DataFrame, customer: DataFrame, address: DataFrame
) -> DataFrame:
    """One row per order with its product, stock, buyer and delivery place.

    Orders meet the narrow buyer row first and the wide product row last, so that the second shuffle carries
    few bytes. No side is forced to broadcast: Spark broadcasts what its size statistics prove small (the
    address list), and AQE splits the join partition of a hot product or customer.
    """
    placed = attach_buyers(orders.withColumnRenamed("id", "order_id"), customer, address)
    return attach_products(placed, product, inventory).select(*WIDE_COLUMNS)


def fill_nulls(df: DataFrame) -> DataFrame:
    """No rating counts as 0 and no discount as 0."""
    return df.fillna(0, subset=["ratings", "no_of_ratings", "discount_price"])


def quality_filter(df: DataFrame) -> DataFrame:
    """Rows with secure links, a price, and a discount (if any) below it.

    All rules read product columns only, so Catalyst applies them to the products before any join.
    """
    priced = df.where(F.col("actual_price").isNotNull() & (F.col("actual_price") != 0))
    for url in ("image", "link"):
        priced = priced.where(F.col(url).isNotNull() & F.col(url).rlike(SECURE_URL))
    return fill_nulls(priced).where(F.col("discount_price") < F.col("actual_price"))


def wide_sales(
    inventory: DataFrame, product: DataFrame, orders: DataFrame, customer: DataFrame, address: DataFrame
) -> DataFrame:
    return quality_filter(join_sales(inventory, product, orders, customer, address))
