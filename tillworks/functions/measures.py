"""Row-level money measures of the sales reports, all BIGINT.

They expect the quality-filtered row, where a missing discount has already become 0.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The delivery states of an order and the share of each, used when states are assigned.
DELIVERY_WEIGHTS = {"Preparing": 15, "Shipped": 10, "Delivered": 80, "Undelivered": 5}
IN_PROGRESS = ("Shipped", "Preparing")


def is_discounted() -> Column:
    return F.col("discount_price") != 0


def selling_price() -> Column:
    """The discount price where there is one, else the actual price."""
    return F.when(is_discounted(), F.col("discount_price")).otherwise(F.col("actual_price")).cast("bigint")


def projected_income() -> Column:
    """Price of an order still under way; by definition not multiplied by quantity."""
    return F.when(F.col("delivery_status").isin(*IN_PROGRESS), selling_price()).otherwise(F.lit(0).cast("bigint"))


def income() -> Column:
    sold = selling_price() * F.col("quantity_sold").cast("bigint")
    return F.when(F.col("delivery_status") == "Delivered", sold).otherwise(F.lit(0).cast("bigint"))


def inventory_value() -> Column:
    return selling_price() * F.col("inv_quantity").cast("bigint")


def discount_rate() -> Column:
    """Percent taken off the actual price as an exact decimal of fourteen places, 0 where there is no discount."""
    off = (F.col("actual_price") - F.col("discount_price")).cast("decimal(20,0)") * 100 / F.col("actual_price").cast("decimal(18,0)")
    return F.when(is_discounted(), off).otherwise(F.lit(0)).cast("decimal(26,16)")


def spending() -> Column:
    """What the buyer pays: nothing for an undelivered order at full price."""
    pays_full = F.col("delivery_status").isin(*IN_PROGRESS, "Delivered") & ~is_discounted()
    return F.when(pays_full, F.col("actual_price")).otherwise(F.col("discount_price")).cast("bigint")


def add_measures(df: DataFrame) -> DataFrame:
    return df.withColumns(
        {"projected_income": projected_income(), "income": income(), "inv_value": inventory_value()}
    )
