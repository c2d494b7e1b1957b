"""Star schema: one order fact and four dimensions, each from the wide sales row."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..catalog import WAREHOUSE
from ..functions.dates import month_name, quarter_name, weekday_name
from .numbering import dense_ids
from .wide import attach_products, quality_filter


def fact_order(wide: DataFrame) -> DataFrame:
    """Distinct order facts, numbered by product."""
    return dense_ids(wide.select(*WAREHOUSE["factOrder"].columns[1:]).distinct(), "product_id")


def _dimension(wide: DataFrame, key: str, table: str) -> DataFrame:
    """The distinct rows of a declared table whose ``id`` is a key of the wide row."""
    return wide.select(F.col(key).alias("id"), *WAREHOUSE[table].columns[1:]).distinct()


def used_by(source: DataFrame, wide: DataFrame, key: str) -> DataFrame:
    """The rows of a table with one row per ``id`` that the sales rows refer to.

    Where the sales rows are not written yet, this moves only ids with the order lines; taking a dimension's texts from
    the sales rows would move these along.
    """
    used = wide.select(F.col(key).alias("id")).distinct()
    return source.join(used, "id", "left_semi")


def dim_product(wide: DataFrame) -> DataFrame:
    return _dimension(wide, "product_id", "dimProduct")


def dim_product_of_lines(lines: DataFrame, product: DataFrame, inventory: DataFrame) -> DataFrame:
    """:func:`dim_product` where the sales rows are not written yet, from placed order lines, products and stock.

    The lines are reduced to distinct (product, status) before they meet the products. Each task reduces its own
    first, so a product that holds a third of all lines brings a few rows per task into the join, and the product's
    texts move once per status.
    """
    sold = lines.select("product_id", "delivery_status").distinct()
    kept = quality_filter(attach_products(sold, product, inventory))
    return kept.select(F.col("product_id").alias("id"), *WAREHOUSE["dimProduct"].columns[1:])


def dim_customer(wide: DataFrame) -> DataFrame:
    return _dimension(wide, "customer_id", "dimCustomer")


def dim_location(wide: DataFrame) -> DataFrame:
    return _dimension(wide, "city_id", "dimDiliveryLocation")


def dim_date(wide: DataFrame) -> DataFrame:
    """Calendar attributes of each order's shipping day.

    The attributes are a function of the day, so the distinct runs over three narrow columns before them.
    """
    shipped = F.col("shipped")
    days = wide.select("timeuuid", "quarter", F.col("ship_date").cast("date").alias("shipped")).distinct()
    return days.select(
        "timeuuid",
        F.year(shipped).alias("year"),
        "quarter",
        quarter_name(F.col("quarter")).alias("quarter_name"),
        F.month(shipped).alias("month"),
        month_name(shipped).alias("month_name"),
        F.dayofmonth(shipped).alias("day"),
        weekday_name(shipped).alias("weekday_name"),
    )


def in_calendar_order(dates: DataFrame) -> DataFrame:
    """Sorted for display by month and day; ``timeuuid`` lets a busy day span several sort ranges."""
    return dates.orderBy("month", "day", "timeuuid")
