"""The order, part and customer test tables seen as the retail model.

The tables hold no missing or malformed values, so these are put in by fixed rules on the keys: every quality
rule then has rows to reject. All rows of all tables take part.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..catalog import WIDE_COLUMNS
from ..functions.dates import quarter_bucket, ship_date
from ..functions.keyed import keyed_int, keyed_pick, stable_uuid
from ..functions.text import email_address
from ..operators.builders import COUNTRY, EMAIL_DOMAINS, EMAIL_NUMBERS, GENDERS
from ..operators.wide import attach_products, quality_filter, with_buyers, with_places


# Declared, so that opening a table starts no job to read file footers.
SCHEMAS = {
    "region": "r_regionkey INT, r_name STRING",
    "nation": "n_nationkey INT, n_name STRING, n_regionkey INT",
    "customer": "c_custkey BIGINT, c_name STRING, c_nationkey INT, c_acctbal DOUBLE, c_mktsegment STRING",
    "supplier": "s_suppkey BIGINT, s_name STRING, s_nationkey INT, s_acctbal DOUBLE",
    "part": "p_partkey BIGINT, p_name STRING, p_brand STRING, p_type STRING, p_size INT, p_retailprice DOUBLE",
    "orders": "o_orderkey BIGINT, o_custkey BIGINT, o_orderstatus STRING, o_totalprice DOUBLE,"
    " o_orderdate TIMESTAMP_NTZ, o_orderpriority STRING",
    "lineitem": "l_orderkey BIGINT, l_partkey BIGINT, l_suppkey BIGINT, l_linenumber INT, l_quantity DOUBLE,"
    " l_extendedprice DOUBLE, l_discount DOUBLE, l_tax DOUBLE, l_returnflag STRING, l_linestatus STRING,"
    " l_shipdate TIMESTAMP_NTZ",
    "events": "event_id BIGINT, ts TIMESTAMP_NTZ, user_id BIGINT, event_type STRING, value DOUBLE, props STRING",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(SCHEMAS[name]).parquet(f"{sf_dir}/{name}.parquet")


def every(n: int, key: str = "p_partkey") -> Column:
    return F.col(key) % n == 0


def unless(broken: Column, value: Column) -> Column:
    """The value, or NULL where it is to be missing."""
    return F.when(~broken, value)


def size_class() -> Column:
    size = F.col("p_size")
    return F.when(size < 17, "SMALL").when(size < 34, "MEDIUM").otherwise("LARGE")


def actual_price() -> Column:
    price = F.when(every(29), F.lit(0)).otherwise(F.floor("p_retailprice"))
    return unless(every(19), price).cast("bigint")


def discount_price() -> Column:
    percent = F.col("p_size") % 11
    reduced = F.call_function("div", actual_price() * (100 - percent), F.lit(100))
    return F.when(every(37), actual_price()).when(percent != 0, reduced).cast("bigint")


def image_url() -> Column:
    scheme = F.when(every(13), "http").otherwise("https")
    return unless(every(17), F.concat(scheme, F.lit("://img.example.com/"), F.col("p_partkey").cast("string")))


def link_url() -> Column:
    return unless(every(31), F.concat(F.lit("https://shop.example.com/p/"), F.col("p_partkey").cast("string")))


def rating_tenths() -> Column:
    return unless(every(23), 10 + F.col("p_partkey") % 41)


def rating_count() -> Column:
    return unless(every(23), F.col("p_partkey") * 37 % 20000)


def inventory(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("p_partkey")
    return table(spark, sf_dir, "part").select(
        key.alias("id"),
        (50 + key * 7919 % 9950).cast("int").alias("inv_quantity"),
        (50 + (key * 104729 + F.col("p_size")) % 9950).cast("int").alias("quantity_sold"),
    )


def product_columns() -> list[Column]:
    """A product's columns, all told by its row of the part table."""
    return [
        F.col("p_partkey").alias("id"),
        F.col("p_name").alias("product_name"),
        F.col("p_type").alias("category"),
        size_class().alias("type"),
        actual_price().alias("actual_price"),
        discount_price().alias("discount_price"),
        (rating_tenths() / 10).alias("ratings"),
        rating_count().alias("no_of_ratings"),
        link_url().alias("link"),
        image_url().alias("image"),
        F.col("p_partkey").alias("inventory_id"),
    ]


def product(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").select(*product_columns())


def order_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("order_id"),
        F.col("o_custkey").alias("customer_id"),
        F.col("o_orderdate").alias("order_date"),
    )


def header_columns() -> dict[str, Column]:
    """The columns of an order that its key and day tell."""
    placed = F.col("order_date")
    return {
        "timestamp": placed,
        "timeuuid": stable_uuid(F.col("order_id")),
        "quarter": quarter_bucket(placed),
    }


def order_headers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return order_keys(spark, sf_dir).withColumns(header_columns())


def line_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per line item, without its order's columns."""
    flag = F.col("l_returnflag")
    status = (
        F.when(flag == "R", "Undelivered")
        .when(flag == "A", "Delivered")
        .when(F.col("l_linestatus") == "F", "Shipped")
        .otherwise("Preparing")
    )
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("order_id"),
        F.col("l_partkey").alias("product_id"),
        (1 + F.col("l_linenumber") % 7).alias("shipping_days"),
        status.alias("delivery_status"),
    )


def shipped() -> Column:
    return ship_date(F.col("order_date"), F.col("shipping_days"))


def order_lines(spark: SparkSession, sf_dir: str, headers: DataFrame) -> DataFrame:
    """One order row per line item."""
    lines = line_items(spark, sf_dir).join(headers, "order_id")
    return lines.withColumn("ship_date", shipped()).drop("shipping_days")


def customer_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An order goes to its buyer's nation, so the place id rides on the customer row."""
    return table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("id"),
        F.col("c_name").alias("customer_name"),
        F.col("c_mktsegment").alias("segment"),
        F.col("c_nationkey").cast("bigint").alias("city_id"),
    )


def customer_columns(key: Column) -> dict[str, Column]:
    """The columns of a customer that its key and name tell."""
    return {
        "gender": keyed_pick(key, "gender", GENDERS),
        "email": email_address(
            F.col("customer_name"), keyed_int(key, "email", *EMAIL_NUMBERS), keyed_pick(key, "domain", EMAIL_DOMAINS)
        ),
    }


def customer(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = customer_keys(spark, sf_dir).withColumns(customer_columns(F.col("id")))
    return rows.select("id", "customer_name", "gender", "email", "segment", "city_id")


def places(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "nation").join(
        table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey")
    )


def address(spark: SparkSession, sf_dir: str) -> DataFrame:
    return places(spark, sf_dir).select(
        F.col("n_nationkey").cast("bigint").alias("id"),
        F.col("n_name").alias("city"),
        F.col("r_name").alias("state"),
        F.lit(COUNTRY).alias("country"),
    )


def bought(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders with their buyer, and the place's id only.

    Buyers are attached to the orders, before these fan out to their lines: lines are never shuffled by customer.
    """
    return with_buyers(order_keys(spark, sf_dir), customer(spark, sf_dir))


def described(spark: SparkSession, sf_dir: str, lines: DataFrame) -> DataFrame:
    """Lines of :func:`bought` orders with all that follows from their columns.

    This comes behind the joins, whose shuffles then move keys and no texts made of them. Places are nations, few at any
    scale, but Spark's estimate for their join with the regions may pass its limit: without the hint, all rows would be
    shuffled to two dozen keys.
    """
    columns = header_columns() | {"ship_date": shipped()}
    return with_places(lines.withColumns(columns).drop("shipping_days"), F.broadcast(address(spark, sf_dir)))


def placed_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order lines with header, buyer and place."""
    return described(spark, sf_dir, line_items(spark, sf_dir).join(bought(spark, sf_dir), "order_id"))


def bought_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """:func:`placed_lines` without the columns that others tell."""
    return line_items(spark, sf_dir).join(with_buyers(order_keys(spark, sf_dir), customer_keys(spark, sf_dir)), "order_id")


def placed(spark: SparkSession, sf_dir: str, lines: DataFrame) -> DataFrame:
    """Rows of :func:`bought_lines` with the other columns of :func:`placed_lines`."""
    return described(spark, sf_dir, lines).withColumns(customer_columns(F.col("customer_id")))


def wide_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The joined sales rows before the quality filter.

    Lines meet their product first, as narrow as they are stored, so that the quality rules drop them before they move
    on; what the part row tells is worked out behind the last join. By then rows lie by order, which is how the order
    report groups them.
    """
    key = F.col("p_partkey")
    parts = table(spark, sf_dir, "part").withColumns({"id": key, "inventory_id": key})
    sold = attach_products(line_items(spark, sf_dir), parts, inventory(spark, sf_dir)).drop("product_id", "inventory_id")
    rows = described(spark, sf_dir, sold.join(bought(spark, sf_dir), "order_id"))
    products = rows.select("*", *product_columns()).withColumnRenamed("id", "product_id")
    return products.select(*WIDE_COLUMNS)


def wide(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_filter(wide_rows(spark, sf_dir))


def listings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw listing rows as the scraper would write them: money with currency sign and thousands commas."""
    money = F.concat(F.lit("₹"), F.format_number(F.col("p_retailprice"), 2))
    reduced = F.concat(F.lit("₹"), F.format_number(discount_price(), 0))
    return table(spark, sf_dir, "part").select(
        F.col("p_name").alias("name"),
        F.col("p_type").alias("main_category"),
        size_class().alias("sub_category"),
        image_url().alias("image"),
        link_url().alias("link"),
        (rating_tenths() / 10).cast("string").alias("ratings"),
        F.format_number(rating_count(), 0).alias("no_of_ratings"),
        reduced.alias("discount_price"),
        unless(every(19), F.when(every(29), "").otherwise(money)).alias("actual_price"),
    )
