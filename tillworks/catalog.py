"""Declared tables: one schema and one key list per table, checked before every write."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql.types import StructType


@dataclass(frozen=True)
class Table:
    name: str
    ddl: str
    key: tuple[str, ...]
    #: Of a dimension: what names the thing that its versions describe.
    identity: tuple[str, ...] = ()

    @property
    def schema(self) -> StructType:
        return StructType.fromDDL(self.ddl)

    @property
    def columns(self) -> list[str]:
        return self.schema.fieldNames()

    def conform(self, df: DataFrame) -> DataFrame:
        """The frame in declared column order and types; a missing or undeclared column is an error."""
        missing = set(self.columns) - set(df.columns)
        surplus = set(df.columns) - set(self.columns)
        if missing or surplus:
            raise ValueError(f"{self.name}: missing {sorted(missing)}, undeclared {sorted(surplus)}")
        return df.select(*[df[field.name].cast(field.dataType) for field in self.schema])


# Raw listing files: every column is text.
LISTING_COLUMNS = (
    "name", "main_category", "sub_category", "image", "link",
    "ratings", "no_of_ratings", "discount_price", "actual_price",
)

# Stamps added by the lake writer; business columns keep their own year, month and day.
LOAD_DAY = ("load_year", "load_month", "load_day")
LOAD_STAMPS = ("load_seq", "load_batch", *LOAD_DAY)
LOAD_DDL = "load_seq BIGINT, load_batch STRING, load_year INT, load_month INT, load_day INT"

# Names, types and order of the columns below are those that existing consumers of the tables know.
LAKE = {
    t.name: t
    for t in (
        Table("inventory", "id BIGINT, inv_quantity INT, quantity_sold INT", ("id",)),
        Table(
            "product",
            "id BIGINT, product_name STRING, category STRING, type STRING, actual_price BIGINT,"
            " discount_price BIGINT, ratings DOUBLE, no_of_ratings BIGINT, link STRING, image STRING,"
            " inventory_id BIGINT, order_id BIGINT",
            ("id",),
        ),
        Table(
            "orderr",
            "id BIGINT, customer_id BIGINT, order_date TIMESTAMP_NTZ, ship_date TIMESTAMP_NTZ,"
            " timestamp TIMESTAMP_NTZ, timeuuid STRING, quarter INT, delivery_status STRING, city_id BIGINT",
            ("id",),
        ),
        Table(
            "customer",
            "id BIGINT, customer_name STRING, gender STRING, email STRING, segment STRING",
            ("id",),
        ),
        Table("address", "id BIGINT, city STRING, state STRING, country STRING", ("id",)),
        Table("customerAddress", "customer_id BIGINT, address_id BIGINT", ("customer_id", "address_id")),
    )
}

WAREHOUSE = {
    t.name: t
    for t in (
        Table(
            "factOrder",
            "id BIGINT, product_id BIGINT, customer_id BIGINT, city_id BIGINT, timeuuid STRING",
            ("id",),
        ),
        Table(
            "dimProduct",
            "id BIGINT, product_name STRING, category STRING, type STRING, actual_price BIGINT,"
            " discount_price BIGINT, ratings DOUBLE, no_of_ratings BIGINT, link STRING, image STRING,"
            " quantity_sold INT, inv_quantity INT, delivery_status STRING",
            ("id", "delivery_status", "quantity_sold", "inv_quantity"),
            ("id", "delivery_status"),
        ),
        Table(
            "dimCustomer",
            "id BIGINT, customer_name STRING, gender STRING, email STRING, segment STRING",
            ("id",),
            ("id",),
        ),
        # Spelled as published, so that existing consumers find it.
        Table("dimDiliveryLocation", "id BIGINT, city STRING, state STRING, country STRING", ("id",), ("id",)),
        Table(
            "dimDate",
            "timeuuid STRING, year INT, quarter INT, quarter_name STRING, month INT, month_name STRING,"
            " day INT, weekday_name STRING",
            ("timeuuid",),
            # An order ships on several days where its lines do.
            ("timeuuid", "year", "month", "day"),
        ),
    )
}

MART = {
    t.name: t
    for t in (
        Table(
            "revenue_table",
            "category STRING, type STRING, city STRING, state STRING, month INT, quarter INT, year INT,"
            " ratings DOUBLE, no_of_ratings BIGINT, avg_disc_price DOUBLE, avg_act_price DOUBLE,"
            " avg_disc_rate BIGINT, quantity_sold BIGINT, projected_income BIGINT, income BIGINT,"
            " inv_quantity BIGINT, inv_value BIGINT",
            ("category", "type", "city", "state", "month", "quarter", "year"),
        ),
        Table(
            "order_table",
            "order_id BIGINT, city STRING, state STRING, month INT, quarter INT, year INT,"
            " avg_spending DOUBLE, processing_time DOUBLE, canceled_order BIGINT, total_order BIGINT,"
            " cancellation_rate DOUBLE",
            ("order_id", "city", "state", "month", "quarter", "year"),
        ),
        Table(
            "customer_table",
            "customer_id BIGINT, gender STRING, segment STRING, city STRING, state STRING, month INT,"
            " quarter INT, year INT, loyal_customer STRING, total_orders BIGINT",
            ("customer_id", "gender", "segment", "city", "state", "month", "quarter", "year"),
        ),
    )
}

# The joined sales row, in published column order.
WIDE_COLUMNS = (
    "product_id", "product_name", "category", "type", "actual_price", "discount_price", "ratings",
    "no_of_ratings", "inventory_id", "inv_quantity", "quantity_sold", "link", "image", "customer_id",
    "customer_name", "gender", "email", "delivery_status", "segment", "city_id", "city", "state",
    "country", "order_id", "order_date", "ship_date", "timestamp", "timeuuid", "quarter",
)
