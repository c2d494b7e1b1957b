"""Source tables built from the clean catalog, with deterministic attributes."""

from __future__ import annotations

from datetime import datetime
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.dates import quarter_bucket, ship_date
from ..functions.keyed import keyed_int, keyed_pick, keyed_timestamp, keyed_weighted_pick, stable_uuid
from ..functions.measures import DELIVERY_WEIGHTS
from ..functions.text import email_address
from .catalog_clean import TRIPLE, distinct_triples
from .numbering import dense_ids

# Fixed values of the generated attributes.
GENDERS = ["Male", "Female", "Other"]
EMAIL_DOMAINS = ["Gmail.com", "Yahoo.com", "Outlook.com", "iCloud.com"]
SEGMENTS = ["Home Office", "Consumer", "Corporate"]
COUNTRY = "United States"
STOCK_RANGE = (50, 9999)
EMAIL_NUMBERS = (100, 500)
SHIPPING_DAYS = (1, 7)
FIRST_MOMENT = datetime(2023, 1, 1)
MOMENT_SPAN_SECONDS = 365 * 24 * 3600


def natural_key(*columns: str) -> Column:
    """A text that differs for different values: each part with its length before it, NULL as a dash."""
    part = lambda c: F.coalesce(F.concat(F.length(c).cast("string"), F.lit(":"), F.col(c)), F.lit("-"))
    return F.concat(*map(part, columns))


def number_products(catalog: DataFrame) -> DataFrame:
    """Distinct product triples with ids; product, inventory and order tables share this one numbering."""
    return dense_ids(distinct_triples(catalog), *TRIPLE)


def build_inventory(numbered: DataFrame) -> DataFrame:
    key = natural_key(*TRIPLE)
    return numbered.select(
        "id",
        keyed_int(key, "inv_quantity", *STOCK_RANGE).cast("int").alias("inv_quantity"),
        keyed_int(key, "quantity_sold", *STOCK_RANGE).cast("int").alias("quantity_sold"),
    )


def build_product(catalog: DataFrame, numbered: DataFrame) -> DataFrame:
    """Every listing with its id; a NULL in the triple is a value like any other."""
    keys = numbered.select("id", *(F.col(c).alias(f"key_{c}") for c in TRIPLE))
    same = reduce(Column.__and__, (F.col(c).eqNullSafe(F.col(f"key_{c}")) for c in TRIPLE))
    return catalog.join(keys, same).select(
        "id", *TRIPLE, "actual_price", "discount_price", "ratings", "no_of_ratings", "link", "image",
        F.col("id").alias("inventory_id"), F.col("id").alias("order_id"),
    )


BUYER = ("customer_name", "gender", "email", "segment")
PLACE = ("city", "state")


def draw_customers(catalog: DataFrame, names: DataFrame) -> DataFrame:
    """One buyer per listing, named from the ``name`` list; equal buyers are merged."""
    listing = natural_key(*TRIPLE, "link")
    numbered_names = dense_ids(names.select("name").where(F.col("name").isNotNull()).distinct(), "name")
    name_count = numbered_names.agg(F.count(F.lit(1))).scalar()
    drawn = catalog.select(
        keyed_int(listing, "name", 1, name_count).alias("id"),
        keyed_pick(listing, "gender", GENDERS).alias("gender"),
        keyed_int(listing, "email", *EMAIL_NUMBERS).alias("number"),
        keyed_pick(listing, "domain", EMAIL_DOMAINS).alias("domain"),
        keyed_pick(listing, "segment", SEGMENTS).alias("segment"),
    ).distinct()
    # Names are unique by id, and an e-mail tells its number and domain: distinct draws are distinct buyers.
    return drawn.join(numbered_names, "id").select(
        F.col("name").alias("customer_name"),
        "gender",
        email_address(F.col("name"), F.col("number"), F.col("domain")).alias("email"),
        "segment",
    )


def build_customer(catalog: DataFrame, names: DataFrame) -> DataFrame:
    """The buyers of :func:`draw_customers`, numbered."""
    return dense_ids(draw_customers(catalog, names), *BUYER)


def build_address(cities: DataFrame) -> DataFrame:
    """The numbered city list, one row per (city, state)."""
    places = cities.select("city", "state").distinct()
    return dense_ids(places, "city", "state").withColumn("country", F.lit(COUNTRY))


def build_orders(numbered: DataFrame, customer: DataFrame, address: DataFrame) -> DataFrame:
    """One order per product; buyer and place are drawn from the dense ids of their tables."""
    key = natural_key(*TRIPLE)
    customers = customer.agg(F.count(F.lit(1))).scalar()
    cities = address.agg(F.count(F.lit(1))).scalar()
    moments = numbered.select(
        "id",
        *TRIPLE,
        keyed_timestamp(key, "timestamp", FIRST_MOMENT, MOMENT_SPAN_SECONDS).alias("timestamp"),
        keyed_timestamp(key, "order_date", FIRST_MOMENT, MOMENT_SPAN_SECONDS).alias("order_date"),
    )
    return moments.select(
        "id",
        keyed_int(key, "customer", 1, customers).alias("customer_id"),
        "order_date",
        ship_date(F.col("order_date"), keyed_int(key, "days", *SHIPPING_DAYS)).alias("ship_date"),
        "timestamp",
        stable_uuid(key).alias("timeuuid"),
        quarter_bucket(F.col("timestamp")).alias("quarter"),
        keyed_weighted_pick(key, "status", DELIVERY_WEIGHTS).alias("delivery_status"),
        keyed_int(key, "city", 1, cities).alias("city_id"),
    )


def build_customer_address(orders: DataFrame) -> DataFrame:
    """Each customer with the addresses that the customer's orders go to."""
    return orders.select("customer_id", F.col("city_id").alias("address_id")).distinct()
