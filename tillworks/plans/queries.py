"""The registered queries: each takes (spark, sf_dir), reads whole tables and returns a DataFrame."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from datetime import date, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import dates, keyed, text
from ..functions.measures import DELIVERY_WEIGHTS, add_measures
from ..operators import builders, catalog_clean, reports, star
from ..operators import wide as wide_ops
from ..operators.envelope import decode, encode
from ..operators.latest import latest_by_key
from ..operators.numbering import dense_ids
from ..operators.stable_keys import keys_not_stored, stable_ids
from ..session import fresh_dir, written
from ..sources.endpoints import file_topic
from ..sources.history import read_versions, write_versions
from ..sources.lake import read_lake, read_table, upsert_table, write_batch
from ..sources.listings import read_listings, union_sources
from ..sources.sales_store import SalesStore
from ..streaming.envelope_stream import topic_to_lake
from . import adapter
from .report_loads import add_load, read_report

Query = Callable[[SparkSession, str], DataFrame]

RUN_DATE = date(2024, 7, 1)
NEXT_RUN_DATE = date(2024, 7, 8)
STORE_BUCKETS = 16
SCAN_MONTH = 7
EVENT_COLUMNS = ("event_id", "ts", "user_id", "event_type", "value", "props")

_registry: dict[str, Query] = {}


def query(function: Query) -> Query:
    _registry[function.__name__.removesuffix("_query")] = function
    return function


def queries() -> dict[str, Query]:
    return dict(_registry)


def _over_wide(name: str, report: Callable[[DataFrame], DataFrame]) -> None:
    _registry[name] = lambda spark, sf_dir: report(adapter.wide(spark, sf_dir))


# Wide table, reports, star schema


@query
def wide_sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    return adapter.wide_rows(spark, sf_dir)


@query
def wide_sales_stored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The wide rows from lines and products that were stored in buckets of the product."""
    lines, product, inventory = adapter.bought_lines(spark, sf_dir), adapter.product(spark, sf_dir), adapter.inventory(spark, sf_dir)
    path = fresh_dir(spark, "sales-store")
    products = wide_ops.stocked(product, inventory)
    store = SalesStore(
        spark, path, f"sales_{uuid.uuid4().hex}", lines.schema, products.schema, STORE_BUCKETS,
        describe=lambda rows: adapter.placed(spark, sf_dir, rows),
    )
    store.put_products(product, inventory)
    store.add_lines(lines)
    return store.wide()


@query
def report_loads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The revenue report, grown by three loads: sales rows that are delivered, those that are not, and the rest."""
    rows = adapter.wide(spark, sf_dir)
    root = fresh_dir(spark, "report")
    status = F.coalesce("delivery_status", F.lit(""))
    ended = ("Delivered", "Undelivered")
    for batch, load in (("w1", status == ended[0]), ("w2", status == ended[1]), ("w3", ~status.isin(*ended))):
        add_load(rows.where(load), root, RUN_DATE, batch, [reports.REVENUE])
    return read_report(spark, root, reports.REVENUE)


@query
def dim_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Versions of the products over two loads, the second of which raises the price of each thirteenth product."""
    product = adapter.product(spark, sf_dir).drop("inventory_id")
    path = fresh_dir(spark, "history")
    raised = F.when(adapter.every(13, "id"), F.col("actual_price") + 1).otherwise(F.col("actual_price"))
    write_versions(product, path, ["id"], RUN_DATE, "w1")
    write_versions(product.withColumn("actual_price", raised), path, ["id"], NEXT_RUN_DATE, "w2")
    return read_versions(spark, path, product.schema, ["id"]).select(
        "id", "product_name", "actual_price", "discount_price", "ratings", "link", "valid_from", "valid_to"
    )


@query
def quality_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return adapter.wide(spark, sf_dir)


@query
def fill_nulls(spark: SparkSession, sf_dir: str) -> DataFrame:
    filled = wide_ops.fill_nulls(adapter.product(spark, sf_dir))
    return filled.select("id", "discount_price", "ratings", "no_of_ratings", "actual_price")


@query
def revenue_measures(spark: SparkSession, sf_dir: str) -> DataFrame:
    return add_measures(adapter.wide(spark, sf_dir)).select(
        "order_id", "product_id", "delivery_status", "actual_price", "discount_price", "projected_income",
        "income", "inv_value",
    )


_over_wide("revenue_report", reports.revenue_report)
_over_wide("order_report", reports.order_report)
_over_wide("customer_report", reports.customer_report)
_over_wide("fact_order", star.fact_order)
_over_wide("dim_date", lambda rows: star.in_calendar_order(star.dim_date(rows)))


@query
def dim_product(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = adapter.placed_lines(spark, sf_dir)
    return star.dim_product_of_lines(lines, adapter.product(spark, sf_dir), adapter.inventory(spark, sf_dir))


@query
def dim_customer(spark: SparkSession, sf_dir: str) -> DataFrame:
    buyers = adapter.customer(spark, sf_dir).select("id", "customer_name", "gender", "email", "segment")
    return star.used_by(buyers, adapter.wide(spark, sf_dir), "customer_id")


@query
def dim_location(spark: SparkSession, sf_dir: str) -> DataFrame:
    return star.used_by(adapter.address(spark, sf_dir), adapter.wide(spark, sf_dir), "city_id")


@query
def preview_topn(spark: SparkSession, sf_dir: str) -> DataFrame:
    report = reports.revenue_report(adapter.wide(spark, sf_dir))
    return reports.preview(report, reports.DISPLAY_ORDER["revenue_table"])


# Keys, joins, sets


def _catalog(spark: SparkSession, sf_dir: str) -> DataFrame:
    return catalog_clean.clean_catalog(adapter.listings(spark, sf_dir))


@query
def distinct_triples(spark: SparkSession, sf_dir: str) -> DataFrame:
    return catalog_clean.distinct_triples(_catalog(spark, sf_dir))


@query
def surrogate_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every order line's (product, customer, day) combination, numbered in that order."""
    combos = adapter.order_lines(spark, sf_dir, adapter.order_headers(spark, sf_dir))
    return dense_ids(combos.select("product_id", "customer_id", "ship_date").distinct(), "product_id", "customer_id")


@query
def incremental_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of all listings after two overlapping loads: those of the first load stay, new ones go above them."""
    catalog = catalog_clean.distinct_triples(_catalog(spark, sf_dir))
    first, second = _loads(catalog)
    path = fresh_dir(spark, "keys")
    stable_ids(path, first, *catalog_clean.TRIPLE)
    stable_ids(path, second, *catalog_clean.TRIPLE)
    return stable_ids(path, catalog, *catalog_clean.TRIPLE)


@query
def new_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The listings of a second, overlapping load that the first has not brought."""
    first, second = _loads(_catalog(spark, sf_dir))
    path = fresh_dir(spark, "keys")
    stable_ids(path, first, *catalog_clean.TRIPLE)
    return keys_not_stored(path, second, *catalog_clean.TRIPLE)


def _loads(catalog: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Two loads that together hold all rows and share one size class."""
    return catalog.where(F.col("type") != "LARGE"), catalog.where(F.col("type") != "SMALL")


@query
def join_using_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each listing with the number and lowest price of its copies.

    The aggregate is written first: read back, it enters the join through a shuffle of its own, which is what
    lets AQE split the partition of a triple that holds a third of the listings.
    """
    catalog = _catalog(spark, sf_dir)
    copies = catalog.groupBy(*catalog_clean.TRIPLE).agg(
        F.count(F.lit(1)).alias("copies"), F.min("actual_price").alias("lowest_price")
    )
    return catalog.join(written(copies, "copies"), list(catalog_clean.TRIPLE), "inner").select(
        "link", *catalog_clean.TRIPLE, "actual_price", "copies", "lowest_price"
    )


@query
def customer_places(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each buyer with the places that the buyer's orders go to."""
    headers = adapter.order_headers(spark, sf_dir).select("customer_id")
    buyers = adapter.customer(spark, sf_dir).select(F.col("id").alias("customer_id"), "city_id")
    return builders.build_customer_address(headers.join(buyers, "customer_id"))


@query
def union_sources_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    buyers = adapter.table(spark, sf_dir, "customer").select(
        F.lit("customer").alias("party"),
        F.col("c_custkey").alias("party_id"),
        F.col("c_name").alias("name"),
        F.col("c_mktsegment").alias("segment"),
    )
    sellers = adapter.table(spark, sf_dir, "supplier").select(
        F.col("s_suppkey").alias("party_id"), F.col("s_name").alias("name"), F.lit("supplier").alias("party")
    )
    return union_sources(buyers, sellers)


@query
def collect_set_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per region, the nations that have buyers. Nations are made distinct before they are collected, so an
    array is as long as the list of nations, however many customers there are."""
    served = adapter.table(spark, sf_dir, "customer").select(F.col("c_nationkey").alias("n_nationkey")).distinct()
    named = served.join(adapter.places(spark, sf_dir), "n_nationkey")
    return named.groupBy("r_name").agg(
        F.array_join(F.sort_array(F.collect_set("n_name")), ",").alias("nations")
    )


@query
def high_water_mark(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events beyond what the loads before the last day have stored."""
    incoming = adapter.table(spark, sf_dir, "events")
    last_day = incoming.agg(F.date_trunc("day", F.max("ts")).cast("timestamp_ntz")).scalar()
    stored = incoming.where(F.col("ts") < last_day)
    return catalog_clean.rows_above_mark(incoming, stored, "event_id").select(*EVENT_COLUMNS)


# Cleaning and scalar functions


@query
def catalog_clean_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    listings = adapter.listings(spark, sf_dir)
    both = listings.withColumn("actual_digits", text.clean_price(F.col("actual_price"), "digits"))
    return catalog_clean.clean_catalog(both)


@query
def quarter_bucket(spark: SparkSession, sf_dir: str) -> DataFrame:
    known = F.when(~adapter.every(10, "o_orderkey"), F.col("o_orderdate"))
    month = F.month(known)
    return adapter.table(spark, sf_dir, "orders").select(
        "o_orderkey",
        month.alias("month"),
        dates.quarter_bucket(known).alias("quarter"),
        month.between(4, 9).alias("mid_year"),
    )


@query
def ship_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = adapter.order_lines(spark, sf_dir, adapter.order_headers(spark, sf_dir))
    return lines.select(
        "order_id", "product_id", "order_date", "ship_date",
        dates.days_between(F.col("order_date"), F.col("ship_date")).alias("processing_days"),
    )


@query
def customer_email(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("p_partkey")
    number = keyed.keyed_int(key, "email", *builders.EMAIL_NUMBERS)
    domain = keyed.keyed_pick(key, "domain", builders.EMAIL_DOMAINS)
    return adapter.table(spark, sf_dir, "part").select(
        "p_partkey",
        text.first_word(F.col("p_name")).alias("first_word"),
        text.email_address(adapter.unless(adapter.every(19), F.col("p_name")), number, domain).alias("email"),
    )


@query
def address_pack(spark: SparkSession, sf_dir: str) -> DataFrame:
    buyers = adapter.table(spark, sf_dir, "customer")
    placed = buyers.join(adapter.places(spark, sf_dir), F.col("c_nationkey") == F.col("n_nationkey"))
    state = F.when(~adapter.every(7, "c_custkey"), F.col("r_name"))
    packed = placed.select("c_custkey", text.pack_fields(F.col("c_custkey"), F.col("n_name"), state).alias("address"))
    return packed.select(
        "c_custkey",
        "address",
        text.unpack_field(F.col("address"), 0).try_cast("bigint").alias("id"),
        text.unpack_field(F.col("address"), 1).alias("city"),
        text.unpack_field(F.col("address"), 2).alias("state"),
    )


@query
def parse_timestamp(spark: SparkSession, sf_dir: str) -> DataFrame:
    written = F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss")
    messy = F.when(adapter.every(7, "o_orderkey"), "not a date").when(~adapter.every(11, "o_orderkey"), written)
    parsed = dates.parse_timestamp(F.col("written"))
    return adapter.table(spark, sf_dir, "orders").select("o_orderkey", messy.alias("written")).select(
        "o_orderkey", "written", parsed.alias("parsed"), dates.weekday_name(parsed).alias("weekday_name")
    )


# Keyed enrichment


@query
def keyed_pick(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Picks from fixed lists, and from the numbered nations by an equi-join on the drawn number."""
    key = F.col("c_custkey")
    nations = adapter.table(spark, sf_dir, "nation").select(
        F.col("n_nationkey").cast("bigint").alias("drawn"), F.col("n_name").alias("nation")
    )
    count = nations.agg(F.count(F.lit(1))).scalar()
    return adapter.table(spark, sf_dir, "customer").select(
        "c_custkey",
        keyed.keyed_pick(key, "gender", builders.GENDERS).alias("gender"),
        keyed.keyed_pick(key, "segment", builders.SEGMENTS).alias("segment"),
        keyed.keyed_int(key, "nation", 0, count - 1).alias("drawn"),
    ).join(nations, "drawn")


@query
def keyed_int(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("o_orderkey")
    return adapter.table(spark, sf_dir, "orders").select(
        "o_orderkey",
        keyed.key_hash(key, "days").alias("hash"),
        keyed.keyed_int(key, "days", *builders.SHIPPING_DAYS).alias("days"),
        keyed.keyed_int(key, "quantity_sold", *builders.STOCK_RANGE).alias("quantity"),
    )


@query
def keyed_weighted_pick(spark: SparkSession, sf_dir: str) -> DataFrame:
    status = keyed.keyed_weighted_pick(F.col("o_orderkey"), "status", DELIVERY_WEIGHTS)
    return adapter.table(spark, sf_dir, "orders").select("o_orderkey", status.alias("delivery_status"))


@query
def keyed_timestamp(spark: SparkSession, sf_dir: str) -> DataFrame:
    moment = keyed.keyed_timestamp(
        F.col("o_orderkey"), "timestamp", builders.FIRST_MOMENT, builders.MOMENT_SPAN_SECONDS
    )
    return adapter.table(spark, sf_dir, "orders").select("o_orderkey", moment.alias("moment"))


@query
def stable_uuid(spark: SparkSession, sf_dir: str) -> DataFrame:
    return adapter.table(spark, sf_dir, "orders").select(
        "o_orderkey", keyed.stable_uuid(F.col("o_orderkey")).alias("timeuuid")
    )


# Source tables from the catalog


def _built_customer(spark: SparkSession, sf_dir: str, catalog: DataFrame) -> DataFrame:
    names = adapter.table(spark, sf_dir, "customer").select(F.col("c_name").alias("name"))
    return builders.build_customer(catalog, names)


@query
def build_inventory(spark: SparkSession, sf_dir: str) -> DataFrame:
    return builders.build_inventory(builders.number_products(_catalog(spark, sf_dir)))


@query
def build_product(spark: SparkSession, sf_dir: str) -> DataFrame:
    catalog = _catalog(spark, sf_dir)
    return builders.build_product(catalog, builders.number_products(catalog))


@query
def build_customer(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _built_customer(spark, sf_dir, _catalog(spark, sf_dir))


@query
def build_address(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The cities in which customers live, numbered."""
    buyers = adapter.table(spark, sf_dir, "customer").select(F.col("c_nationkey").alias("n_nationkey")).distinct()
    cities = buyers.join(adapter.places(spark, sf_dir), "n_nationkey")
    return builders.build_address(cities.select(F.col("n_name").alias("city"), F.col("r_name").alias("state")))


@query
def build_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    catalog = _catalog(spark, sf_dir)
    return builders.build_orders(
        builders.number_products(catalog),
        adapter.customer(spark, sf_dir),
        adapter.address(spark, sf_dir),
    )


# Movement


@query
def scan_csv_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All listings written as CSV, one folder per category, and read back in one scan."""
    root = fresh_dir(spark, "listings")
    listings = adapter.listings(spark, sf_dir)
    foldered = listings.withColumn("folder", F.col("main_category"))
    writer = foldered.hint("rebalance", "folder").write.partitionBy("folder")
    writer.option("header", True).option("escape", '"').csv(root)
    return read_listings(spark, f"{root}/*")


@query
def envelope_encode(spark: SparkSession, sf_dir: str) -> DataFrame:
    messages = encode(adapter.product(spark, sf_dir), "b1")

    def sent(name: str, kind: str):
        return F.get_json_object("value", f"$.{name}").try_cast(kind).alias(name)

    return messages.select(
        "key",
        "batch",
        sent("id", "bigint"),
        sent("product_name", "string"),
        sent("actual_price", "bigint"),
        sent("discount_price", "bigint"),
        sent("ratings", "double"),
        sent("link", "string"),
        F.size(F.json_object_keys("value")).alias("fields"),
    )


@query
def envelope_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = adapter.table(spark, sf_dir, "events")
    topic = file_topic(fresh_dir(spark, "topic"))
    topic.publish(encode(events, "b1"))
    return decode(topic.consume(spark), events.schema, "b1")


@query
def lake_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = adapter.table(spark, sf_dir, "events")
    path = fresh_dir(spark, "lake")
    write_batch(events, path, RUN_DATE, "b1")
    return read_lake(spark, path, events.schema, keep_stamps=True).drop("load_batch", "load_seq")


@query
def month_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders stored by the month they were placed in; one calendar month is read back."""
    orders = adapter.table(spark, sf_dir, "orders")
    path = fresh_dir(spark, "orders")
    write_batch(orders, path, F.trunc(F.col("o_orderdate").cast("date"), "month"), "b1")
    return read_lake(spark, path, orders.schema, month=SCAN_MONTH)


@query
def upsert_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Last event per user, kept in a keyed table by two merges: first half of January, then the rest."""
    events = adapter.table(spark, sf_dir, "events")
    half = F.lit(datetime(2024, 1, 16).isoformat(sep=" ")).cast("timestamp_ntz")
    path = fresh_dir(spark, "latest")
    for load in (events.where(F.col("ts") < half), events.where(F.col("ts") >= half)):
        upsert_table(path, load, ["user_id"], ["ts", "event_id"], buckets=8)
    return read_table(spark, path, events.schema)


@query
def envelope_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last event per user, of all events that went through the topic as a stream into the lake.

    The topic also holds a failed attempt at the batch, which does not count.
    """
    events = adapter.table(spark, sf_dir, "events")
    topic = file_topic(fresh_dir(spark, "stream-topic"))
    topic.publish(encode(events.withColumn("value", -F.col("value")), "b1-failed"))
    topic.publish(encode(events, "b1"))
    path = fresh_dir(spark, "stream-lake")
    stream = topic_to_lake(
        spark, topic, events.schema, path, fresh_dir(spark, "stream-progress"), RUN_DATE, attempts=["b1"]
    )
    stream.awaitTermination()
    return latest_by_key(read_lake(spark, path, events.schema), ["user_id"], ["ts", "event_id"])
