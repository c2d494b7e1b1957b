"""The three loads as callable jobs: ingestion into the lake, warehouse, and mart.

Every table hops over a topic of its own. Where the topics and the result tables live is passed in: Kafka and
JDBC on a cluster, folders in tests.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from datetime import date

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..catalog import LAKE, MART, WAREHOUSE, Table
from ..operators import builders, reports, star
from ..operators.catalog_clean import TRIPLE, clean_catalog
from ..operators.envelope import encode
from ..operators.numbering import dense_ids
from ..operators.stable_keys import keys_not_stored, same_key, stable_ids
from ..operators.wide import wide_sales
from ..session import path_exists, working_tables, written
from ..sources.endpoints import Endpoint, Topic
from ..sources.history import write_versions
from ..sources.lake import read_latest, stamp, write_batch
from ..sources.listings import read_cities, read_listings, read_names
from ..streaming.envelope_stream import land_attempt

TopicOf = Callable[[str], Topic]
Sink = Callable[[Table, DataFrame], None]


def hop(
    rows: DataFrame,
    table: Table,
    topics: TopicOf,
    batch: str,
    rejects: Sink | None = None,
    progress: str | None = None,
) -> DataFrame:
    """Publish one batch of a table and take it from the topic again, typed as declared.

    Each attempt at a batch sends under an id of its own, so one that failed half-way leaves nothing behind
    for the next. Where the transport may repeat messages, repeats are told by their number. Below ``progress``, a folder
    that stays from load to load, it is kept how far each topic has been read, and a hop reads what came after that;
    without it, the whole topic. Messages are counted by the passes that send and that store them: those that cannot be
    decoded go to ``rejects``, and the batch fails without it, or if any message is missing.
    """
    topic = topics(table.name)
    attempt = f"{batch}-{uuid.uuid4().hex}"
    counts = Observation()
    sent = encode(written(table.conform(rows), f"sent-{table.name}"), attempt, table.key)
    topic.publish(sent.observe(counts, F.count(F.lit(1)).alias("sent")))
    read_so_far = f"{progress}/{table.name}" if progress else None
    landing = land_attempt(
        rows.sparkSession, topic, table.schema, table.key, attempt, read_so_far, label=f"received-{table.name}"
    )
    number = counts.get.get("sent", 0)
    if landing.received != number:
        raise RuntimeError(f"{table.name}: {number - landing.received} of the messages of {attempt} did not come back")
    if landing.rejected:
        if rejects is None:
            raise RuntimeError(f"{table.name}: {landing.rejected} of the messages of {attempt} cannot be decoded")
        rejects(table, landing.bad())
    return landing.rows()


def lake_rejects(root: str, loaded: date, batch: str) -> Sink:
    """Keep rejected messages as a lake table beside the table they were meant for."""
    return lambda table, messages: write_batch(messages, f"{root}/_rejected/{table.name}", loaded, batch)


def lake_sink(root: str, loaded: date, batch: str) -> Sink:
    return lambda table, rows: write_batch(rows, f"{root}/{table.name}", loaded, batch)


def history_sink(root: str, loaded: date, batch: str) -> Sink:
    """Dimensions as versions (:mod:`..sources.history`), of which only changed rows are stored; other tables as
    batches of a lake."""

    def store(table: Table, rows: DataFrame) -> None:
        if table.identity:
            write_versions(rows, f"{root}/{table.name}", table.identity, loaded, batch)
        else:
            write_batch(rows, f"{root}/{table.name}", loaded, batch)

    return store


def endpoint_sink(endpoint_of: Callable[[str], Endpoint], loaded: date, batch: str) -> Sink:
    """Append stamped rows to any data source, e.g. ``relational_table`` by table name."""
    return lambda table, rows: endpoint_of(table.name).save(stamp(rows, loaded, batch))


def ingest(
    spark: SparkSession,
    listing_paths: str | list[str],
    names_path: str,
    cities_path: str,
    lake: str,
    topics: TopicOf,
    loaded: date,
    batch: str,
    price_mode: str = "decimal",
    only_if_new: bool = False,
    store: Sink | None = None,
) -> bool:
    """Listing files → six lake tables, or tables of another ``store``, e.g. of a keyed store through
    :func:`endpoint_sink`; the lake then keeps the key tables and rejected messages alone. With ``only_if_new``, only products that no load has brought; False if none.

    Products, buyers and places keep their ids over all loads, by key tables in the lake. Frames that several tables
    derive from are written once, and go when the load has ended.
    """
    with working_tables(spark):
        return _ingest(
            spark, listing_paths, names_path, cities_path, lake, topics, loaded, batch, price_mode, only_if_new, store
        )


def _ingest(
    spark: SparkSession,
    listing_paths: str | list[str],
    names_path: str,
    cities_path: str,
    lake: str,
    topics: TopicOf,
    loaded: date,
    batch: str,
    price_mode: str,
    only_if_new: bool,
    store: Sink | None,
) -> bool:
    catalog = written(clean_catalog(read_listings(spark, listing_paths), price_mode), "catalog")
    keys = f"{lake}/_keys"
    if only_if_new and path_exists(spark, f"{keys}/product"):
        fresh = written(keys_not_stored(f"{keys}/product", catalog, *TRIPLE), "new-products")
        if fresh.isEmpty():
            return False
        catalog = written(catalog.join(fresh, same_key(catalog, fresh, TRIPLE), "left_semi"), "new-listings")
    numbered = written(stable_ids(f"{keys}/product", catalog, *TRIPLE), "numbered")
    buyers = written(builders.draw_customers(catalog, read_names(spark, names_path)), "buyers")
    customer = written(stable_ids(f"{keys}/customer", buyers, *builders.BUYER), "customer")
    places = read_cities(spark, cities_path).select(*builders.PLACE).distinct()
    known_places = stable_ids(f"{keys}/address", places, *builders.PLACE)
    address = written(known_places.withColumn("country", F.lit(builders.COUNTRY)), "address")
    orders = written(_orders(numbered, customer, address), "orders")
    frames = {
        "inventory": builders.build_inventory(numbered),
        "product": builders.build_product(catalog, numbered),
        "orderr": orders,
        "customer": customer,
        "address": address,
        "customerAddress": builders.build_customer_address(orders),
    }
    store, rejects = store or lake_sink(lake, loaded, batch), lake_rejects(lake, loaded, batch)
    for name, frame in frames.items():
        store(LAKE[name], hop(frame, LAKE[name], topics, batch, rejects, f"{lake}/_progress"))
    return True


def _orders(numbered: DataFrame, customer: DataFrame, address: DataFrame) -> DataFrame:
    """Orders of the load's own buyers and places, which are drawn by their places in this load."""
    by_place = {
        "customer_id": written(dense_ids(customer.withColumnRenamed("id", "known"), *builders.BUYER), "buyer-places"),
        "city_id": written(dense_ids(address.withColumnRenamed("id", "known"), *builders.PLACE), "city-places"),
    }
    orders = builders.build_orders(numbered, *by_place.values())
    for column, places in by_place.items():
        known = places.select(F.col("id").alias(column), "known")
        orders = orders.join(known, column).withColumn(column, F.col("known")).drop("known")
    return orders


def load_wide(
    spark: SparkSession,
    lake: str | Callable[[str], Endpoint],
    month: int | None = None,
    year: int | None = None,
    batch: str | None = None,
) -> DataFrame:
    """The wide sales table from the last write per key, of all loads or of one month's, year's or batch's.

    It is computed once and written; all tables of a job derive from the written rows. ``lake`` is a folder, or gives
    the endpoint of each table in a store that itself keeps the last write per key.
    """

    def table(name: str) -> DataFrame:
        declared = LAKE[name]
        if callable(lake):
            rows = lake(name).load(spark)
            for column, wanted in (("load_month", month), ("load_year", year), ("load_batch", batch)):
                rows = rows if wanted is None else rows.where(F.col(column) == wanted)
            return declared.conform(rows.select(*declared.columns))
        return read_latest(
            spark, f"{lake}/{name}", declared.schema, declared.key, month=month, year=year, batch=batch
        )

    # A buyer may hold a third of the orders. AQE splits such a join partition only between two shuffles, so
    # the buyers are written rather than joined in the partitioning of their aggregate.
    # The same holds for places: a city receives a large share of all orders by nature.
    buyers, places = written(table("customer"), "buyers"), written(table("address"), "places")
    joined = wide_sales(table("inventory"), table("product"), table("orderr"), buyers, places)
    return written(joined, "wide")


def publish_all(
    frames: dict[str, DataFrame],
    tables: dict[str, Table],
    topics: TopicOf,
    sink: Sink,
    batch: str,
    progress: str | None = None,
):
    for name, frame in frames.items():
        with working_tables(frame.sparkSession):
            sink(tables[name], hop(frame, tables[name], topics, batch, progress=progress))


def build_warehouse(wide: DataFrame, topics: TopicOf, sink: Sink, batch: str, progress: str | None = None) -> None:
    """Fact and dimensions of the wide rows; with ``progress`` each topic is read on from the load before (:func:`hop`)."""
    frames = {
        "factOrder": star.fact_order(wide),
        "dimProduct": star.dim_product(wide),
        "dimCustomer": star.dim_customer(wide),
        "dimDiliveryLocation": star.dim_location(wide),
        "dimDate": star.dim_date(wide),
    }
    publish_all(frames, WAREHOUSE, topics, sink, batch, progress)


def build_mart(wide: DataFrame, topics: TopicOf, sink: Sink, batch: str, progress: str | None = None) -> None:
    frames = {
        "revenue_table": reports.revenue_report(wide),
        "order_table": reports.order_report(wide),
        "customer_table": reports.customer_report(wide),
    }
    publish_all(frames, MART, topics, sink, batch, progress)
