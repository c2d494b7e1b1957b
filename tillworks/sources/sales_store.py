"""Sales lines and products stored in buckets of their product, so that the wide table is joined without a shuffle."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..catalog import WIDE_COLUMNS
from ..operators.wide import stocked
from ..session import hadoop_fs, path_exists, working_tables, written

KEY = "product_id"
#: A product counts as hot in a load if its lines would make a bucket's fair share this many times over.
HOT_SHARE = 0.5
#: Lines of a bucket that one task sorts when they are stored.
TASK_ROWS = 500_000
#: What a task sorts or hashes of a bucket in memory when lines meet products, by its size in files.
BUCKET_BYTES = 16 << 20


class SalesStore:
    """Placed order lines and stocked products below ``path``, as Spark's own bucketed tables.

    Lines meet their product once per report but come in once: they are dealt into buckets when a load is added, and
    every later join reads bucket by bucket. A bucket cannot be split, so the lines of products that would fill a good
    part of one are stored beside the buckets, as plain files that many tasks read; there are at most
    ``buckets / HOT_SHARE`` such products in a load, and their rows are broadcast. Another session opens the same tables
    by path, name and number of buckets.

    ``describe`` adds what follows from the columns of joined lines. Lines are then moved, sorted and stored without it.
    """

    def __init__(
        self, spark: SparkSession, path: str, name: str, lines: StructType, products: StructType, buckets: int = 64,
        describe: Callable[[DataFrame], DataFrame] = lambda rows: rows,
    ):
        self.spark, self.path, self.buckets, self.describe = spark, path, buckets, describe
        self.hot_schema = lines
        self.lines = self._declared(f"{name}_lines", lines, f"{path}/lines")
        self.products = self._declared(f"{name}_products", products, f"{path}/products")

    def _declared(self, name: str, schema: StructType, path: str) -> str:
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
        self.spark.sql(
            f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING parquet CLUSTERED BY ({KEY}) SORTED BY ({KEY}) "
            f"INTO {self.buckets} BUCKETS LOCATION '{path}'"
        )
        return name

    def _dealt(self, rows: DataFrame, table: str, tasks: int = 1) -> DataFrame:
        """Rows as the table's buckets are made: so many tasks, and so files, per bucket.

        A multiple of the buckets splits each of them by the same hash, so that no task has rows of two.
        """
        return rows.repartition(self.buckets * tasks, KEY).select(*self.spark.table(table).columns)

    def _stored_bytes(self, folder: str) -> int:
        if not path_exists(self.spark, f"{self.path}/{folder}"):
            return 0
        fs, hadoop_path = hadoop_fs(self.spark, f"{self.path}/{folder}")
        return fs.getContentSummary(hadoop_path).getLength()

    def _streamed(self) -> bool:
        """Whether the lines of a bucket are too many to be sorted in memory, but its products can be hashed there.

        Products that Spark broadcasts by itself need neither.
        """
        lines, products = self._stored_bytes("lines"), self._stored_bytes("products")
        few = self.spark._jsparkSession.sessionState().conf().autoBroadcastJoinThreshold()
        return lines > BUCKET_BYTES * self.buckets >= products > few

    def put_products(self, product: DataFrame, inventory: DataFrame) -> None:
        """Replace the products by these, with their stock; each id comes once."""
        self._dealt(stocked(product, inventory), self.products).write.insertInto(self.products, overwrite=True)

    def add_lines(self, lines: DataFrame) -> None:
        """Add the placed lines of a load."""
        with working_tables(self.spark):
            rows = written(lines.select(*self.hot_schema.fieldNames()), "lines")
            all_rows = rows.count()
            counts = rows.groupBy(KEY).agg(F.count(F.lit(1)).alias("n"))
            hot = written(counts.where(F.col("n") * self.buckets > all_rows * HOT_SHARE).select(KEY), "hot-products")
            number = hot.count()
            if number > self.buckets / HOT_SHARE:
                raise AssertionError("more hot products than shares of the lines")
            cool = rows.join(F.broadcast(hot), KEY, "left_anti")
            tasks = max(1, -(-all_rows // (self.buckets * TASK_ROWS)))
            self._dealt(cool, self.lines, tasks).write.insertInto(self.lines)
            if number:
                rows.join(F.broadcast(hot), KEY, "left_semi").write.mode("append").parquet(f"{self.path}/hot_lines")
                hot.write.mode("append").parquet(f"{self.path}/hot_products")

    def wide(self) -> DataFrame:
        """The joined sales rows of all loads, before the quality filter.

        Where lines would spill as they are sorted, they stream past the hashed products of their bucket.
        """
        products = self.spark.table(self.products)
        met = products.hint("shuffle_hash") if self._streamed() else products
        joined = self.spark.table(self.lines).join(met, KEY)
        if path_exists(self.spark, f"{self.path}/hot_products"):
            ids = self.spark.read.schema(StructType([self.hot_schema[KEY]])).parquet(f"{self.path}/hot_products")
            hot = self.spark.read.schema(self.hot_schema).parquet(f"{self.path}/hot_lines")
            few = products.join(F.broadcast(ids), KEY, "left_semi")
            joined = joined.unionByName(hot.join(F.broadcast(few), KEY))
        return self.describe(joined).select(*WIDE_COLUMNS)
