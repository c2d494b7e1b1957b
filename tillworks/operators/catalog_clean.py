"""Raw product listings → typed catalog, and the incremental gate."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import clean_count, clean_price, clean_rating

TRIPLE = ("product_name", "category", "type")


def clean_catalog(listings: DataFrame, price_mode: str = "decimal") -> DataFrame:
    """Business column names and typed prices, ratings and counts; all other columns pass through."""
    renamed = listings.withColumnsRenamed(
        {"name": "product_name", "main_category": "category", "sub_category": "type"}
    )
    return renamed.withColumns(
        {
            "actual_price": clean_price(F.col("actual_price"), price_mode),
            "discount_price": clean_price(F.col("discount_price"), price_mode),
            "ratings": clean_rating(F.col("ratings")),
            "no_of_ratings": clean_count(F.col("no_of_ratings")),
        }
    )


def distinct_triples(catalog: DataFrame) -> DataFrame:
    """The natural product key. Duplicates collapse map-side, so a much-copied product moves one row per task."""
    return catalog.select(*TRIPLE).distinct()


def rows_above_mark(incoming: DataFrame, stored: DataFrame, key: str = "id") -> DataFrame:
    """Rows of ``incoming`` beyond the largest stored key; all of them when nothing is stored.

    The mark is a scalar subquery: no driver round trip, and it reaches the scan as a runtime filter.
    """
    mark = stored.agg(F.coalesce(F.max(key), F.lit(0)).alias("mark")).scalar()
    return incoming.where(F.col(key) > mark)
