from __future__ import annotations

import pytest

from tillworks.catalog import LAKE, MART, WAREHOUSE
from tillworks.operators.catalog_clean import clean_catalog, rows_above_mark
from tillworks.sources.listings import read_listings, union_sources

HEADER = "name,main_category,sub_category,image,link,ratings,no_of_ratings,discount_price,actual_price"


@pytest.fixture
def listing_folder(tmp_path):
    (tmp_path / "plain.csv").write_text(
        f"{HEADER}\n"
        '"Cream, 80 gm",beauty,Deals,https://i/1,https://l/1,4.3,"8,442",₹406,₹465\n'
        'Figure,toys,Toys,https://i/2,https://l/2,,,"₹9,807.50","₹12,516.90"\n'
        "Quiet,toys,Toys,https://i/3,,Get,,,\n",
        encoding="utf-8",
    )
    (tmp_path / "empty.csv").write_text(f"{HEADER}\n")
    (tmp_path / "indexed.csv").write_text(
        f",{HEADER}\n"
        '0,"Say ""hi""",books,Books,http://i/4,https://l/4,5,12,₹10,₹20\n'
        "1,Pen,books,Books,https://i/5,https://l/5,4.0,1,,\n",
        encoding="utf-8",
    )
    return str(tmp_path)


def test_listing_files_become_one_frame(spark, listing_folder):
    rows = {r.name: r for r in read_listings(spark, f"{listing_folder}/*.csv").collect()}
    assert set(rows) == {"Cream, 80 gm", "Figure", "Quiet", 'Say "hi"', "Pen"}
    assert rows["Pen"].image == "https://i/5" and rows["Pen"].actual_price is None
    assert rows['Say "hi"'].actual_price == "₹20"
    assert rows["Quiet"].link is None


def test_column_subset_of_mixed_files(spark, listing_folder):
    prices = read_listings(spark, f"{listing_folder}/*.csv").select("name", "main_category").collect()
    assert {tuple(r) for r in prices} == {
        ("Cream, 80 gm", "beauty"), ("Figure", "toys"), ("Quiet", "toys"), ('Say "hi"', "books"), ("Pen", "books"),
    }


def test_clean_catalog(spark, listing_folder):
    rows = {r.product_name: r for r in clean_catalog(read_listings(spark, f"{listing_folder}/*.csv")).collect()}
    cream, figure, quiet = rows["Cream, 80 gm"], rows["Figure"], rows["Quiet"]
    assert (cream.category, cream.type) == ("beauty", "Deals")
    assert (cream.actual_price, cream.discount_price, cream.ratings, cream.no_of_ratings) == (465, 406, 4.3, 8442)
    assert (figure.actual_price, figure.discount_price) == (12517, 9808)
    assert (quiet.actual_price, quiet.discount_price, quiet.ratings, quiet.no_of_ratings) == (None,) * 4


def test_gate_takes_all_when_nothing_is_stored(spark):
    incoming = spark.range(1, 6)
    assert rows_above_mark(incoming, spark.range(0)).count() == 5
    assert sorted(r.id for r in rows_above_mark(incoming, spark.range(4)).collect()) == [4, 5]
    assert rows_above_mark(incoming, spark.range(9)).isEmpty()


def test_union_matches_names_and_fills_missing(spark):
    left = spark.createDataFrame([(1, "a")], "id INT, name STRING")
    right = spark.createDataFrame([("b", 2, True)], "name STRING, id INT, extra BOOLEAN")
    assert sorted(map(tuple, union_sources(left, right).collect())) == [(1, "a", None), (2, "b", True)]


def test_keys_are_declared_columns():
    for table in [*LAKE.values(), *WAREHOUSE.values(), *MART.values()]:
        assert set(table.key) <= set(table.columns)


def test_conform_refuses_undeclared_and_missing_columns(spark):
    inventory = LAKE["inventory"]
    good = spark.range(1).selectExpr("2 AS quantity_sold", "id", "1 AS inv_quantity")
    assert inventory.conform(good).columns == ["id", "inv_quantity", "quantity_sold"]
    with pytest.raises(ValueError, match="quantity"):
        inventory.conform(good.withColumnRenamed("inv_quantity", "quantity"))
