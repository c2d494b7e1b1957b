"""The wide table, star schema and reports on hand-made rows."""

from __future__ import annotations

from datetime import datetime

import pytest

from tillworks.catalog import LAKE
from tillworks.operators import reports, star
from tillworks.operators.wide import join_sales, quality_filter, wide_sales


def frame(spark, table, rows):
    return spark.createDataFrame(rows, LAKE[table].schema)


@pytest.fixture
def model(spark):
    """Six products with one order each: product i belongs to order i, ordered by buyer 1 or 2."""
    good = "https://x/1"
    products = [
        # id, name, category, type, actual, discount, ratings, count, link, image, inventory, order
        (1, "Cup", "home", "Deals", 100, 80, 4.3, 10, good, good, 1, 1),
        (2, "Cup", "home", "Deals", 200, None, None, None, good, good, 2, 2),
        (3, "Pen", "home", "Deals", 50, 50, 4.0, 1, good, good, 3, 3),  # discount equals price
        (4, "Pan", "home", "Deals", 0, None, 4.0, 1, good, good, 4, 4),  # no price
        (5, "Hat", "home", "Deals", 70, 10, 4.0, 1, good, "http://x/5", 5, 5),  # insecure image
        (6, "Box", "home", "Deals", 3_000_000, 2_999_999, 5.0, 3, good, good, 6, 6),
        (7, "Net", "home", "Deals", 10, 5, 5.0, 3, None, good, 7, 7),  # no link
        (8, "Jar", "home", "Deals", 10, 5, 5.0, 3, "https://", good, 8, 8),  # link without host
        (9, "Bag", "home", "Deals", None, 5, 5.0, 3, good, good, 9, 9),
    ]
    status = {1: "Delivered", 2: "Undelivered", 6: "Delivered"}
    day = datetime(2023, 9, 10, 15, 30)
    orders = [
        (i, 1 if i < 6 else 2, day, datetime(2023, 9, 12), datetime(2023, 2, 1), f"u{i}", 1, status.get(i, "Shipped"), 1)
        for i in range(1, 10)
    ]
    return {
        "inventory": frame(spark, "inventory", [(i, 1000 * i, 1000) for i in range(1, 10)]),
        "product": frame(spark, "product", products),
        "orders": frame(spark, "orderr", orders),
        "customer": frame(
            spark, "customer", [(1, "Ann B", "Other", "Ann_1@x", "Consumer"), (2, "Cy", "Other", "Cy_2@x", "Corporate")]
        ),
        "address": frame(spark, "address", [(1, "Reno", "Nevada", "United States")]),
    }


def test_quality_rules(model):
    kept = wide_sales(**model).collect()
    assert sorted(r.product_id for r in kept) == [1, 2, 6]
    undiscounted = next(r for r in kept if r.product_id == 2)
    assert (undiscounted.discount_price, undiscounted.ratings, undiscounted.no_of_ratings) == (0, 0.0, 0)


def test_fill_runs_before_the_price_comparison(model):
    joined = join_sales(**model)
    assert joined.count() == 9
    assert quality_filter(joined).where("product_id = 2").count() == 1


def test_missing_keys_never_match_and_repeated_ids_multiply(spark, model):
    orphan = model["orders"].selectExpr("* EXCEPT (customer_id)", "CAST(NULL AS BIGINT) AS customer_id")
    assert wide_sales(**{**model, "orders": orphan}).isEmpty()
    twice = model["address"].union(model["address"])
    assert wide_sales(**{**model, "address": twice}).count() == 6


def test_revenue_report(model):
    (row,) = reports.revenue_report(wide_sales(**model)).collect()
    assert (row.month, row.quarter, row.year) == (9, 1, 2023)  # quarter of ordering, month of shipping
    assert row.ratings == 3.1  # (4.3 + 0 + 5) / 3
    assert row.no_of_ratings == 13
    assert row.avg_disc_price == round((80 + 0 + 2_999_999) / 3, 2)
    assert row.avg_act_price == 1_000_100.0
    assert row.avg_disc_rate == 7  # (20 + 0 + 0.00003…) / 3, rounded up
    assert row.projected_income == 0
    assert row.income == 80 * 1000 + 2_999_999 * 1000  # beyond 32 bits
    assert row.quantity_sold == 3000
    assert row.inv_value == 80 * 1000 + 200 * 2000 + 2_999_999 * 6000


def test_projected_income_is_not_multiplied(model):
    under_way = model["orders"].selectExpr("* EXCEPT (delivery_status)", "'Preparing' AS delivery_status")
    (row,) = reports.revenue_report(wide_sales(**{**model, "orders": under_way})).collect()
    assert (row.projected_income, row.income) == (80 + 200 + 2_999_999, 0)


def test_order_report(model):
    rows = {r.order_id: r for r in reports.order_report(wide_sales(**model)).collect()}
    assert (rows[1].avg_spending, rows[1].processing_time) == (80.0, 2.0)
    assert rows[2].avg_spending == 0.0  # undelivered at full price
    assert (rows[2].canceled_order, rows[2].total_order, rows[2].cancellation_rate) == (1, 1, 100.0)
    assert (rows[6].canceled_order, rows[6].cancellation_rate) == (0, 0.0)


def test_unknown_delivery_state_is_not_an_error(model):
    unknown = model["orders"].selectExpr("* EXCEPT (delivery_status)", "CAST(NULL AS STRING) AS delivery_status")
    rows = reports.order_report(wide_sales(**{**model, "orders": unknown})).collect()
    assert {(r.total_order, r.cancellation_rate) for r in rows} == {(0, None)}


def test_customer_report(model):
    rows = {r.customer_id: r for r in reports.customer_report(wide_sales(**model)).collect()}
    assert (rows[1].loyal_customer, rows[1].total_orders) == ("True", 2)
    assert (rows[2].loyal_customer, rows[2].total_orders) == ("False", 1)


def test_half_cents_round_up(spark, model):
    """A mean of exactly 4.005 rounds to 4.01."""
    base = quality_filter(join_sales(**model)).where("product_id = 1")
    many = base.selectExpr("*", "explode(sequence(1, 200)) AS copy").selectExpr(
        "* EXCEPT (ratings, copy)", "CASE WHEN copy = 1 THEN 5.0D ELSE 4.0D END AS ratings"
    )
    (row,) = reports.revenue_report(many).collect()
    assert row.ratings == 4.01


def test_star_schema(model):
    wide = wide_sales(**model)
    facts = star.fact_order(wide).orderBy("id").collect()
    assert [(r.id, r.product_id, r.timeuuid) for r in facts] == [(1, 1, "u1"), (2, 2, "u2"), (3, 6, "u6")]
    assert star.dim_product(wide).count() == 3
    assert star.dim_customer(wide).count() == 2
    assert star.dim_location(wide).collect() == [(1, "Reno", "Nevada", "United States")]
    first = star.dim_date(wide).where("timeuuid = 'u1'").first()
    assert first.asDict() == {
        "timeuuid": "u1", "year": 2023, "quarter": 1, "quarter_name": "Q1", "month": 9, "month_name": "September",
        "day": 12, "weekday_name": "Tuesday",
    }


def test_product_dimension_has_a_row_per_state(model):
    """One product ordered twice in different states appears once per state."""
    second = model["orders"].where("id = 1").selectExpr(
        "* EXCEPT (delivery_status)", "'Shipped' AS delivery_status"
    )
    wide = wide_sales(**{**model, "orders": model["orders"].where("id = 1").unionByName(second)})
    assert sorted((r.id, r.delivery_status) for r in star.dim_product(wide).collect()) == [
        (1, "Delivered"), (1, "Shipped"),
    ]


def test_report_sums_equal_row_sums(model):
    wide = wide_sales(**model)
    total = wide.selectExpr("sum(quantity_sold)", "sum(inv_quantity)").first()
    report = reports.revenue_report(wide).selectExpr("sum(quantity_sold)", "sum(inv_quantity)").first()
    assert total == report


def test_preview_is_a_top_k(model):
    report = reports.order_report(wide_sales(**model))
    assert [r.order_id for r in reports.preview(report, reports.DISPLAY_ORDER["order_table"], 2).collect()] == [1, 2]
