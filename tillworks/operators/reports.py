"""Revenue, order and customer reports from the wide sales row.

Each report is a single hash aggregation with map-side partial sums, so a group that holds a third of the rows still
moves one row per task. What is aggregated are sums of integers or exact decimals and counts; averages and ratios are
taken from these afterwards. The sums of several loads therefore add up to those of all their rows, and rounded results
are independent of row order and of how rows came in loads.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..catalog import MART
from ..functions import measures as m
from ..functions.dates import days_between

RATING_TYPE = "decimal(20,10)"
MEAN_RATING_TYPE = "decimal(24,14)"
# A mean rate this close above a whole number (in decimals) counts as whole: the rates' own decimals end at the 14th.
RATE_DECIMALS = 12
#: Sums of decimals keep this type however often they are added up.
SUM_TYPES = {"ratings_sum": "decimal(30,10)", "rate_sum": "decimal(36,16)"}
#: Sales rows in a group.
ROWS = "group_rows"


def _period() -> dict[str, Column]:
    """Month and year of shipping, quarter of ordering."""
    shipped = F.col("ship_date")
    return {"month": F.month(shipped), "quarter": F.col("quarter"), "year": F.year(shipped)}


@dataclass(frozen=True)
class Report:
    """A report as sums and counts by group (``sums``, from columns of wide rows) and what is shown of them (``shown``)."""

    name: str
    groups: tuple[str, ...]
    sums: Callable[[], dict[str, Column]]
    shown: Callable[[], dict[str, Column]]
    prepared: Callable[[DataFrame], DataFrame] = lambda wide: wide

    def states(self, wide: DataFrame) -> DataFrame:
        """One row per group with its sums, counts and number of rows."""
        period = _period()
        groups = [period.get(g, F.col(g)).alias(g) for g in self.groups]
        sums = {**self.sums(), ROWS: F.count(F.lit(1))}
        return self.prepared(wide).groupBy(*groups).agg(*(c.cast(self._type(n)).alias(n) for n, c in sums.items()))

    def merged(self, states: DataFrame) -> DataFrame:
        """The states of several loads as one row per group."""
        names = [c for c in states.columns if c not in self.groups]
        return states.groupBy(*self.groups).agg(*(F.sum(n).cast(self._type(n)).alias(n) for n in names))

    def finished(self, states: DataFrame) -> DataFrame:
        return states.select(*self.groups, *(c.alias(n) for n, c in self.shown().items()))

    def __call__(self, wide: DataFrame) -> DataFrame:
        return self.finished(self.states(wide))

    @staticmethod
    def _type(name: str) -> str:
        return SUM_TYPES.get(name, "bigint")


def _total(column: str) -> Column:
    return F.sum(F.col(column).cast("bigint"))


def _mean(name: str) -> Column:
    return F.col(f"{name}_sum") / F.col(f"{name}_count")


def _exact_mean(name: str, kind: str) -> Column:
    return (F.col(f"{name}_sum") / F.col(f"{name}_count").cast("decimal(20,0)")).cast(kind)


def _with_count(name: str, value: Column) -> dict[str, Column]:
    return {f"{name}_sum": F.sum(value), f"{name}_count": F.count(value)}


_TOTALS = ("no_of_ratings", "quantity_sold", "projected_income", "income", "inv_quantity", "inv_value")


def _revenue_sums() -> dict[str, Column]:
    return {
        **_with_count("ratings", F.col("ratings").cast(RATING_TYPE)),
        **_with_count("disc_price", F.col("discount_price")),
        **_with_count("act_price", F.col("actual_price")),
        **_with_count("rate", m.discount_rate()),
        **{name: _total(name) for name in _TOTALS},
    }


def _revenue_shown() -> dict[str, Column]:
    return {
        "ratings": F.round(_exact_mean("ratings", MEAN_RATING_TYPE), 2).cast("double"),
        "no_of_ratings": F.col("no_of_ratings"),
        "avg_disc_price": F.round(_mean("disc_price"), 2),
        "avg_act_price": F.round(_mean("act_price"), 2),
        "avg_disc_rate": F.ceil(F.round(_exact_mean("rate", "decimal(30,16)"), RATE_DECIMALS)).cast("bigint"),
        **{name: F.col(name) for name in _TOTALS[1:]},
    }


def _order_sums() -> dict[str, Column]:
    status = F.col("delivery_status")
    return {
        **_with_count("spending", m.spending()),
        **_with_count("processing", days_between(F.col("order_date"), F.col("ship_date"))),
        "canceled_order": F.count_if(status == "Undelivered"),
        "total_order": F.count(status),
    }


def _order_shown() -> dict[str, Column]:
    canceled, known = F.col("canceled_order"), F.col("total_order")
    return {
        "avg_spending": F.round(_mean("spending"), 2),
        "processing_time": F.round(_mean("processing"), 2),
        "canceled_order": canceled,
        "total_order": known,
        "cancellation_rate": F.when(known > 0, F.round(canceled * 100 / known, 2)),
    }


def _customer_shown() -> dict[str, Column]:
    orders = F.col("total_orders")
    return {"loyal_customer": F.when(orders > 1, "True").otherwise("False"), "total_orders": orders}


REVENUE = Report("revenue_table", MART["revenue_table"].key, _revenue_sums, _revenue_shown, m.add_measures)
ORDERS = Report("order_table", MART["order_table"].key, _order_sums, _order_shown)
CUSTOMERS = Report(
    "customer_table", MART["customer_table"].key, lambda: {"total_orders": F.count("customer_id")}, _customer_shown
)


def revenue_report(wide: DataFrame) -> DataFrame:
    return REVENUE(wide)


def order_report(wide: DataFrame) -> DataFrame:
    return ORDERS(wide)


def customer_report(wide: DataFrame) -> DataFrame:
    return CUSTOMERS(wide)


# The order in which each report is displayed. Stored reports stay unsorted: a sort before a topic or table is lost.
DISPLAY_ORDER = {
    "revenue_table": ("month", "category", "type", "city", "state", "quarter", "year"),
    "order_table": ("month", "order_id", "city", "state", "quarter", "year"),
    "customer_table": ("customer_id", "gender", "segment", "city", "state", "month", "quarter", "year"),
}


def preview(report: DataFrame, order: tuple[str, ...], rows: int = 10) -> DataFrame:
    """The first rows in display order, by a top-k that never sorts the whole report."""
    return report.orderBy(*order).limit(rows)
