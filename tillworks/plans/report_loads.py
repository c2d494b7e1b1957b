"""Reports that grow by loads: a load adds its own sums and counts, and only the groups that it touches are finished
again."""

from __future__ import annotations

import uuid
from collections.abc import Iterable
from datetime import date
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..catalog import MART
from ..operators.reports import CUSTOMERS, ORDERS, REVENUE, ROWS, Report
from ..session import path_exists, working_tables, written
from ..sources.lake import read_lake, read_latest, write_batch

REPORTS = (REVENUE, ORDERS, CUSTOMERS)


def add_load(
    wide: DataFrame, root: str, loaded: date, batch: str, reports: Iterable[Report] = REPORTS
) -> None:
    """Add the wide rows of one load to the stored reports.

    The load's states are stored as a batch of ``_states/<report>``, which a repeated load replaces. The groups that it
    touches are finished again from the states of all loads and stored as a new version; the sales rows of earlier
    loads are not read. A group that a repeated load no longer has keeps a state of no rows, so that it is finished
    again too. Loads hold different sales rows: one that comes again in another load counts again.
    """
    spark = wide.sparkSession
    for report in reports:
        with working_tables(spark):
            _add(report, report.states(wide), f"{root}/_states/{report.name}", f"{root}/{report.name}", loaded, batch)


def _add(report: Report, states: DataFrame, at: str, result: str, loaded: date, batch: str) -> None:
    spark, schema = states.sparkSession, states.schema
    if path_exists(spark, at):
        earlier = read_lake(spark, at, schema, batch=batch)
        nothing = [F.lit(0 if f.name == ROWS else None).cast(f.dataType).alias(f.name) for f in schema if f.name not in report.groups]
        states = report.merged(states.unionByName(earlier.select(*report.groups, *nothing)))
    # Written before the batch is replaced that it is read from.
    write_batch(written(states, "states"), at, loaded, batch)
    every, own = read_lake(spark, at, schema), read_lake(spark, at, schema, batch=batch).select(*report.groups)
    same = reduce(Column.__and__, (every[g].eqNullSafe(own[g]) for g in report.groups))
    touched = report.merged(every.join(own, same, "left_semi"))
    finished = report.finished(touched.where(F.col(ROWS) > 0)).withColumn("gone", F.lit(False))
    gone = touched.where(F.col(ROWS) == 0).select(
        *(F.col(c) if c in report.groups else F.lit(None).cast(t).alias(c) for c, t in finished.drop("gone").dtypes), F.lit(True).alias("gone")
    )
    rows = written(finished.unionAll(gone), "finished")
    # The newest version of a group counts, also where an earlier load is repeated.
    write_batch(rows, result, loaded, f"{batch}-{uuid.uuid4().hex}")


def read_report(spark: SparkSession, root: str, report: Report) -> DataFrame:
    """A stored report with the rows of all loads."""
    table = MART[report.name]
    rows = read_latest(spark, f"{root}/{report.name}", StructType([*table.schema.fields]).add("gone", "boolean"), report.groups)
    return rows.where(~F.col("gone")).drop("gone")
