"""Helpers shared by the operators of this package."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

#: Bytes A-Z become a-z, all others stay: lower case for ASCII letters only, safe on UTF-8.
ASCII_LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def map_rows(
    df: DataFrame, fields: str, make: Callable[[], Callable[[dict[str, pa.Array]], dict[str, list]]]
) -> DataFrame:
    """``mapInArrow`` for functions from column arrays to column lists, one output batch per input batch.

    ``make`` is called once per task and returns the function, so models load once. ``fields`` is the DDL schema of
    the output.
    """
    from pyspark.sql.pandas.types import to_arrow_type
    from pyspark.sql.types import _parse_datatype_string

    schema = _parse_datatype_string(fields)
    arrow = pa.schema([(f.name, to_arrow_type(f.dataType)) for f in schema.fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        function = make()
        for batch in batches:
            out = function(dict(zip(batch.schema.names, batch.columns, strict=True)))
            yield pa.RecordBatch.from_arrays([pa.array(out[n], arrow.field(n).type) for n in arrow.names], schema=arrow)

    return df.mapInArrow(run, schema)
