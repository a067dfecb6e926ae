"""Small in-memory tables."""

from __future__ import annotations

from collections.abc import Iterable

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

_ARROW = {
    T.StringType(): pa.string(),
    T.LongType(): pa.int64(),
    T.IntegerType(): pa.int32(),
    T.DoubleType(): pa.float64(),
    T.BooleanType(): pa.bool_(),
}


def _arrow_type(kind: T.DataType) -> pa.DataType:
    if isinstance(kind, T.ArrayType):
        return pa.list_(_arrow_type(kind.elementType))
    return _ARROW[kind]


def local_table(spark: SparkSession, rows: Iterable[tuple], schema: str) -> DataFrame:
    """DataFrame of driver-side rows with a size known to the optimizer.

    Given as an Arrow table the rows become a local relation, which Spark broadcasts on
    its own when small. A plain list of rows would become an RDD of unknown size and turn
    every look-up into a shuffle join.
    """
    if schema.startswith("struct<"):
        schema = schema.removeprefix("struct<").removesuffix(">")
    fields = T.StructType.fromDDL(schema)
    arrow_schema = pa.schema([(f.name, _arrow_type(f.dataType)) for f in fields])
    columns = list(zip(*rows)) or [()] * len(arrow_schema)
    arrays = [pa.array(c, type=f.type) for c, f in zip(columns, arrow_schema)]
    return spark.createDataFrame(pa.table(arrays, schema=arrow_schema))
