"""Integer arithmetic on sizes and coordinates, exact for all 64-bit values."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def floor_div(x: Column | str, y: Column | int) -> Column:
    """Rounds towards minus infinity; ``div`` alone rounds towards zero."""
    x, y = F.col(x) if isinstance(x, str) else x, F.lit(y) if isinstance(y, int) else y
    x, y = x.cast("long"), y.cast("long")
    return F.call_function("div", x - F.pmod(x, y), y)


def ceil_div(x: Column | str, y: Column | int) -> Column:
    x = F.col(x) if isinstance(x, str) else x
    return -floor_div(-x, y)


def truncated(x: Column, dtype: str) -> Column:
    """A value in the array's own type: integers lose their fraction, towards zero."""
    return x.cast(SPARK_TYPE[dtype])


#: Spark's type for each array type; unsigned ones take the next wider signed type.
SPARK_TYPE = {
    "uint8": "short", "uint16": "int", "uint32": "long", "uint64": "decimal(20,0)",
    "int8": "byte", "int16": "short", "int32": "int", "int64": "long", "float32": "float", "float64": "double",
}
