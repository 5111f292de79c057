"""Size check before a side of a join is broadcast."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# A broadcast side is built on the driver and held by every executor.
BROADCAST_BYTES = 64 * 1024 * 1024
_FIXED_WIDTH = 16


def _width(field: T.StructField):
    c = F.col(f"`{field.name}`")
    if isinstance(field.dataType, T.StringType):
        return F.coalesce(F.octet_length(c), F.lit(0)) + _FIXED_WIDTH
    if isinstance(field.dataType, T.ArrayType) and not isinstance(
        field.dataType.elementType, (T.StringType, T.ArrayType, T.StructType, T.MapType)
    ):
        return F.coalesce(F.size(c), F.lit(0)) * 8 + _FIXED_WIDTH
    if isinstance(field.dataType, (T.ArrayType, T.StructType, T.MapType)):
        return F.coalesce(F.octet_length(F.to_json(F.struct(c))), F.lit(0)) + _FIXED_WIDTH
    return F.lit(_FIXED_WIDTH)


def measured_bytes(df: DataFrame) -> int:
    """Bytes the rows take, counted over the whole frame in one aggregate."""
    row = sum((_width(f) for f in df.schema.fields), F.lit(0)).cast("bigint")
    return df.agg(F.coalesce(F.sum(row), F.lit(0)).alias("bytes")).first()["bytes"]


def fits_broadcast(df: DataFrame, limit: int = BROADCAST_BYTES) -> bool:
    return measured_bytes(df) <= limit
