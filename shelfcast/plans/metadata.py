"""A job's one-row summary as run metadata."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

SCALARS = (T.BooleanType, T.IntegralType, T.FloatType, T.DoubleType, T.StringType)
CONTAINERS = (T.StructType, T.MapType, T.ArrayType)
# instants inside containers as in their own text
JSON_OPTIONS = {"ignoreNullFields": "false", "timestampFormat": "yyyy-MM-dd HH:mm:ssxxx"}


def _entry(field: T.StructField) -> Column:
    value = F.col(f"`{field.name}`")
    if isinstance(field.dataType, CONTAINERS):
        kind, text = "json", F.to_json(value, JSON_OPTIONS)
    elif isinstance(field.dataType, SCALARS):
        kind, text = field.dataType.simpleString(), value.cast("string")
    else:
        kind, text = "text", value.cast("string")
    return F.struct(F.lit(field.name).alias("key"), F.when(value.isNull(), F.lit("none")).otherwise(F.lit(kind)).alias("kind"),
                    F.coalesce(text, F.lit("None")).alias("value"))


def flatten_summary(summary: DataFrame) -> DataFrame:
    """(key, kind, value) per column of a summary row, in column order.

    Scalars keep their value (``kind`` is their type), null is the text ``None``,
    structs, maps and arrays become JSON text, all else (dates, instants, decimals)
    its own text.
    """
    return summary.select(F.explode(F.array(*[_entry(f) for f in summary.schema.fields])).alias("m")).select("m.*")
