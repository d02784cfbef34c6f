"""Small literal configuration tables as inline ``VALUES`` relations.

``spark.createDataFrame(list)`` becomes a Python-RDD scan that runs Python
workers every time a branch of a plan reads it; an inline table is a JVM
``LocalRelation`` whose exact size Catalyst knows (so broadcasting it is a
decision on a known bound).  Only for config-sized rows given in code.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


def _lit(v, dtype: T.DataType) -> str:
    if v is None:
        return f"CAST(NULL AS {dtype.simpleString()})"
    if isinstance(dtype, T.ArrayType):
        inner = ", ".join(_lit(x, dtype.elementType) for x in v)
        return f"CAST(array({inner}) AS {dtype.simpleString()})"
    if isinstance(dtype, T.BooleanType):
        return "true" if v else "false"
    if isinstance(dtype, (T.LongType, T.IntegerType, T.ShortType, T.ByteType)):
        return f"CAST({int(v)} AS {dtype.simpleString()})"
    if isinstance(dtype, (T.DoubleType, T.FloatType)):
        return f"CAST('{float(v)!r}' AS {dtype.simpleString()})"
    if isinstance(dtype, T.StringType):
        s = str(v).replace("\\", "\\\\").replace("'", "\\'")
        return f"'{s}'"
    if isinstance(dtype, (T.TimestampType, T.DateType)):
        return f"CAST('{v}' AS {dtype.simpleString()})"
    raise TypeError(f"unsupported literal type {dtype}")


def literal_table(spark: SparkSession, rows: list[tuple], schema: T.StructType) -> DataFrame:
    names = [f.name for f in schema.fields]
    if not rows:
        cols = ", ".join(f"CAST(NULL AS {f.dataType.simpleString()}) AS `{f.name}`" for f in schema.fields)
        return spark.sql(f"SELECT {cols} WHERE false")
    values = ", ".join("(" + ", ".join(_lit(v, f.dataType) for v, f in zip(r, schema.fields)) + ")"
                       for r in rows)
    aliases = ", ".join(f"c{i}" for i in range(len(names)))
    cols = ", ".join(f"c{i} AS `{n}`" for i, n in enumerate(names))
    return spark.sql(f"SELECT {cols} FROM VALUES {values} AS t({aliases})")
