"""Nested rows as (path, text, number): structs and arrays flattened to their leaves (IN-05, AN-13, EX-18).

The path of a leaf is made of field names and positions, as in ``$.top[0].name``.  The
leaves are known from the schema, so flattening is one expression and no code is run on
rows.  Numbers keep a column of their own; dates and truth values are text.  A NULL leaf
has a row with neither; an empty or NULL array has none.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _leaf(value: Column, kind: T.DataType, path: Column) -> Column:
    text, number = F.lit(None).cast("string"), F.lit(None).cast("double")
    if isinstance(kind, T.NumericType):
        number = value.cast("double")
    elif isinstance(kind, T.TimestampNTZType | T.TimestampType):
        text = F.date_format(value, "yyyy-MM-dd'T'HH:mm:ss")
    else:
        text = value.cast("string")
    return F.array(F.struct(path.alias("path"), text.alias("text"), number.alias("number")))


def leaves(value: Column, kind: T.DataType, path: Column) -> Column:
    """array<struct<path, text, number>> of a value of this type."""
    if isinstance(kind, T.StructType):
        parts = [leaves(value.getField(f.name), f.dataType, F.concat(path, F.lit(f".{f.name}"))) for f in kind.fields]
        return F.concat(*parts)
    if isinstance(kind, T.ArrayType):
        each: Callable[[Column, Column], Column] = lambda x, i: leaves(
            x, kind.elementType, F.concat(path, F.lit("["), i.cast("string"), F.lit("]")))
        none = F.array().cast("array<struct<path:string,text:string,number:double>>")
        return F.coalesce(F.flatten(F.transform(value, each)), none)
    return _leaf(value, kind, path)


def path_values(df: DataFrame, keys: list[str], column: str) -> DataFrame:
    """(keys, path, text, number): one row for each leaf of a nested column."""
    flat = leaves(F.col(column), df.schema[column].dataType, F.lit("$"))
    return df.select(*keys, F.explode(flat).alias("__leaf")).select(*keys, "__leaf.path", "__leaf.text", "__leaf.number")


def parsed(df: DataFrame, column: str, text: str) -> DataFrame:
    """The rows with ``column`` read back from its JSON text."""
    return df.withColumn(column, F.from_json(F.col(text), df.schema[column].dataType))
