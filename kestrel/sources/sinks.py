"""Sinks (IN-03..IN-05): table, CSV and JSON writers.

Tables are replaced by committed versions; exports overwrite their folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kestrel.sources import versions


def write_table(df: DataFrame, path: str, partition_by: list[str] | None = None) -> str:
    """IN-03: create-or-replace a mart as a parquet table (optionally partitioned).

    The table's next version is written beside the one that readers see and committed at the end (`versions`), so
    a job that dies leaves the old one.  Returns the folder of the new version.
    """
    def write(folder: str) -> None:
        w = df.write.mode("error")
        (w.partitionBy(*partition_by) if partition_by else w).parquet(folder)
    return versions.publish(df.sparkSession, path, write).path


def save_table(df: DataFrame, name: str) -> str:
    """IN-03 (catalog form): create-or-replace a managed table."""
    df.write.mode("overwrite").saveAsTable(name)
    return name


def _flat(df: DataFrame) -> DataFrame:
    """Nested columns become JSON text, so CSV stays one value per cell."""
    cols = []
    for f in df.schema.fields:
        if isinstance(f.dataType, (T.StructType, T.ArrayType, T.MapType)):
            cols.append(F.to_json(F.col(f.name)).alias(f.name))
        else:
            cols.append(F.col(f.name))
    return df.select(*cols)


def write_csv(df: DataFrame, path: str) -> str:
    """IN-04: CSV export with a header; ISO dates."""
    (_flat(df).write.mode("overwrite").option("header", True).option("dateFormat", "yyyy-MM-dd")
     .option("timestampNTZFormat", "yyyy-MM-dd'T'HH:mm:ss").csv(path))
    return path


def write_json(df: DataFrame, path: str) -> str:
    """IN-05: JSON records (nested structs kept), ISO dates and timestamps."""
    (df.write.mode("overwrite").option("dateFormat", "yyyy-MM-dd")
     .option("timestampNTZFormat", "yyyy-MM-dd'T'HH:mm:ss").option("ignoreNullFields", False).json(path))
    return path


def records_json(df: DataFrame) -> DataFrame:
    """IN-05 as a column: one JSON document per row."""
    return df.select(F.to_json(F.struct(*df.columns)).alias("record"))
