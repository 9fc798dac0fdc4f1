"""IN-01 / IN-02: parquet scans of named tables, failing fast on a missing path."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession

TEST_TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events")


def table_path(base: str, name: str) -> str:
    return f"{base.rstrip('/')}/{name}.parquet"


def read_table(spark: SparkSession, base: str, name: str, columns: list[str] | None = None) -> DataFrame:
    """Scan one parquet table; projection is left to Catalyst's column pruning."""
    path = table_path(base, name)
    try:        # only Spark knows the default file system: its reader finds out
        df = spark.read.parquet(path)
    except AnalysisException as e:
        if "PATH_NOT_FOUND" in str(e.getCondition()):
            raise FileNotFoundError(f"missing table {name!r} at {path}") from e
        raise
    return df.select(*columns) if columns else df


class Tables:
    """Lazy accessor ``t.orders`` -> DataFrame over ``<base>/orders.parquet``."""

    def __init__(self, spark: SparkSession, base: str):
        self.spark = spark
        self.base = base
        self._cache: dict[str, DataFrame] = {}

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_"):
            raise AttributeError(name)
        if name not in self._cache:
            self._cache[name] = read_table(self.spark, self.base, name)
        return self._cache[name]


def load_raw(spark: SparkSession, base: str, names=TEST_TABLES) -> dict[str, DataFrame]:
    """Every named table or a FileNotFoundError naming the first missing one."""
    return {n: read_table(spark, base, n) for n in names}
