"""Feature encoding as tables (ML-04): a level dictionary, a scaling table and sparse long rows.

What is learned from the training rows is two small tables, one row for each level of
a categorical and one for each numeric, and encoding is a join with them.  A
level that training never saw has no row in the dictionary, so it has none in the
result (one-hot "ignore").  Numerics are centred and divided by the population
standard deviation; a constant one is only centred.  NULL has no row.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Levels up to which the dictionary is sent to every task; a longer one is joined by shuffle.
BROADCAST_LEVELS = 50_000


def _long(df: DataFrame, keep: Sequence[str], columns: Sequence[str], kind: str, value: str) -> DataFrame:
    cols = [F.col(c).cast(kind).alias(f"__{c}") for c in columns]
    long = df.select(*keep, *cols).unpivot(list(keep), [f"__{c}" for c in columns], "feature", value)
    return long.withColumn("feature", F.substring("feature", 3, 1 << 20)).where(F.col(value).isNotNull())


def level_dictionary(df: DataFrame, categorical: Sequence[str]) -> DataFrame:
    """(feature, level, term) of every level that occurs; ``term`` names the column of the encoded matrix."""
    levels = _long(df, [], categorical, "string", "level").distinct()
    return levels.withColumn("term", F.concat("feature", F.lit("="), "level"))


def scaling(df: DataFrame, numeric: Sequence[str]) -> DataFrame:
    """(feature, mean, scale) of every numeric, from one aggregate."""
    aggs = [a for c in numeric for a in (F.avg(F.col(c).cast("double")).alias(f"m_{c}"),
                                         F.stddev_pop(F.col(c).cast("double")).alias(f"s_{c}"))]
    one = [F.struct(F.lit(c).alias("feature"), F.col(f"m_{c}").alias("mean"),
                    F.when(F.col(f"s_{c}") > 0, F.col(f"s_{c}")).otherwise(F.lit(1.0)).alias("scale")) for c in numeric]
    return df.agg(*aggs).select(F.explode(F.array(*one)).alias("f")).select("f.*")


def encoded(df: DataFrame, key: Sequence[str], dictionary: DataFrame, scales: DataFrame, categorical: Sequence[str],
            numeric: Sequence[str]) -> DataFrame:
    """(key, term, value): the sparse rows of the encoded matrix.

    The scaling table has a row for each numeric of the contract.  The dictionary is broadcast only when a
    count of it says that it is short.
    """
    short = dictionary.limit(BROADCAST_LEVELS + 1).count() <= BROADCAST_LEVELS
    cats = _long(df, key, categorical, "string", "level").join(F.broadcast(dictionary) if short else dictionary, ["feature", "level"])
    nums = _long(df, key, numeric, "double", "v").join(F.broadcast(scales), "feature")
    return cats.select(*key, "term", F.lit(1.0).alias("value")).unionByName(
        nums.select(*key, F.col("feature").alias("term"), ((F.col("v") - F.col("mean")) / F.col("scale")).alias("value")))


def reference_levels(df: DataFrame, categorical: Sequence[str]) -> dict[str, str | None]:
    """The first level of each categorical, which treatment coding leaves out (one row reaches the driver)."""
    row = df.agg(*[F.min(F.col(c).cast("string")).alias(c) for c in categorical]).first()
    return {c: row[c] for c in categorical}


def treatment_terms(numeric: Sequence[str], categorical: Sequence[str], reference: dict[str, str | None],
                    naming: str = "{0}[T.{1}]", dropped: Sequence[str] = ()) -> Column:
    """array<struct<term, value>>: the non-zero terms of a row of a treatment-coded design with an intercept."""
    def term(name: Column, value: Column) -> Column:
        return F.struct(name.alias("term"), value.cast("double").alias("value"))
    before, between, after = naming.partition("{0}")[0], naming.partition("{0}")[2].partition("{1}")[0], naming.partition("{1}")[2]
    cols = [term(F.lit("Intercept"), F.lit(1.0)), *[term(F.lit(c), F.col(c)) for c in numeric]]
    for c in categorical:
        level = F.col(c).cast("string")
        cols.append(term(F.concat(F.lit(f"{before}{c}{between}"), level, F.lit(after)),
                         F.when(level != F.lit(reference[c]), F.lit(1.0))))
    gone = F.array(*[F.lit(d) for d in dropped]).cast("array<string>")
    return F.filter(F.array(*cols), lambda s: s["value"].isNotNull() & (s["value"] != 0) & ~F.array_contains(gone, s["term"]))
