"""Bounded samples of groups of any size."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def smallest(df: DataFrame, by: list[str], value: str, most: int = 5) -> DataFrame:
    """by and value: the `most` smallest distinct values of each group, nulls left out.

    Distinct values are spread over tasks by (group, value); of these each task
    passes on `most` a group (Spark's limit of a ranked window), so that no task
    holds a group.  Samples add up: those of united samples are those of the
    united rows.
    """
    each = df.select(*by, value).where(F.col(value).isNotNull()).distinct()
    place = F.row_number().over(Window.partitionBy(*by).orderBy(value))
    return each.withColumn("_place", place).where(F.col("_place") <= most).drop("_place")


def with_samples(counts: DataFrame, rows: DataFrame, by: list[str], value: str, name: str, most: int = 5) -> DataFrame:
    """counts with an array of the smallest values of rows, empty if there are none; a null group is a group."""
    if not by:
        whole = F.lit(1).alias("_whole")
        return with_samples(counts.select("*", whole), rows.select(value, whole), ["_whole"], value, name, most).drop("_whole")
    each = smallest(rows, by, value, most).groupBy(*by).agg(F.sort_array(F.collect_list(value)).alias(name))
    none = F.array().cast(f"array<{rows.schema[value].dataType.simpleString()}>")
    same: Column = F.lit(True)
    for c in by:
        same = same & F.col(c).eqNullSafe(F.col(f"_{c}"))
    joined = counts.join(each.toDF(*[f"_{c}" for c in by], name), same, "left")
    return joined.drop(*[f"_{c}" for c in by]).withColumn(name, F.coalesce(name, none))
