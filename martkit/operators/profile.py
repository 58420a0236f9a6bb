"""Column statistics and key checks."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T


def column_profile(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One row per column: row count, nulls, exact distinct values, smallest and largest value.

    One aggregation over the named columns; distinct values are combined before the shuffle.
    """
    stats = df.agg(
        F.count(F.lit(1)).alias("_rows"),
        *[F.count(c).alias(f"_filled_{c}") for c in columns],
        *[F.count_distinct(c).alias(f"_distinct_{c}") for c in columns],
        *[F.min(c).cast("string").alias(f"_min_{c}") for c in columns],
        *[F.max(c).cast("string").alias(f"_max_{c}") for c in columns],
    )
    lines = [
        F.struct(
            F.lit(c).alias("column_name"),
            F.col("_rows").alias("row_count"),
            (F.col("_rows") - F.col(f"_filled_{c}")).alias("null_count"),
            F.col(f"_distinct_{c}").alias("distinct_count"),
            F.col(f"_min_{c}").alias("min_value"),
            F.col(f"_max_{c}").alias("max_value"),
        )
        for c in columns
    ]
    return stats.select(F.inline(F.array(*lines)))


def slice_sketches(df: DataFrame, columns: Sequence[str], by: Sequence[str]) -> DataFrame:
    """Statistics of every slice that can be merged: one row per slice and column, to be stored beside the slice.

    Rows, filled rows, smallest and largest value are exact; distinct values are an HLL sketch and the spread of numbers
    and dates (as day numbers) a KLL sketch, both of bounded size.  No row is copied, whatever the number of columns.
    """
    kinds = {f.name: f.dataType for f in df.schema.fields}
    parts = [F.count(F.lit(1)).alias("_rows")]
    for c in columns:
        value = F.col(f"`{c}`")
        text = value.cast("string")
        parts += [F.count(value).alias(f"_filled_{c}"), F.min(value).cast("string").alias(f"_min_{c}"), F.max(value).cast("string").alias(f"_max_{c}")]
        parts.append(F.hll_sketch_agg(text).alias(f"_hll_{c}"))
        number = F.unix_date(value) if isinstance(kinds[c], T.DateType) else value if isinstance(kinds[c], T.NumericType) else None
        spread = F.lit(None).cast("binary") if number is None else F.call_function("kll_sketch_agg_double", number.cast("double"))
        parts.append(spread.alias(f"_kll_{c}"))
    stats = df.groupBy(*by).agg(*parts)
    names = ("filled", "min", "max", "hll", "kll")
    lines = [F.struct(F.lit(c).alias("column_name"), F.col("_rows").alias("row_count"), *[F.col(f"_{n}_{c}").alias(n) for n in names]) for c in columns]
    return stats.select(*by, F.inline(F.array(*lines)))


def merged_profile(sketches: DataFrame, kinds: T.StructType) -> DataFrame:
    """The profile of a table from the stored statistics of its slices: exact counts and bounds, about how many distinct values,
    about the median (of dates as a day number).  ``kinds`` is the schema of the table."""
    out = []
    for name in [r.column_name for r in sketches.select("column_name").distinct().collect()]:  # one row a column
        kind = kinds[name].dataType
        own = sketches.filter(F.col("column_name") == name)
        typed = lambda c, kind=kind: F.col(c).cast(kind)
        merged = own.groupBy("column_name").agg(
            F.sum("row_count").alias("row_count"), F.sum(F.col("row_count") - F.col("filled")).alias("null_count"),
            F.hll_sketch_estimate(F.hll_union_agg("hll")).alias("about_distinct"),
            F.min(typed("min")).cast("string").alias("min_value"), F.max(typed("max")).cast("string").alias("max_value"),
            F.call_function("kll_merge_agg_double", F.col("kll")).alias("_spread"),
        )
        has_spread = isinstance(kind, (T.DateType, T.NumericType))
        median = F.call_function("kll_sketch_get_quantile_double", F.col("_spread"), F.lit(0.5)) if has_spread else F.lit(None).cast("double")
        out.append(merged.withColumn("about_median", median).drop("_spread"))
    return reduce(DataFrame.unionByName, out)


def analyze_columns(spark: SparkSession, table: str, columns: Sequence[str]) -> None:
    """Store the statistics of a catalog table for the cost-based optimizer."""
    names = ", ".join(f"`{c}`" for c in columns)
    spark.sql(f"ANALYZE TABLE {table} COMPUTE STATISTICS FOR COLUMNS {names}")


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once, with their row count."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("row_count")).filter(F.col("row_count") > 1)


def count_by_class(
    df: DataFrame, keys: Sequence[str], column: str, special: str, special_out: str, other_out: str
) -> DataFrame:
    """Rows per key in the special class and in any other class, in one pass; a NULL class is in neither."""
    c = F.col(column)
    return df.groupBy(*keys).agg(
        F.count_if(c == special).alias(special_out), F.count_if(c != special).alias(other_out)
    )
