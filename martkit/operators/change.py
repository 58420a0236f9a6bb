"""Row changes as rewrites: delete, slice replace, lookup update, flag update."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import date, timedelta
from functools import reduce
from itertools import product

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from martkit.functions.predicates import holds
from martkit.operators.hot import is_short
from martkit.operators.joins import cross_source_match, spread_join


def delete_where(df: DataFrame, condition: Column) -> DataFrame:
    """Drop rows for which the condition is true; unknown keeps the row."""
    return df.filter(~holds(condition))


def drop_null_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    return df.dropna(subset=list(keys))


def replace_slice(target: DataFrame, new: DataFrame, condition: Column) -> DataFrame:
    """The target with one slice replaced by ``new``; applying it twice changes nothing."""
    return delete_where(target, condition).unionByName(new)


def write_slice(
    new: DataFrame,
    path: str,
    partition_by: Sequence[str],
    slice_values: Mapping[str, Sequence[object]],
) -> int:
    """Replace a slice of a partitioned parquet dataset; returns how many partitions were written.

    ``slice_values`` names every partition of the slice (for a load window: one source and its days).  A partition whose rows
    are already there is left alone: a count and a sum of row hashes, which do not depend on the order of rows, tell it.  The
    others found in ``new`` are overwritten in one commit; those of the slice that ``new`` does not fill are removed
    afterwards, so an empty ``new`` also clears the slice, and a rerun after a failure ends in the same state.  A reader in
    between may see a removed partition's old rows beside new ones of other partitions.  ``new`` is read twice and must not read
    from ``path``: hand in a staged table.
    """
    names = list(partition_by)
    inside = F.lit(True)
    for name in names:
        inside = inside & F.col(name).isin(*slice_values[name])
    if not new.filter(~holds(inside)).isEmpty():
        raise ValueError("write_slice: rows outside the slice being replaced")
    spark = new.sparkSession
    root = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    there = root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(root)
    # At most one row per partition of the slice.
    filled = partition_digests(new, names)
    known = partition_digests(spark.read.schema(new.schema).parquet(path).filter(inside), names) if there else {}
    changed = [values for values, digest in filled.items() if known.get(values) != digest]
    if changed or not there:
        # Partitions in which nothing changed are neither written nor removed.
        wanted = reduce(Column.__or__, [reduce(Column.__and__, [F.col(n) == F.lit(v) for n, v in zip(names, c)]) for c in changed], F.lit(not changed))
        (
            # Gathers the rows of a partition into few files and splits a large one by size.
            new.filter(wanted).hint("rebalance", *names)
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy(*names)
            .parquet(path)
        )
    keep = {tuple(str(v) for v in values) for values in filled}
    _remove_partitions(spark, path, names, slice_values, keep)
    return len(changed)


def partition_digests(df: DataFrame, partition_by: Sequence[str]) -> dict[tuple, tuple]:
    """Rows and sum of row hashes of each partition: equal for equal rows in any order."""
    hashed = F.xxhash64(*[F.col(f"`{c}`") for c in sorted(df.columns)])
    again = F.xxhash64(F.lit(1), *[F.col(f"`{c}`") for c in sorted(df.columns)])
    sums = [F.sum(h.cast("decimal(38,0)")) for h in (hashed, again)]
    rows = df.groupBy(*partition_by).agg(F.count(F.lit(1)), *sums).collect()
    width = len(partition_by)
    return {tuple(r)[:width]: tuple(r)[width:] for r in rows}


def _remove_partitions(
    spark: SparkSession,
    path: str,
    partition_by: Sequence[str],
    slice_values: Mapping[str, Sequence[object]],
    keep: set[tuple[str, ...]],
) -> None:
    jvm = spark.sparkContext._jvm
    root = jvm.org.apache.hadoop.fs.Path(path)
    fs = root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    escape = jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.escapePathName
    for values in product(*[slice_values[name] for name in partition_by]):
        texts = tuple(str(v) for v in values)
        if texts in keep:
            continue
        folder = "/".join(f"{name}={escape(text)}" for name, text in zip(partition_by, texts))
        fs.delete(jvm.org.apache.hadoop.fs.Path(root, folder), True)


def days_in(window: tuple[date, date]) -> list[date]:
    """The days of a load window, as partition values."""
    start, end = window
    return [start + timedelta(days=i) for i in range((end - start).days + 1)]


def update_from(
    target: DataFrame,
    source: DataFrame,
    on: Sequence[tuple[str, str]],
    set_columns: Mapping[str, str],
    when: Column | None = None,
    codes: bool = False,
) -> DataFrame:
    """Set target columns from the source row with the same key; other rows stay as they are.

    ``on`` pairs target and source columns; a NULL key matches nothing.  ``set_columns`` maps target to
    source columns.  ``when`` limits the update to some target rows.  A matched NULL overwrites.  Two
    source rows for one updated target row raise when the job runs.  ``codes=True`` says that the source is a list of codes,
    cheap to read: a short one is broadcast, so that the target stays where it is.
    """
    keys = [f"_k{i}" for i in range(len(on))]
    values = [f"_v{i}" for i in range(len(set_columns))]
    renamed = source.select(
        *[F.col(s).alias(k) for (_, s), k in zip(on, keys)],
        *[F.col(s).alias(v) for s, v in zip(set_columns.values(), values)],
    ).dropna(subset=keys)
    # Grouped before the exchange: the guard needs one row per key, however often it repeats.
    lookup = renamed.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("_hits"), *[F.first(v).alias(v) for v in values]
    )
    keyed = target.select("*", *[F.col(t).alias(k) for (t, _), k in zip(on, keys)])
    if codes and is_short(renamed):
        joined = keyed.join(F.broadcast(lookup), keys, "left")
    else:
        joined = spread_join(keyed, lookup, keys, "left")
    matched = F.col("_hits").isNotNull()
    if when is not None:
        matched = matched & holds(when)
    guarded = F.when(
        matched & (F.col("_hits") > 1),
        F.raise_error(F.lit("update_from: several source rows for one target row")).cast("boolean"),
    ).otherwise(matched)
    new_value = dict(zip(set_columns, values))
    out = [
        F.when(F.col("_set"), F.col(new_value[c]).cast(target.schema[c].dataType)).otherwise(F.col(c)).alias(c)
        if c in new_value
        else F.col(c)
        for c in target.columns
    ]
    return joined.withColumn("_set", guarded).select(*out)


def flag_matched(
    df: DataFrame,
    on: Sequence[str],
    flag: str = "bcc_migrated_ind",
    source: str = "src_cd",
    first: str = "ID",
    second: str = "ED",
) -> DataFrame:
    """Flag ``first``-source rows with 'Y' whose key also occurs in the ``second`` source."""
    matches = cross_source_match(df, on, source, first, second, F.col(flag) == "N").withColumn(
        "_yes", F.lit("Y")
    )
    return update_from(
        df, matches, [(k, k) for k in on], {flag: "_yes"}, when=F.col(source) == first
    )
