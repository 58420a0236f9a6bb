"""Conform rows to a target schema, extend rows, union sources."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F, types as T


def conform(df: DataFrame, schema: T.StructType, /, only: bool = False, **constants: object) -> DataFrame:
    """Exactly the columns of ``schema``: by name from ``df``, else a constant, else a typed NULL.

    ``only=True`` is for a frame made for this schema: a column of ``df`` that the schema does not have (a misspelt one, say)
    is an error instead of being left out.
    """
    have = {c.lower(): c for c in df.columns}
    if only and (strange := set(have) - {n.lower() for n in schema.names}):
        raise ValueError(f"not in the target schema: {sorted(strange)}")
    unknown = set(constants) - set(schema.names)
    if unknown:
        raise ValueError(f"not in the target schema: {sorted(unknown)}")
    out = []
    for field in schema.fields:
        if field.name in constants:
            value = constants[field.name]
            column = value if isinstance(value, Column) else F.lit(value)
            out.append(column.cast(field.dataType).alias(field.name))
        else:
            source = have.get(field.name.lower())
            text = f"`{source}`" if source else "NULL"
            out.append(F.expr(f"CAST({text} AS {field.dataType.simpleString()}) AS `{field.name}`"))
    return df.select(*out)


def extend(df: DataFrame, **columns: Column) -> DataFrame:
    """All columns of ``df`` plus computed ones, in order; later ones may use earlier ones."""
    return reduce(lambda d, item: d.withColumn(*item), columns.items(), df)


def union_events(*parts: DataFrame) -> DataFrame:
    """Bag union of sources by column name."""
    return reduce(lambda a, b: a.unionByName(b), parts)


def rename(df: DataFrame, **new_from_old: str) -> DataFrame:
    """Project to new names: ``rename(df, out="source")``."""
    return df.select(*[F.col(old).alias(new) for new, old in new_from_old.items()])


def take(df: DataFrame, mapping: Mapping[str, Column]) -> DataFrame:
    return df.select(*[column.alias(name) for name, column in mapping.items()])
