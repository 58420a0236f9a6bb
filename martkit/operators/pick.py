"""Pick the best row or rows of every group."""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window, functions as F

from martkit.operators.joins import own_exchange


class Order(NamedTuple):
    column: Column
    newest_first: bool


def latest(column: str | Column, default: object = None) -> Order:
    return Order(_with_default(column, default), True)


def earliest(column: str | Column, default: object = None) -> Order:
    return Order(_with_default(column, default), False)


def _with_default(column: str | Column, default: object) -> Column:
    c = F.col(column) if isinstance(column, str) else column
    return c if default is None else F.coalesce(c, F.lit(default))


def _sort(order: Sequence[Order]) -> list[Column]:
    # A missing value sorts lowest in either direction.
    return [o.column.desc_nulls_last() if o.newest_first else o.column.asc_nulls_first() for o in order]


def best_rows(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[Order],
    ties: bool = True,
    spread_ties: bool = False,
) -> DataFrame:
    """Best row(s) per key.

    ``ties=True`` keeps all rows that share first place, ``ties=False`` exactly one, with the
    remaining columns as tiebreak so that a rerun picks the same row.

    The rank filter sits right on the window, so Spark cuts every group to its best rows before the
    shuffle: a task receives at most the tied rows of its keys.  Where those may themselves be too many for
    one task, ``spread_ties=True`` avoids gathering them: the best order values of each key
    are found first (one row per key and task reaches the shuffle), then the rows are compared with them
    in a join that is open to the adaptive skew split.  No row is copied.  That reads the input twice, so hand
    it a scan or a stored table.
    """
    if not ties:
        return _ranked(df, keys, _sort(order) + _tiebreak(df, keys), F.row_number())
    if not spread_ties:
        return _ranked(df, keys, _sort(order), F.rank())
    return _best_rows_spread(df, keys, order)


def _tiebreak(df: DataFrame, keys: Sequence[str]) -> list[Column]:
    others = [f"`{c}`" for c in df.columns if c not in set(keys)]
    return [F.expr(c).desc_nulls_last() for c in others]


def _ranked(df: DataFrame, keys: Sequence[str], sort: Sequence[Column], function: Column) -> DataFrame:
    place = function.over(Window.partitionBy(*keys).orderBy(*sort))
    return df.withColumn("_place", place).filter(F.col("_place") == 1).drop("_place")


def _best_rows_spread(df: DataFrame, keys: Sequence[str], order: Sequence[Order]) -> DataFrame:
    values = [f"_o{i}" for i in range(len(order))]
    keyed = df.select("*", *[o.column.alias(v) for o, v in zip(order, values)])
    sort = _sort([Order(F.col(v), o.newest_first) for o, v in zip(order, values)])
    best = _ranked(keyed.select(*keys, *values), keys, sort, F.row_number())
    matched = [*keys, *values]
    found = best.select(*[F.col(c).alias(f"_best_{c}") for c in matched], own_exchange(keys).alias("_best_side"))
    same = _all_same([F.col(c) for c in matched], [F.col(f"_best_{c}") for c in matched])
    sided = keyed.withColumn("_side", own_exchange(keys))
    return sided.join(found, (F.col("_side") == F.col("_best_side")) & same, "left_semi").select(*df.columns)


def _all_same(left: Sequence[Column], right: Sequence[Column]) -> Column:
    condition = F.lit(True)
    for a, b in zip(left, right):
        condition = condition & a.eqNullSafe(b)
    return condition
