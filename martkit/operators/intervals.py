"""Join days to the validity intervals that hold them, for keys with very many of both.

A day belongs to one block of 1, 2, 4 ... days at every level; an interval is the disjoint union of at most two such blocks a level.  So
days and intervals meet on equal (key, level, block), each valid pair exactly once: nothing is compared that does not match, and
a frequent key is spread over its blocks.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F, types as T

# Days from year 1 to 9999 count from 0 below 2 ** LEVELS.
LEVELS = 22
FIRST_DAY = 719_162


def _number(day: Column) -> Column:
    return F.unix_date(day) + FIRST_DAY


def _block(level: Column, block: Column) -> Column:
    return F.struct(level.cast("int").alias("level"), block.cast("int").alias("block"))


def blocks_of_day(day: Column) -> Column:
    """The block of each level that a day is in."""
    levels = F.sequence(F.lit(0), F.lit(LEVELS - 1))
    return F.transform(levels, lambda k: _block(k, F.call_function("shiftright", _number(day), k)))


def blocks_of_interval(first: Column, last: Column) -> Column:
    """The fewest blocks that cover the days ``first`` to ``last`` and no other; none if ``last`` is earlier."""
    levels = F.sequence(F.lit(0), F.lit(LEVELS - 1))
    low, high = F.greatest(_number(first), F.lit(0)), F.least(_number(last), F.lit((1 << LEVELS) - 2)) + 1

    def at(k: Column) -> Column:
        size = F.call_function("shiftleft", F.lit(1), k)
        left = F.call_function("shiftright", low + size - 1, k)
        right = F.call_function("shiftright", high, k)
        odd = lambda v: v.bitwiseAND(F.lit(1)) == 1
        begins = F.when((left < right) & odd(left), _block(k, left))
        ends = F.when((left < right) & odd(right), _block(k, right - 1))
        return F.array(begins, ends)

    return F.filter(F.flatten(F.transform(levels, at)), lambda b: b.isNotNull())


def days_only(left: DataFrame, right: DataFrame, at: str, opened: str, closed: str) -> bool:
    """Whether all three columns are dates: a moment within a day has no block."""
    kinds = [left.schema[at].dataType, right.schema[opened].dataType, right.schema[closed].dataType]
    return all(isinstance(k, T.DateType) for k in kinds)


def valid_pairs(
    days: DataFrame, versions: DataFrame, on: Sequence[str], at: str, opened: str, closed: str, grace: int = 0
) -> DataFrame:
    """Each distinct (key, day) with every version valid on it; key and day columns as in ``days``.

    The versions' key columns have the same names; validity may start ``grace`` days early.
    """
    asked = days.select(*on, at).dropna().distinct()
    asked = asked.select(*on, at, F.explode(blocks_of_day(F.col(at))).alias("_b")).select(*on, at, "_b.level", "_b.block")
    first = F.date_sub(opened, grace) if grace else F.col(opened)
    held = versions.dropna(subset=[*on, opened, closed])
    held = held.select("*", F.explode(blocks_of_interval(first, F.col(closed))).alias("_b"))
    held = held.select(*versions.columns, F.col("_b.level").alias("level"), F.col("_b.block").alias("block"))
    return asked.join(held, [*on, "level", "block"]).drop("level", "block")
