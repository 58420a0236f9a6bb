"""Frequent keys found by a mergeable sketch, and touched keys marked in a map of fixed size."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

# Frequent keys that are told at most, counters a task keeps for them, and rows from which on a key is frequent.
MOST_KEYS, COUNTERS, FREQUENT_ROWS = 200, 4_000, 256
# Words of 64 bits in the map of touched keys: what is broadcast has so many rows at most, however many keys there are.
MAP_WORDS = 1 << 20
# Rows up to which a list of codes goes to the rows of a table, instead of the table being shuffled to meet it.
LISTED_ROWS = 400_000


def key_hash(columns: Sequence[str]) -> Column:
    return F.xxhash64(*[F.col(f"`{c}`") for c in columns])


def frequent_keys(df: DataFrame, on: Sequence[str], rows: int = FREQUENT_ROWS, most: int = MOST_KEYS) -> list[int]:
    """Hashes of the keys that at least ``rows`` rows have, the most frequent ``most`` of them.

    One pass over the key columns: every task keeps a top-k sketch of fixed size, the sketches merge, and one row reaches
    the driver.  The sketch never counts a key too low, so a frequent key is missed only where more than ``most`` are.
    Missing values do not count: they match nothing.
    """
    keys = df.select(*on).dropna().select(key_hash(on).alias("key"))
    top = keys.agg(F.expr(f"approx_top_k(key, {most}, {COUNTERS})").alias("top")).first().top
    return [r["item"] for r in top or [] if r["count"] >= rows]


def is_one_of(on: Sequence[str], keys: Sequence[int]) -> Column:
    """Whether a row's key is among hashes that ``frequent_keys`` told."""
    return key_hash(on).isin(*keys) if keys else F.lit(False)


def _bits(value: Column) -> Column:
    """Two bits of a word."""
    one = F.lit(1).cast("long")
    at = lambda by: F.shiftrightunsigned(value, by).bitwiseAND(F.lit(63)).cast("int")
    return F.call_function("shiftleft", one, at(0)).bitwiseOR(F.call_function("shiftleft", one, at(6)))


def _word(value: Column) -> Column:
    return F.pmod(F.shiftrightunsigned(value, 12), F.lit(MAP_WORDS))


def key_map(keys: DataFrame, on: Sequence[str]) -> DataFrame:
    """``(_word, _bits)``: the keys of a table as bits of a map of fixed size, combined before they travel."""
    value = key_hash(on)
    marked = keys.select(*on).dropna().select(_word(value).alias("_word"), _bits(value).alias("_bits"))
    return marked.groupBy("_word").agg(F.bit_or("_bits").alias("_bits"))


def perhaps_touched(rows: DataFrame, marks: DataFrame, on: Sequence[str]) -> DataFrame:
    """Rows whose key may be in a ``key_map``, found where they are read, before any shuffle.

    No row of a mapped key is lost.  Others pass by chance, more of them the more keys there are, so an exact join must follow.
    """
    value = key_hash(on)
    wanted = marks.select(F.col("_word").alias("_map_word"), F.col("_bits").alias("_map_bits"))
    # MAP_WORDS rows of 16 bytes at most.
    held = (_word(value) == F.col("_map_word")) & (_bits(value).bitwiseAND(F.col("_map_bits")) == _bits(value))
    return rows.join(F.broadcast(wanted), held, "left_semi")


def is_short(codes: DataFrame) -> bool:
    """Whether a list of codes has at most ``LISTED_ROWS`` rows, which is counted: what is broadcast is bounded."""
    return codes.limit(LISTED_ROWS + 1).count() <= LISTED_ROWS


def listed(codes: DataFrame) -> DataFrame:
    """A short list of codes marked for broadcast; a longer one as it is."""
    return F.broadcast(codes) if is_short(codes) else codes


def touched_by(rows: DataFrame, keys: DataFrame, pairs: Sequence[tuple[str, str]]) -> DataFrame:
    """``perhaps_touched`` for keys under other names: pairs of a column of ``rows`` and one of ``keys``."""
    renamed = keys.select(*[F.col(k).cast(rows.schema[r].dataType).alias(r) for r, k in pairs])
    on = [r for r, _ in pairs]
    return perhaps_touched(rows, key_map(renamed, on), on)
