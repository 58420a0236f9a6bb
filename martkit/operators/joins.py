"""Joins: validity in time, nearest prior day, frequent keys, defaulted keys, code lists."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date, timedelta

from pyspark.sql import Column, DataFrame, Window, functions as F

from martkit.functions.dates import HIGH_DATE
from martkit.functions.predicates import current_rows, folded, holds, same_text, valid_at
from martkit.operators.hot import FREQUENT_ROWS, frequent_keys, is_one_of, key_hash, key_map, perhaps_touched, touched_by
from martkit.operators.intervals import days_only, valid_pairs

# Parts a frequent key is cut into where the caller names frequent keys.
SALTS = 8


def row_salt(columns: Sequence[str], salts: int) -> Column:
    names = ", ".join(f"`{c}`" for c in columns)
    return F.expr(f"CAST(pmod(xxhash64({names}), {salts}) AS INT)")


def own_exchange(on: Sequence[str]) -> Column:
    """Always 0, which the optimizer cannot know: as one more key it puts a fresh exchange on both sides of a join."""
    return F.pmod(key_hash(on), F.lit(1)).cast("int")


def spread_join(
    left: DataFrame, right: DataFrame, on: Sequence[str], how: str = "left", frequent: Sequence[int] = (), salts: int = SALTS
) -> DataFrame:
    """Join many ``left`` rows to a narrow ``right`` that was grouped or ranked on the same keys.

    Such a ``right`` is already partitioned by the key, which would pull every row of one key into one task and keeps the adaptive
    skew split from applying.  One more key column that is always 0, which the optimizer cannot know, puts a fresh exchange on both
    sides: the sizes measured there show which keys are frequent, and only their partitions are split.  No row is copied.

    ``frequent`` names keys to be cut in advance, as hashes that ``frequent_keys`` tells from a stored ``left``: their right
    rows are copied ``salts`` times and their left rows dealt out by content, so that a repeated task places every row as before.
    All other keys are joined as they are.
    """
    if how not in ("inner", "left", "left_semi"):
        raise ValueError(f"spread_join cannot do a {how} join")
    same = own_exchange(on)
    if not frequent:
        return left.withColumn("_salt", same).join(right.withColumn("_salt", same), [*on, "_salt"], how).drop("_salt")
    hot = is_one_of(on, frequent)
    salted_left = left.withColumn("_salt", F.when(hot, row_salt(left.columns, salts)).otherwise(same))
    plain = right.filter(~hot).withColumn("_salt", same)
    copied = right.filter(hot).withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    return salted_left.join(plain.unionByName(copied), [*on, "_salt"], how).drop("_salt")


def temporal_join(
    left: DataFrame,
    right: DataFrame,
    on: Sequence[str],
    at: str,
    opened: str = "open_dt",
    closed: str = "close_dt",
    grace: int = 0,
    how: str = "inner",
    among: DataFrame | None = None,
    extra: Column | None = None,
    marks: DataFrame | None = None,
    heavy: Sequence[int] = (),
) -> DataFrame:
    """Join each left row to the right rows of its key that are valid on ``left[at]``.

    ``on`` columns are shared names; the other columns of the two sides must differ.  ``among`` is any
    frame that holds the ``on`` keys of the left side and is cheap to read, ``marks`` a stored ``key_map`` of them: the right side
    is cut to about those keys where it is read, before the shuffle.  Where ``left[at]`` is known to lie in a window, hand in a
    history cut by ``alive_in``.

    An ordinary key is an equality join with the validity as a further condition; no row is copied and a frequent key is left to
    the adaptive skew split.  That compares every event of a key with every version.  Keys with many of both, named by ``heavy``
    (``heavy_keys`` finds them), meet by blocks of days instead, where only valid pairs meet; their days must be dates.
    """
    if marks is None and among is not None:
        marks = key_map(among, on)
    if marks is not None:
        right = perhaps_touched(right, marks, on)
    renamed, keys = _own_keys(right, on)
    valid = valid_at(F.col(at), F.col(opened), F.col(closed), grace)
    if extra is not None:
        valid = valid & extra
    if not heavy:
        return left.join(renamed, _equal(left, renamed, keys) & valid, how).drop(*[r for _, r in keys])
    if how not in ("inner", "left") or not days_only(left, right, at, opened, closed):
        raise ValueError("heavy keys need an inner or left join of dates")
    hot = is_one_of(on, heavy)
    few = temporal_join(left.filter(~hot), right.filter(~hot), on, at, opened, closed, grace, how, extra=extra)
    events = left.filter(hot)
    pairs, names = _own_keys(valid_pairs(events, right.filter(hot), on, at, opened, closed, grace), [*on, at])
    many = events.join(pairs, _equal(events, pairs, names) & (F.lit(True) if extra is None else extra), how)
    return few.unionByName(many.drop(*[r for _, r in names]))


def heavy_keys(left: DataFrame, right: DataFrame, on: Sequence[str], rows: int = FREQUENT_ROWS) -> list[int]:
    """Hashes of keys with at least ``rows`` rows on either side: two passes over key columns, a sketch each."""
    many = frequent_keys(right, on, rows)
    return sorted(set(many) & set(frequent_keys(left, on, rows))) if many else []


def alive_in(
    history: DataFrame, window: tuple[date, date], opened: str = "open_dt", closed: str = "close_dt", grace: int = 0
) -> DataFrame:
    """History rows valid on some day of a window, which may start ``grace`` days early.

    Bare columns against literals, so that the scan can skip row groups.  Only for joins whose other side lies in
    the window by a filter of its own: rows outside would find nothing.
    """
    low, high = window
    return history.filter((F.col(opened) <= F.lit(high + timedelta(days=grace))) & (F.col(closed) >= F.lit(low)))


def _own_keys(right: DataFrame, on: Sequence[str]) -> tuple[DataFrame, list[tuple[str, str]]]:
    keys = [(k, f"_r_{k}") for k in on]
    return right.withColumnsRenamed(dict(keys)), keys


def _equal(left: DataFrame, right: DataFrame, keys: Sequence[tuple[str, str]]) -> Column:
    condition = F.lit(True)
    for a, b in keys:
        condition = condition & (F.col(a) == F.col(b))
    return condition


def asof_join(
    left: DataFrame,
    right: DataFrame,
    on: Sequence[str],
    left_day: str,
    right_day: str,
    pick: str = "latest",
) -> DataFrame:
    """Left join to the right rows of one prior day per left row; all rows of that day are kept.

    ``pick="latest"`` takes the nearest day on or before ``left[left_day]``, ``"earliest"`` the first
    day of the key if it is on or before it.  Both day columns are dates, so each key is reduced to its
    distinct days before anything is ordered: a group is never longer than the calendar.
    """
    keys = list(on)
    right_days = right.select(*keys, F.col(right_day).alias("_rday")).filter(F.col("_rday").isNotNull())
    if pick == "earliest":
        chosen = right_days.groupBy(*keys).agg(F.min("_rday").alias("_pick"))
        dated = spread_join(left, chosen, keys, "left").withColumn(
            "_pick", F.when(F.col("_pick") <= F.col(left_day), F.col("_pick"))
        )
    elif pick == "latest":
        asked = left.select(*keys, F.col(left_day).alias("_day")).distinct()
        timeline = asked.withColumn("_rday", F.lit(None).cast("date")).unionByName(
            right_days.distinct().withColumn("_day", F.col("_rday"))
        )
        # Same day: a right row (non-null, sorted first) counts for the left row.
        walk = (
            Window.partitionBy(*keys)
            .orderBy(F.col("_day").asc(), F.col("_rday").asc_nulls_last())
            .rowsBetween(Window.unboundedPreceding, Window.currentRow)
        )
        chosen = (
            timeline.withColumn("_pick", F.last("_rday", ignorenulls=True).over(walk))
            .filter(F.col("_rday").isNull() & F.col("_pick").isNotNull())
            .select(*keys, F.col("_day").alias(left_day), "_pick")
        )
        dated = spread_join(left, chosen, [*keys, left_day], "left")
    else:
        raise ValueError(f"unknown pick {pick!r}")
    matches = right.withColumn("_pick", F.col(right_day))
    return dated.join(matches, [*keys, "_pick"], "left").drop("_pick")


def null_safe_join(
    left: DataFrame,
    right: DataFrame,
    null_safe: Sequence[tuple[str, str]],
    plain: Sequence[tuple[str, str]] = (),
    how: str = "inner",
) -> DataFrame:
    """Join where NULL equals NULL on the ``null_safe`` column pairs but not on the ``plain`` pairs."""
    condition = F.lit(True)
    for a, b in null_safe:
        condition = condition & F.col(a).eqNullSafe(F.col(b))
    for a, b in plain:
        condition = condition & (F.col(a) == F.col(b))
    return left.join(right, condition, how)


def semi_join(left: DataFrame, right: DataFrame, left_key: str, right_key: str, early: bool = False) -> DataFrame:
    """Keep left rows whose key occurs on the right.

    The right keys are made distinct first: a semi join cannot split a frequent key of its right side.  ``early=True`` drops most
    other rows of a long history where it is read, by a map of the right keys; the keys are then read twice, so they should be
    cheap to read.
    """
    if early:
        left = touched_by(left, right, [(left_key, right_key)])
    keys = right.select(F.col(right_key).alias("_k")).dropna().distinct()
    return spread_join(left.withColumn("_k", F.col(left_key)), keys, ["_k"], "left_semi").drop("_k")


def cast_key_join(
    left: DataFrame, right: DataFrame, left_key: str, right_key: str, how: str = "inner"
) -> DataFrame:
    """Join a numeric key to a text key; both sides compare as text."""
    return left.join(right, F.col(left_key).cast("string") == F.col(right_key).cast("string"), how)


def decode(
    df: DataFrame,
    codes: DataFrame,
    key_type: str,
    code: str,
    out: str,
    high_date: date = HIGH_DATE,
) -> DataFrame:
    """Left join to one key type of a code list (``mstr_cd_key_type, mstr_cd, decoded_value, close_dt``)."""
    wanted = codes.filter(
        (F.col("close_dt") == F.lit(high_date)) & same_text(F.col("mstr_cd_key_type"), key_type)
    ).select(folded(F.col("mstr_cd")).alias("_code"), F.col("decoded_value").alias(out))
    return df.join(wanted, folded(F.col(code)) == F.col("_code"), "left").drop("_code")


def segment_of(df: DataFrame, classes: DataFrame, code: str = "vip_code", out: str = "cfu") -> DataFrame:
    """Left join to the current sales classes: segment by class code, compared as text."""
    wanted = current_rows(classes).select(
        folded(F.col("sales_class_ref_cd").cast("string")).alias("_class"), F.col("cfu").alias(out)
    )
    return df.join(wanted, folded(F.col(code).cast("string")) == F.col("_class"), "left").drop("_class")


def cross_join_param(df: DataFrame, **values: object) -> DataFrame:
    """Attach parameter values to every row: literals instead of a one-row table."""
    return df.select("*", *[F.lit(v).alias(k) for k, v in values.items()])


def cross_source_match(
    df: DataFrame,
    on: Sequence[str],
    source: str = "src_cd",
    first: str = "ID",
    second: str = "ED",
    first_when: Column | None = None,
) -> DataFrame:
    """Keys present under both source codes: one grouping instead of a self join."""
    is_first = F.col(source) == first
    if first_when is not None:
        is_first = is_first & first_when
    return (
        df.filter(F.col(source).isin(first, second))
        .dropna(subset=list(on))
        .groupBy(*on)
        .agg(
            F.max(holds(is_first)).alias("_first"),
            F.max(holds(F.col(source) == second)).alias("_second"),
        )
        .filter("_first AND _second")
        .select(*on)
    )
