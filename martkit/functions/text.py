"""Code decoding and text pieces."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, functions as F

from martkit.functions.predicates import same_text

# Product action codes, account type letters and staging status letters.
PRODUCT_ACTIONS = {"1": "Provide", "2": "Change", "3": "Cancel", "4": "Cease"}
ACCOUNT_TYPES = {"D": "Consumer", "S": "SMB"}
STAGING_STATUS = {"A": "Gross Adds", "C": "Churns"}


def decode_case(column: Column, labels: Mapping[str, str], otherwise: Column | str | None) -> Column:
    """One CASE over literal codes; ``otherwise`` covers unknown and missing codes."""
    result = None
    for code, label in labels.items():
        hit = same_text(column, code)
        result = F.when(hit, label) if result is None else result.when(hit, label)
    fallback = otherwise if isinstance(otherwise, Column) else F.lit(otherwise)
    return result.otherwise(fallback)


def mid_token(column: Column) -> Column:
    """Middle of ``A_B_C``; text without an underscore stays, exactly one underscore gives NULL."""
    pieces = F.split(column, "_")
    return F.when(F.size(pieces) == 1, column).when(F.size(pieces) >= 3, pieces.getItem(1))


def varchar(column: Column, length: int) -> Column:
    """Text cut to a declared length."""
    return F.substring(column.cast("string"), 1, length)


def whole_number_text(column: Column) -> Column:
    """Numeric key as text without a fraction part."""
    return column.cast("bigint").cast("string")
