"""Cleaning of text columns: NULL markers, units, money, delimited lists."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Texts that stand for a missing value.
NULL_MARKERS = ("", "null")
# Fixed value: white space and letters are dropped from a number with a unit.
UNIT_PATTERN = r"[\sA-Za-z]"


def blank_to_null(col: Column, markers: tuple[str, ...] = NULL_MARKERS) -> Column:
    """NULL for texts of no length and for the other markers, white space around them aside."""
    bare = F.trim(col)
    named = [m for m in markers if m]
    blank = F.length(bare) == 0 if "" in markers else F.lit(False)
    return F.when(blank | bare.isin(*named), None).otherwise(col)


def before(col: Column, mark: str) -> Column:
    """The part before the first ``mark`` by its position; text without the mark stays whole."""
    at = F.position(F.lit(mark), col)
    return F.when(at > 0, F.substring(col, F.lit(1), at - 1)).otherwise(col)


def leading_number(col: Column) -> Column:
    """``'13.4 km'`` -> 13.4; text without a digit -> NULL; digits that are no number (``'1.2.3'``) stop the query."""
    digits = F.regexp_replace(col, UNIT_PATTERN, "")
    number = digits.try_cast("double")
    unreadable = number.isNull() & digits.rlike("[0-9]")
    return F.when(unreadable, F.raise_error(F.concat(F.lit("not a number: "), col)).cast("double")).otherwise(number)


def scaled_amount(col: Column) -> Column:
    """``'$1.2B'`` -> 1.2e9, ``'$300M'`` -> 3e8, no suffix -> as written."""
    factor = F.when(col.contains("B"), F.lit(1e9)).when(col.contains("M"), F.lit(1e6)).otherwise(F.lit(1.0))
    return F.translate(col, "$BM", "").try_cast("double") * factor


def prefix_before(col: Column, mark: str) -> Column:
    """The part before the first ``mark``."""
    return F.split_part(col, F.lit(mark), F.lit(1))


def list_items(col: Column) -> Column:
    """``'1, 2,5'`` -> ``['1', '2', '5']``; NULL stays NULL."""
    return F.split(F.trim(col), r"\s*,\s*")


def list_ids(col: Column) -> Column:
    """A delimited list of whole numbers as an array of int."""
    return list_items(col).cast("array<int>")
