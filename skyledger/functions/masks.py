"""Masking expressions, kept as SQL text so views and DataFrames share them."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from skyledger.functions.keys import KEY_SQL

# Which digits of a code stay visible, and the width of a published range.
CODE_MASK_SQL = "regexp_replace({code}, '^([0-9]{{2}})[0-9]+([0-9]{{2}})$', '$1***$2')"
RANGE_WIDTH = 1000
RANGE_SQL = (
    "concat(cast({count} div {width} * {width} as string), '–', "
    "cast({count} div {width} * {width} + {width} - 1 as string))"
)


def mask_code(column: str) -> Column:
    """First and last two digits of codes with five or more digits; others unchanged."""
    return F.expr(CODE_MASK_SQL.format(code=column))


def mask_label(column: str) -> Column:
    return F.expr(KEY_SQL.format(text=column))


def range_label(column: str, width: int = RANGE_WIDTH) -> Column:
    """The closed range of ``width`` numbers that holds the value."""
    return F.expr(RANGE_SQL.format(count=column, width=width))
