"""Number parsing, guarding and rounding."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from skyledger.functions.text import as_column, normalized

# Guards: Spark's own cast would also accept '1d', 'nan' and 'inf'.
FLOAT_TEXT = r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?$"
WHOLE_TEXT = r"^[+-]?[0-9]+$"

# Below the first limit double amounts are summed as whole cents in a long, which holds some
# ninety million of them; from the second on a double has no cents that a long could hold.
LARGE_FROM, WHOLE_FROM = 1e9, 1e15

# Exact amounts: six places as read, two places as money; sums have all digits there are.
AMOUNT, MONEY = "decimal(38,6)", "decimal(38,2)"


def is_finite(value: Column | str) -> Column:
    number = as_column(value)
    return number.isNotNull() & ~F.isnan(number) & (F.abs(number) < float("inf"))


def parse_float(text: Column) -> Column:
    """Tidy text to a double, infinite when too large to hold.

    Parsers refer to their input once per step: nested, they would otherwise repeat
    the whole expression below them.
    """
    return F.regexp_extract(text, FLOAT_TEXT, 0).try_cast("double")


def finite(parsed: Column) -> Column:
    return F.nullif(F.nullif(parsed, F.lit(float("inf"))), F.lit(float("-inf")))


def number(value: Column | str) -> Column:
    """Text or number to a finite double, anything else to null."""
    return finite(parse_float(normalized(value)))


def _with_point(value: Column | str) -> Column:
    """Tidy text without spaces, with a decimal point for a comma."""
    return F.replace(F.replace(normalized(value), F.lit(","), F.lit(".")), F.lit(" "), F.lit(""))


def decimal_comma_number(value: Column | str) -> Column:
    """Like ``number`` with spaces as thousands separators and a decimal comma."""
    return finite(parse_float(_with_point(value)))


def count_number(value: Column | str) -> Column:
    """A non-negative whole number, halves to even, negative to null."""
    parsed = parse_float(_with_point(value))
    rounded = F.rint(parsed).try_cast("bigint")
    return F.nullif(F.greatest(rounded, F.lit(-1)), F.lit(-1))


def whole_or(value: Column | str, default: int | None = None) -> Column:
    """Whole-number text to int, blank or malformed text to the default."""
    parsed = F.regexp_extract(normalized(value), WHOLE_TEXT, 0).try_cast("int")
    return F.coalesce(parsed, F.lit(default).cast("int"))


def number_or(value: Column | str, default: float | None = None) -> Column:
    return F.coalesce(number(value), F.lit(default).cast("double"))


def whole_within(value: Column | str, low: float, high: float) -> Column:
    """The value rounded half-even to int when inside [low, high], else null."""
    parsed = number(value)
    return F.when(parsed.between(low, high), F.rint(parsed).cast("int"))


def null_if(value: Column | str, *sentinels: int) -> Column:
    result = as_column(value)
    for sentinel in sentinels:
        result = F.nullif(result, F.lit(sentinel))
    return result


def settle(value: Column | str, digits: int, half_even: bool = False) -> Column:
    """Round a computed double, independent of the order its parts were added in.

    Sums and averages of doubles carry noise in the last bits that depends on
    how rows were spread over tasks. Fixing eight decimals first removes it, so
    a tie always rounds the same way. A double of 1e30 or more, which does not fit, has no
    fraction: rounding leaves it as it is.
    """
    exact = as_column(value).try_cast("decimal(38,8)")
    rounder = F.bround if half_even else F.round
    return F.coalesce(
        rounder(exact, digits).cast("double"), rounder(as_column(value).cast("double"), digits)
    )


def settled_decimal(
    value: Column | str, precision: int, scale: int, half_even: bool = False
) -> Column:
    exact = as_column(value).try_cast("decimal(38,8)")
    rounder = F.bround if half_even else F.round
    return rounder(exact, scale).try_cast(f"decimal({precision},{scale})")


def exact_amount(value: Column | str) -> Column:
    """Text with a decimal comma or point to a decimal, without a double in between.

    Six places are kept, halves away from zero; text that is no number, or has more than 32
    digits before the point, is null.
    """
    text = F.regexp_extract(_with_point(value), FLOAT_TEXT, 0)
    return F.nullif(text, F.lit("")).try_cast(AMOUNT)


def cents(value: Column | str, below: float = WHOLE_FROM) -> Column:
    """A double amount below the limit as whole cents, halves up.

    Summing longs stays on the fast generated-code path and is exact in any order.
    """
    amount = as_column(value).cast("double")
    return F.when(F.abs(amount) < below, F.floor(amount * F.lit(100.0) + F.lit(0.5)))


def large_amount(value: Column | str) -> Column:
    """A double amount from ``LARGE_FROM`` on as a decimal of two places."""
    amount = as_column(value).cast("double")
    exact = F.coalesce(money(cents(amount)), amount.try_cast(MONEY))
    return F.when(F.abs(amount) >= LARGE_FROM, exact)


def money(total_cents: Column) -> Column:
    """Whole cents as a decimal of two places."""
    hundredth = F.expr("0.01BD")
    return (total_cents.cast("decimal(19,0)") * hundredth).cast(MONEY)


def held(value: Column | str, exact: bool) -> Column:
    """Whether an amount can be money at all: null when there is none."""
    amount = as_column(value)
    return F.when(amount.isNotNull(), (amount if exact else finite(amount.cast("double"))).try_cast(MONEY).isNotNull())
