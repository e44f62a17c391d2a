"""Money arithmetic.

Amounts are summed as DECIMAL at nine decimals: exact, and independent of the
order of addition, so every task layout gives the same answer.  An amount that
DECIMAL(24,9) does not hold exactly (NaN, infinities, very large numbers, more
than nine decimals) is summed as DOUBLE beside it, so it reaches the result of
its own key and stops no job.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: sales tax rate applied to the subtotal.
TAX_RATE = "0.10"

EXACT = "decimal(24,9)"
SUM = "decimal(38,9)"
PLACES = 9
# Prices at their full scale: only a line's sum is rounded to cents.
PRICE = "decimal(18,6)"


def sum_parts(amount: Column, times: Column | None = None) -> list[Column]:
    """Aggregates ``_sum`` (exact) and ``_rest`` (DOUBLE, of the amounts that
    are not exact), each amount taken ``times`` times.  NULL where there is
    nothing to add."""
    times = F.lit(1) if times is None else times
    exact = amount.try_cast(EXACT)
    is_exact = F.coalesce(exact.cast("double") == amount.cast("double"), F.lit(False))
    return [
        F.sum(F.when(is_exact & (times > 0), exact * times.cast("decimal(10,0)"))).cast(SUM).alias("_sum"),
        F.sum(F.when(~is_exact & (times > 0), amount.cast("double") * times)).alias("_rest"),
    ]


def total_of(exact: Column, rest: Column) -> Column:
    """The total as DOUBLE."""
    value = exact.cast("double")
    return F.when(rest.isNull(), value).otherwise(F.coalesce(value, F.lit(0.0)) + rest)


def round2(x: Column) -> Column:
    """Round half up to two places (X5).  On a decimal input this is exact."""
    return F.round(x, 2)


def line_amount(weight_quantity: Column, price: Column) -> Column:
    """Exact ``weight * price`` as DECIMAL (X6), the price at ``PRICE``'s six decimals."""
    return weight_quantity.cast("decimal(12,0)") * price.cast(PRICE)


def taxes_of(subtotal: Column) -> Column:
    """Tax at the fixed rate, rounded to cents (exact decimal arithmetic)."""
    return round2(subtotal * F.lit(TAX_RATE).cast("decimal(3,2)"))


def strip_zeros(text: Column) -> Column:
    """``"600.00"`` -> ``"600"``, ``"74.50"`` -> ``"74.5"``."""
    return F.regexp_replace(F.regexp_replace(text, r"(\.\d*?)0+$", "$1"), r"\.$", "")


def _units(amount: Column) -> Column:
    """``|amount|`` of a DECIMAL(38,9) in whole units of the last place."""
    return (F.abs(amount) * F.lit(10**PLACES).cast("decimal(10,0)")).cast("decimal(38,0)")


def _placed(units: Column, places: int, negative: Column) -> Column:
    """Decimal text of ``units`` of the given place, without trailing zeros."""
    digits = units.cast("string")
    digits = F.lpad(digits, F.greatest(F.length(digits), F.lit(places + 1)), F.lit("0"))
    text = F.concat(F.left(digits, F.length(digits) - places), F.lit("."), F.right(digits, F.lit(places)))
    sign = F.when(negative & (units > 0), F.lit("-")).otherwise(F.lit(""))
    return F.concat(sign, strip_zeros(text))


def sum_text(amount: Column) -> Column:
    """Exact decimal text of a DECIMAL(38,9), e.g. ``"74.55"``."""
    return _placed(_units(amount), PLACES, amount < 0)


def _divided(a: Column, b: Column) -> tuple[Column, Column]:
    """Whole quotient and remainder in DECIMAL(38,0)."""
    rest = a % b
    return ((a - rest) / b).cast("decimal(38,0)"), rest


def mean_text(amount: str, n: str) -> Column:
    """Decimal text of ``amount / n`` to 18 places, rounded half away from zero.

    Two long-division steps of nine digits each, in whole numbers, so no
    binary expansion reaches the text and a hot key's sum does not overflow.
    """
    ten9 = F.lit(10**PLACES).cast("decimal(10,0)")
    count = F.col(n).cast("decimal(38,0)")
    whole, rest = _divided(_units(F.col(amount)), count)
    part, rest = _divided((rest * ten9).cast("decimal(38,0)"), count)
    up = F.when(rest * 2 >= count, F.lit(1)).otherwise(F.lit(0))
    units = (whole * ten9 + part + up).cast("decimal(38,0)")
    return F.when(F.col(n) > 0, _placed(units, 2 * PLACES, F.col(amount) < 0))
