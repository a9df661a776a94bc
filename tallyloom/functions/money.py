"""Sums of money that do not depend on the order of the rows.

A plain sum of doubles changes in its last digits with the partitioning. Here
an amount is split into whole cents, summed as a decimal, and the remainder
below a cent, summed as a double. For prices with two decimals the remainder
is exactly zero, so the total is the same in every run. Any other double
(fractions of a cent, NaN, infinity, more than 28 digits of cents) is carried by
the remainder, so nothing is rounded away and nothing overflows.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Whole cents of one row take at most so many digits; the sum has ten more.
ROW_CENTS, ALL_CENTS = "decimal(28,0)", "decimal(38,0)"


def _whole(number: Column) -> Column:
    """The nearest integer as a decimal; NULL for NaN, infinity and what has too many digits."""
    return F.rint(number).try_cast(ROW_CENTS)


def _split(price: Column, quantity: Column | None) -> tuple[Column, Column]:
    """Whole cents of price * quantity, and what is left of it.

    A whole number of pieces is multiplied in cents; a fraction of a piece is
    multiplied first, as the columns are, and then split.
    """
    if quantity is None:
        pieces, amount = F.lit(1).cast("decimal(19,0)"), price
        whole_pieces = F.lit(True)
    else:
        pieces = quantity.try_cast("decimal(19,0)")
        whole_pieces = pieces.cast("double") == quantity.cast("double")
        amount = price * quantity
    each = _whole(price * 100)
    product = F.try_multiply(each, pieces).try_cast(ROW_CENTS)
    of_pieces = F.when(whole_pieces, product).otherwise(_whole(amount * 100))
    rest = F.when(of_pieces.isNull(), amount)
    rest = rest.when(whole_pieces, (price - each.cast("double") / 100) * pieces.cast("double"))
    rest = rest.otherwise(amount - of_pieces.cast("double") / 100)
    cents = F.when(amount.isNotNull(), F.coalesce(of_pieces, F.lit(0).cast(ROW_CENTS)))
    return cents, rest


def money_sums(
    name: str, price: Column, quantity: Column | None = None, where: Column | None = None
) -> dict[str, Column]:
    """Aggregates ``<name>_cents``, ``<name>_rest`` and ``<name>_n`` (rows with an amount).

    All three can be summed again, so they work as partial results.
    """
    cents, rest = _split(price.cast("double"), quantity)
    if where is not None:
        cents, rest = F.when(where, cents), F.when(where, rest)
    return {
        f"{name}_cents": F.sum(cents.cast(ALL_CENTS)),
        f"{name}_rest": F.sum(rest),
        f"{name}_n": F.count(rest),
    }


def money_total(name: str) -> Column:
    """The amount behind the partial sums ``name``; NULL when no row had one."""
    return F.col(f"{name}_cents").cast("double") / 100 + F.col(f"{name}_rest")


def money_mean(name: str) -> Column:
    """Mean amount per row; NULL when no row had one."""
    return F.try_divide(money_total(name), F.col(f"{name}_n"))


def or_zero(amount: Column) -> Column:
    """0 for NULL and NaN."""
    return F.coalesce(F.nanvl(amount, F.lit(None).cast("double")), F.lit(0.0))
