"""Casts, keys and exact money arithmetic.

Casts use ``try_cast``: a value that does not parse becomes null and is left to the
quality rules, it does not end the job under ANSI mode.

Money is summed as whole cents in a BIGINT. Every channel states amounts with two decimals,
so the sum does not depend on row order or partitioning, which a sum of doubles does. It
stays in the hash aggregate's code-generated path, where DECIMAL sums measured four times
slower. A sum beyond 9.2e16 currency units raises under ANSI mode, it does not wrap.
"""

from pyspark.sql import Column
from pyspark.sql import functions as F

CENTS_PER_UNIT = 100


def _col(c: "str | Column") -> Column:
    return F.col(c) if isinstance(c, str) else c


def timestamp(c: "str | Column") -> Column:
    """ISO-8601 text (or a date) as a timestamp, null where it does not parse."""
    return _col(c).try_cast("timestamp")


def number(c: "str | Column") -> Column:
    """A value as a finite double, null where it does not parse or is NaN or infinite."""
    value = _col(c).try_cast("double")
    return F.when(F.abs(value) < F.lit(float("inf")), value)


def whole(c: "str | Column") -> Column:
    """A value as an int, null where it is no whole number or does not fit; ``2.0`` is 2."""
    value = number(c)
    return F.when(value == F.floor(value), value.try_cast("int"))


def cents(c: "str | Column") -> Column:
    """An amount as whole cents, null if it is not finite or too large for them."""
    return F.rint(_col(c) * CENTS_PER_UNIT).try_cast("bigint")


def from_cents(c: "str | Column") -> Column:
    """Whole cents as an amount."""
    return _col(c) / F.lit(float(CENTS_PER_UNIT))


def money_sum(c: "str | Column") -> Column:
    """Exact sum of an amount, as a double; null if every amount is null."""
    return from_cents(F.sum(cents(c)))


def money_avg(c: "str | Column") -> Column:
    """Exact sum of an amount divided by the number of non-null amounts."""
    return F.try_divide(money_sum(c), F.count(_col(c)))


def day_text(c: "str | Column") -> Column:
    """Calendar day as ``yyyy-MM-dd``."""
    return F.date_format(_col(c), "yyyy-MM-dd")


def item_key(order_id: "str | Column", sku: "str | Column") -> Column:
    """SHA-256 hex of ``order_id-sku``; null if either part is null."""
    return F.sha2(F.concat(_col(order_id), F.lit("-"), _col(sku)), 256)
