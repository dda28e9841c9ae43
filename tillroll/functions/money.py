"""Money arithmetic.

Sums of doubles depend on the order rows arrive in, so the same query can give
different last digits on a different partitioning.  Money is therefore summed as
DECIMAL (exact) and only the final value is turned into a double.

Ledger amounts are held to a millionth (18 integer digits): cents-only input is
exact, finer input is rounded there and nowhere else, and an amount too large
raises under ANSI instead of turning into something else.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MONEY = "decimal(15,2)"     # cents
LEDGER = "decimal(24,6)"    # amounts that may be finer than cents


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def money(c) -> Column:
    return _c(c).cast(MONEY)


def line_total(amount, quantity) -> Column:
    """amount * quantity, to a millionth (see above)."""
    return _c(amount).cast(LEDGER) * _c(quantity)


def opposite_signs(a, b) -> Column:
    """a * b < 0, decided on the values as they are: no product is rounded."""
    a, b = _c(a), _c(b)
    return ((a < 0) & (b > 0)) | ((a > 0) & (b < 0))


def exact_sum(c) -> Column:
    """SUM of a decimal expression, returned as double."""
    return F.sum(c).cast("double")


def ratio(num, den) -> Column:
    """num / den, 0 when den = 0 (ANSI division by zero raises)."""
    num, den = _c(num).cast("double"), _c(den).cast("double")
    return F.when(den == 0, F.lit(0.0)).otherwise(num / den)


def mean_of(total, count) -> Column:
    """AVG written as sum / count so both engines agree bit for bit."""
    return _c(total).cast("double") / _c(count)
