"""The row-level defect predicates.  Each one is TRUE or FALSE, never NULL."""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values.
VALID_STATUSES = ["COMPLETED", "PENDING", "SHIPPED", "CANCELLED"]
DIRTY_STATUS = "INVALID/DIRTY"
TOTAL_TOLERANCE = 0.05

FLAGS = [
    "is_orphan_order",
    "has_negative_amount",
    "is_duplicate",
    "is_future_order",
    "has_math_error",
    "has_bad_status",
]


def _known(predicate: Column) -> Column:
    return F.coalesce(predicate, F.lit(False))


def orphan(joined_customer_id: Column) -> Column:
    """No customer was found (also when the order names none)."""
    return joined_customer_id.isNull()


def negative_amount(total_amount: Column) -> Column:
    return _known(total_amount < 0)


def future(order_date: Column, as_of: Column) -> Column:
    return _known(order_date > as_of)


def math_error(total_amount: Column, quantity: Column, price: Column) -> Column:
    """Total and quantity x price differ by more than the tolerance; FALSE when either is unknown."""
    return _known(F.abs(total_amount - quantity * price) > TOTAL_TOLERANCE)


def bad_status(status: Column) -> Column:
    """Not one of the valid statuses; an unknown status is bad."""
    return F.coalesce(~status.isin(*VALID_STATUSES), F.lit(True))


def dirty() -> Column:
    """Any of the six flags; the one definition of an unusable row."""
    return reduce(or_, [F.col(f) for f in FLAGS])


def reasons() -> Column:
    """Names of the flags that are set, as an array."""
    return F.array_compact(F.array(*[F.when(F.col(f), F.lit(f)) for f in FLAGS]))


def status_bucket(status: Column) -> Column:
    """A valid status as it is, everything else (also NULL) in one bucket."""
    return F.when(status.isin(*VALID_STATUSES), status).otherwise(F.lit(DIRTY_STATUS))
