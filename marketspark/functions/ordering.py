"""Total orders packed into one number.

``min_by``/``max_by`` over a struct key force a sort-based aggregation, because
a struct cannot be updated in place in the hash table.  A decimal can, so the
same order written as one decimal keeps the aggregation hash-based, before and
after the shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_WIDE = "decimal(38,0)"


def packed(high: Column, low: Column, low_digits: int) -> Column:
    """Order by ``high``, then by ``low``; both are whole numbers and ``low`` is
    non-negative with at most ``low_digits`` digits."""
    scale = F.lit("1" + "0" * low_digits).cast(f"decimal({low_digits + 1},0)")
    return (high.cast("decimal(18,0)") * scale).cast(_WIDE) + low.cast("decimal(19,0)")


def packed_fields(*fields: tuple[Column, int]) -> Column:
    """Order by several whole non-negative numbers, given with their most digits (38 together).

    A value with more digits is an error in ANSI mode, not a wrong order.
    """
    total, shift = None, 0
    for value, digits in reversed(fields):
        scale = F.lit("1" + "0" * shift).cast(f"decimal({shift + 1},0)")
        part = (value.cast(f"decimal({digits},0)") * scale).cast(_WIDE)
        total, shift = part if total is None else (total + part).cast(_WIDE), shift + digits
    return total


def time_order(event_time: Column, event_id: Column) -> Column:
    """Order by time to the microsecond, then by id (any non-negative bigint)."""
    return packed(F.unix_micros(event_time), event_id, 19)
