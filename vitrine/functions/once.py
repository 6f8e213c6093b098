"""Evaluate a costly expression once and use it several times.

Catalyst shares repeated expressions of one projection, but not inside lambdas or
the later branches of CASE and COALESCE, where a repeated regex would run again
for every mention. An aggregation over no elements carries the value instead: an element taken out of a
one-element array would work out the type of the whole body again for every row.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, functions as F


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` evaluated once."""
    return F.aggregate(F.array().cast("array<int>"), value, lambda kept, _: kept, body)


def keep_if(value: Column, test: Callable[[Column], Column]) -> Column:
    """``value`` where ``test(value)`` holds, else null; ``value`` is evaluated once."""
    return let(value, lambda x: F.when(test(x), x))


def nonblank(value: Column) -> Column:
    """``value`` unless it is null or an empty string."""
    return keep_if(value, lambda x: x != "")
