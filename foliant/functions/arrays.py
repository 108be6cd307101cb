"""Array helpers that stay inside one row: no explode, no shuffle."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """Evaluate value once and use it several times in body.

    Inside a lambda a plain expression is evaluated again per element; bound
    like this it is a variable with constant-time access.
    """
    return F.element_at(F.transform(F.array(value), body), 1)


def running(items: Column, start: int, step: Callable[[Column, Column], Column]) -> Column:
    """All int states of a left fold over items by an associative step.

    Every element takes in the one 1, 2, 4, ... places before it: n log n steps,
    and no list grows element by element.
    """
    ints = "array<int>"

    def fold(array: Column) -> Column:
        widths = F.transform(F.sequence(F.lit(0), F.ceil(F.log2(F.size(array))).cast("int")), lambda k: F.pow(F.lit(2), k).cast("int"))
        joined = lambda states, width: F.transform(
            states, lambda x, i: F.when(i >= width, step(F.get(states, i - width), x)).otherwise(x)
        )
        scanned = F.aggregate(widths, array.cast(ints), lambda states, width: joined(states, width).cast(ints))
        return F.when(F.size(array) < 2, array.cast(ints)).otherwise(scanned)

    return F.transform(let(items, fold), lambda x: step(F.lit(start), x).cast("int"))
