"""Class codes and tolerant casts."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Lower bounds of the middle and the top price class, and the class names.
PRICE_BOUNDS = (100000.0, 350000.0)
PRICE_NAMES = ("cheap", "average", "expensive")


def _by_price(price: Column, values: tuple) -> Column:
    low, high = PRICE_BOUNDS
    return (
        F.when(price < low, F.lit(values[0]))
        .when(price < high, F.lit(values[1]))
        .otherwise(F.lit(values[2]))
    )


def price_class_code(price: Column) -> Column:
    """0, 1 or 2; NULL and NaN land in the top class, as failed comparisons do."""
    return _by_price(price, (0, 1, 2))


def price_class_name(price: Column) -> Column:
    return _by_price(price, PRICE_NAMES)


def cast_numeric(col: Column, kind: str) -> Column:
    """Cast to double, float, bigint or int; what does not parse becomes NULL."""
    return col.try_cast(kind)


def known(col: Column) -> Column:
    """NaN counts as missing, like NULL."""
    return F.nanvl(col.cast("double"), F.lit(None).cast("double"))
