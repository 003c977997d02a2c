"""Randomness keyed by row identity.

A draw depends only on the row's id, a salt and the seed, so it is the same
for any partitioning, any retry and any engine that has md5.
"""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

TWO_32 = 4294967296.0


def let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` computed once per row.

    Catalyst evaluates an expression inside a lambda once per element; binding it
    to a one-entry array first keeps the work per row linear.
    """
    return F.get(F.transform(F.array(value), body), F.lit(0))


def digest(*parts) -> Column:
    """md5 hex of the parts joined by ':'; non-columns are taken as literals."""
    cols = [p if isinstance(p, Column) else F.lit(p) for p in parts]
    return F.md5(F.concat_ws(":", *[c.cast("string") for c in cols]))


def order_key(seed: int, ids: list[str]) -> Column:
    """Shuffle key: ordering by it (then by the ids) is a seeded permutation."""
    return digest(*[F.col(i) for i in ids], seed)


def _word(hexed: Column, start: int) -> Column:
    return F.conv(F.substring(hexed, start, 8), 16, 10).cast("double")


def uniform(*parts) -> Column:
    """Uniform draw in [0, 1)."""
    return _word(digest(*parts), 1) / F.lit(TWO_32)


def coin(p: float, *parts) -> Column:
    """True with probability ``p``: the same event as ``uniform(*parts) < p``.

    Hex digits of one length order like the numbers they stand for, so no draw is parsed.
    """
    bound = math.ceil(p * TWO_32)
    if bound >= TWO_32:
        return F.lit(True)
    return digest(*parts) < F.lit(f"{bound:08x}")


def gaussian(*parts) -> Column:
    """Standard normal draw: Box-Muller on the two first words of one digest."""

    def draw(hexed):
        radius = F.sqrt(F.lit(-2.0) * F.ln((_word(hexed, 1) + 1.0) / F.lit(TWO_32 + 1.0)))
        return radius * F.cos(F.lit(2.0 * math.pi) * _word(hexed, 9) / F.lit(TWO_32))

    return let(digest(*parts), draw)


def gaussian_vector(row_id: Column, dim: int | Column, seed: int) -> Column:
    """``dim`` independent normals for one row; ``dim`` may be a column."""
    last = (F.lit(dim) if isinstance(dim, int) else dim).cast("int") - 1
    return F.transform(F.sequence(F.lit(0), last), lambda i: gaussian(row_id, i, seed))
