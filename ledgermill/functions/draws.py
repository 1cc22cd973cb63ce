"""Repeatable draws: a function of the row's key, never of its partition.

``rand()`` depends on how the data happens to be split, so a retried task or a
second run would pick other rows. Both generators here map a key and a seed to
an integer in ``[0, 2**31)``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from ledgermill.functions.bands import as_column

DRAW_RANGE = 2**31


def hash_draw(key: Column | str, seed: int = 0) -> Column:
    """Draw for a key of any type."""
    return F.pmod(F.xxhash64(as_column(key), F.lit(seed)), F.lit(DRAW_RANGE))


def number_draw(key: Column | str, seed: int = 0) -> Column:
    """Draw for an integer key by one linear congruential step.

    Plain integer arithmetic, so any SQL engine can repeat it; distinct keys
    below 2**31 give distinct draws.
    """
    start = (as_column(key) + F.lit(seed)) % F.lit(DRAW_RANGE)
    return (start * F.lit(1103515245) + F.lit(12345)) % F.lit(DRAW_RANGE)


def unit(draw: Column) -> Column:
    """Draw scaled to ``[0, 1)``."""
    return draw / F.lit(DRAW_RANGE)


def hash_range(key: Column | str, size: int, seed: int = 0) -> Column:
    """Stable position of a key in ``[0, size)``, by a hash that other engines have too."""
    digest = F.md5(F.concat(F.lit(f"{seed}:"), as_column(key).cast("string")).cast("binary"))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint") % F.lit(size)


def draw_between(draw: Column, low: int, high: int) -> Column:
    """Integer in ``[low, high)``; uses the high bits of the draw."""
    return (F.lit(low) + F.floor(unit(draw) * F.lit(high - low))).cast("int")


def pick(draw: Column, options: Sequence[str]) -> Column:
    """One of the options, evenly."""
    position = draw_between(draw, 0, len(options))
    return F.element_at(F.array(*[F.lit(o) for o in options]), position + 1)


def weighted_pick(draw: Column, weights: Sequence[tuple[str, float]]) -> Column:
    """One of the labels with the given weights; the last label takes the rest."""
    position = unit(draw)
    reached = 0.0
    chain = None
    for label, weight in weights[:-1]:
        reached += weight
        hit = position < F.lit(round(reached, 12))
        chain = F.when(hit, label) if chain is None else chain.when(hit, label)
    last = weights[-1][0]
    return F.lit(last) if chain is None else chain.otherwise(last)
