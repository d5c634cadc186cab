"""Deterministic random draws: a hash of (seed, slot, id), independent of partitioning and order.

``u`` is the first 32 bits of md5("seed:slot:id") over 2^32, which any SQL engine can compute alike.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def draw_bits(seed: int | str, slot: str | Column, *ids: Column) -> Column:
    """The draw as an integer of 32 bits."""
    slot = F.lit(slot) if isinstance(slot, str) else slot.cast("string")
    parts = [F.lit(str(seed)), slot, *(i.cast("string") for i in ids)]
    return F.conv(F.substring(F.md5(F.concat_ws(":", *parts)), 1, 8), 16, 10).cast("bigint")


def u(seed: int | str, slot: str | Column, *ids: Column) -> Column:
    """A uniform draw in [0, 1)."""
    return draw_bits(seed, slot, *ids) / F.lit(4294967296.0)


def pick(options: list, seed: int | str, slot: str, *ids: Column) -> Column:
    """One of a fixed list of options, uniformly."""
    return F.element_at(F.array(*[F.lit(o) for o in options]), (1 + draw_bits(seed, slot, *ids) % len(options)).cast("int"))


def weighted(weights: dict[str, float], draw: Column) -> Column:
    """A category by cumulative weights: the first whose running share reaches the draw."""
    if not weights or min(weights.values()) < 0 or sum(weights.values()) <= 0:
        raise ValueError("weights must be non-negative with a positive sum")
    total, running, out, names = sum(weights.values()), 0.0, None, list(weights)
    for name in names[:-1]:
        running += weights[name]
        test = draw * F.lit(float(total)) <= F.lit(float(running))
        out = F.when(test, name) if out is None else out.when(test, name)
    return F.lit(names[-1]) if out is None else out.otherwise(names[-1])


def let(value: Column, body) -> Column:
    """``body(value)`` with the value computed once."""
    return F.get(F.transform(F.array(value), body), F.lit(0))
