"""Engine-independent pseudo randomness from integers (BIGINT only).

The same formula is written in SQL for the oracles, so walks and draws are
reproducible on any engine and any partitioning: no ``rand()``, no hash of
the row layout. All intermediate values stay below 2^63.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .. import constants as C


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def mix(a, b, seed: int) -> Column:
    """A value in [0, 2^31 - 1) from two non-negative integers and a seed."""
    a, b = _c(a).cast("bigint"), _c(b).cast("bigint")
    x = (a * C.HASH_A + b * C.HASH_B + F.lit(seed * C.HASH_C + 1)) % C.HASH_MOD
    y = (x * (x % C.HASH_MIX + 1)) % C.HASH_MOD
    # x < 2^31, so the double quotient is exact and truncation is integer division.
    return (y * C.HASH_A + (x / F.lit(C.HASH_SHIFT)).cast("bigint")) % C.HASH_MOD


def draw(a, b, seed: int) -> Column:
    """A double in [0, 1) derived from :func:`mix`."""
    return mix(a, b, seed).cast("double") / F.lit(float(C.HASH_MOD))


def mix_sql(a: str, b: str, seed: int) -> str:
    """The same formula as SQL text (``//`` is integer division in DuckDB)."""
    x = f"(({a}) * {C.HASH_A} + ({b}) * {C.HASH_B} + {seed * C.HASH_C + 1}) % {C.HASH_MOD}"
    y = f"((({x}) * (({x}) % {C.HASH_MIX} + 1)) % {C.HASH_MOD})"
    return f"((({y}) * {C.HASH_A} + ({x}) // {C.HASH_SHIFT}) % {C.HASH_MOD})"


def draw_sql(a: str, b: str, seed: int) -> str:
    return f"(CAST({mix_sql(a, b, seed)} AS DOUBLE) / CAST({C.HASH_MOD} AS DOUBLE))"
