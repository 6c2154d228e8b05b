"""Keyed draws: values that depend only on (seed, salt, key).

A task that is retried, a plan that is computed twice and a table with another
partitioning all see the same value, which ``rand()`` does not promise.

``method="xxhash64"`` is the fast default. ``method="md5"`` costs more and exists
because other engines can compute it too, so results can be checked elsewhere.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tallymark.functions.columns import as_column

# The default seed, and the number of steps of a draw.
SEED = 42
STEPS = 1_000_000


def draw_steps(
    salt: str, *keys: Column | str, seed: int = SEED, method: str = "xxhash64"
) -> Column:
    """Whole number in [0, STEPS), the exact form of a draw."""
    if not keys:
        raise ValueError("a draw needs at least one key column")
    columns = [as_column(key) for key in keys]
    if method == "xxhash64":
        return F.pmod(F.xxhash64(F.lit(seed), F.lit(salt), *columns), F.lit(STEPS))
    if method == "md5":
        text = F.concat_ws("|", F.lit(str(seed)), F.lit(salt), *[c.cast("string") for c in columns])
        return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("long") % F.lit(STEPS)
    raise ValueError(f"unknown draw method {method!r}; use 'xxhash64' or 'md5'")


def uniform(salt: str, *keys: Column | str, seed: int = SEED, method: str = "xxhash64") -> Column:
    """Draw in [0, 1) with a step of one millionth."""
    return draw_steps(salt, *keys, seed=seed, method=method).cast("double") / F.lit(float(STEPS))
