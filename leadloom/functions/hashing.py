"""A portable hash that stands in for random draws."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

HASH_RANGE = 2**32
FOLD = 2**31
# Two multiply and shift rounds; every product stays inside BIGINT.
FIRST_FACTOR, FIRST_SHIFT = 2654435761, 15
SECOND_FACTOR, SECOND_SHIFT = 99338871, 13
SEED_STEP = 1000003


def _long(value: int) -> Column:
    return F.lit(value).cast("bigint")


def portable_hash(key: Column | str, seed: int = 0) -> Column:
    """A seeded number in [0, 2^32) for an integer key; plain SQL can compute the same."""
    key = F.col(key) if isinstance(key, str) else key
    mixed = F.pmod(key.cast("bigint"), _long(FOLD)) * _long(FIRST_FACTOR) + _long(seed * SEED_STEP % HASH_RANGE)
    mixed = F.pmod(mixed, _long(HASH_RANGE))
    mixed = mixed.bitwiseXOR(F.shiftright(mixed, FIRST_SHIFT))
    mixed = F.pmod(mixed * _long(SECOND_FACTOR) + _long(seed), _long(HASH_RANGE))
    return mixed.bitwiseXOR(F.shiftright(mixed, SECOND_SHIFT))
