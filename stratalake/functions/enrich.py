"""Filling attribute columns from value lists.

``pick`` depends on the key alone, so a row gets the same value in every task retry, every
evaluation of a lazy plan and every run. The values of ``random_pick`` change between evaluations.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Sample attribute lists.
FIRST_NAMES = ("Ada", "Boris", "Chen", "Dana", "Elif", "Farid", "Greta", "Hugo", "Ines", "Jonas", "Kira")
LAST_NAMES = ("Abel", "Brandt", "Costa", "Dumas", "Eriksen", "Fofana", "Gruber", "Hansen", "Ito")
PHONE_PREFIXES = ("201", "305", "415", "512", "617", "702", "808")


def pick(values: Sequence[str], *keys: str, salt: str = "") -> Column:
    return _element(values, F.pmod(F.xxhash64(F.lit(salt), *keys), F.lit(len(values))))


def keyed_phone(*keys: str) -> Column:
    digits = F.pmod(F.xxhash64(F.lit("line"), *keys), F.lit(10_000_000)).cast("string")
    return F.concat(pick(PHONE_PREFIXES, *keys, salt="prefix"), F.lpad(digits, 7, "0"))


def _element(values: Sequence[str], slot: Column) -> Column:
    return F.element_at(F.array(*[F.lit(v) for v in values]), (slot + 1).cast("int"))


def random_pick(values: Sequence[str]) -> Column:
    """Any value, another one in every evaluation."""
    return _element(values, F.floor(F.rand() * len(values)))


def vectorised_pick(values: Sequence[str], key: str) -> Column:
    """The value that a whole-number key falls on; NULL for a NULL key."""
    return F.when(F.col(key).isNotNull(), _element(values, F.pmod(F.col(key), F.lit(len(values)))))
