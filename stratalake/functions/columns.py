"""Small column expressions used by the transforms and the analytics."""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce
from operator import and_, or_

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField

from stratalake.functions.numeric import PLAIN

# Brand tiers, event types, payment labels, airport rate codes.
PREMIUM_BRANDS = ("samsung", "apple", "huawei")
MID_BRANDS = ("xiaomi", "lg", "sony")
EVENT_TYPES = ("view", "cart", "purchase")
PAYMENT_LABELS = {1: "Credit Card", 2: "Cash", 3: "No Charge", 4: "Dispute"}
AIRPORT_RATE_CODES = (2, 3)

_WHOLE_WITH_FRACTION = r"^\s*[+-]?\d+\.\d*\s*$"
_INTEGRAL = ("bigint", "int", "smallint", "tinyint")


def lenient_cast(source: StructField, target: StructField) -> Column:
    """Cast that gives NULL for unreadable values instead of raising.

    Text such as ``12.50`` still becomes the integer 12, as in a non-ANSI cast. A column that has
    the type already is passed on as it is, so filters on it reach the scan.
    """
    c, type_name = F.col(target.name), target.dataType.simpleString()
    if source.dataType == target.dataType:
        return c
    cast = c.try_cast(type_name)
    if isinstance(source.dataType, StringType) and type_name in _INTEGRAL:
        whole = F.when(c.rlike(_WHOLE_WITH_FRACTION), F.substring_index(c, ".", 1))
        cast = F.coalesce(cast, whole.try_cast(type_name))
    return cast.alias(target.name)


def digits_only(c: Column) -> Column:
    return F.regexp_replace(c, r"[^0-9]", "")


def full_name(first: str, last: str) -> Column:
    return F.concat_ws(" ", first, last)


def brand_tier(c: Column) -> Column:
    return (
        F.when(c.isin(*PREMIUM_BRANDS), "premium").when(c.isin(*MID_BRANDS), "mid").otherwise("other")
    )


def payment_label(c: Column) -> Column:
    """Label of a payment type; valid codes without a label read ``Unknown`` like all others."""
    (first, label), *rest = PAYMENT_LABELS.items()
    chain = F.when(c == first, label)
    for code, label in rest:
        chain = chain.when(c == code, label)
    return chain.otherwise("Unknown")


def minutes_between(start: str, end: str, math=PLAIN) -> Column:
    seconds = F.unix_timestamp(end) - F.unix_timestamp(start)
    return math.round(seconds / 60, 1)


def hour_stamp(c: Column) -> Column:
    """Folder name of the hour, ``2024-01-31_09``."""
    return F.date_format(c, "yyyy-MM-dd_HH")


def hour_parts(c: Column) -> dict[str, Column]:
    """Partition columns of an hourly layout."""
    return {"year": F.year(c), "month": F.month(c), "day": F.dayofmonth(c), "hour": F.hour(c)}


def any_of(conditions: Iterable[Column]) -> Column:
    return reduce(or_, conditions)


def all_of(conditions: Iterable[Column]) -> Column:
    return reduce(and_, conditions)


def same_keys(left: str, right: str, keys: Iterable[str]) -> Column:
    """Composite equi-join condition between two aliased frames."""
    return all_of(F.col(f"{left}.{k}") == F.col(f"{right}.{k}") for k in keys)
