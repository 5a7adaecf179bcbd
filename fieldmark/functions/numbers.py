"""Row-level number and code functions.  All stay inside generated code."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def threshold_flag(value: Column, limit: float) -> Column:
    """1 where the value is above the limit; 0 elsewhere, also for NULL."""
    return F.when(value > limit, 1).otherwise(0)


def truncate_number(value: Column) -> Column:
    """Whole part, cut toward zero."""
    return value.cast("int")


def smoothed_ratio(total: Column, unique: Column) -> Column:
    """total / (unique + 1): defined for customers without any distinct value."""
    return total.cast("double") / (unique + F.lit(1))


def log_value(value: Column) -> Column:
    """Natural logarithm; NULL outside its domain."""
    return F.when(value > 0, F.log(value))


def exp_value(value: Column) -> Column:
    return F.exp(value)


def factor_index(value: Column, levels: Sequence) -> Column:
    """0-based place in the declared levels; NULL for a value not declared."""
    place = F.array_position(F.array(*[F.lit(v) for v in levels]), value)
    return F.when(place > 0, (place - 1).cast("int"))


def relabel(value: Column, names: Mapping) -> Column:
    """Recode by a fixed map; NULL for a code without a name."""
    pairs = [F.lit(x) for item in names.items() for x in item]
    return F.try_element_at(F.create_map(*pairs), value)


def safe_divide(top: Column, bottom: Column) -> Column:
    """NULL where the divisor is 0 or NULL."""
    return F.try_divide(top.cast("double"), bottom.cast("double"))


def outer_product(left: Column, right: Column) -> Column:
    """All products of two arrays, the left index running slowest."""
    return F.flatten(F.transform(left, lambda x: F.transform(right, lambda y: x * y)))


def hash_percent(key: Column) -> Column:
    """0..99 from md5(key): the same split on every engine and every run."""
    head = F.substring(F.md5(key.cast("string")), 1, 8)
    return F.conv(head, 16, 10).cast("bigint") % 100


def hash_order(key: Column) -> Column:
    """An order that has nothing to do with the key itself."""
    return F.md5(key.cast("string"))
