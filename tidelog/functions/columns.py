"""Small Column helpers shared by the operators."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """Evaluate ``value`` once per row and use it several times in ``body``.

    Spark inlines a column that is referenced inside a lambda, which would
    repeat an expensive parse; a one-element ``transform`` binds it instead.
    """
    return F.transform(F.array(value), body)[0]


def rarely(value: Column, body: Callable[[Column], Column]) -> Column:
    """A :func:`let` for a branch that few rows take.

    A lambda is interpreted, so a long expression in it does not grow the
    generated code of the common branch past what the JVM compiles.
    """
    return let(value, body)


def quote(name: str) -> str:
    """Column reference for a name that may contain dots or backticks."""
    return "`" + name.replace("`", "``") + "`"


def ref(name: str) -> Column:
    return F.col(quote(name))


def is_empty(value: Column) -> Column:
    """True for a null or zero-length payload."""
    return F.coalesce(F.octet_length(value), F.lit(0)) == 0


_ORDER = "decimal(38,0)"


def message_order(time: Column, offset: Column) -> Column:
    """(time, offset) of one partition as a DECIMAL that sorts the same way.

    A number is an aggregation buffer Spark can update in place, so "latest"
    and "first" stay hash aggregates; a struct would make it sort all rows.
    Any time and any offset fit; partitions are compared afterwards, on the
    one row that each of them has left.
    """
    micros = F.unix_micros(time).cast("decimal(19,0)") * F.lit(str(10**19)).cast("decimal(20,0)")
    return (micros.cast(_ORDER) + offset.cast("decimal(19,0)")).cast(_ORDER)


def line_order(partition: Column, offset: Column, line: Column) -> Column:
    """(partition, offset, line) as one DECIMAL that sorts the same way: 31, 63
    and 31 bits."""
    high = partition.cast("decimal(10,0)") * F.lit(str(2**63)).cast("decimal(19,0)")
    place = (high + offset.cast("decimal(19,0)")).cast("decimal(29,0)")
    wide = (place * F.lit(2**31).cast("decimal(10,0)")).cast(_ORDER)
    return (wide + line.cast("decimal(10,0)")).cast(_ORDER)
