"""Single line-protocol values: validity, number and text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidelog.functions import lp_patterns as P

EXACT_DOUBLE_INT = 9007199254740991
MAX_UINT64 = 18446744073709551615


def _without_suffix(raw: Column) -> Column:
    return F.substring(raw, F.lit(1), F.length(raw) - 1)


def _as_double(raw: Column) -> Column:
    plain = F.when(raw.contains("_"), F.replace(raw, F.lit("_"), F.lit(""))).otherwise(raw)
    return plain.try_cast("double")


def is_bad(raw: Column) -> Column:
    """True for an unquoted value that is no integer, boolean or float, or
    that does not fit its type."""
    body = _without_suffix(raw)
    integer = body.rlike(P.INTEGER) & body.try_cast("bigint").isNotNull()
    limit = F.lit(str(MAX_UINT64)).cast("decimal(38,0)")
    unsigned = body.rlike(P.UNSIGNED) & (body.try_cast("decimal(38,0)") <= limit)
    overflow = (F.abs(_as_double(raw)) == float("inf")) & ~raw.rlike(P.INFINITY)
    good = (
        F.when(raw.startswith('"'), True)
        .when(raw.endswith("i"), integer)
        .when(raw.endswith("u"), unsigned)
        .when(raw.isin(*P.TRUE_WORDS, *P.FALSE_WORDS), True)
        .otherwise(raw.rlike(P.FLOAT) & ~overflow)
    )
    return ~F.coalesce(good, F.lit(False))


def field_value(raw: Column) -> tuple[Column, Column]:
    """``value`` and ``value_str`` of a valid field value.

    Numbers and booleans go to ``value``, strings to ``value_str``, and so do
    whole numbers that a double cannot hold exactly.
    """
    last = F.substring(raw, -1, 1)
    # the usual number first: no other kind of value ends in a digit
    usual = last.between("0", "9")
    quoted = raw.startswith('"')
    inner = F.substring(raw, F.lit(2), F.length(raw) - 2)
    text = F.when(
        inner.contains("\\"), F.regexp_replace(inner, r'\\(["\\])', "$1")
    ).otherwise(inner)
    # a whole number is exact if its double is: beyond the last exact one no
    # double comes back below it. One cast for signed and unsigned keeps the
    # generated code small; 0.0 is added as "-0i" is 0
    whole = last.isin("i", "u")
    digits = _without_suffix(raw)
    near = digits.try_cast("double")
    exact = F.abs(near) <= float(EXACT_DOUBLE_INT)
    number = (
        F.when(usual, _as_double(raw))
        .when(quoted, F.lit(None).cast("double"))
        .when(whole, F.when(exact, near + F.lit(0.0)))
        .when(raw.isin(*P.TRUE_WORDS), 1.0)
        .when(raw.isin(*P.FALSE_WORDS), 0.0)
        .otherwise(_as_double(raw))
    )
    string = (
        F.when(usual, F.lit(None).cast("string"))
        .when(quoted, text)
        .when(whole & ~exact, digits.try_cast("decimal(20,0)").cast("string"))
    )
    return number, string
