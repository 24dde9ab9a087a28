"""The reason why a line-protocol line is bad, as text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidelog.functions import lp_patterns as P
from tidelog.functions.columns import let
from tidelog.functions.lp_values import is_bad

_HEAD = rf"(?s)^({P.MEASUREMENT})({P.TAGS})"
_WHOLE_FIELD = rf"{P.KEY}={P.FIELD_VALUE}(?=[, ]|$)"
_DONE_FIELDS = rf"(?s)^(?:{_WHOLE_FIELD}(?:,{_WHOLE_FIELD})*+)?+"
_NEXT_FIELD = rf"(?s)^,?({P.KEY})(=?)(.*)$"
_CLOSED_QUOTE = rf"(?s)^{P.QUOTED}(.)"


def _quoted(text: Column) -> Column:
    escaped = F.replace(F.replace(text, F.lit("\\"), F.lit("\\\\")), F.lit('"'), F.lit('\\"'))
    return F.concat(F.lit('"'), escaped, F.lit('"'))


def _number_reason(pair: Column) -> Column:
    key = F.regexp_extract(pair, P.SPLIT_FIELD, 1)
    raw = F.regexp_extract(pair, P.SPLIT_FIELD, 2)
    body = F.substring(raw, F.lit(1), F.length(raw) - 1)

    def says(kind: str, parser: str, shown: Column, syntax: str) -> Column:
        why = F.when(shown.rlike(syntax), "value out of range").otherwise("invalid syntax")
        return F.concat(
            F.lit(f"invalid {kind} "), _quoted(raw), F.lit(f": strconv.{parser}: parsing "),
            _quoted(shown), F.lit(": "), why,
        )

    reason = (
        F.when(raw.endswith("i"), says("integer", "ParseInt", body, P.INTEGER))
        .when(raw.endswith("u"), says("unsigned", "ParseUint", body, P.UNSIGNED))
        .otherwise(says("number", "ParseFloat", raw, P.FLOAT))
    )
    return F.concat(F.lit("field "), _quoted(key), F.lit(": "), reason)


def _next_field_reason(rest: Column) -> Column:
    key = F.regexp_extract(rest, _NEXT_FIELD, 1)
    equals = F.regexp_extract(rest, _NEXT_FIELD, 2)
    value = F.regexp_extract(rest, _NEXT_FIELD, 3)
    after = F.regexp_extract(value, _CLOSED_QUOTE, 1)
    in_value = F.concat(F.lit("field value for "), _quoted(key), F.lit(": "))
    return (
        F.when(equals == "", F.concat(F.lit("field "), _quoted(key), F.lit(" missing '='")))
        .when(value == "", F.concat(in_value, F.lit("empty field value")))
        .when(
            value.startswith('"') & (after != ""),
            F.concat(in_value, F.lit("unexpected byte '"), after, F.lit("' after quoted string")),
        )
        .when(value.startswith('"'), F.concat(in_value, F.lit("unterminated quoted string")))
        .otherwise(F.concat(F.lit("field "), _quoted(key), F.lit(": empty value")))
    )


def _time_reason(rest: Column) -> Column:
    text = F.trim(rest, F.lit(P.SPACES))
    why = F.when(text.rlike(P.INTEGER), "value out of range").otherwise("invalid syntax")
    return F.concat(
        F.lit("timestamp "), _quoted(text), F.lit(": strconv.ParseInt: parsing "), _quoted(text),
        F.lit(": "), why,
    )


def _fields_reason(fields: Column) -> Column:
    pairs = F.regexp_extract_all(fields, F.lit(P.EACH_FIELD), F.lit(1))
    wrong = F.filter(pairs, lambda kv: let(F.regexp_extract(kv, P.SPLIT_FIELD, 2), is_bad))
    rest = F.regexp_replace(fields, _DONE_FIELDS, "")
    return (
        F.when(F.size(wrong) > 0, _number_reason(F.get(wrong, 0)))
        .when(rest.startswith(" "), _time_reason(rest))
        .otherwise(_next_field_reason(rest))
    )


def line_error(text: Column, number: Column, default: str) -> Column:
    """``line N: <reason>`` for the bad line ``text``; ``default`` where the
    payload has no line at all (``number`` below 1)."""
    tags = F.regexp_extract(text, _HEAD, 2)
    rest = F.regexp_replace(text, _HEAD, "")
    reason = (
        F.when(~text.rlike(rf"(?s)^{P.MEASUREMENT}"), "empty measurement")
        .when((rest == "") & (tags == ""), "no fields")
        .when(rest == "", "tag \"\" missing '='")
        .when(
            rest.startswith(","),
            F.concat(F.lit("tag "), _quoted(F.substring(rest, 2, (1 << 31) - 1)), F.lit(" missing '='")),
        )
        .otherwise(_fields_reason(F.substring(rest, 2, (1 << 31) - 1)))
    )
    numbered = F.concat(F.lit("line "), number.cast("string"), F.lit(": "), reason)
    return F.when(number < 1, default).otherwise(numbered)
