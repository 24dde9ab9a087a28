"""Filters on measurement, field and tags of line-protocol rows.

Each axis is a comma-separated list of anchored patterns; an empty axis matches
everything and the axes are combined with AND.
"""

from __future__ import annotations

import re
from dataclasses import dataclass
from functools import reduce
from operator import or_

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F


def _legal_re2(pattern: str) -> bool:
    """RE2 decides what a pattern is; Java alone would accept more."""
    try:
        pc.match_substring_regex(pa.array([""]), f"^(?:{pattern})$")
    except pa.ArrowInvalid:
        return False
    return True


def _legal_java(spark: SparkSession, pattern: str) -> bool:
    """A bad pattern fails the query, so try it on one row first."""
    try:
        spark.range(1).select(F.lit("").rlike(pattern)).collect()
    except Exception as error:  # the class differs between classic and Connect
        if "PATTERN" in str(error).upper():
            return False
        raise
    return True


def _java_body(pattern: str) -> str:
    """RE2 spelling to Java's: named groups, POSIX classes."""
    named = re.sub(r"\(\?P<", "(?<", pattern)
    return re.sub(
        r"\[:(\^?)(\w+):\]",
        lambda m: rf"\{'P' if m[1] else 'p'}{{{_POSIX.get(m[2], m[2].capitalize())}}}",
        named,
    )


def _java_pattern(pattern: str) -> str:
    """The whole text, with line ends as RE2 has them."""
    return rf"(?d)^(?:{_java_body(pattern)})\z"


# fixed values: POSIX class names whose Java property is not the capitalised name
_POSIX = {"xdigit": "XDigit", "alnum": "Alnum"}


def compile_pattern(spark: SparkSession, pattern: str) -> str | None:
    """Anchored Java regex, or None when ``pattern`` is to match literally."""
    if not _legal_re2(pattern):
        return None
    java = _java_pattern(pattern)
    return java if _legal_java(spark, java) else None


def split_patterns(text: str) -> list[str]:
    return [p.strip() for p in text.split(",") if p.strip()]


def split_tag_patterns(text: str) -> dict[str, list[str]]:
    """``key=pattern,…`` by key. Entries without ``=`` or with a blank side
    are ignored."""
    by_key: dict[str, list[str]] = {}
    for part in text.split(","):
        key, equals, pattern = part.partition("=")
        if equals and key.strip() and pattern.strip():
            by_key.setdefault(key.strip(), []).append(pattern.strip())
    return by_key


# What a pattern may consist of to be tried inside a line: nothing that asks for
# the end of the text, looks around or changes how the rest is read.
_SIMPLE = re.compile(r"(?:[\w\-./%:@*+?|()\[\]]|\\[dws.\-/])*")


def _inside(spark: SparkSession, patterns: list[str]) -> str | None:
    """The patterns as one Java pattern to be met inside a line, or None if one
    of them cannot be read there as it is for a whole name."""
    parts = []
    for pattern in patterns:
        if pattern.isalnum():
            parts.append(pattern)
        elif compile_pattern(spark, pattern) is None:
            parts.append(r"\Q" + pattern + r"\E" if r"\E" not in pattern else ".*")
        elif _SIMPLE.fullmatch(pattern) and not re.search(r"\(\?|\[:|\[[^\]]*\[", pattern):
            parts.append(f"(?:{pattern})")
        else:
            return None
    return "(?:" + "|".join(parts) + ")"


def _any_match(spark: SparkSession, value: Column, patterns: list[str]) -> Column:
    """One test for all patterns: ``value`` is often an expression, and each
    test of its own would repeat it in the generated code, which the JVM does
    not compile past a size."""
    java = {p: None if p.isalnum() else compile_pattern(spark, p) for p in patterns}
    if not any(java.values()):  # plain words: equality is cheaper than a regex
        return value.isin(*patterns)
    if len(patterns) == 1:
        return value.rlike(java[patterns[0]])
    if any("(?<" in (j or "") or "\\E" in p for p, j in java.items()):
        # names of groups may meet
        return reduce(or_, [value == p if j is None else value.rlike(j) for p, j in java.items()])
    parts = [rf"\Q{p}\E" if j is None else f"(?:{_java_body(p)})" for p, j in java.items()]
    return value.rlike(rf"(?d)^(?:{'|'.join(parts)})\z")


@dataclass(frozen=True)
class LineFilter:
    measurements: str = ""
    fields: str = ""
    tags: str = ""

    def on_line(self, spark: SparkSession, measurement: Column, tags: Column) -> Column | None:
        """Conditions that need no field, usable before the field explode."""
        tests = []
        wanted = split_patterns(self.measurements)
        if wanted:
            tests.append(_any_match(spark, measurement, wanted))
        for key, patterns in split_tag_patterns(self.tags).items():
            value = F.try_element_at(tags, F.lit(key))
            tests.append(F.coalesce(_any_match(spark, value, patterns), F.lit(False)))
        return reduce(lambda a, b: a & b, tests) if tests else None

    def other_lines(self, spark: SparkSession) -> str | None:
        """A pattern of whole lines that the filter cannot let through, or None.

        It looks at the raw text: the head for the measurement, anywhere for
        tags and fields. Every line that might pass is left alone: names and
        values are only met as written, so a line with a backslash stays, and
        so does one that does not start with a plain character.
        """
        wanted = []
        names = split_patterns(self.measurements)
        if names and (inside := _inside(spark, names)):
            wanted.append(f"{inside}[, ]")
        for key, patterns in split_tag_patterns(self.tags).items():
            if not re.search(r"[\s,=\\]", key) and (inside := _inside(spark, patterns)):
                wanted.append(rf"[^\n]*?,\Q{key}\E={inside}[, ]" if r"\E" not in key else "")
        names = split_patterns(self.fields)
        if names and (inside := _inside(spark, names)):
            wanted.append(rf"[^\n]*?[, ]{inside}=")
        if not any(wanted):
            return None
        may_pass = "".join(f"(?={w})" for w in wanted)
        return rf"(?md)^(?![^\n]*\\|[^\n\x21-\x7e]|{may_pass})[^\n]++"

    def on_field(self, spark: SparkSession, field: Column) -> Column | None:
        wanted = split_patterns(self.fields)
        return _any_match(spark, field, wanted) if wanted else None
