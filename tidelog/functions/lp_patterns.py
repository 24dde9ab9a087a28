"""Regular expressions of the line-protocol grammar.

Patterns are possessive throughout, so a line is scanned once and a mismatch
never backtracks. They are passed to Spark as string literals of the DataFrame
API (no SQL un-escaping).
"""

from __future__ import annotations

# white space that is trimmed from both ends of a line
SPACE = r"[\s\u0085\p{Z}]"
SPACES = " \t\n\v\f\r\u0085\u00a0\u1680" + "".join(map(chr, range(0x2000, 0x200B))) + (
    "\u2028\u2029\u202f\u205f\u3000"
)

# --- any legal line: backslash escapes, quoted strings ---------------------
MEASUREMENT = r"(?:\\.|[^, ])++"
KEY = r"(?:\\.|[^=])*+"
TAG_VALUE = r"(?:\\.|[^, ])*+"
QUOTED = r'"(?:\\["\\]|[^"])*+"'
FIELD_VALUE = rf'(?:{QUOTED}|(?!")(?:\\.|[^, ])++)'
TAGS = rf"(?:,{KEY}={TAG_VALUE})*+"
FIELDS = rf"{KEY}={FIELD_VALUE}(?:,{KEY}={FIELD_VALUE})*+"
ANY_LINE = rf"(?s)^({MEASUREMENT})({TAGS}) ({FIELDS})(?: {SPACE}*+([+-]?\d++)?+{SPACE}*+)?+$"
EACH_TAG = rf"(?s)\G,({KEY})=({TAG_VALUE})"
EACH_FIELD = rf"(?s)\G(?:^|,)({KEY}={FIELD_VALUE})"
SPLIT_FIELD = rf"(?s)^({KEY})=(.*)$"

# --- the common line: simple names, values that are certainly valid --------
# Unrolled and possessive: no step is ever taken back. It is applied to a whole
# message, so no part may run over a line end or contain the mark.
MARK = "\u0001"
_IN_LINE = r"\n\u0001"
_ESCAPED = rf"\\[^{_IN_LINE}]"
PLAIN_INT = r"[+-]?+(?:[0-8]\d{18}|\d{1,18})(?!\d)"
PLAIN_BOOL = r"(?:true|false|True|False|TRUE|FALSE|[tTfF])"
_EXPONENT = r"(?:[eE][+-]?+\d{1,2}+)?+"
_NUMBER = rf"[+-]?+(?:\d{{1,18}}+(?:i|(?:\.\d{{0,99}}+)?+{_EXPONENT})|\.\d{{1,99}}+{_EXPONENT})"
_VALUE_END = r"(?=[, \t\r\n]|\z)"
_PLAIN_QUOTED = rf'"(?:\\["\\]|[^"{_IN_LINE}])*+"'
PLAIN_VALUE = rf"(?:(?:{_NUMBER}|\d{{1,18}}+u|{PLAIN_BOOL}){_VALUE_END}|{_PLAIN_QUOTED})"
PLAIN_KEY = rf'[^=, \\"{_IN_LINE}]*+(?:{_ESCAPED}[^=, \\"{_IN_LINE}]*+)*+'
_PLAIN_TAG = rf"{PLAIN_KEY}=[^, =\\{_IN_LINE}]*+(?:{_ESCAPED}[^, =\\{_IN_LINE}]*+)*+"
PLAIN_FIELD = rf"{PLAIN_KEY}={PLAIN_VALUE}"
# a blank line or a comment matches too and leaves all four groups empty
_FULL_LINE = (
    rf"((?!#|{SPACE})[^, \\{_IN_LINE}]++(?:{_ESCAPED}[^, \\{_IN_LINE}]*+)*+)"
    rf"((?:,{_PLAIN_TAG})*+) ({PLAIN_FIELD}(?:,{PLAIN_FIELD})*+)"
    rf"(?: [ \t]*+({PLAIN_INT})?+)?+[ \t\r]*+"
)
PLAIN_LINE = rf"(?md)^[ \t]*+(?:{_FULL_LINE}|(?:#[^{_IN_LINE}]*+|\r*+))$"
# a text that begins with a good common line
GOOD_START = rf"(?md)\A[ \t]*+{_FULL_LINE}$"
EACH_PLAIN_FIELD = r'\G(?:^|,)([^=]++=(?:"[^"]*+"|[^,]++))'

# --- single values ---------------------------------------------------------
INTEGER = r"^[+-]?\d+$"
UNSIGNED = r"^\d+$"
_DIGITS = r"\d+(?:_\d+)*"
_HEX = r"[0-9a-f]+(?:_[0-9a-f]+)*"
INFINITY = r"(?i)^[+-]?inf(?:inity)?$"
FLOAT = (
    r"(?i)^(?:nan|[+-]?inf(?:inity)?"
    rf"|[+-]?(?:{_DIGITS}\.?(?:{_DIGITS})?|\.{_DIGITS})(?:e[+-]?{_DIGITS})?"
    rf"|[+-]?0x_?(?:{_HEX}\.?(?:{_HEX})?|\.{_HEX})p[+-]?{_DIGITS})$"
)

TRUE_WORDS = ("t", "T", "true", "True", "TRUE")
FALSE_WORDS = ("f", "F", "false", "False", "FALSE")
