"""URL filters by a bit-parallel wildcard automaton.

Glob rules over the canonical URL (``.`` host path) become the bits of one
Shift-And automaton that spans several 64-bit words: a bit per pattern
position, a mask of positions per input byte, and a second mask of the
positions that stay set on a byte (wildcards). One pass over the bytes of a
URL simulates all rules at once; a batch of URLs runs as NumPy vectors.

Globs: ``*`` matches any run of bytes without ``/``, ``**`` any run of bytes,
``?`` one byte other than ``/``; a match must reach the end of the URL.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidelog.llm.common import free_prefix, ref

ALLOW, BLOCK = "allow", "block"


@dataclass(frozen=True)
class Rule:
    """``text`` is host and path prefix, as in ``example.org/es/``."""

    verdict: str
    text: str

    def glob(self) -> str:
        return f"*.{self.text}**"


#: The rules of the registered query.
RULES = (
    Rule(ALLOW, "org/"),
    Rule(BLOCK, "example.org/es/"),
    Rule(BLOCK, "example.org/en/1"),
    Rule(ALLOW, "com/fr/"),
    Rule(BLOCK, "com/de/"),
)


class ShiftAnd:
    """The automaton of some globs: ``match`` gives a flag per URL and glob.

    A glob of n symbols takes n + 1 positions, the first set before any byte.
    """

    def __init__(self, globs: Sequence[str]):
        symbols: list[bytes | None] = []  # what leads into a position; None where a glob starts
        stays: list[bytes] = []  # the bytes on which a position stays set
        every = bytes(range(256))
        segment = every.replace(b"/", b"")
        ends = []
        for glob in globs:
            symbols.append(None)
            stays.append(b"")
            raw, i = glob.encode(), 0
            while i < len(raw):
                if raw[i : i + 2] == b"**":
                    stays[-1], i = every, i + 2
                elif raw[i : i + 1] == b"*":
                    stays[-1], i = stays[-1] or segment, i + 1
                else:
                    symbols.append(segment if raw[i : i + 1] == b"?" else raw[i : i + 1])
                    stays.append(b"")
                    i += 1
            ends.append(len(symbols) - 1)
        words = len(symbols) // 64 + 1
        self.start = np.zeros(words, np.uint64)
        self.enter = np.zeros((256, words), np.uint64)
        self.stay = np.zeros((256, words), np.uint64)
        for bit, (into, on) in enumerate(zip(symbols, stays, strict=True)):
            word, mask = bit // 64, np.uint64(1 << bit % 64)
            if into is None:
                self.start[word] |= mask
            else:
                self.enter[list(into), word] |= mask
            if on:
                self.stay[list(on), word] |= mask
        self.ends = [(end // 64, np.uint64(end % 64)) for end in ends]

    def match(self, urls: Sequence[bytes]) -> np.ndarray:
        """URLs run by length, so that those that have ended drop out."""
        found = np.zeros((len(urls), len(self.ends)), bool)
        if not len(urls):
            return found
        lengths = np.array([len(u) for u in urls])
        order = np.argsort(-lengths, kind="stable")
        data = np.frombuffer(b"".join(urls[i] for i in order), np.uint8)
        lengths = lengths[order]
        starts = np.concatenate(([0], np.cumsum(lengths)[:-1]))
        state = np.repeat(self.start[None, :], len(urls), axis=0)
        one, top = np.uint64(1), np.uint64(63)
        running = len(urls)
        for at in range(int(lengths[0])):
            running = int(np.searchsorted(-lengths[:running], -at, side="left"))
            byte = data[starts[:running] + at]
            now = state[:running]
            moved = now << one
            moved[:, 1:] |= now[:, :-1] >> top
            state[:running] = (moved & self.enter[byte]) | (now & self.stay[byte])
        for k, (word, bit) in enumerate(self.ends):
            found[order, k] = (state[:, word] >> bit & one).astype(bool)
        return found


#: URLs run through the automaton at a time; memory follows it, results do not.
BATCH_BYTES = 8 << 20


def _verdicts(rules: Sequence[Rule], default: str, column: str):
    machine = ShiftAnd([r.glob() for r in rules])
    # of several rules that fit, the longest; of equal ones, the first
    rank = sorted(range(len(rules)), key=lambda k: (-len(rules[k].text), k))

    def judge(canonical: pd.Series) -> pd.DataFrame:
        raw = [u.encode() for u in canonical]
        best = np.full(len(raw), -1)
        first, size = 0, 0
        for i, u in enumerate([*raw, b""]):
            if i == len(raw) or size + len(u) > BATCH_BYTES and i > first:
                hits = machine.match(raw[first:i])
                for k in reversed(rank):
                    best[first:i][hits[:, k]] = k
                first, size = i, 0
            size += len(u)
        return pd.DataFrame(
            {
                "rule": [rules[k].text if k >= 0 else None for k in best],
                "verdict": [rules[k].verdict if k >= 0 else default for k in best],
            }
        )

    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield judge(batch)

    kind = T.StructType([T.StructField("rule", T.StringType()), T.StructField("verdict", T.StringType())])
    run.__annotations__ = {"batches": Iterator[pd.Series], "return": Iterator[pd.DataFrame]}
    return F.pandas_udf(run, kind)(F.col(column))


def filter_urls(
    df: DataFrame, rules: Sequence[Rule] = RULES, url_col: str = "url", default: str = ALLOW
) -> DataFrame:
    """``df`` with ``host``, ``path``, ``rule`` and ``verdict``.

    A null URL, an empty one and one without ``://`` have an empty host and
    path, fit no rule and get the default. Hosts are lower-cased (A-Z), paths
    are not; query and fragment play no part. Rows are judged one by one, so
    repeated rows keep their number; columns with the name of a result give
    way to it. No shuffle; an empty rule list leaves the default everywhere.
    """
    p = free_prefix(df, "url")
    rest, canonical, judged = f"{p}rest", f"{p}canonical", f"{p}judged"
    kept = [c for c in df.columns if c not in ("host", "path", "rule", "verdict")]
    url = F.coalesce(ref(url_col).cast("string"), F.lit(""))
    at = F.locate("://", url)
    df = df.select(
        *[ref(c) for c in kept],
        F.when(at > 0, F.substring(url, at + 3, F.char_length(url))).otherwise("").alias(rest),
    )
    host = F.translate(
        F.regexp_extract(rest, r"^[^/?#]*", 0), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    )
    path = F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)
    # what follows the host is the path only if it begins with a slash
    df = df.withColumn(f"{p}host", host).withColumn(f"{p}path", path)
    df = df.withColumn(canonical, F.concat(F.lit("."), f"{p}host", f"{p}path"))
    df = df.withColumn(judged, _verdicts(tuple(rules), default, canonical))
    return df.select(
        *[ref(c) for c in kept],
        F.col(f"{p}host").alias("host"),
        F.col(f"{p}path").alias("path"),
        F.col(f"{judged}.rule").alias("rule"),
        F.col(f"{judged}.verdict").alias("verdict"),
    )
