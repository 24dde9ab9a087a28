"""The key hash by which producers choose a partition, as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidelog.functions.columns import let

# fixed values: multiplier, shift and seed of the 32-bit MurmurHash2 of producers
_M = 0x5BD1E995
_SHIFT = 24
_SEED = 0x9747B28C
_MASK = 0xFFFFFFFF
_POSITIVE = 0x7FFFFFFF


def _times(x: Column) -> Column:
    """32-bit product; x is below 2^32 and the factor below 2^31, so it fits a long."""
    return (x * F.lit(_M).cast("bigint")).bitwiseAND(F.lit(_MASK).cast("bigint"))


def _folded(x: Column, bits: int) -> Column:
    return let(x, lambda k: k.bitwiseXOR(F.shiftrightunsigned(k, bits)))


def _byte(digits: Column, at: Column) -> Column:
    """Byte ``at`` (from 0) of a hex text."""
    return F.conv(F.substr(digits, at * 2 + 1, F.lit(2)), 16, 10).cast("bigint")


def murmur2(key: Column) -> Column:
    """Unsigned 32-bit hash of bytes as a long; NULL for NULL."""

    def of(digits: Column) -> Column:
        length = F.call_function("div", F.length(digits), F.lit(2)).cast("int")
        words = F.call_function("div", length, F.lit(4)).cast("int")

        def word(i: Column) -> Column:
            parts = [F.substr(digits, i * 8 + at, F.lit(2)) for at in (7, 5, 3, 1)]
            number = F.conv(F.concat(*parts), 16, 10).cast("bigint")
            return _times(_folded(_times(number), _SHIFT))

        mixed = F.when(words > 0, F.transform(F.sequence(F.lit(0), words - 1), word)).otherwise(
            F.array().cast("array<bigint>")
        )
        seed = F.lit(_SEED).cast("bigint").bitwiseXOR(length.cast("bigint"))
        body = F.aggregate(mixed, seed, lambda h, k: _times(h).bitwiseXOR(k))
        left = length - words * 4

        def tail(h: Column) -> Column:
            for i in (2, 1, 0):
                rest = F.shiftleft(_byte(digits, words * 4 + i), 8 * i)
                h = h.bitwiseXOR(F.when(left > i, rest).otherwise(F.lit(0).cast("bigint")))
            return F.when(left > 0, _times(h)).otherwise(h)

        return _folded(_times(_folded(let(body, tail), 13)), 15)

    return let(F.hex(key), of)


def key_partition(key: Column, partitions: Column | int) -> Column:
    """The partition of a key, as producers choose it; NULL for NULL."""
    count = F.lit(partitions) if isinstance(partitions, int) else partitions
    return (murmur2(key).bitwiseAND(F.lit(_POSITIVE).cast("bigint")) % count).cast("int")
