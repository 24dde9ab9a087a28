"""The schema-registry header of a message: magic byte, schema id, and the
message index path of Protobuf."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidelog.functions.columns import rarely

HEADER = 5
# at most 16 indexes of at most 10 bytes, and their count or terminator
_INDEX_BYTES = 170
_MAX_COUNT = 10
_MAX_TERMINATED = 16
_TO_END = (1 << 31) - 1
_PATH = "struct<path:array<bigint>,skip:int>"


def has_header(value: Column, wire_format: str = "auto") -> Column:
    """``auto`` takes any payload over 5 bytes that starts with 0x00 as framed."""
    if wire_format == "raw":
        return F.lit(False)
    framed = (F.octet_length(value) > HEADER) & (F.substring(value, 1, 1) == F.lit(bytearray(b"\0")))
    return F.coalesce(framed, F.lit(False))


def schema_id(value: Column) -> Column:
    """Big-endian unsigned 32-bit id after the magic byte."""
    return F.conv(F.hex(F.substring(value, 2, 4)), 16, 10).cast("bigint")


def body(value: Column, wire_format: str = "auto") -> Column:
    framed = has_header(value, wire_format)
    return F.when(framed, F.substring(value, HEADER + 1, _TO_END)).otherwise(value)


def header_columns(value: Column, wire_format: str = "auto") -> dict[str, Column]:
    framed = has_header(value, wire_format)
    return {
        "schema_id": F.when(framed, schema_id(value)),
        "payload": body(value, wire_format),
    }


def with_header(schema: int, payload: Column, index: Column | None = None) -> Column:
    """Frame ``payload``: 0x00, the id, then for Protobuf a count of one and
    the message index (below 128)."""
    head = F.lit(bytearray(b"\0" + schema.to_bytes(4, "big")))
    if index is None:
        return F.concat(head, payload)
    return F.concat(head, F.lit(bytearray(b"\1")), F.unhex(F.lpad(F.hex(index), 2, "0")), payload)


def message_index(framed: Column) -> Column:
    """``STRUCT<path ARRAY<BIGINT>, skip INT>`` of the bytes after the header.

    A single 0x00 is the first message; else the count-prefixed form, then the
    zero-terminated one, then a single index. NULL when no form fits. The two
    short forms are plain byte tests, the rest goes byte by byte.
    """
    first = F.conv(F.hex(F.substring(framed, 1, 1)), 16, 10).cast("int")
    second = F.conv(F.hex(F.substring(framed, 2, 1)), 16, 10).cast("int")
    return (
        F.when(first == 0, _path(F.array(F.lit(0)), F.lit(1)))
        .when(
            (first == 1) & (F.octet_length(framed) > 1) & (second < 128),
            _path(F.array(second), F.lit(2)),
        )
        .otherwise(rarely(F.substring(framed, 1, _INDEX_BYTES), _general_index))
    )


def _path(indexes: Column, skip: Column) -> Column:
    return F.struct(
        indexes.cast("array<bigint>").alias("path"), skip.cast("int").alias("skip")
    ).cast(_PATH)


def _general_index(data: Column) -> Column:
    return rarely(_varints(data), _choose_form)


def _choose_form(numbers: Column) -> Column:
    def value(i: Column | int) -> Column:
        return F.get(numbers, i)["value"]

    values = F.transform(numbers, lambda n: n["value"])
    count = value(0)
    size = count.cast("int")
    # a number that does not fit ends the list as -1; no form may contain it
    complete = F.size(numbers) - F.when(F.get(values, F.size(values) - 1) < 0, 1).otherwise(0)
    counted = count.between(1, _MAX_COUNT) & (complete > count)
    by_count = _path(F.slice(values, F.lit(2), size), F.get(numbers, size)["end"])
    zero = F.array_position(values, 0).cast("int")
    terminated = zero.between(2, _MAX_TERMINATED + 1)
    by_zero = _path(F.slice(values, F.lit(1), zero - 1), F.get(numbers, zero - 1)["end"])
    return (
        F.when(counted, by_count)
        .when(terminated, by_zero)
        .when((complete > 0) & (complete == F.size(numbers)), _path(F.array(count), F.get(numbers, 0)["end"]))
    )


def _varints(data: Column) -> Column:
    """Unsigned base-128 numbers at the start of ``data`` with the position
    after each. Reading stops at one that does not fit 63 bits, which is -1."""
    text = F.hex(data)
    places = F.sequence(F.lit(1), F.greatest(F.octet_length(data), F.lit(1)))
    empty = F.struct(
        F.array().cast("array<struct<value:bigint,end:int>>").alias("done"),
        F.lit(0).cast("bigint").alias("value"),
        F.lit(0).alias("shift"),
        F.lit(True).alias("open"),
    )

    def step(state: Column, place: Column) -> Column:
        byte = F.conv(F.substring(text, place * 2 - 1, F.lit(2)), 16, 10).cast("int")
        fits = state["shift"] <= 56
        low = F.when(fits, F.call_function("shiftleft", (byte % 128).cast("bigint"), state["shift"]))
        total = state["value"] + F.coalesce(low, F.lit(0))
        ended = byte < 128
        number = F.when(fits, total).otherwise(F.lit(-1).cast("bigint"))
        done = F.concat(
            state["done"], F.array(F.struct(number.alias("value"), place.cast("int").alias("end")))
        )
        read = state["open"] & byte.isNotNull()
        go = read & fits
        return F.struct(
            F.when(go & ended | read & ~fits, done).otherwise(state["done"]).alias("done"),
            F.when(go & ~ended, total).otherwise(F.lit(0).cast("bigint")).alias("value"),
            F.when(go & ~ended, state["shift"] + 7).otherwise(F.lit(0)).alias("shift"),
            go.alias("open"),
        )

    return F.aggregate(places, empty, step, lambda state: state["done"])
