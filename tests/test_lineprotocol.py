import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tidelog.operators.encode import LineSpec, encode_lines
from tidelog.operators.lineprotocol import (
    LineOptions,
    lp_long,
    lp_pivot,
    lp_tag_keys,
    lp_wide,
    tag_column_names,
)


def rows(df, **options):
    got = lp_long(df, LineOptions(**options)).orderBy("partition", "offset", "line").collect()
    return [(r["_measurement"], r["_field"], r["value"], r["value_str"]) for r in got]


VALUES = (
    [
        ("1", 1.0, None),
        ("-1.5e3", -1500.0, None),
        (".5", 0.5, None),
        ("5.", 5.0, None),
        ("+2", 2.0, None),
        ("7i", 7.0, None),
        ("-7i", -7.0, None),
        ("9007199254740991i", 9007199254740991.0, None),
        ("9007199254740992i", None, "9007199254740992"),
        ("-9223372036854775808i", None, "-9223372036854775808"),
        ("7u", 7.0, None),
        ("18446744073709551615u", None, "18446744073709551615"),
        ("t", 1.0, None),
        ("TRUE", 1.0, None),
        ("F", 0.0, None),
        ("False", 0.0, None),
        ('"1"', None, "1"),
        ('"a, b=c"', None, "a, b=c"),
        (r'"q\"z\\ \n"', None, r'q"z\ \n'),
        ('""', None, ""),
        ("1_000", 1000.0, None),
        ("0x1p4", 16.0, None),
        ("inf", float("inf"), None),
        ("-Infinity", float("-inf"), None),
        ("1e-400", 0.0, None),
    ]
)


def test_values(topic):
    got = rows(topic([f"m f={raw} 1" for raw, _, _ in VALUES]))
    assert got == [("m", "f", number, text) for _, number, text in VALUES]


BAD_LINES = (
    [
        ("nothing", "no fields"),
        ("free text", "field \"text\" missing '='"),
        (",a=b f=1", "empty measurement"),
        ("m,tag f=1 x", "missing '='"),  # the tag key runs up to the equals sign
        ("m f=", 'field value for "f": empty field value'),
        ('m f="x', 'field value for "f": unterminated quoted string'),
        ('m f="x"y', "field value for \"f\": unexpected byte 'y' after quoted string"),
        ("m f=1 soon", 'timestamp "soon": strconv.ParseInt: parsing "soon": invalid syntax'),
        ("m f=1 9223372036854775808", "value out of range"),
        ("m f=abc", 'field "f": invalid number "abc": strconv.ParseFloat: parsing "abc": invalid syntax'),
        ("m f=1.5i", 'field "f": invalid integer "1.5i": strconv.ParseInt: parsing "1.5": invalid syntax'),
        ("m f=-1u", 'field "f": invalid unsigned "-1u": strconv.ParseUint: parsing "-1": invalid syntax'),
        ("m f=18446744073709551616u", "value out of range"),
        ("m f=1e400", "value out of range"),
        ("m f=1f", "invalid number"),
        ("m f=1_", "invalid number"),
        ("m f=1,g", "field \"g\" missing '='"),
        ("m f=,g=1", 'field "f": empty value'),
        ("m,t=1", "tag \"\" missing '='"),
        ("# only a comment", "lineprotocol payload produced no parseable lines"),
        (" \n ", "lineprotocol payload produced no parseable lines"),
    ]
)


def test_error_rows(topic):
    got = lp_long(topic([line for line, _ in BAD_LINES])).orderBy("offset").collect()
    assert len(got) == len(BAD_LINES)
    for r, (line, reason) in zip(got, BAD_LINES, strict=True):
        assert (r["_measurement"], r["_field"], r["value"], r["value_str"]) == ("", "", None, None)
        assert reason in r["error"], line
        assert r["Time"] is not None


def test_error_names_its_line(topic):
    got = lp_long(topic(["# c\n\nbad\nworse"])).collect()
    assert got[0]["error"].startswith("line 3: ")


def test_bad_lines_beside_good_ones_are_dropped(topic):
    df = topic(["a f=1\nbroken\nb f=2,g=x\nc f=3\r\n", None, ""])
    assert rows(df) == [("a", "f", 1.0, None), ("c", "f", 3.0, None)]


def test_escapes_and_duplicate_tags(topic):
    df = topic([r"a\ b\,c,k\ 1=v\=2,k=1,k=2 x\ y\=z=1,p=2 5"])
    got = lp_long(df).collect()
    assert [(r["_measurement"], r["_field"]) for r in got] == [("a b,c", "x y=z"), ("a b,c", "p")]
    assert got[0]["tags"] == {"k 1": "v=2", "k": "2"}


def test_unusual_but_legal(topic):
    df = topic(["m,t=a=b f=1", "m  f=1", "m =1", "m,a b=1 f=2", " m f=1\t", "m,t= f=1"])
    got = lp_long(df).orderBy("offset").collect()
    assert [(r["_field"], r["tags"]) for r in got] == [
        ("f", {"t": "a=b"}),
        (" f", {}),
        ("", {}),
        ("f", {"a b": "1"}),
        ("f", {}),
        ("f", {"t": ""}),
    ]
    assert all(r["error"] is None for r in got)


INSTANT = 1_700_000_000


STAMPS = (
    [
        (f"{INSTANT}", "auto", INSTANT * 10**6, INSTANT * 10**9),
        (f"{INSTANT}123", "auto", INSTANT * 10**6 + 123000, INSTANT * 10**9 + 123 * 10**6),
        (f"{INSTANT}123456", "auto", INSTANT * 10**6 + 123456, None),
        (f"{INSTANT}123456789", "auto", INSTANT * 10**6 + 123456, INSTANT * 10**9 + 123456789),
        (f"{INSTANT}", "s", INSTANT * 10**6, None),
        (f"{INSTANT}", "ms", INSTANT * 1000, None),
        (f"{INSTANT}", "us", INSTANT, None),
        (f"{INSTANT}999", "ns", INSTANT, INSTANT * 1000 + 999),
        ("-1", "ns", -1, -1),
        ("-1001", "ns", -2, -1001),
        ("-9223372036854775808", "auto", -9223372036854776, -9223372036854775808),
        ("999999999999", "auto", 999999999999 * 10**6, None),
        ("9223372036854775807", "s", None, None),
    ]
)


@pytest.mark.parametrize("precision", ["auto", "s", "ms", "us", "ns"])
def test_timestamps(topic, precision):
    cases = [c for c in STAMPS if c[1] == precision]
    long = lp_long(topic([f"m f=1 {c[0]}" for c in cases]), LineOptions(precision=precision))
    got = long.select("offset", F.unix_micros("Time").alias("us"), "time_ns", "error")
    for r, (_, _, micros, nanos) in zip(got.orderBy("offset").collect(), cases, strict=True):
        assert r["us"] == micros
        assert nanos is None or r["time_ns"] == nanos
        assert (r["error"] == "timestamp out of range") == (micros is None)


def test_time_modes(topic):
    df = topic(["m f=1", "m f=1 5"])
    got = lp_long(df).select(F.unix_seconds("Time").alias("s")).collect()
    assert sorted(r["s"] for r in got) == [5, 1704067200]
    now = lp_long(df, LineOptions(time_mode="now"))
    assert now.filter("Time > TIMESTAMP'2025-01-01'").count() == 2


FILTER_TOPIC = [
    "Breaker\\ Data,Building=B1,Device=-X1 volt=1,amp=2\nLast\\ Trip,Building=B2,Device=+N01 code=3i,amp=4",
]


@pytest.mark.parametrize(
    ("options", "expected"),
    [
        ({}, ["volt", "amp", "code", "amp"]),
        ({"measurements": "Breaker"}, []),
        ({"measurements": "Breaker Data"}, ["volt", "amp"]),
        ({"measurements": " Breaker.* , Last Trip"}, ["volt", "amp", "code", "amp"]),
        ({"measurements": " , "}, ["volt", "amp", "code", "amp"]),
        ({"fields": "amp"}, ["amp", "amp"]),
        ({"fields": "am"}, []),
        ({"fields": "co[cd]e|volt"}, ["volt", "code"]),
        ({"tags": "Building=B1"}, ["volt", "amp"]),
        ({"tags": "Building=B1,Building=B2"}, ["volt", "amp", "code", "amp"]),
        ({"tags": "Building=B[12],Device=-X."}, ["volt", "amp"]),
        ({"tags": "Missing=.*"}, []),
        ({"tags": "Building=,noequals,=x"}, ["volt", "amp", "code", "amp"]),
        ({"tags": "Device=+N01"}, ["code", "amp"]),
        ({"tags": "Device=(?!x).*"}, []),
        ({"measurements": "Last.*", "fields": "amp", "tags": "Building=B2"}, ["amp"]),
    ],
)
def test_filters(topic, options, expected):
    assert [r[1] for r in rows(topic(FILTER_TOPIC), **options)] == expected


def test_filters_keep_error_rows(topic):
    got = lp_long(topic(["bad", "m f=1"]), LineOptions(measurements="x", tags="a=b")).collect()
    assert len(got) == 1 and got[0]["error"] is not None


def test_tag_columns(topic):
    df = topic(["b,z=1,a=2 f=1\nc,value=3 f=2", "b,a=5,n=6,tag_value=7 f=3", "junk"])
    keys = lp_tag_keys(df)
    assert keys == ["z", "a", "value", "n", "tag_value"]
    assert lp_tag_keys(df, cap=3) == ["z", "a", "value"]
    wide = lp_wide(lp_long(df), keys)
    assert wide.columns == [
        "Time", "_measurement", "_field", "value", "value_str", "z", "a", "tag_value", "n",
        "tag_tag_value", "partition", "offset", "error",
    ]
    r = wide.filter("value = 3").collect()[0]
    assert (r["z"], r["a"], r["n"], r["tag_tag_value"]) == (None, "5", "6", "7")
    assert "partition" not in lp_wide(lp_long(df), [], partition_column=False).columns


def test_reserved_names():
    names = tag_column_names(["value", "tag_value", "error", "Time", "host"])
    assert names == {
        "value": "tag_value",
        "tag_value": "tag_tag_value",
        "error": "tag_error",
        "Time": "tag_Time",
        "host": "host",
    }


def test_pivot(topic):
    df = topic(["m,h=a x=1,y=2 5\nm,h=b x=3 5", "m,h=a x=9 5"])
    got = lp_pivot(lp_long(df), ["x", "y"], by=["h"]).orderBy("h").collect()
    assert [(r["h"], r["x"], r["y"]) for r in got] == [("a", 9.0, 2.0), ("b", 3.0, None)]


NAME = st.text(st.sampled_from("ab ,=é"), min_size=1, max_size=5)


@settings(max_examples=3, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(
    st.lists(
        st.tuples(
            st.text(st.sampled_from('ab ,="\\'), max_size=6),
            st.integers(-(2**63), 2**63 - 1),
            st.floats(allow_nan=False, allow_infinity=False),
            st.text(st.sampled_from("ab ,=x"), min_size=1, max_size=4),
        ),
        min_size=1,
        max_size=20,
    ),
    NAME,
)
def test_encode_then_parse(spark, records, name):
    df = spark.createDataFrame(
        [(i, *r) for i, r in enumerate(records)], "offset long, text string, n long, x double, tag string"
    )
    spec = LineSpec("m 1,2", {name: "text", name + "n": "n", name + "x": "x"}, {name: "tag"}, F.lit(5))
    value = encode_lines([spec], dict(df.dtypes))
    log = df.select(
        "offset", value.alias("value"), F.lit("t").alias("topic"), F.lit(0).alias("partition"),
        F.current_timestamp().alias("timestamp"),
    )
    got = {}
    for r in lp_long(log).collect():
        assert r["error"] is None and r["_measurement"] == "m 1,2"
        got[r["offset"], r["_field"]] = (r["value"], r["value_str"], r["tags"])
    for i, (text, n, x, tag) in enumerate(records):
        assert got[i, name] == (None, text, {name: tag})
        number = (float(n), None) if abs(n) < 2**53 else (None, str(n))
        assert got[i, name + "n"][:2] == number
        assert got[i, name + "x"][0] == x
