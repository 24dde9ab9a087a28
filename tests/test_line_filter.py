"""Lines that a filter cannot let through are left out before the parse; the
rows are those of a filter after it."""

import random
import re

import pytest

import __spark_entry__ as entry
from tidelog.operators import lineprotocol
from tidelog.operators.lineprotocol import LineOptions, lp_long, lp_tag_keys
from tidelog.operators.lp_filter import LineFilter

PIECES = {
    "name": ["cpu", "cpu1", "cpu22", "mem", "disk io".replace(" ", r"\ "), "net,x".replace(",", r"\,"), "été", "+N01", "a.b"],
    "tags": ["", ",host=a", ",host=b,zone=x", ",host=a\\ b", ",zone=y,host=c1", ",host=a,host=b", ",ho=a"],
    "fields": ["load=1", "load=1.5,idle=2i", 'idle="load=3, x"', "load1=t", r"lo\ ad=2", "x y=1", "load=1i,free=2u"],
    "rest": ["", " 1700000000", " ", " x", "\r"],
}
ODD = ["", "# comment", "   ", "\t cpu load=1", "cpu", "cpu load=", "no fields here", " cpu load=2", '"cpu" load=1']
FILTERS = [
    LineOptions(measurements="cpu"),
    LineOptions(measurements="cpu.*,mem"),
    LineOptions(measurements="cpu[0-9]+"),
    LineOptions(measurements="disk io"),
    LineOptions(measurements="+N01"),
    LineOptions(measurements="cpu$"),
    LineOptions(measurements="[[:alpha:]]+"),
    LineOptions(measurements="(?i)CPU"),
    LineOptions(measurements="none"),
    LineOptions(fields="load"),
    LineOptions(fields="lo.*|idle"),
    LineOptions(fields="x y"),
    LineOptions(fields=".b,lo ad"),
    LineOptions(tags="host=a"),
    LineOptions(tags="host=b|c\\d,zone=[xy]"),
    LineOptions(tags="zone=.*"),
    LineOptions(measurements="cpu.*", fields="load", tags="host=a,host=b"),
]


@pytest.fixture(scope="module")
def payloads():
    rng = random.Random(7)
    out = []
    for _ in range(400):
        lines = []
        for _ in range(rng.randint(1, 6)):
            if rng.random() < 0.2:
                lines.append(rng.choice(ODD))
            else:
                n, t, f, r = (rng.choice(PIECES[k]) for k in ("name", "tags", "fields", "rest"))
                lines.append(f"{n}{t} {f}{r}")
        out.append("\n".join(lines))
    return [*out, None, "", "\n", "cpu load=1", "free text"]


@pytest.mark.parametrize("options", FILTERS, ids=str)
def test_rows_are_those_of_a_filter_after_the_parse(topic, payloads, monkeypatch, options):
    df = topic(payloads, partitions=2)
    found = sorted(map(str, lp_long(df, options).collect()))
    keys = lp_tag_keys(df, options)
    monkeypatch.setattr(LineFilter, "other_lines", lambda *_: None)
    assert found == sorted(map(str, lp_long(df, options).collect()))
    assert keys == lp_tag_keys(df, options)


def test_most_lines_are_never_parsed(spark, topic):
    """Nine of ten lines are blank before the grammar sees them."""
    text = "\n".join(f"cpu{i},host=h{i} load={i},idle=2 17000000{i:02}" for i in range(10))
    df = topic([text] * 5)
    told = LineOptions(measurements="cpu3").filter.other_lines(spark)
    assert len([x for x in re.sub(_python(told), "", text).split("\n") if x]) == 1
    lines = lineprotocol.parse_lines(df, unwanted=told)
    assert lines.count() == 5 and {r["line"] for r in lines.collect()} == {3}
    # a message without a wanted line is good by its first line
    assert lineprotocol.parse_lines(df, unwanted=LineOptions(measurements="disk").filter.other_lines(spark)).count() == 0
    bad = topic(["free text\nmore"])
    assert lp_long(bad, LineOptions(measurements="disk")).collect()[0]["error"] is not None


def _python(java):
    return java.replace("(?md)", "(?m)").replace("[^\\n]++", "[^\\n]+")


def test_whole_numbers_at_the_edge_of_a_double(topic):
    values = ["-0i", "+7i", "007i", "9007199254740991i", "-9007199254740991i", "9007199254740992i", "-9223372036854775808i"]
    values += ["9007199254740991u", "9007199254740993u", "18446744073709551615u", "+9007199254740993i"]
    rows = lp_long(topic([f"m f={v}" for v in values])).orderBy("offset").collect()
    edge = 9007199254740991.0
    assert [repr(r["value"]) for r in rows] == [repr(x) for x in [0.0, 7.0, 7.0, edge, -edge, None, None, edge, None, None, None]]
    assert [r["value_str"] for r in rows if r["value"] is None] == [
        "9007199254740992", "-9223372036854775808", "9007199254740993", "18446744073709551615", "9007199254740993"
    ]


@pytest.mark.parametrize("name", ["lp_filter_field", "lp_filter_literal", "lp_filter_all"])
def test_generated_code_is_compiled(spark, name):
    """The JVM interprets methods of over 8,000 bytes, at half the speed."""
    df = entry.queries()[name](spark, "/root/testdata/sf0.001")
    mode = spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("codegen")
    sizes = re.findall(r"maxMethodCodeSize:(\d+)", df._jdf.queryExecution().explainString(mode))
    assert sizes and max(map(int, sizes)) < 8000


def test_patterns_of_a_list_are_tried_as_one(spark, topic):
    df = topic(["m " + ",".join(f"{n}=1" for n in ("load", "LOAD1", "a1", "x.y", "b|c", "zz"))])
    found = lambda f: sorted(r["_field"] for r in lp_long(df, LineOptions(fields=f)).collect())
    assert found("(?i)load\\d,a|a1") == ["LOAD1", "a1"]
    assert found("+x,x[.]y,zz") == ["x.y", "zz"]
    assert found("(?P<n>a)1,(?P<n>z)z") == ["a1", "zz"]
