import pytest
from pyspark.sql import functions as F

from tidelog.functions import variants as V
from tidelog.operators.flatten import FlattenOptions, flatten_long, text_leaves, variant_leaves
from tidelog.operators.infer import field_list, infer_fields, schema_groups
from tidelog.operators.wide import FieldSpec, in_column_order, wide_reader


def long_rows(df, options=FlattenOptions()):
    value = ("v_str", "v_bool", "v_long", "v_double")
    rows = flatten_long(df.select("offset", "value"), options=options).collect()
    return {
        (r["offset"], r["path"]): (r["type"], next((r[v] for v in value if r[v] is not None), None))
        for r in rows
    }


def paths(df, options):
    return sorted(p for _, p in long_rows(df, options))


def test_types_of_leaves(topic):
    df = topic(['{"i":2,"f":2.0,"e":1e3,"b":true,"s":"x\\"y<","n":null,"a":[1,{"z":2,"b":"<"}],"o":{}}'])
    got = {path: value for (_, path), value in long_rows(df).items()}
    assert got == {
        "i": ("long", 2),
        "f": ("double", 2.0),
        "e": ("double", 1000.0),
        "b": ("bool", True),
        "s": ("string", 'x"y<'),
        "n": ("null", None),
        "a": ("json", '[1,{"b":"\\u003c","z":2}]'),
    }


NUMBERS = (
    [
        ("9223372036854775807", "long", 9223372036854775807),
        ("-9223372036854775808", "long", -9223372036854775808),
        ("9223372036854775808", "double", 9.223372036854775808e18),
        ("1.0", "double", 1.0),
        ("1e2", "double", 100.0),
        ("0.1", "double", 0.1),
        ("123456789012345678901234567890123456789012", "double", 1.2345678901234568e41),
    ]
)


def test_number_coercion(topic):
    got = long_rows(topic([f'{{"x":{literal}}}' for literal, _, _ in NUMBERS]))
    assert got == {(i, "x"): (kind, value) for i, (_, kind, value) in enumerate(NUMBERS)}


DEEP = '{"a":1,"b":{"c":2,"d":{"e":3,"f":{"g":4,"h":{"i":5}}}}}'


@pytest.mark.parametrize(
    ("depth", "expected"),
    [
        (1, []),
        (2, ["a"]),
        (3, ["a", "b.c"]),
        (4, ["a", "b.c", "b.d.e"]),
        (5, ["a", "b.c", "b.d.e", "b.d.f.g"]),
        (0, ["a", "b.c", "b.d.e", "b.d.f.g"]),
        (6, ["a", "b.c", "b.d.e", "b.d.f.g", "b.d.f.h.i"]),
    ],
)
def test_depth_bound(topic, depth, expected):
    assert paths(topic([DEEP]), FlattenOptions(max_depth=depth)) == expected


@pytest.mark.parametrize("cap", [1, 3, 5])
def test_cap_keeps_first_paths_in_byte_order(topic, cap):
    df = topic(['{"d":1,"B":2,"a":{"y":3,"x":4},"é":5}'])
    assert paths(df, FlattenOptions(field_cap=cap)) == ["B", "a.x", "a.y", "d", "é"][:cap]


def test_top_level_array(topic):
    df = topic(['[{"id":1,"n":{"x":2}},[3],"s"]', "[]"])
    assert long_rows(df) == {
        (0, "item_0.id"): ("long", 1),
        (0, "item_0.n.x"): ("long", 2),
        (0, "item_1"): ("json", "[3]"),
        (0, "item_2"): ("string", "s"),
    }


TWICE = (
    [
        ('{"a.b":1,"a":{"b":2}}', 1),
        ('{"a":{"b":2},"a.b":1}', 1),
        ('{"a.b":0,"a.b":3}', 3),
        ('{"a":{"b":1,"b":7}}', 7),
    ]
)


def test_deep_objects_open_each_level_once(spark, topic):
    """An object is opened by its members alone; a schema at every level would
    be read as often as there are levels."""
    df = topic(['{"a":{"b":{"c":{"d":{},"e":1,"a":[{"x":1}]}},"n":null}}', '{"a":{}}', "1"])
    leaves = text_leaves(F.col("value"), FlattenOptions(60))
    rows = df.orderBy("offset").select(F.transform(leaves, lambda x: x["path"]).alias("p")).collect()
    assert [sorted(r["p"]) if r["p"] is not None else None for r in rows] == [["a.b.c.a", "a.b.c.e", "a.n"], [], None]
    plan = df.select(leaves.alias("p"))._jdf.queryExecution().analyzed().toString()
    assert plan.count("schema_of_variant") <= 1


def test_one_path_twice(topic):
    got = long_rows(topic([text for text, _ in TWICE]))
    assert got == {(i, "a.b"): ("long", value) for i, (_, value) in enumerate(TWICE)}


def test_variant_and_text_leaves_agree(spark, topic):
    df = topic([DEEP, '[1,{"a":{"b":[2]}}]', "{}", "5", "x", '{"a.b":1,"a":{"b":2}}'])
    shown = lambda c: F.transform(c, lambda x: F.concat_ws("=", x["path"], F.to_json(x["node"])))
    rows = df.select(
        shown(text_leaves(F.col("value"))).alias("t"),
        shown(variant_leaves(V.parse(F.col("value")))).alias("v"),
    ).collect()
    for r in rows:
        assert (r["t"] is None) == (r["v"] is None)
        assert sorted(r["t"] or []) == sorted(r["v"] or [])


def test_infer_widening_and_null_memory(topic):
    df = topic(
        [
            '{"a":1,"b":1,"c":null,"d":122,"e":true,"f":[1],"g":"x"}',
            '{"a":2.5,"b":"x","c":null,"d":null,"e":null,"f":null,"g":null}',
            '{"a":3,"b":false,"d":126,"f":[2]}',
            "broken",
        ]
    )
    got = {r["path"]: (r["type"], r["mixed"], r["last_type"], r["nulls"]) for r in infer_fields(df).collect()}
    assert got == {
        "a": ("double", False, "long", 0),
        "b": ("string", True, "bool", 0),
        "c": ("double", False, "double", 2),
        "d": ("long", False, "long", 1),
        "e": ("bool", False, "bool", 1),
        "f": ("json", False, "json", 1),
        "g": ("string", False, "string", 1),
    }


def test_field_list_is_sorted_and_whole(topic):
    df = topic(['{"item_10":1,"item_2":2,"b":{"c":1},"a.x":1}'])
    fields = field_list(infer_fields(df))
    assert [f.path for f in fields] == ["a.x", "b.c", "item_10", "item_2"]
    # the cap is one of each message
    two = topic(['{"a":1,"b":1}', '{"c":1,"d":1}'])
    assert len(field_list(infer_fields(two, options=FlattenOptions(field_cap=2)))) == 4
    assert fields[0].depths == (1,) and fields[1].depths == (2,)


def wide(df, fields):
    reader = wide_reader(fields)
    parsed = df.select("*", reader.parsed(F.col("value")).alias("_record"))
    columns = reader.columns("_record", F.col("value"))
    ordered = [f.path for f in in_column_order(fields)]
    rows = parsed.select(*[columns[p].alias(p) for p in ordered]).collect()
    return [tuple(r) for r in rows]


def test_wide_is_strict_about_types(topic):
    fields = [FieldSpec("b", "bool"), FieldSpec("d", "double"), FieldSpec("l", "long"), FieldSpec("s", "string")]
    df = topic(
        [
            '{"b":true,"d":1,"l":2,"s":"x"}',
            '{"b":"true","d":"1","l":2.5,"s":"y"}',
            '{"b":1,"d":1.5,"l":"2","s":null}',
            '{"l":99999999999999999999,"d":"NaN"}',
        ]
    )
    assert wide(df, fields) == [
        (True, 1.0, 2, "x"),
        (None, None, None, "y"),
        (None, 1.5, None, None),
        (None, None, None, None),
    ]


def test_wide_literal_and_nested_dots(topic):
    df = topic(['{"a.b":1}', '{"a":{"b":2}}', '{"a.b":3,"a":{"b":4}}', '{"a":5}'])
    assert wide(df, [FieldSpec("a.b", "long")]) == [(1,), (2,), (3,), (None,)]


def test_wide_partly_literal_dots(topic):
    df = topic(['{"a.b":{"c":1}}', '{"a":{"b.c":2}}', '{"a":{"b":{"c":3}}}'])
    assert wide(df, [FieldSpec("a.b.c", "long", depths=(2, 3))]) == [(1,), (2,), (3,)]


def test_wide_value_here_object_there(topic):
    df = topic(['{"a":7}', '{"a":{"b":8}}', '{"a":"x"}'])
    fields = [FieldSpec("a", "string", mixed=True), FieldSpec("a.b", "long")]
    assert wide(df, fields) == [("7", None), (None, 8), ("x", None)]


def test_wide_array_members_and_text(topic):
    df = topic(['[{"id":1},{"t":[1, 2]}]', '[{"id":2}]', '{"item_0":{"id":3}}'])
    fields = [FieldSpec("item_0.id", "long"), FieldSpec("item_1.t", "json")]
    assert wide(df, fields) == [(1, "[1,2]"), (2, None), (3, None)]
    df = topic(['{"t":[1, {"z":1,"a":"<"}]}', '{"t":"[x]"}', '{"t":null}'])
    assert wide(df, [FieldSpec("t", "json")]) == [('[1,{"a":"\\u003c","z":1}]',), (None,), (None,)]


def test_schema_groups(topic):
    df = topic(['{"a":1,"b":"x"}', '{"b":"y","a":2}', '{"a":1.5}', '{"a":null}', "bad"])
    got = {r["fields"]: r["messages"] for r in schema_groups(df).collect()}
    assert got == {"a:long|b:string": 2, "a:double": 2, "error:string": 1}
    got = {r["fields"]: r["messages"] for r in schema_groups(df, types={"a": "long"}).collect()}
    assert got["a:long"] == 1
