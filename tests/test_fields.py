"""Fields of a topic by the merged schema, by leaves and by key segments; depth
without bound; the left-over map."""

import json
import random

import pytest
from pyspark.sql import functions as F

from tidelog.operators import infer
from tidelog.operators.flatten import FlattenOptions, flatten_long
from tidelog.operators.infer import field_list, find_fields, infer_fields, key_segments, merged_fields
from tidelog.operators.wide import FieldSpec, wide_reader
from tidelog.plans.query import TopicQuery
from tidelog.plans.run import run

EVENTS = TopicQuery("t", offset="earliest")


def as_before(specs):
    return [(s.path, s.type, s.mixed, s.depths) for s in specs]


def random_value(rng, depth):
    kind = rng.randrange(9 if depth else 7)
    if kind == 0:
        return rng.randint(-5, 1 << 40)
    if kind == 1:
        return rng.random()
    if kind == 2:
        return rng.choice([True, False])
    if kind == 3:
        return rng.choice(["x", "OBJECT<", "a`b"])
    if kind == 4:
        return None
    if kind == 5:
        return [1, "a", {"z": 1}]
    if kind == 6:
        return rng.choice([1e300, 2**70, 2.0])
    return {rng.choice(["a", "b c", "d`e", "f.g", "item_0", "é"]): random_value(rng, depth - 1) for _ in range(rng.randint(0, 3))}


@pytest.mark.parametrize("seed", range(12))
def test_merged_fields_are_the_inferred_ones_or_none(topic, seed):
    rng = random.Random(seed)
    values = []
    fixed = {f"k{i}": random_value(rng, 3) for i in range(4)}
    for _ in range(30):
        value = dict(fixed) if seed % 3 else {"k": random_value(rng, 2)}
        value.pop(f"k{rng.randrange(4)}", None)
        values.append(json.dumps(value, ensure_ascii=False))
    values += [None, "", "{bad", "5", ' {"k0": null}', "null"]
    options = FlattenOptions(rng.choice([2, 3, 5]), rng.choice([0, 3]))
    df = topic(values, partitions=2)
    expected = field_list(infer_fields(df, options=options))
    merged = merged_fields(df, options=options)
    if merged is not None:
        assert as_before(merged) == as_before(expected)
    assert as_before(find_fields(df, options=options)) == as_before(expected)


def test_when_the_merged_schema_tells_all(topic):
    told = merged_fields(topic(['{"a":1,"b":{"c.d":"x","e":[1]},"n":null,"o":{}}', '{"a":2.5}']))
    assert [(s.path, s.type, s.segments) for s in told] == [
        ("a", "double", (("a",),)), ("b.c.d", "string", (("b", "c.d"),)), ("b.e", "json", (("b", "e"),)), ("n", "double", (("n",),))
    ]
    for values in (['{"a":1}', '{"a":"x"}'], ['{"a":1}', '{"a":{"b":1}}'], ['{"a":1}', "[1]"], ['{"a.b":1,"a":{"b":2}}']):
        assert merged_fields(topic(values)) is None
    assert merged_fields(topic(['{"a":1,"b":2}']), options=FlattenOptions(5, 1)) is None
    assert merged_fields(topic(["5", None])) == []
    keys = merged_fields(topic(["{}"], keys=['{"u":1,"v":{"w":"x"}}']), "key", prefix="key")
    assert [(s.path, s.depths) for s in keys] == [("key.u", (1,)), ("key.v.w", (2,))]


def test_key_segments_instead_of_guessed_cuts(topic):
    long = ".".join(f"s{i}" for i in range(23))
    parts = long.split(".")
    nested = {".".join(parts[3:]): 7}
    for cut in (".".join(parts[1:3]), parts[0]):
        nested = {cut: nested}
    values = [json.dumps(nested), json.dumps({long: 8}), '{"a":1}', '{"a":"x"}']  # a: the merged schema does not tell
    df = topic(values)
    specs = {s.path: s for s in find_fields(df)}
    wanted = (tuple(parts[:1] + [".".join(parts[1:3]), ".".join(parts[3:])]), (long,))
    assert set(specs[long].segments) == set(wanted)
    assert len(specs[long].accessors()) == 2
    assert key_segments(df, [long]) == {long: tuple(sorted(wanted))}
    got = run(df.sparkSession, EVENTS, df).orderBy("offset").collect()
    assert [r[long] for r in got] == [7, 8, None, None]
    with pytest.raises(ValueError, match="segments"):
        FieldSpec(long, "long", depths=(11,)).accessors()
    assert len(wide_reader([specs[long]]).direct[0][1]) == 2


def nested(depth, leaf):
    return '{"k":' * depth + leaf + "}" * depth


def nodes(df):
    """Expressions and operators of the optimised plan, numbers left out."""
    text = df._jdf.queryExecution().optimizedPlan().toString()
    return sum(c == "(" for c in text)


def test_any_depth_with_one_plan(topic):
    df = topic([nested(3, "1"), nested(40, '"x"'), nested(70, "2"), '{"a.b":1,"a":{"b":2,"c":{}}}'])
    deep = flatten_long(df.select("offset", "value"), options=FlattenOptions(60))
    got = {(r["offset"], r["path"]): (r["v_long"], r["v_str"]) for r in deep.collect()}
    assert got == {(0, ".".join("k" * 3)): (1, None), (1, ".".join("k" * 40)): (None, "x"), (3, "a.b"): (1, None)}
    shallow = flatten_long(df.select("offset", "value"), options=FlattenOptions(5))
    assert nodes(deep) == nodes(shallow)


def test_shallowest_leaf_of_a_path_wins_at_any_depth(topic):
    df = topic(['{"a":{"b":{"c.d":3}},"a.b":{"c":{"d":2}},"a.b.c.d":1}', '{"a":{"b":{"c.d":3}},"a.b":{"c":{"d":2}}}'])
    got = flatten_long(df.select("offset", "value"), options=FlattenOptions(9)).collect()
    assert {(r["offset"], r["path"], r["v_long"]) for r in got} == {(0, "a.b.c.d", 1), (1, "a.b.c.d", 3)}


def test_merged_fields_do_not_spread_messages(topic, monkeypatch):
    monkeypatch.setattr(infer, "infer_fields", None)
    assert [s.path for s in find_fields(topic(['{"a":{"b":1}}']))] == ["a.b"]
    plan = topic(['{"a":1}']).agg(F.schema_of_variant_agg(F.try_parse_json(F.col("value").cast("string"))))
    assert "Generate" not in plan._jdf.queryExecution().toString()
