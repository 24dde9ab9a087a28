"""Flatten nested JSON to dotted leaf paths, inside the row.

Everything is array expressions over the parsed message: no shuffle is needed
to apply the per-message field cap or to settle two leaves with one path, and
the same columns work on a stream. Levels are steps of a fold, so a depth of 60
has the plan of a depth of 5.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidelog.functions import variants as V
from tidelog.functions.columns import let

DEFAULT_DEPTH = 5
DEFAULT_CAP = 1000
LEAVES = "array<struct<path:string,depth:int,node:variant>>"
# while levels are opened: a leaf with the members of its node, null if it is no object
_OPEN = "array<struct<path:string,depth:int,node:variant,members:map<string,variant>>>"


@dataclass(frozen=True)
class FlattenOptions:
    """Bounds of a flatten: 0 means the default, anything below 1 means 1."""

    max_depth: int = DEFAULT_DEPTH
    field_cap: int = DEFAULT_CAP

    def __post_init__(self) -> None:
        object.__setattr__(self, "max_depth", _bound(self.max_depth, DEFAULT_DEPTH))
        object.__setattr__(self, "field_cap", _bound(self.field_cap, DEFAULT_CAP))


def _bound(value: int, default: int) -> int:
    return default if value == 0 else max(value, 1)


def no_leaves() -> Column:
    return F.array().cast(LEAVES)


def text_leaves(
    payload: Column,
    options: FlattenOptions = FlattenOptions(),
    prefix: str = "",
    wrap_array: bool = True,
    separator: str = ".",
) -> Column:
    """Leaves of a JSON text as ``ARRAY<STRUCT<path, depth, node>>``.

    NULL when the text is not an object (or, with ``wrap_array``, an array).
    A leaf at depth d is kept when ``d < max_depth`` (the root is depth 0).
    Arrays are leaves, except a top-level array, whose elements become
    ``item_0``, ``item_1``, ... Of two leaves with one path the shallowest
    wins. Beyond ``field_cap`` leaves the first paths in byte order are kept.
    Another ``separator`` tells the segments of a path apart.
    """

    def first_level(members: Column) -> Column:
        keys = F.map_keys(members)
        distinct = F.size(F.array_distinct(keys)) == F.size(keys)
        return F.when(distinct, _children(members, prefix, separator)).otherwise(
            let(V.parse(payload), lambda root: _first_level(root, prefix, wrap_array, separator))
        )

    return _below(let(V.object_fields(payload), first_level), options, separator)


def variant_leaves(
    root: Column,
    options: FlattenOptions = FlattenOptions(),
    prefix: str = "",
    wrap_array: bool = True,
) -> Column:
    """As :func:`text_leaves`, for a VARIANT column."""
    return _below(_first_level(root, prefix, wrap_array, "."), options, ".")


def _first_level(root: Column, prefix: str, wrap_array: bool, separator: str) -> Column:
    members = _children(V.as_object(root), prefix, separator)
    if not wrap_array:
        return members
    items = F.transform(
        V.as_array(root),
        lambda node, i: _leaf(F.concat(F.lit("item_"), i.cast("string")), F.lit(1), node),
    )
    return F.coalesce(members, items)


def _leaf(path: Column, depth: Column, node: Column) -> Column:
    return F.struct(path.alias("path"), depth.alias("depth"), node.alias("node"))


def _children(members: Column, prefix: str | Column, separator: str, depth: Column | None = None) -> Column:
    depth = F.lit(1) if depth is None else depth
    parent = F.lit(prefix) if isinstance(prefix, str) else prefix
    top = isinstance(prefix, str) and not prefix

    def child(entry: Column) -> Column:
        path = entry["key"] if top else F.concat(parent, F.lit(separator), entry["key"])
        return _leaf(path, depth, entry["value"])

    return F.transform(F.map_entries(members), child)


def _below(first: Column, options: FlattenOptions, separator: str) -> Column:
    """Expand the first level down to the depth bound and apply the rules."""
    if options.max_depth < 2:
        return F.when(first.isNotNull(), no_leaves())

    def opened(leaves: Column) -> Column:
        # members are looked up once a node: to ask for its schema instead
        # would read all that is below it at every level
        def with_members(leaf: Column) -> Column:
            return F.struct(leaf["path"], leaf["depth"], leaf["node"], V.as_object(leaf["node"]).alias("members"))

        return F.transform(leaves, with_members).cast(_OPEN)

    def is_open(leaf: Column) -> Column:
        return leaf["members"].isNotNull()

    def expand(leaf: Column) -> Column:
        nested = opened(_children(leaf["members"], leaf["path"], separator, leaf["depth"] + 1))
        return F.when(is_open(leaf), nested).otherwise(F.array(leaf))

    def deeper(items: Column, _: Column) -> Column:
        # a level is a step of a fold: the plan is the same for any depth
        return F.when(F.exists(items, is_open), F.flatten(F.transform(items, expand)).cast(_OPEN)).otherwise(items)

    def expand_all(level: Column) -> Column:
        nested = level
        if options.max_depth > 2:
            levels = F.array_repeat(F.lit(0), options.max_depth - 2)
            nested = F.aggregate(levels, level.cast(_OPEN), deeper)
        closed = F.filter(nested, lambda leaf: ~is_open(leaf))
        plain = F.transform(closed, lambda leaf: F.struct(leaf["path"], leaf["depth"], leaf["node"])).cast(LEAVES)
        return let(plain, _settle)

    def by_level(level: Column) -> Column:
        return F.when(F.exists(level, lambda leaf: V.is_object(leaf["node"])), let(opened(level), expand_all)).otherwise(level)

    return let(let(first, by_level), lambda items: _capped(items, options.field_cap))


def _paths(items: Column) -> Column:
    return F.transform(items, lambda leaf: leaf["path"])


def _settle(items: Column) -> Column:
    repeated = F.size(F.array_distinct(_paths(items))) < F.size(items)
    return F.when(repeated, _first_by_depth(items)).otherwise(items)


def _first_by_depth(items: Column) -> Column:
    """Of the leaves with one path the shallowest, the first of equal ones."""
    # the sort is stable
    ordered = F.array_sort(items, lambda a, b: a["depth"] - b["depth"])

    def first_only(state: Column) -> Column:
        return F.filter(
            state["items"],
            lambda leaf, i: F.array_position(state["paths"], leaf["path"]) == i + 1,
        )

    return let(
        ordered,
        lambda o: let(F.struct(o.alias("items"), _paths(o).alias("paths")), first_only),
    )


def _capped(items: Column, cap: int) -> Column:
    last = F.element_at(F.sort_array(_paths(items)), cap)
    first_paths = let(
        F.struct(items.alias("items"), last.alias("last")),
        lambda state: F.filter(state["items"], lambda leaf: leaf["path"] <= state["last"]),
    )
    return F.when(F.size(items) > cap, first_paths).otherwise(items)


def merge_key_leaves(value_items: Column, key_items: Column) -> Column:
    """Key leaves that do not clash with a value leaf, then the value leaves."""

    def merge(state: Column) -> Column:
        fresh = F.filter(
            state["keys"], lambda leaf: ~F.array_contains(state["paths"], leaf["path"])
        )
        return F.concat(fresh, state["items"])

    def bind(items: Column) -> Column:
        keys = F.coalesce(key_items, no_leaves())
        return let(
            F.struct(items.alias("items"), _paths(items).alias("paths"), keys.alias("keys")), merge
        )

    return let(value_items, bind)


def left_over(items: Column, columns: Sequence[str]) -> Column:
    """The leaves that are no column as a map of path to text: strings as they
    are, everything else as JSON, null as null."""

    def entry(leaf: Column) -> Column:
        def text(kind: Column) -> Column:
            written = F.to_json(leaf["node"])
            return (
                F.when(kind == V.STRING, F.try_variant_get(leaf["node"], "$", "string"))
                .when(kind == V.JSON, V.escape_markup(written))
                .when(kind != V.NULL, written)
            )

        return F.struct(leaf["path"].alias("key"), let(V.leaf_type(leaf["node"]), text).alias("value"))

    known = F.array(*[F.lit(c) for c in columns]).cast("array<string>")
    others = F.filter(items, lambda leaf: ~F.array_contains(known, leaf["path"]))
    return F.map_from_entries(F.transform(others, entry))


def explode_leaves(df: DataFrame, items: str, keep_empty: bool = False) -> DataFrame:
    """One row per leaf of the array column ``items``, which is replaced by
    ``path, type, v_long, v_double, v_bool, v_str``.

    A message without leaves has no row unless ``keep_empty`` is set.
    """
    keep = [c for c in df.columns if c != items]
    # the outer form: a plain inline makes the optimizer add a filter on the
    # array, and with it a second evaluation of the whole parse
    exploded = df.select(*keep, F.inline_outer(items).alias("path", "_depth", "_node"))
    if not keep_empty:
        exploded = exploded.filter(F.col("path").isNotNull())
    typed = exploded.select(
        *keep,
        "path",
        F.when(F.col("path").isNotNull(), V.leaf_type(F.col("_node"))).alias("type"),
        F.to_json("_node").alias("_text"),
        "_node",
    )
    values = V.leaf_columns(F.col("_text"), F.col("_node"), F.col("type"))
    return typed.select(*keep, "path", "type", *[c.alias(n) for n, c in values.items()])


def flatten_long(
    df: DataFrame, value: str = "value", options: FlattenOptions = FlattenOptions()
) -> DataFrame:
    """Long shape of the JSON text or bytes in ``value``, which is dropped."""
    keep = [c for c in df.columns if c != value]
    return explode_leaves(df.select(*keep, text_leaves(F.col(value), options).alias("_items")), "_items")
