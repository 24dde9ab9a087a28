"""Wide shape: one typed column per dotted path.

The fast route reads all wanted members with one ``from_json`` whose schema is
built from the paths, so a message is tokenised once and only the wanted
members are materialised. Paths it cannot express (members of a top-level
array, a path that is a value in some messages and an object in others) are
taken from a VARIANT instead.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from dataclasses import dataclass
from itertools import combinations
from math import comb

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidelog.functions import variants as V
from tidelog.functions.columns import let

BAD = "\u0001bad"
#: Ways to cut a path of unknown segments that are tried.
GUESSES = 1000
RESERVED = ("time", "partition", "offset", "error")
_TYPES = {
    V.LONG: T.LongType(),
    V.DOUBLE: T.DoubleType(),
    V.BOOL: T.BooleanType(),
    V.STRING: T.StringType(),
    V.JSON: T.StringType(),
}


@dataclass(frozen=True)
class FieldSpec:
    """A wanted path. ``segments`` are the key segments it was seen with. Where
    they are not known, ``depths`` are the numbers of them; empty means either
    fully nested or one literal dotted key."""

    path: str
    type: str
    mixed: bool = False
    depths: tuple[int, ...] = ()
    segments: tuple[tuple[str, ...], ...] = ()

    def accessors(self) -> list[tuple[str, ...]]:
        """Key segments to try, shallowest first."""
        if self.segments:
            return sorted(self.segments, key=lambda s: (len(s), s))
        parts = self.path.split(".")
        depths = self.depths or ((1, len(parts)) if len(parts) > 1 else (1,))
        if sum(comb(len(parts) - 1, d - 1) for d in set(depths)) > GUESSES:
            raise ValueError(f"{self.path!r} can be cut in too many ways: give its segments")
        found = []
        for depth in sorted(set(depths)):
            for cuts in combinations(range(1, len(parts)), depth - 1):
                edges = (0, *cuts, len(parts))
                found.append(
                    tuple(".".join(parts[a:b]) for a, b in zip(edges, edges[1:], strict=False))
                )
        return found


def in_column_order(fields: Iterable[FieldSpec]) -> list[FieldSpec]:
    """Byte order of the paths, so ``item_10`` comes before ``item_2``."""
    return sorted(fields, key=lambda f: f.path.encode())


def column_name(path: str, taken: Sequence[str] = RESERVED) -> str:
    """A value named like a fixed column is published as ``value.<name>``."""
    return f"value.{path}" if path in taken else path


def column_names(paths: Sequence[str], taken: Sequence[str] = RESERVED) -> dict[str, str]:
    """The published name of each path; ``value.`` is put before a taken one
    until it is free."""
    used = {*taken, *paths}
    names = {}
    for path in paths:
        name = path
        if path in taken:
            while name in used:
                name = f"value.{name}"
            used.add(name)
        names[path] = name
    return names


def _array_index(path: str) -> int | None:
    head = path.split(".", 1)[0]
    digits = head.removeprefix("item_")
    return int(digits) if head != digits and digits.isascii() and digits.isdigit() else None


class _Tree(dict):
    """Nested member names; a leaf is a Spark type."""

    def add(self, segments: tuple[str, ...], leaf: T.DataType) -> bool:
        node = self
        for name in segments[:-1]:
            child = node.setdefault(name, _Tree())
            if not isinstance(child, _Tree):
                return False
            node = child
        if segments[-1] in node:
            return node[segments[-1]] == leaf
        node[segments[-1]] = leaf
        return True

    def struct(self) -> T.StructType:
        return T.StructType(
            [
                T.StructField(n, t.struct() if isinstance(t, _Tree) else t)
                for n, t in self.items()
            ]
        )


@dataclass(frozen=True)
class WideReader:
    """Columns of one payload: ``parsed`` must be projected first, because
    ``columns`` refers to it many times."""

    schema: T.StructType
    direct: tuple[tuple[FieldSpec, tuple[tuple[str, ...], ...]], ...]
    by_variant: tuple[FieldSpec, ...]

    def parsed(self, payload: Column) -> Column:
        return F.from_json(
            payload.cast("string"),
            self.schema,
            {**V.STRICT_JSON, "columnNameOfCorruptRecord": BAD},
        )

    def columns(self, parsed: str, payload: Column) -> dict[str, Column]:
        out = {spec.path: self._direct(parsed, spec, paths) for spec, paths in self.direct}
        if self.by_variant:
            root = V.parse(payload)
            for spec in self.by_variant:
                out[spec.path] = _from_variant(root, spec)
        return out

    def suspect(self, parsed: str) -> Column:
        """True where the reader met anything unexpected in the payload."""
        record = F.col(parsed)
        return record.isNull() | record[BAD].isNotNull()

    @staticmethod
    def _direct(parsed: str, spec: FieldSpec, paths: tuple[tuple[str, ...], ...]) -> Column:
        found = []
        for segments in paths:
            value = F.col(parsed)
            for name in segments:
                value = value.getField(name)
            found.append(value)
        value = found[0] if len(found) == 1 else F.coalesce(*found)
        if spec.type == V.JSON:
            # only an array is a value here; print it compactly, keys sorted
            return F.when(value.startswith("["), V.escape_markup(F.to_json(F.try_parse_json(value))))
        return value


def _from_variant(root: Column, spec: FieldSpec) -> Column:
    candidates: list[Column] = []
    index = _array_index(spec.path)
    if index is not None:
        rest = spec.path.split(".", 1)[1:]
        inner = FieldSpec(rest[0], spec.type).accessors() if rest else [()]
        candidates += [V.typed_member(root, V.member_path((index, *p)), spec.type) for p in inner]
    candidates += [V.typed_member(root, V.member_path(p), spec.type) for p in spec.accessors()]
    return F.coalesce(*candidates)


def wide_reader(fields: Iterable[FieldSpec]) -> WideReader:
    """Split ``fields`` between the two routes and build the read schema."""
    ordered = in_column_order(fields)
    tree = _Tree()
    direct, by_variant = [], []
    containers = {
        ".".join(p[:i]) for f in ordered for p in [f.path.split(".")] for i in range(1, len(p))
    }
    for spec in ordered:
        paths = tuple(spec.accessors())
        simple = (
            not spec.mixed
            and spec.path not in containers
            and _array_index(spec.path) is None
            and "" not in spec.path.split(".")
        )
        if simple and all(_fits(tree, p, _TYPES[spec.type]) for p in paths):
            for path in paths:
                tree.add(path, _TYPES[spec.type])
            direct.append((spec, paths))
        else:
            by_variant.append(spec)
    tree[BAD] = T.StringType()
    return WideReader(tree.struct(), tuple(direct), tuple(by_variant))


def _fits(tree: _Tree, path: tuple[str, ...], leaf: T.DataType) -> bool:
    node = tree
    for name in path[:-1]:
        child = node.get(name)
        if child is None:
            return True
        if not isinstance(child, _Tree):
            return False
        node = child
    return path[-1] not in node or node[path[-1]] == leaf


def json_error(payload: Column) -> Column:
    """Why a payload is not a JSON object or array; NULL when it is one."""
    kinds = {"VOID": "<nil>", "BOOLEAN": "bool", "STRING": "string"}

    def judge(root: Column) -> Column:
        schema = F.schema_of_variant(root)
        name = F.lit("json.Number")
        for spark_name, shown in kinds.items():
            name = F.when(schema == spark_name, shown).otherwise(name)
        return (
            F.when(
                F.coalesce(F.octet_length(payload), F.lit(0)) == 0,
                "message value is nil - possible decoding failure",
            )
            .when(root.isNull(), "json decoding failed: malformed JSON")
            .when(
                ~V.is_container(root),
                F.concat(F.lit("decoded JSON is not a valid object or array: "), name),
            )
        )

    return let(V.parse(payload), judge)
