"""Deeply nested records as related flat tables: shared inlining.

The element graph of the records is analysed first: which element holds which, how often, and under how many others.
An element that occurs at most once in its parent, under one parent only, is inlined into the parent's table; one that
is repeated, shared by several parents or recursive gets a table of its own. Each row of such a table holds a foreign
key to the row its parent element was put in.

The graph is as large as the records' vocabulary, not as the data: every task folds its records into edges, these are
aggregated, and only they reach the driver.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterator
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

ROOT = "$"
#: The only column of a list's entry that is no object.
VALUE = "$value"

#: How a name of a field is written; an object that has other keys and only objects as values is a map from keys to elements.
FIELD_NAME = r"[a-z][a-zA-Z0-9_]*"


def _no_constant(name: str) -> None:
    raise ValueError(name)


def read_json(text: str | None) -> object:
    """The value of a JSON text, however deeply nested; raises ValueError if it isn't one (NaN and Infinity aren't JSON either)."""
    if text is None:
        raise ValueError("no text")
    try:
        return json.loads(text, parse_constant=_no_constant)
    except RecursionError:
        return _read_deep(text)


_PIECE = re.compile(r'[ \t\n\r]*([\[\]{},:]|"(?:[^"\\\x00-\x1f]|\\.)*"|[^\s\[\]{},:"]+)')


def _read_deep(text: str) -> object:
    """As :func:`read_json`, with a stack instead of recursion: what is open, and for objects the name that waits for its value."""
    done: list[object] = []  # the outermost value, once it is there
    open_: list[tuple[list | dict, list[str]]] = []
    wants = "value"  # or "name", ":" or "more", or with "]" or "}" beside it where a list or object may end at once
    at, end = 0, len(text.rstrip(" \t\n\r"))
    while at < end:
        piece = _PIECE.match(text, at)
        if piece is None or done:
            raise ValueError("not JSON")
        at, mark = piece.end(), piece.group(1)
        if mark in "]}":
            if not open_ or (mark == "]") != isinstance(open_[-1][0], list) or not (wants == "more" or wants.endswith(mark)):
                raise ValueError("not JSON")
            value: object = open_.pop()[0]
        elif wants == "more":
            if mark != "," or not open_:
                raise ValueError("not JSON")
            wants = "value" if isinstance(open_[-1][0], list) else "name"
            continue
        elif wants == ":":
            if mark != ":":
                raise ValueError("not JSON")
            wants = "value"
            continue
        elif wants.startswith("name"):
            if mark[0] != '"':
                raise ValueError("not JSON")
            open_[-1][1].append(json.loads(mark))
            wants = ":"
            continue
        elif mark in "[{":
            open_.append(([], []) if mark == "[" else ({}, []))
            wants = "value]" if mark == "[" else "name}"
            continue
        else:
            value = json.loads(mark, parse_constant=_no_constant)
        if not open_:
            done.append(value)
        elif isinstance(open_[-1][0], list):
            open_[-1][0].append(value)
        else:
            open_[-1][0][open_[-1][1].pop()] = value
        wants = "more"
    if not done:
        raise ValueError("not JSON")
    return done[0]


def scalar(value: object) -> str | None:
    """A leaf as text: strings as they are, other values as JSON writes them, None as None."""
    if value is None or isinstance(value, str):
        return value
    try:
        return json.dumps(value, ensure_ascii=False, separators=(",", ":"))
    except RecursionError:
        return _write_deep(value)


def _write_deep(value: object) -> str:
    out: list[str] = []
    todo: list[object] = [value]
    while todo:
        item = todo.pop()
        if isinstance(item, _Mark):
            out.append(item)
        elif isinstance(item, (list, dict)):
            pairs = item.items() if isinstance(item, dict) else ((None, v) for v in item)
            parts: list[object] = [_Mark("[" if isinstance(item, list) else "{")]
            for i, (k, v) in enumerate(pairs):
                parts.append(_Mark(("," if i else "") + ("" if k is None else json.dumps(k, ensure_ascii=False) + ":")))
                parts.append(v)
            parts.append(_Mark("]" if isinstance(item, list) else "}"))
            todo.extend(reversed(parts))
        else:
            out.append(json.dumps(item, ensure_ascii=False))
    return "".join(out)


class _Mark(str):
    """Text of the JSON being written, not a value of it."""


#: How often a recursive element stands in a path, at most, and how long a row's name may be before a digest stands for it.
PATH_TURNS, NAME_LENGTH = 8, 512


def _below(path: str, step: str) -> str:
    """``path`` with ``step`` at its end; once it has turned round often enough, a path stays as it is."""
    return path if path.count(f"/{step}") >= PATH_TURNS else f"{path}/{step}"


def _named(parent: str, step: str, i: int) -> str:
    """The name of a row from its parent's; of long ones a digest, or names would grow with the depth."""
    if len(parent) > NAME_LENGTH:
        parent = hashlib.blake2b(parent.encode("utf-8", "surrogatepass"), digest_size=DIGEST).hexdigest()
    return f"{parent}/{step}:{i}"


#: Bytes of a digest that stands for a text: two texts of 10^15 share one with odds of 10^-9 at most.
DIGEST = 16


@dataclass(frozen=True)
class Shredder:
    """Walks records.

    ``opened``: fields whose strings may hold JSON and are then read as if it stood there itself. ``maps``: fields
    whose object, if all its values are objects, is a map from keys to elements whatever the keys look like.
    """

    opened: frozenset[str] = frozenset()
    maps: frozenset[str] = frozenset()
    field_name: str = FIELD_NAME

    def value(self, name: str, value: object) -> object:
        if name in self.opened and isinstance(value, str) and value.lstrip()[:1] in ("[", "{"):
            try:
                return read_json(value)
            except ValueError:
                return value
        return value

    def children(self, name: str, value: object) -> Iterator[tuple[object, int, str | None]]:
        """The objects that a field holds, with position and map key: one object has position 0, entries of a list theirs as written."""
        value = self.value(name, value)
        if isinstance(value, list):
            for i, entry in enumerate(value):
                entry = self.value(name, entry)
                if isinstance(entry, dict):
                    yield entry, i, None
        elif isinstance(value, dict):
            if value and all(isinstance(x, dict) for x in value.values()) and (name in self.maps or not any(re.fullmatch(self.field_name, k) for k in value)):
                for i, (k, entry) in enumerate(value.items()):
                    yield entry, i, k
            else:
                yield value, 0, None

    def leaves(self, name: str, value: object) -> Iterator[tuple[object, int]]:
        """The entries of a list that are no objects, NULL ones too, with position; lists in a list are entries as they are."""
        value = self.value(name, value)
        if isinstance(value, list):
            for i, entry in enumerate(value):
                if not isinstance(self.value(name, entry), dict):
                    yield entry, i

    def edges(self, record: object, found: dict[tuple[str, str], bool]) -> None:
        """Add (parent element, child element) -> repeated?"""
        todo = [(ROOT, entry) for entry, _, _ in self.children(ROOT, record)]
        if isinstance(record, list):
            found[(ROOT, ROOT)] = True
        while todo:
            name, element = todo.pop()
            for field, held in element.items():
                entries = list(self.children(field, held))
                held = self.value(field, held)
                if entries or isinstance(held, list):
                    repeated = isinstance(held, list) or any(k is not None for _, _, k in entries)
                    found[(name, field)] = found.get((name, field), False) or repeated
                    todo.extend((field, entry) for entry, _, _ in entries)

    def rows(self, record: object, tables: frozenset[str], key: str | None, start: str) -> Iterator[tuple]:
        """(path, table, row, parent row, position, owner, columns); a row's name is its parent's and its own place there."""
        todo = [(ROOT, ROOT, entry, f"{start}:{i}", None, i, None, k) for entry, i, k in self.children(ROOT, record)]
        for entry, i in self.leaves(ROOT, record):
            yield ROOT, ROOT, f"{start}:{i}", None, i, None, {VALUE: scalar(entry)}
        while todo:
            path, table, element, row, parent, pos, owner, map_key = todo.pop()
            columns: dict[str, str | None] = {}
            below: list[tuple[str, str, object]] = []
            inline = [("", element)]
            while inline:
                prefix, part = inline.pop()
                for field, held in part.items():
                    entries = list(self.children(field, held))
                    others = list(self.leaves(field, held))
                    if field in tables and (entries or others):
                        below.append((prefix, field, held))
                    elif entries or others:
                        # inlined: the first object under the field's own name, what else there is under its place
                        inline.extend((f"{prefix}{field}." if n == 0 else f"{prefix}{field}[{i}].", entry) for n, (entry, i, _) in enumerate(entries))
                        columns.update({f"{prefix}{field}[{i}]": scalar(entry) for entry, i in others})
                    elif field not in tables or not isinstance(held, (list, dict)):
                        columns[prefix + field] = scalar(held)
            own = columns.get(key) if key else None
            inherited = own if own is not None else map_key if map_key is not None else owner
            for prefix, field, held in below:
                held, step = self.value(field, held), prefix + field
                at = _below(path, step)
                todo.extend((at, field, entry, _named(row, step, i), row, i, inherited, k) for entry, i, k in self.children(field, held))
                for entry, i in self.leaves(field, held):
                    yield at, field, _named(row, step, i), row, i, inherited, {VALUE: scalar(entry)}
            yield path, table, row, parent, pos, owner, columns


def element_graph(df: DataFrame, column: str, shredder: Shredder) -> DataFrame:
    """(parent, child, repeated) of the JSON texts in ``column``; texts that aren't JSON add nothing."""

    def fold(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        found: dict[tuple[str, str], bool] = {}
        for batch in batches:
            for text in batch["text"]:
                try:
                    shredder.edges(read_json(text), found)
                except ValueError:
                    continue
        yield pd.DataFrame([(p, c, r) for (p, c), r in found.items()], columns=["parent", "child", "repeated"])

    edges = df.select(F.col(f"`{column}`").alias("text")).filter(F.col("text").isNotNull()).mapInPandas(fold, "parent string, child string, repeated boolean")
    return edges.groupBy("parent", "child").agg(F.max("repeated").alias("repeated"))


def own_tables(edges: list[tuple[str, str, bool]]) -> frozenset[str]:
    """The elements that get a table: the root, and those that are repeated, shared by several parents or recursive."""
    parents: dict[str, set[str]] = {}
    below: dict[str, set[str]] = {}
    tables = {ROOT}
    for parent, child, repeated in edges:
        parents.setdefault(child, set()).add(parent)
        below.setdefault(parent, set()).add(child)
        if repeated:
            tables.add(child)
    tables |= {child for child, above in parents.items() if len(above) > 1}
    for start in list(below):
        seen: set[str] = set()
        todo = list(below[start])
        while todo:
            element = todo.pop()
            if element not in seen:
                seen.add(element)
                todo.extend(below.get(element, ()))
        if start in seen:
            tables.add(start)
    return frozenset(tables)


SHREDDED = "root_id string, path string, tab string, row_id string, parent_row string, pos int, owner string, cols map<string,string>"


def shred_json(df: DataFrame, root_id: str, column: str, key: str | None = None, opened: tuple[str, ...] = (), maps: tuple[str, ...] = (), own: tuple[str, ...] = (), inline: tuple[str, ...] = (), tables: frozenset[str] | None = None) -> DataFrame:
    """All rows of all tables of the JSON texts in ``column``, in one frame: filter on ``tab`` to have one table.

    * root_id: of the record the row is from; path: the elements above it; tab: its table.
    * row_id: names the row; it starts with a digest of the text, so a text that comes twice gives equal rows, and two
      texts under one root_id don't mix. parent_row: the foreign key to the row above, NULL for the root.
    * pos: from 0 in the list as written; 0 if not in a list.
    * owner: the foreign key to the nearest row above that has the field ``key`` or, lacking it, stood under a key in a map.
    * cols: the element's own fields and those inlined into it, named by their path; other values than strings as JSON.

    Entries of lists that aren't objects are rows with the one column ``$value``: NULL for NULL, a list in a list as JSON.
    Paths name an element eight times at most, however deep it recurs. Empty lists give no row, nor do texts that are NULL, empty, not JSON or a single value. ``opened``, ``maps``: see :class:`Shredder`. ``own``: elements that get a table even if these
    records hold one of them at most; ``inline``: elements that don't even if they are shared or repeated: of several in
    a list, the first has columns ``field.name``, others ``field[i].name``. Both keep the tables the same whatever the
    records at hold; all other elements are placed by the graph. ``tables``: all elements with tables, if they are known; else the graph is
    analysed first.
    """
    shredder = Shredder(frozenset(opened), frozenset(maps))
    if tables is None:
        # as many rows as the records have kinds of elements in elements
        tables = own_tables([tuple(e) for e in element_graph(df, column, shredder).collect()]) - set(inline) | set(own)

    def shred(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        names = ["root_id", "path", "tab", "row_id", "parent_row", "pos", "owner", "cols"]
        for batch in batches:
            out: list[tuple] = []
            for root, text in zip(batch["root_id"], batch["text"]):
                try:
                    record = read_json(text)
                except ValueError:
                    continue
                digest = hashlib.blake2b(text.encode("utf-8", "surrogatepass"), digest_size=DIGEST).hexdigest()
                for row in shredder.rows(record, tables, key, digest):
                    out.append((root, *row))
                    if len(out) >= 20_000:
                        yield pd.DataFrame(out, columns=names)
                        out = []
            if out:
                yield pd.DataFrame(out, columns=names)

    texts = df.select(F.col(f"`{root_id}`").cast("string").alias("root_id"), F.col(f"`{column}`").alias("text"))
    return texts.filter(F.col("text").isNotNull()).mapInPandas(shred, SHREDDED)


def typed_graph(kind: T.DataType, name: str = ROOT) -> list[tuple[str, str, bool]]:
    """The edges of a column's type: what a schema says needs no look at the data."""
    if isinstance(kind, T.ArrayType):
        return typed_graph(kind.elementType, name)
    if isinstance(kind, T.MapType):
        return typed_graph(kind.valueType, name)
    if not isinstance(kind, T.StructType):
        return []
    edges: list[tuple[str, str, bool]] = []
    for field in kind.fields:
        inner = field.dataType
        if isinstance(inner, (T.ArrayType, T.MapType, T.StructType)):
            edges.append((name, field.name, isinstance(inner, (T.ArrayType, T.MapType))))
            edges += typed_graph(inner, field.name)
    return edges


def _flat(column: Column, kind: T.StructType, prefix: str = "") -> list[Column]:
    """The leaves of a struct, singletons inlined; arrays and maps are left to tables of their own."""
    out: list[Column] = []
    for field in kind.fields:
        inner = column.getField(field.name)
        if isinstance(field.dataType, T.StructType):
            out += _flat(inner, field.dataType, f"{prefix}{field.name}_")
        elif not isinstance(field.dataType, (T.ArrayType, T.MapType)):
            out.append(inner.alias(f"{prefix}{field.name}"))
    return out


def child_table(df: DataFrame, root_id: str, column: str) -> DataFrame:
    """The flat table of an array of structs: root_id, pos (from 0 as written), and the entry's leaves.

    NULL entries keep their place but give no row; a NULL or empty array gives none. Leaves called like ``root_id`` or
    ``pos`` get the array's name in front.
    """
    kind = df.schema[column].dataType
    if not isinstance(kind, T.ArrayType) or not isinstance(kind.elementType, T.StructType):
        raise TypeError(f"{column} is no array of structs")
    rows = df.select(F.col(f"`{root_id}`").alias("__root"), F.posexplode(F.col(f"`{column}`")).alias("__pos", "__entry")).filter(F.col("__entry").isNotNull())
    leaves = _flat(F.col("__entry"), kind.elementType)
    wide = rows.select(F.col("__root"), F.col("__pos"), *leaves)
    clash = {c: f"{column}_{c}" for c in wide.columns[2:] if c in (root_id, "pos")}
    return wide.withColumnsRenamed(clash).withColumnsRenamed({"__root": root_id, "__pos": "pos"})


def is_object() -> Column:
    """Whether a row of :func:`shred_json` is an object, not another value in a list."""
    return ~F.map_contains_key("cols", F.lit(VALUE))


def owned_rows(shredded: DataFrame, table: str, under: str, code: str, detail: str) -> DataFrame:
    """(root_id, parent_id, pos, code, detail) of the rows of ``table`` below an element ``under`` and in no other row of ``table``.

    Entries of ``table`` that aren't objects keep their place but give no row. parent_id is the owner's key. ``detail`` may be an object, inlined: its field "code" then. What is missing or NULL is ''.
    """

    def field(name: str) -> Column:
        return F.try_element_at("cols", F.lit(name))

    again = rf"[/.]{re.escape(table)}/(?:.*[/.])?{re.escape(table)}$"
    below = F.col("path").rlike(rf"[/.]{re.escape(under)}[/.]")
    return shredded.filter((F.col("tab") == table) & is_object() & below & ~F.col("path").rlike(again)).select(
        "root_id",
        F.coalesce("owner", F.lit("")).alias("parent_id"),
        "pos",
        F.coalesce(field(code), F.lit("")).alias("code"),
        F.coalesce(field(detail), field(f"{detail}.code"), F.lit("")).alias("detail"),
    )
