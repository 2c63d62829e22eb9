"""JSON column functions over text columns.

Field order matters to several rules here, so a document is opened as a map,
which keeps the order of its text; a variant sorts its keys. A second read of
the same document as variants only tells texts from objects and arrays.
"""

from __future__ import annotations

import json
import re
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sparkdesk.functions.strings import is_empty

_CORRUPT = "_unreadable"
_TEXT_MAP = "map<string,string>"
_VARIANT_MAP = "map<string,variant>"
_NODES = "array<struct<path:string,key:string,kind:string,value:string,level:int>>"


def _as_text(c: Column) -> Column:
    return c.cast("string")


def _starts(c: Column, bracket: str) -> Column:
    return F.startswith(F.ltrim(c, F.lit(" \t\r\n")), F.lit(bracket))


def json_valid(c: Column) -> Column:
    """True for readable JSON; text after the first value is allowed, an empty text is not."""
    readable = (
        F.when(_starts(c, "{"), F.from_json(c, _TEXT_MAP).isNotNull())
        .when(_starts(c, "["), F.from_json(c, "array<string>").isNotNull())
        .when(F.ltrim(c, F.lit(" \t\r\n")) == "", F.lit(True))
        .otherwise(F.try_parse_json(c).isNotNull())
    )
    return ~is_empty(c) & readable


def _fields(schema: T.StructType | str) -> T.StructType:
    if isinstance(schema, T.StructType):
        return schema
    return T.StructType.fromDDL(schema)


def json_parse(c: Column, schema: T.StructType | str) -> Column:
    """A struct of the declared fields; null for an empty, unreadable or ill-typed text and for ``[]``.

    Bytes are read as UTF-8. Fields that the schema does not name are ignored.
    """
    fields = _fields(schema)
    text = _as_text(c)
    checked = T.StructType(fields.fields + [T.StructField(_CORRUPT, T.StringType())])
    row = F.from_json(text, checked, {"columnNameOfCorruptRecord": _CORRUPT})
    readable = _starts(text, "{") & row.getField(_CORRUPT).isNull()
    return F.when(readable, F.struct(*[row.getField(f.name).alias(f.name) for f in fields.fields]))


def json_list(c: Column, element: str) -> Column:
    """An array of the element type; an empty array for an empty, unreadable or ill-typed text."""
    plain = F.from_json(c, f"array<{element}>")
    wrapped = F.from_json(
        F.concat(F.lit('{"v":'), c, F.lit("}")),
        f"v array<{element}>, {_CORRUPT} string",
        {"columnNameOfCorruptRecord": _CORRUPT},
    )
    ends = F.endswith(F.rtrim(c, F.lit(" \t\r\n")), F.lit("]"))
    fits = _starts(c, "[") & (~ends | wrapped.getField(_CORRUPT).isNull())
    return F.coalesce(F.when(fits, plain), F.array().cast(f"array<{element}>"))


def _kind(v: Column) -> Column:
    """object, array, text or other; the type of the variant is made once."""
    known = F.create_map(*[F.lit(x) for pair in (("OBJECT", "object"), ("ARRAY", "array"), ("STRING", "text")) for x in pair])
    return F.coalesce(F.try_element_at(known, F.substring_index(F.schema_of_variant(v), "<", 1)), F.lit("other"))


def _children(c: Column, path: Column, level: int) -> Column:
    """array<struct<path, key, kind, value, level>> of one document that itself is at ``path``, in document order.

    Array elements have a null key. ``value`` is the bare text of a text and
    the JSON of anything else; a scalar document has no children.
    """

    def node(step: Column, key: Column, value: Column, typed: Column) -> Column:
        return F.struct(
            F.concat(path, step).alias("path"), key.alias("key"), _kind(typed).alias("kind"),
            F.coalesce(value, F.lit("null")).alias("value"), F.lit(level).alias("level"),
        )

    fields = F.zip_with(
        F.map_entries(F.from_json(c, _TEXT_MAP)),
        F.map_values(F.from_json(c, _VARIANT_MAP)),
        lambda e, v: node(F.concat(F.lit("."), e["key"]), e["key"], e["value"], v),
    )
    items = F.zip_with(
        F.transform(F.from_json(c, "array<string>"), lambda e, i: F.struct(e.alias("e"), i.alias("i"))),
        F.from_json(c, "array<variant>"),
        lambda e, v: node(F.concat(F.lit("["), e["i"].cast("string"), F.lit("]")), F.lit(None).cast("string"), e["e"], v),
    )
    return F.coalesce(F.when(_starts(c, "{"), fields).when(_starts(c, "["), items), F.array().cast(_NODES))


def is_container(kind: Column) -> Column:
    return kind.isin("object", "array")


def _nodes(c: Column, path: Column, depth: int, level: int = 1) -> Column:
    """All nodes below a document with their ``level``, a parent before its children, down to level ``depth``."""
    nodes = _children(c, path, level)
    if level >= depth:
        return nodes

    def with_below(e: Column) -> Column:
        return F.when(is_container(e["kind"]), F.concat(F.array(e), _nodes(e["value"], e["path"], depth, level + 1))).otherwise(F.array(e))

    return F.flatten(F.transform(nodes, with_below))


def nodes_from(c: Column, path: Column, depth: int) -> Column:
    """array<struct<path, key, kind, value, level>> of ``depth`` levels of a document that itself is at ``path``."""
    return _nodes(c, path, depth)


_STRING = r'"[^"\\]*+(?:\\.[^"\\]*+)*+"'


def json_depth(c: Column) -> Column:
    """How many levels of nodes a document has: its brackets, outside of texts, open so deep at most."""
    brackets = F.regexp_replace(F.regexp_replace(c, rf"(?s){_STRING}", ""), r"[^\[\]{}]++", "")
    start = F.struct(F.lit(0).alias("now"), F.lit(0).alias("most"))

    def step(state: Column, sign: Column) -> Column:
        now = state["now"] + F.when(sign.isin("{", "["), 1).when(sign == "", 0).otherwise(-1)
        return F.struct(now.alias("now"), F.greatest(state["most"], now).alias("most"))

    return F.coalesce(F.aggregate(F.split(brackets, ""), start, step, lambda state: state["most"]), F.lit(0))


def json_flatten(c: Column, depth: int) -> Column:
    """array<struct<path, key, kind, value>> of the first ``depth`` levels, in document order; explode it for rows.

    ``value`` is a raw-fragment read: a text stays text, anything else is JSON. For all levels
    see ``operators.json_nodes``.
    """
    plain = lambda e: F.struct(*[e[f].alias(f) for f in ("path", "key", "kind", "value")])
    return F.transform(_nodes(c, F.lit("$"), depth), plain)


def _root(c: Column) -> Column:
    """The compact document of an object or an array, null for anything else."""
    return F.when(_starts(c, "{") | _starts(c, "["), F.get_json_object(c, "$"))


def _key(name: str) -> str:
    return json.dumps(name, ensure_ascii=False) + ":"


def _found(c: Column, names: Sequence[str], container) -> Column:
    """A struct of the texts of the first field of each name; ``container(document, name)`` is that of an object or array.

    The compact document is made once and scanned once, into its texts, each with the scalar after it where it is a key. In a
    compact document a text before a colon is a key, and a key without a scalar has a container.
    """
    fields = F.regexp_extract_all(_root(c), F.lit(rf"(?s){_STRING}(?::(?:{_STRING}|[^\"\[\]{{}},]++)?+)?+"), F.lit(0))

    def text(found: Column, name: str) -> Column:
        value = F.substring(F.get(F.filter(found, lambda f: F.startswith(f, F.lit(_key(name)))), F.lit(0)), len(_key(name)) + 1, 2**31 - 1)
        bare = F.get_json_object(F.concat(F.lit('{"v":'), value, F.lit("}")), "$.v")
        return F.when(value == "", container(c, name)).when(F.startswith(value, F.lit('"')), bare).otherwise(value)

    # The list is bound by a lambda, so it is made once for all names.
    told = F.transform(F.array(fields), lambda found: F.struct(*[text(found, name).alias(name) for name in names]))
    return F.get(told, F.lit(0))


def json_find_all(c: Column, names: Sequence[str]) -> Column:
    """A struct with ``json_find`` of every name, from one scan of the document."""
    return _found(c, names, lambda c, name: F.lit(""))


def json_node_strings(c: Column, names: Sequence[str]) -> Column:
    """A struct with ``json_node_string`` of every name, from one scan; the document is read again only for a field that is a container."""
    found = _found(c, names, lambda c, name: _value_text(_field_tail(c, name)))
    whole = F.transform(F.array(found), lambda r: F.struct(*[F.coalesce(r[name], F.lit("")).alias(name) for name in names]))
    return F.get(whole, F.lit(0))


def _field_tail(c: Column, name: str) -> Column:
    """The compact document from the value of the first field ``name`` on, null without one.

    The first such key in the text is the first in document order at any depth. The
    pattern steps over whole string tokens, so a text that looks like a key is not taken
    for one; it never backtracks.
    """
    key = re.escape(_key(name))
    return F.nullif(F.regexp_extract(_root(c), rf'(?s)^(?:[^"]++|(?!{key}){_STRING})*+{key}(.*)$', 1), F.lit(""))


def _value_text(tail: Column) -> Column:
    return F.get_json_object(F.concat(F.lit('{"v":'), tail), "$.v")


def json_find(c: Column, name: str) -> Column:
    """The first field of that name at any depth, as text; a container reads as an empty text."""
    return json_find_all(c, [name]).getField(name)


def json_node_string(c: Column, name: str) -> Column:
    """As ``json_find``, but a container reads as its JSON and a missing field as an empty text."""
    return json_node_strings(c, [name]).getField(name)


def json_text_or(c: Column, path: str, default) -> Column:
    return F.coalesce(F.get_json_object(c, path), default if isinstance(default, Column) else F.lit(default))


def json_map(c: Column) -> Column:
    """map<string,string>; null for an empty or unreadable text and where a value is nested."""
    nested = F.exists(F.map_values(F.from_json(c, _VARIANT_MAP)), lambda v: is_container(_kind(v)))
    return F.when(_starts(c, "{") & ~nested, F.from_json(c, _TEXT_MAP))


def json_map_typed(c: Column, value_type: str = "string") -> Column:
    """As ``json_map`` with typed values; an empty map instead of null, nested values kept as JSON."""
    typed = f"map<string,{value_type}>"
    return F.coalesce(F.when(_starts(c, "{"), F.from_json(c, typed)), F.create_map().cast(typed))


def json_encode(*columns: Column, pretty: bool = False) -> Column:
    """A JSON text of the given named columns; null fields are written."""
    options = {"ignoreNullFields": "false"}
    if pretty:
        options["pretty"] = "true"
    return F.to_json(F.struct(*columns), options)


def json_bytes(*columns: Column) -> Column:
    return json_encode(*columns).cast("binary")


def _strict(c: Column, bracket: str, what: str) -> Column:
    value = F.parse_json(c)
    wrong = F.raise_error(F.concat(F.lit(f"not a JSON {what}: "), F.substring(c, 1, 80)))
    return F.when(c.isNull() | _starts(c, bracket), value).otherwise(wrong.cast("variant"))


def json_strict_object(c: Column) -> Column:
    """Variant of a JSON object; the job fails on anything else. An empty text gives null."""
    return F.when(c == "", F.lit(None).cast("variant")).otherwise(_strict(c, "{", "object"))


def json_strict_array(c: Column) -> Column:
    return _strict(c, "[", "array")


def map_to_struct(c: Column, schema: T.StructType | str) -> Column:
    return F.from_json(F.to_json(c), _fields(schema).simpleString())


def struct_to_map(c: Column, fields: list[str]) -> Column:
    return F.map_from_arrays(
        F.array(*[F.lit(name) for name in fields]), F.array(*[c.getField(name).cast("string") for name in fields])
    )
