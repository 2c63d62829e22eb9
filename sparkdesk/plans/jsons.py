"""JSON functions: queries and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkdesk.functions import jsons as J
from sparkdesk.operators.json_nodes import json_nodes
from sparkdesk.plans.inputs import table


def _props():
    """Event properties; by event number also empty, cut off, an empty array, or with text after the value."""
    key = F.col("event_id") % 8
    return (
        F.when(key == 1, "").when(key == 2, F.substring("props", 1, 5)).when(key == 3, "[]")
        .when(key == 4, F.concat("props", F.lit(" trailing"))).when(key == 5, F.lit(None)).otherwise(F.col("props"))
    )


def _nested():
    """{"z": id, "a": {"u": user, "q": [{"deep": type}]}, "k": props as text, "b": ..., "u": minus user} with a null."""
    inner = F.struct(F.array(F.to_json(F.struct(F.col("event_type").alias("k")))).alias("q"), F.lit(None).cast("int").alias("n"))
    deep = F.struct(
        F.col("event_id").alias("z"),
        F.struct(F.col("user_id").alias("u"), F.array(F.struct(F.col("event_type").alias("deep"))).alias("q")).alias("a"),
        F.col("props").alias("k"),
        inner.alias("b"),
        (-F.col("user_id")).alias("u"),
    )
    return F.to_json(deep, {"ignoreNullFields": "false"})


def _events(spark: SparkSession, d: str, **columns) -> DataFrame:
    return table(spark, d, "events").select("event_id", *[c.alias(name) for name, c in columns.items()])


def json_valid(spark, d):
    return _events(spark, d, valid=J.json_valid(_props()))


def json_parse(spark, d):
    row = J.json_parse(_props(), "k int")
    raw = J.json_parse(_props().cast("binary"), "k int, other string")
    return _events(spark, d, parsed=row.isNotNull(), k=row["k"], from_bytes=raw["k"])


def json_list(spark, d):
    text = F.when(F.col("event_id") % 4 == 1, "[1,").when(F.col("event_id") % 4 == 2, "").otherwise(
        F.concat(F.lit("["), F.concat_ws(",", "user_id", "event_id"), F.lit("]"))
    )
    rows = F.concat(F.lit("["), "props", F.lit(","), "props", F.lit("]"))
    return _events(
        spark, d, numbers=F.array_join(J.json_list(text, "bigint"), "|"),
        ks=F.array_join(F.transform(J.json_list(rows, "struct<k:int>"), lambda x: x["k"]), "|"),
    )


def json_find(spark, d):
    """Six names from one scan; ``u`` stands in the text twice, nested first."""
    found = table(spark, d, "events").select("event_id", J.json_find_all(_nested(), ["u", "deep", "k", "a", "n", "missing"]).alias("f"))
    return found.select(
        "event_id", "f.u", "f.deep", "f.k", F.col("f.a").alias("container"), F.col("f.n").alias("null_value"), "f.missing"
    )


def json_node_string(spark, d):
    found = table(spark, d, "events").select("event_id", J.json_node_strings(_nested(), ["u", "a", "k", "missing"]).alias("f"))
    return found.select(
        "event_id", "f.u", F.col("f.a").alias("container"), "f.k", "f.missing", J.json_node_string(F.lit("{bad"), "k").alias("bad")
    )


def json_map(spark, d):
    plain = J.json_map(_props())
    nested = J.json_map(_nested())
    typed = J.json_map_typed(_props(), "int")
    return _events(spark, d, k=F.try_element_at(plain, F.lit("k")), nested=nested.isNull(), size=F.size(typed))


def json_encode(spark, d):
    fields = [F.col("event_id"), F.col("event_type"), F.when(F.col("event_id") % 2 == 0, F.col("user_id")).alias("user_id")]
    return _events(spark, d, text=J.json_encode(*fields), size=F.octet_length(J.json_bytes(*fields)))


def json_strict(spark, d):
    value = J.json_strict_object(F.col("props"))
    items = J.json_strict_array(F.concat(F.lit("["), "props", F.lit("]")))
    return _events(spark, d, k=F.variant_get(value, "$.k", "int"), first=F.variant_get(items, "$[0].k", "int"))


def map_struct(spark, d):
    row = F.struct("user_id", "event_type")
    as_map = J.struct_to_map(row, ["user_id", "event_type"])
    back = J.map_to_struct(as_map, "event_type string, user_id string, absent int")
    return _events(spark, d, user_text=as_map["user_id"], event_type=back["event_type"], absent=back["absent"])


def json_flatten(spark, d):
    """The nested documents with a chain of five more levels at their end."""
    chain = F.concat(F.lit(',"c":{"d":{"e":{"f":{"g":'), "event_id", F.lit("}}}}}"))
    deep = F.concat(F.regexp_replace(_nested(), r"\}$", ""), chain)
    return json_nodes(table(spark, d, "events").select("event_id", deep.alias("doc")), ["event_id"], "doc")


QUERIES = {
    "json_valid": json_valid,
    "json_parse": json_parse,
    "json_list": json_list,
    "json_find": json_find,
    "json_node_string": json_node_string,
    "json_map": json_map,
    "json_encode": json_encode,
    "json_strict": json_strict,
    "map_struct": map_struct,
    "json_flatten": json_flatten,
}

_K = "(props->>'$.k')::int"
_GOOD = "event_id % 8 in (0, 4, 6, 7)"
_PROPS_TEXT = "'{\"k\": ' || (props->>'$.k') || '}'"
_QUOTED = "'\"' || replace(props, '\"', '\\\"') || '\"'"
_A = "'{\"u\":' || user_id || ',\"q\":[{\"deep\":\"' || event_type || '\"}]}'"
_B = "'{\"q\":[\"{\\\"k\\\":\\\"' || event_type || '\\\"}\"],\"n\":null}'"

ORACLE = {
    "json_valid": "select event_id, event_id % 8 not in (1, 2, 5) as valid from events",
    "json_parse": f"""
        select event_id, {_GOOD} as parsed, case when {_GOOD} then {_K} end as k, case when {_GOOD} then {_K} end as from_bytes
        from events""",
    "json_list": f"""
        select event_id, case when event_id % 4 in (1, 2) then '' else user_id || '|' || event_id end as numbers,
               {_K} || '|' || {_K} as ks
        from events""",
    "json_find": """
        select event_id, user_id::varchar as u, event_type as deep, props as k, '' as container, 'null' as null_value,
               null::varchar as missing
        from events""",
    "json_node_string": f"""
        select event_id, user_id::varchar as u, {_A} as container, props as k, '' as missing, '' as bad from events""",
    "json_map": f"""
        select event_id, case when {_GOOD} then {_K}::varchar end as k, true as nested,
               case when {_GOOD} then 1 else 0 end::int as size
        from events""",
    "json_encode": """
        with t as (select event_id, '{"event_id":' || event_id || ',"event_type":"' || event_type || '","user_id":'
                          || case when event_id % 2 = 0 then user_id::varchar else 'null' end || '}' as text from events)
        select event_id, text, strlen(text)::int as size from t""",
    "json_strict": f"select event_id, {_K} as k, {_K} as first from events",
    "map_struct": "select event_id, user_id::varchar as user_text, event_type, null::int as absent from events",
    "json_flatten": f"""
        select event_id, u.n::int as n, u.path, u.key, u.kind, u.value from (
            select event_id, unnest([
                {{'n': 0, 'path': '$.z', 'key': 'z', 'kind': 'other', 'value': event_id::varchar}},
                {{'n': 1, 'path': '$.a', 'key': 'a', 'kind': 'object', 'value': {_A}}},
                {{'n': 2, 'path': '$.a.u', 'key': 'u', 'kind': 'other', 'value': user_id::varchar}},
                {{'n': 3, 'path': '$.a.q', 'key': 'q', 'kind': 'array', 'value': '[{{"deep":"' || event_type || '"}}]'}},
                {{'n': 4, 'path': '$.a.q[0]', 'key': null, 'kind': 'object', 'value': '{{"deep":"' || event_type || '"}}'}},
                {{'n': 5, 'path': '$.a.q[0].deep', 'key': 'deep', 'kind': 'text', 'value': event_type}},
                {{'n': 6, 'path': '$.k', 'key': 'k', 'kind': 'text', 'value': props}},
                {{'n': 7, 'path': '$.b', 'key': 'b', 'kind': 'object', 'value': {_B}}},
                {{'n': 8, 'path': '$.b.q', 'key': 'q', 'kind': 'array', 'value': '["{{\\"k\\":\\"' || event_type || '\\"}}"]'}},
                {{'n': 9, 'path': '$.b.q[0]', 'key': null, 'kind': 'text', 'value': '{{"k":"' || event_type || '"}}'}},
                {{'n': 10, 'path': '$.b.n', 'key': 'n', 'kind': 'other', 'value': 'null'}},
                {{'n': 11, 'path': '$.u', 'key': 'u', 'kind': 'other', 'value': (-user_id)::varchar}},
                {{'n': 12, 'path': '$.c', 'key': 'c', 'kind': 'object', 'value': '{{"d":{{"e":{{"f":{{"g":' || event_id || '}}}}}}}}'}},
                {{'n': 13, 'path': '$.c.d', 'key': 'd', 'kind': 'object', 'value': '{{"e":{{"f":{{"g":' || event_id || '}}}}}}'}},
                {{'n': 14, 'path': '$.c.d.e', 'key': 'e', 'kind': 'object', 'value': '{{"f":{{"g":' || event_id || '}}}}'}},
                {{'n': 15, 'path': '$.c.d.e.f', 'key': 'f', 'kind': 'object', 'value': '{{"g":' || event_id || '}}'}},
                {{'n': 16, 'path': '$.c.d.e.f.g', 'key': 'g', 'kind': 'other', 'value': event_id::varchar}}]) as u
            from events)""",
}
