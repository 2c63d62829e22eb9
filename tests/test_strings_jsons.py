"""String, link and JSON functions on edge values."""

import json

import pytest
from pyspark.sql import functions as F

from sparkdesk.functions import jsons as J
from sparkdesk.operators.json_nodes import json_nodes
from sparkdesk.functions import links as L
from sparkdesk.functions import strings as S


def values(spark, rule, *inputs):
    rows = [(i, *x) if isinstance(x, tuple) else (i, x) for i, x in enumerate(inputs)]
    width = max(len(r) for r in rows)
    schema = "i int, " + ", ".join(f"c{n} string" for n in range(width - 1))
    df = spark.createDataFrame(rows, schema)
    columns = [F.col(f"c{n}") for n in range(width - 1)]
    return [r["v"] for r in df.select("i", rule(*columns).alias("v")).orderBy("i").collect()]


def test_blank_and_trim(spark):
    nbsp = " "
    assert values(spark, S.is_blank, None, "", " \t\n \x1f", nbsp, "a", "\x00") == [True, True, True, False, False, False]
    assert values(spark, S.is_not_blank, None, "x") == [False, True]
    assert values(spark, S.is_empty, None, "", " ") == [True, True, False]
    assert values(spark, S.trim_ctl, None, "\x00\x01 a b\t\r\n", " x", "\x1f") == [None, "a b", " x", ""]
    assert values(spark, S.first_non_blank, (None, " ", " x "), ("", "", ""), (" a\t", "b", "c")) == ["x", "", "a"]
    assert values(spark, lambda c: S.default_if_blank(c, F.lit("d")), None, " ", "v ") == ["d", "d", "v "]


def test_equals_ignore_case(spark):
    got = values(spark, S.equals_ignore_case, ("aB", "Ab"), (None, None), (None, "a"), ("ß", "SS"), ("É", "é"))
    assert got == [True, True, False, False, True]


def test_escape_java(spark):
    given = ['a"b\\c/\'', "é", "\U0001f600", "\b\f\n\r\t\x01\x1f\x7f", "中", "plain", None, ""]
    want = ['a\\"b\\\\c/\'', "\\u00E9", "\\uD83D\\uDE00", "\\b\\f\\n\\r\\t\\u0001\\u001F\x7f", "\\u4E2D", "plain", None, ""]
    assert values(spark, S.escape_java, *given) == want


def test_small_string_rules(spark):
    assert values(spark, S.single_quote, "a", None) == ["'a'", "'null'"]
    assert values(spark, S.split_double_braces, "{{{", "a}}b{{c", "{}", "}}}}") == ["{ { {", "a} }b{ {c", "{}", "} } } }"]
    assert values(spark, S.last_application_id, "x application_1_2 application_33_4y", "none", None) == ["application_33_4", None, None]
    assert values(spark, S.snippet, "x" * 300, "ab") == ["x" * 240, "ab"]
    assert values(spark, S.job_tags, ("s", " "), ("s", "k")) == ["submissionId=s", "submissionId=s,businessKey=k"]
    df = spark.sql("select array('a', null, 'b') a, cast(array() as array<string>) e, cast(null as array<string>) n")
    assert tuple(df.select(*[S.join_nulls(F.col(c), ",") for c in "aen"]).first()) == ("a,,b", "", None)


def test_links(spark):
    assert values(spark, L.extract_video_id, "https://x/video/BV1234567890abc?p=2", "BV123", None) == ["BV1234567890", None, None]
    urls = ["http://a/?p=3&p=4", "http://a/?%70=5", "http://a/?p", "http://a/?x=1", "http://a/ b?p=3", "http://a/?p=0",
            "http://a/?p=2.5", "http://a/?p=%203", "http://a/?&=&p=7=8", "http://a/?p=9999999999", None]
    assert values(spark, L.url_page_index, *urls) == [3, 5, 1, 1, 1, 1, 1, 1, 1, 1, 1]
    assert values(spark, lambda c: L.url_page_index(c, F.lit(2)), *urls[:2]) == [2, 2]
    assert values(spark, L.https_url, "//a/b", "http://a", "https://a", "ftp://a") == ["https://a/b", "https://a", "https://a", "ftp://a"]
    names = ['a/b\\c:*?"<>|d', "  x \t\n y ", "end...", "...", "", " ", "v" * 200, "a. ."]
    assert values(spark, L.safe_file_name, *names) == ["a_b_c_d", "x y", "end", "untitled", "untitled", "untitled", "v" * 150, "a. "]
    assert values(spark, L.safe_entry_name, "a/b\\c.csv", ".", "..", " ", None) == ["a_b_c.csv", "data.csv", "data.csv", "data.csv", "data.csv"]
    assert values(spark, L.export_base_name, "x.parquet", ".parquet", " ", "x.parquet.gz", "x.parquet\n") == [
        "x", "data", "data", "x.parquet.gz", "x.parquet\n",
    ]
    df = spark.sql("select * from values ('t', 1, 1, 'p'), ('t', 2, 3, 'p'), ('t', 2, 3, 't'), ('t', 2, 3, ' '), ('t', 2, 3, null) v(t, i, n, p)")
    got = [r[0] for r in df.select(L.doc_base_name(F.col("t"), F.col("i"), F.col("n"), F.col("p"))).collect()]
    assert got == ["t", "t-P2-p", "t-P2", "t-P2", "t-P2"]


def test_json_valid_parse_list_map(spark):
    given = ['{"a":1,"zz":2}', "[]", "", "{bad", '{"a":"x"} trailing', "  ", "5", None, '{"a":1,"a":2}', "[1,"]
    assert values(spark, J.json_valid, *given) == [True, True, False, False, True, True, True, False, True, False]
    parsed = values(spark, lambda c: J.json_parse(c, "a int, b string"), *given)
    assert [p and tuple(p) for p in parsed] == [(1, None), None, None, None, None, None, None, None, (2, None), None]
    trailing = values(spark, lambda c: J.json_parse(c, "a string")["a"], '{"a":"x"} trailing')
    assert trailing == ["x"]
    assert values(spark, lambda c: J.json_list(c, "int"), "[1,2]", '[1,"x"]', '{"a":1}', None, "[3] x") == [[1, 2], [], [], [], [3]]
    structs = values(spark, lambda c: J.json_list(c, "struct<a:int>"), '[{"a":1},{"b":2}]', '[{"a":"x"}]', '{"a":1}')
    assert [[tuple(x) for x in v] for v in structs] == [[(1,), (None,)], [], []]
    maps = values(spark, J.json_map, '{"a":1,"b":null,"c":"{}"}', '{"a":{}}', '{"a":[1]}', "[]", "", "{bad")
    assert maps == [{"a": "1", "b": None, "c": "{}"}, None, None, None, None, None]
    assert values(spark, J.json_map_typed, '{"a":{"b":1}}', "", "{bad") == [{"a": '{"b":1}'}, {}, {}]


def reference_find(node, name):
    """First field of that name in document order, by plain recursion; (found, value)."""
    if isinstance(node, dict):
        for key, value in node.items():
            if key == name:
                return True, value
            hit = reference_find(value, name)
            if hit[0]:
                return hit
    elif isinstance(node, list):
        for value in node:
            hit = reference_find(value, name)
            if hit[0]:
                return hit
    return False, None


DOCS = [
    {"z": 1, "a": {"q": [1, 2]}},
    {"a": {"k": "deep"}, "k": "top"},
    {"t": '"k":5', "b": [[{"x": {"y": [{"k": None}]}}]], "k": 1},
    {"t": 'say \\"k\\":', "k": {"n": [1, {"m": "é\n"}]}},
    {"k": ["k", "a"]},
    {'q"k': 1, "kk": 2},
    [{"a": 1}, {"k": True}],
    [],
    "k",
]


def test_json_find_at_any_depth(spark):
    texts = [json.dumps(d, ensure_ascii=False) for d in DOCS]
    find, node = [], []
    for doc in DOCS:
        found, value = reference_find(doc, "k")
        compact = json.dumps(value, ensure_ascii=False, separators=(",", ":"))
        text = value if isinstance(value, str) else compact
        find.append((("" if isinstance(value, (dict, list)) else text) if found else None))
        node.append(text if found else "")
    assert values(spark, lambda c: J.json_find(c, "k"), *texts, "", "{bad", '{"a":1} {"k":2}') == [*find, None, None, None]
    assert values(spark, lambda c: J.json_node_string(c, "k"), *texts, "", "{bad") == [*node, "", ""]


def test_json_find_in_a_long_document(spark):
    long = json.dumps({"a": ["\\" * 50 + '"x' * 50] * 4000, "k": 7})
    assert values(spark, lambda c: J.json_find(c, "k"), long) == ["7"]


def test_json_names_from_one_scan(spark):
    names = ["k", "a", "x", "q\"k", "é", "none"]
    docs = [*DOCS, {"é": "ü", "x": {"é": 1.50, "k": False}}, {"a": "k\":1", "b": ["x", "k"], "x": -1e3}]
    for text in [json.dumps(d, ensure_ascii=False) for d in docs] + ["", "{bad", None, " {} "]:
        all_, each = spark.range(1).select(
            J.json_find_all(F.lit(text).cast("string"), names), F.struct(*[J.json_find(F.lit(text).cast("string"), n) for n in names])
        ).first()
        assert (tuple(all_) if all_ else (None,) * 6) == tuple(each)
        nodes = spark.range(1).select(J.json_node_strings(F.lit(text).cast("string"), names)).first()[0]
        for name, found, node in zip(names, each, nodes or [""] * 6):
            if text and text.strip().startswith(("{", "[")) and text != "{bad":
                hit, value = reference_find(json.loads(text), name)
                compact = json.dumps(value, ensure_ascii=False, separators=(",", ":"))
                want = value if isinstance(value, str) else compact
                if isinstance(value, float):
                    assert float(found) == float(node) == value
                else:
                    assert found == (None if not hit else "" if isinstance(value, (dict, list)) else want)
                    assert node == (want if hit else "")
            else:
                assert found is None and node == ""


def test_json_depth(spark):
    texts = ["", "5", '"["', "[]", '{"a":1}', '{"a":"]}[[[","b":[{"c":[]}]}', "[[[[[[1]]]]],[2]]", None]
    assert values(spark, J.json_depth, *texts) == [0, 0, 0, 1, 1, 4, 6, 0]


def test_json_nodes_make_no_shuffle(spark):
    df = spark.createDataFrame([(1, '{"a":[{"b":[1]}]}')], "id int, doc string")
    assert "Exchange" not in json_nodes(df, ["id"], "doc")._jdf.queryExecution().executedPlan().toString()


def flat(node, path="$", depth=3):
    items = node.items() if isinstance(node, dict) else enumerate(node) if isinstance(node, list) else ()
    for key, value in items:
        here = f"{path}.{key}" if isinstance(node, dict) else f"{path}[{key}]"
        text = value if isinstance(value, str) else json.dumps(value, ensure_ascii=False, separators=(",", ":"))
        yield here, key if isinstance(node, dict) else None, text
        if depth > 1:
            yield from flat(value, here, depth - 1)


def test_json_flatten(spark):
    texts = [json.dumps(d, ensure_ascii=False) for d in DOCS]
    for depth in (1, 3, 6):
        got = values(spark, flatten(depth), *texts)
        for doc, nodes in zip(DOCS, got):
            assert [(n["path"], n["key"], n["value"]) for n in nodes] == list(flat(doc, depth=depth))


@pytest.mark.parametrize("step", [1, 3, 8])
def test_json_nodes_to_any_depth(spark, step):
    docs = [*DOCS, {"a": {"b": {"c": {"d": {"e": [[{"f": 1}]]}}}}}]
    df = spark.createDataFrame([(i, json.dumps(d, ensure_ascii=False)) for i, d in enumerate(docs)] + [(99, None)], "id int, doc string")
    got = {}
    for r in sorted(json_nodes(df, ["id"], "doc", step=step).collect(), key=lambda r: (r["id"], r["n"])):
        got.setdefault(r["id"], []).append((r["path"], r["key"], r["value"]))
    for i, doc in enumerate(docs):
        assert got.get(i, []) == list(flat(doc, depth=20))
    assert 99 not in got
    assert json_nodes(df, ["id"], "doc", 2, step).where("path rlike '[.].*[.].*[.]'").isEmpty()


def flatten(depth):
    return lambda c: J.json_flatten(c, depth)


@pytest.mark.parametrize("text", ["[1]", "{bad", "5"])
def test_json_strict_fails(spark, text):
    with pytest.raises(Exception):
        values(spark, lambda c: J.json_strict_object(c).cast("string"), text)


def test_json_strict(spark):
    assert values(spark, lambda c: F.to_json(J.json_strict_object(c)), '{"a":1}', "", None) == ['{"a":1}', None, None]
    assert values(spark, lambda c: F.to_json(J.json_strict_array(c)), "[1]") == ["[1]"]
    with pytest.raises(Exception):
        values(spark, lambda c: F.to_json(J.json_strict_array(c)), "{}")


def test_json_encode(spark):
    pretty = spark.range(1).select(J.json_encode(F.lit(None).cast("int").alias("a"), F.lit("x").alias("b"), pretty=True).alias("v"))
    assert json.loads(pretty.first()["v"]) == {"a": None, "b": "x"} and "\n" in pretty.first()["v"]
