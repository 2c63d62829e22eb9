"""Captions: link files, part and track choice, documents."""

import glob
import json
import random

from pyspark.sql import functions as F

from sparkdesk.operators import captions as C
from sparkdesk.sources.link_lists import url_source


def test_url_source(spark, tmp_path):
    (tmp_path / "a.txt").write_text("\n  # note\nhttp://1 \r\n\t\nhttp://2\x0bhttp://3\n", newline="")
    (tmp_path / "b.json").write_text('\n [" http://4 ", 5, null, "", {"x": "http://no"},\n "http://5"]')
    (tmp_path / "c.txt").write_text("")
    got = url_source(spark, str(tmp_path)).orderBy("pos")
    assert [r["url"] for r in got.collect()] == ["http://1", "http://2", "http://3", "http://4", "http://5"]
    assert url_source(spark, str(tmp_path / "b.json"), "json").count() == 2
    assert url_source(spark, str(tmp_path / "a.txt"), "lines").count() == 3


def test_track_choice_in_rows_and_arrays(spark):
    pick = random.Random(5)
    lans = [("en", "English"), ("zh-CN", "x"), ("ja", "中文字"), ("JA", "日本"), (None, None), ("de", "Deutsch EN")]
    items = [(i, [pick.choice(lans) for _ in range(pick.randrange(1, 6))]) for i in range(60)]
    schema = "id int, tracks array<struct<lan:string,lan_doc:string>>"
    df = spark.createDataFrame(items, schema)
    rows = df.select("id", F.posexplode("tracks").alias("pos", "t")).select("id", "pos", "t.*")

    def by_hand(tracks, wanted):
        wanted = wanted.strip().lower()
        for lan, words in tracks:
            if wanted and (wanted in (lan or "").lower() or wanted in (words or "").lower()):
                return lan, words
        for lan, words in tracks:
            if "zh" in (lan or "").lower() or "中文" in (words or ""):
                return lan, words
        return tracks[0]

    for wanted in ("zh", " EN ", "", "fr"):
        want = {i: by_hand(t, wanted) for i, t in items}
        in_array = df.select("id", C.pick_track_in(F.col("tracks"), wanted).alias("t"))
        assert {r["id"]: tuple(r["t"]) for r in in_array.collect()} == want
        picked = C.pick_track(rows, ["id"], "pos", wanted)
        assert {r["id"]: (r["lan"], r["lan_doc"]) for r in picked.collect()} == want


def test_select_part(spark):
    view = json.dumps({"data": {"cid": 9, "pages": [{"cid": 1, "part": "a"}, {"cid": 0, "part": " "}, {"part": None}]}})
    df = spark.createDataFrame([(view, i) for i in (1, 2, 3)], "v string, i int")
    data = F.from_json("v", C.VIEW_SCHEMA)["data"]
    got = df.select(C.select_part(data["pages"], F.col("i"), data["cid"]).alias("p")).collect()
    assert [tuple(r["p"]) for r in got] == [(1, "a"), (9, None), (9, None)]


def test_api_code(spark):
    df = spark.createDataFrame([(p,) for p in ('{"code":0}', '{"code":"0"}', '{"code":-1,"message":"m"}', "{}", "bad")], "p string")
    got = df.select(C.api_code_ok(F.col("p")), C.api_error(F.col("p"))).collect()
    assert [tuple(r) for r in got] == [
        (True, None), (True, None), (False, "code=-1, message=m"),
        (False, "code=-2147483648, message="), (False, "code=-2147483648, message="),
    ]


def _landed(spark):
    views = [
        ("BV0000000001", {"code": 0, "data": {"aid": 1, "cid": 11, "title": "T", "pages": [{"cid": 11, "part": "p"}]}}),
        ("BV0000000002", {"code": 0, "data": {"aid": 2, "cid": 22, "title": None}}),
        ("BV0000000003", {"code": 0, "data": []}),
    ]
    entry = [{"lan": "en", "lan_doc": "E", "subtitle_url": "//s/en"}, {"lan": "zh", "lan_doc": "", "subtitle_url": "http://s/zh"}]
    tracks = [(11, 1, {"code": 0, "data": {"subtitle": {"subtitles": entry}}}), (22, 2, {"code": 0, "data": {"subtitle": {}}})]
    bodies = [("https://s/zh", {"body": [{"content": " a "}, {"content": ""}, 5, {"content": "b"}]})]
    return (
        spark.createDataFrame([(k, json.dumps(v)) for k, v in views], "bvid string, payload string"),
        spark.createDataFrame([(c, a, json.dumps(v)) for c, a, v in tracks], "cid bigint, aid bigint, payload string"),
        spark.createDataFrame([(u, json.dumps(v)) for u, v in bodies], "url string, payload string"),
    )


def test_one_item_does_not_stop_the_others(spark):
    links = ["x/BV0000000001", "x/BV0000000001?p=4", "x/BV0000000002", "x/BV0000000003", "x/BV0000000009", "nothing"]
    urls = spark.createDataFrame([(u, 0, i) for i, u in enumerate(links)], "url string, src int, pos int")
    views, tracks, bodies = _landed(spark)
    items = C.caption_tracks(C.caption_context(urls, views), tracks, bodies)
    rows = {r["pos"]: r for r in C.caption_names(items).collect()}
    assert rows[0]["lines"] == rows[1]["lines"] == ["a", "b"] and rows[0]["base_name"] == "T"
    assert rows[1]["page_index"] == 1
    assert [rows[i]["error"] for i in range(6)] == [None, None, "no tracks", "unexpected view", "no view", "no video id"]
    assert rows[2]["title"] == "BV0000000002" and rows[5]["base_name"] is None
    assert {r["status"]: r["items"] for r in C.item_outcomes(items).collect()} == {"ok": 2, "failed": 4}


def test_caption_doc_in_pieces(spark, monkeypatch):
    monkeypatch.setattr(C, "PIECE_BITS", 1)
    rows = [("a", i, f"l{i}") for i in range(20)] + [("b", -1, "x"), ("b", 7, None), ("b", 8, "")]
    df = spark.createDataFrame(random.Random(1).sample(rows, len(rows)), "k string, n int, t string")
    got = {r["k"]: (r["line_count"], r["doc"]) for r in C.caption_doc(df, "k", "n", "t").collect()}
    assert got == {"a": (20, "\n".join(f"l{i}" for i in range(20))), "b": (3, "x\n\n")}


def test_text_files(spark, tmp_path):
    docs = spark.createDataFrame([("x.md", "a\nb"), ("é: 1.md", "")], "name string, doc string")
    C.write_text_docs(docs, str(tmp_path / "one"))
    (file,) = glob.glob(f"{tmp_path}/one/name=x.md/part-*")
    assert open(file).read() == "a\nb\n"
    assert len(glob.glob(f"{tmp_path}/one/name=*")) == 2
    lines = spark.range(1000).select(F.when(F.col("id") % 3 == 0, "x").otherwise("hot").alias("name"), "id", F.col("id").cast("string").alias("t"))
    C.write_text_lines(lines.repartition(5), str(tmp_path / "many"), "name", "id", "t")
    text = "".join(open(f).read() for f in sorted(glob.glob(f"{tmp_path}/many/name=hot/part-*")))
    assert text == "".join(f"{i}\n" for i in range(1000) if i % 3)


def test_documents_in_buckets(spark, tmp_path):
    """A long document, many short ones, empty lines, and lines without a name; folders do not grow with the documents."""
    rows = [("long é", i, f"line é {i}" if i % 7 else None) for i in range(500)]
    rows += [(f"d{i}", 0, "x" * i) for i in range(300)] + [(None, 0, "lost")]
    df = spark.createDataFrame(random.Random(3).sample(rows, len(rows)), "k string, n int, t string")
    path = str(tmp_path / "docs")
    C.write_doc_pieces(df, path, "k", "n", "t", bits=3, buckets=8)
    assert len(glob.glob(f"{path}/bucket=*")) == 8
    pieces = sorted(map(tuple, C.read_doc_pieces(spark, path).select("name", "piece", "byte_start", "byte_count", "line_count", "text").collect()))
    docs, sizes = {}, {}
    for name, _, start, count, lines, text in pieces:
        assert start == len(docs.get(name, "").encode()) and count == len(text.encode()) and 1 <= lines <= 8
        docs[name] = docs.get(name, "") + text
        sizes[name] = sizes.get(name, 0) + lines
    want = {}
    for name, _, text in sorted((r for r in rows if r[0]), key=lambda r: r[:2]):
        want[name] = want.get(name, "") + (text or "") + "\n"
    assert docs == want and sizes["long é"] == 500
    one = C.read_doc_pieces(spark, path, "long é", buckets=8)
    assert one.count() == 63
    assert {f.split("/bucket=")[1].split("/")[0] for f in one.inputFiles()} >= {str(r[0]) for r in spark.createDataFrame([("long é",)], "n string").select(C.doc_bucket(F.col("n"), 8)).collect()}
    plan = one._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(bucket" in plan


def test_no_documents(spark, tmp_path):
    df = spark.createDataFrame([], "k string, n int, t string")
    C.write_doc_pieces(df, str(tmp_path / "none"), "k", "n", "t")
    assert not glob.glob(f"{tmp_path}/none/bucket=*")
