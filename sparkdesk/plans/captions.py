"""Captions: queries and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from sparkdesk.functions.links import doc_base_name, extract_video_id, https_url, safe_file_name, url_page_index
from sparkdesk.operators import captions as C
from sparkdesk.operators.keyed import ordered_union, unique_names
from sparkdesk.plans.inputs import bodies, table, tracks, urls, views
from sparkdesk.plans.sqltext import trimmed
from sparkdesk.session import materialise, scratch_path
from sparkdesk.sources.link_lists import url_source


def read_urls(spark: SparkSession, d: str) -> DataFrame:
    """Page links through text files with comments, blank lines and doubled lines, and through JSON arrays, read back with their places."""
    path = scratch_path(spark, "links")
    pages = table(spark, d, "pages")
    line = (
        F.when(F.col("page_id") % 10 == 3, F.concat(F.lit("  # "), "url"))
        .when(F.col("page_id") % 10 == 4, F.lit(" \t"))
        .when(F.col("page_id") % 10 == 5, F.concat(F.lit("\t"), "url", F.lit("  "), "url", F.lit(" ")))
        .otherwise(F.concat("url", F.lit("\r")))
    )
    thousand = pages.select(F.floor(F.col("page_id") / 1000).alias("part"), "page_id", line.alias("value"))
    thousand.repartition("part").sortWithinPartitions("part", "page_id").select("part", "value").write.partitionBy("part").text(path)
    arrays = scratch_path(spark, "link-arrays")
    item = F.concat(F.lit('" '), "url", F.lit('", 5, null, "", "'), "url", F.lit('#2"'))
    items = F.transform(F.array_sort(F.collect_list(F.struct("page_id", item.alias("item")))), lambda x: x["item"])
    fifty = pages.groupBy(F.floor(F.col("page_id") / 50).alias("part")).agg(F.array_join(items, ",\n").alias("items"))
    fifty.select("part", F.concat(F.lit("["), "items", F.lit("]")).alias("value")).write.partitionBy("part").text(arrays)
    found = url_source(spark, [f"{path}/*", f"{arrays}/*"])
    place = F.row_number().over(W.partitionBy("pos.file").orderBy("pos"))
    kind = F.when(F.contains(F.col("pos.file"), F.lit("/link-arrays-")), "json").otherwise("lines")
    part = F.regexp_extract("pos.file", "/part=([0-9]+)/", 1).cast("bigint")
    return found.select("url", kind.alias("kind"), part.alias("part"), place.cast("bigint").alias("place"))


def video_ids(spark: SparkSession, d: str) -> DataFrame:
    return urls(spark, d).select("pos", extract_video_id(F.col("url")).alias("bvid"))


def page_index(spark: SparkSession, d: str) -> DataFrame:
    """Page links as they are, with a second key, an encoded key, a bad value and an unreadable link mixed in."""
    key = F.col("page_id") % 8
    glue = F.when(F.col("url").contains("?"), "&").otherwise("?")
    plain = F.regexp_replace("url", "#.*$", "")
    link = (
        F.when(key == 1, F.concat(plain, glue, F.lit("p%61ge=7&page=9"))).when(key == 2, F.concat(plain, glue, F.lit("page=-3")))
        .when(key == 3, F.concat(plain, glue, F.lit("page=%2B4"))).when(key == 4, F.concat("url", F.lit(" bad?page=5")))
        .when(key == 5, F.concat(plain, glue, F.lit("page=99999999999"))).otherwise(F.col("url"))
    )
    return table(spark, d, "pages").select(
        "page_id", url_page_index(link, None, "page").alias("page"), url_page_index(link, F.lit(3), "page").alias("clamped")
    )


def select_part(spark: SparkSession, d: str) -> DataFrame:
    data = F.from_json("payload", C.VIEW_SCHEMA)["data"]
    part = C.select_part(data["pages"], F.lit(2), data["cid"])
    return views(spark, d).select("bvid", part["cid"].alias("cid"), part["part"].alias("part"))


def https(spark: SparkSession, d: str) -> DataFrame:
    link = F.when(F.col("page_id") % 3 == 0, F.regexp_replace("url", "^https?:", "")).otherwise(F.col("url"))
    return table(spark, d, "pages").select("page_id", https_url(link).alias("url"))


def _titles(spark: SparkSession, d: str) -> DataFrame:
    title = F.regexp_extract("html", "<title>(.*?)</title>", 1)
    return table(spark, d, "pages").select("page_id", title.alias("title"))


def base_names(spark: SparkSession, d: str) -> DataFrame:
    key = F.col("page_id")
    part = F.when(key % 5 == 0, F.col("title")).when(key % 5 == 1, " ").when(key % 5 == 2, F.lit(None)).otherwise(F.concat(F.lit("p/"), key))
    name = doc_base_name(F.col("title"), (key % 4 + 1).cast("int"), (key % 3 + 1).cast("int"), part)
    return _titles(spark, d).select("page_id", name.alias("base"))


def file_names(spark: SparkSession, d: str) -> DataFrame:
    """Document texts as names: far too long, with line breaks and characters no file may have."""
    text = F.when(F.col("doc_id") % 10 == 1, " ... ").when(F.col("doc_id") % 10 == 2, F.concat("text", F.lit("..")))
    return table(spark, d, "documents").select("doc_id", safe_file_name(text.otherwise(F.col("text"))).alias("name"))


def code_ok(spark: SparkSession, d: str) -> DataFrame:
    payload = F.when(F.col("bvid").endswith("9"), "{}").otherwise(F.col("payload"))
    return views(spark, d).select("bvid", C.api_code_ok(payload).alias("ok"), C.api_error(payload).alias("error"))


def clean(spark: SparkSession, d: str) -> DataFrame:
    lines = table(spark, d, "conversations").select(
        "conv_id", "turn", F.posexplode(F.split(F.concat(F.lit("\n \n\t"), "text"), "\n")).alias("line", "content")
    )
    return C.caption_lines(lines, "content")


def context(spark: SparkSession, d: str) -> DataFrame:
    return C.caption_context(urls(spark, d), views(spark, d), page_name="page").drop("url")


def _items(spark: SparkSession, d: str) -> DataFrame:
    found = C.caption_context(urls(spark, d), views(spark, d), page_name="page")
    return C.caption_tracks(found, tracks(spark, d), bodies(spark, d))


def with_tracks(spark: SparkSession, d: str) -> DataFrame:
    text = F.array_join("lines", "\n")
    return _items(spark, d).select("pos", "cid", "subtitle_url", "error", F.array_size("lines").alias("n"), text.alias("text"))


def doc(spark: SparkSession, d: str) -> DataFrame:
    talks = table(spark, d, "conversations")
    return C.caption_doc(talks, "conv_id", "turn", "text")


def outcomes(spark: SparkSession, d: str) -> DataFrame:
    return C.item_outcomes(_items(spark, d))


def _document_tracks(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "documents").select("source", "doc_id", "lang", F.concat(F.lit("Lang "), F.upper("lang")).alias("lan_doc"))


def pick(spark: SparkSession, d: str) -> DataFrame:
    """Per source the first German document; no track is Chinese, so a source without one gives its first."""
    picked = C.pick_track(_document_tracks(spark, d), ["source"], "doc_id", " DE ", "lang")
    return picked.select("source", "doc_id", "lang", F.col("tier").cast("int").alias("tier"))


def names(spark: SparkSession, d: str) -> DataFrame:
    """Documents named by source and language, in document order."""
    base = safe_file_name(F.concat_ws(":", "source", "lang")).alias("base")
    return unique_names(table(spark, d, "documents").select("doc_id", base), "base", "doc_id")


def names_taken(spark: SparkSession, d: str) -> DataFrame:
    """As ``names`` where every text of odd length has a numbered title, and some names are those of files that are there."""
    docs = table(spark, d, "documents").withColumn("_n", F.length(F.coalesce("text", F.lit(""))))
    plain = F.concat_ws("_", "source", "lang")
    title = F.when(F.col("_n") % 2 == 1, F.concat(plain, F.lit("_"), (2 + F.col("_n") % 9).cast("string"))).otherwise(plain)
    files = docs.select(plain.alias("name"), "lang").distinct()
    files = files.select(F.concat("name", F.when(F.col("lang") == "de", ".md").otherwise("_3.md")).alias("name"))
    return unique_names(docs.select("doc_id", title.alias("base")), "base", "doc_id", taken=files)


def union(spark: SparkSession, d: str) -> DataFrame:
    """Page links twice: without their query part, then as they are."""
    pages = table(spark, d, "pages")
    cut = pages.select(F.concat(F.lit(" "), F.regexp_replace("url", "[?#].*$", "")).alias("url"), F.col("page_id").alias("pos"))
    full = pages.select("url", F.col("page_id").alias("pos"))
    return ordered_union([cut, full], [pages.select(F.lit("unused").alias("url"), F.col("page_id").alias("pos"))])


def text_docs(spark: SparkSession, d: str) -> DataFrame:
    """The finished caption documents, written under their names in pieces of two lines and read back."""
    path = scratch_path(spark, "captions")
    done = C.caption_names(_items(spark, d)).where("error is null")
    done = materialise(done.select("pos", "base_name", "lines"), "captions-done")
    lines = unique_names(done, "base_name", "pos").select("name", F.posexplode_outer("lines").alias("line", "content"))
    C.write_doc_pieces(lines.withColumn("line", F.coalesce("line", F.lit(0))), path, "name", "line", "content", bits=1)
    return C.read_doc_pieces(spark, path)


QUERIES = {
    "url_source": read_urls,
    "extract_video_id": video_ids,
    "url_page_index": page_index,
    "select_part": select_part,
    "https_url": https,
    "doc_base_name": base_names,
    "safe_file_name": file_names,
    "api_code_ok": code_ok,
    "caption_clean": clean,
    "caption_context": context,
    "caption_tracks": with_tracks,
    "caption_doc": doc,
    "item_outcomes": outcomes,
    "pick_track": pick,
    "unique_names": names,
    "unique_names_taken": names_taken,
    "ordered_union": union,
    "write_text_docs": text_docs,
}

_VIDEO = "'BV' || lpad({0}::varchar, 10, '0')"
_PAGE = "coalesce(try_cast(nullif(regexp_extract(url, '[?&]page=([0-9]+)', 1), '') as int), 1)"

# Every turn as a video, and the links of pages to the turns of their conversation.
_LINKS = f"""
    talk as (select conv_id * 8 + turn as v, conv_id, turn, text from conversations),
    link as (
        select page_id * 8 + coalesce(turn, 0) as pos, url, page_id % 20 <> 7 as named, page_id // 2 * 8 + coalesce(turn, 0) as number
        from pages left join talk on conv_id = page_id // 2)"""
# Links with their turn, as the landed payloads say it.
_CONTEXT = f"""
    {_LINKS},
    joined as (
        select pos, case when named then {_VIDEO.format('number')} end as bvid, v, text, 1 + v % 3 as pages, least({_PAGE}, 1 + v % 3)::int as p
        from link left join talk on named and v = number),
    context as (
        select pos, bvid, v, pages, p,
               case when bvid is null then 'no video id' when v is null then 'no view'
                    when v % 17 = 3 then 'view failed: code=-404, message=not found'
                    when v % 19 = 5 then 'missing aid' end as e,
               case when p = 2 and v % 5 = 1 then v * 100 + 50 else v * 100 + p end as c,
               case when v % 7 <> 2 then text else bvid end as t,
               case p when 1 then 'Part: one' when 2 then case when v % 4 <> 1 then '2. ' || text end
                      else case when trim(text) <> '' then text end end as part
        from joined)"""
_ITEMS = f"""
    {_CONTEXT},
    part as (select v, v * 100 + i as cid, text from (select *, unnest(generate_series(1, 1 + v % 3)) as i from talk)),
    body as (
        select cid, case when v % 7 = 6 then [] else
                    [y for y in [{trimmed('x')} for x in string_split(text, chr(10))] if y <> ''] end as lines
        from part),
    known as (select cid from part where v % 11 <> 4 union all select v * 100 + 50 from talk),
    choice as (
        select x.*, (v + c) % 5 as list, k.cid as track_cid, b.lines as body_lines, b.cid as body_cid,
               case (v + c) % 5 when 1 then 'zh-CN' when 2 then 'xx' when 3 then 'en' end as lan
        from context x left join known k on e is null and k.cid = c left join body b on e is null and b.cid = c),
    items as (
        select *, case when e is not null then e when track_cid is null then 'no track list' when list = 0 then 'no tracks'
                  when list = 4 then 'empty track url' when body_cid is null then 'no body'
                  when len(body_lines) = 0 then 'no content lines' end as error
        from choice)"""


def _safe(text: str) -> str:
    spaced = f"regexp_replace(regexp_replace({text}, '[\\\\/:*?\"<>|]+', '_', 'g'), '[ \\t\\n\\x0B\\f\\r]+', ' ', 'g')"
    stripped = f"rtrim({trimmed(spaced)}, '.')"
    return f"substr(case when trim({stripped}) = '' then 'untitled' else {stripped} end, 1, 150)"


_TITLE = "regexp_extract(html, '<title>(.*?)</title>', 1)"
_PART = f"case page_id % 5 when 0 then {_TITLE} when 1 then ' ' when 2 then null else 'p/' || page_id end"

ORACLE = {
    "url_source": """
        with u as (
            select 'lines' as kind, page_id // 1000 as part, page_id, 1 as i, url from pages where page_id % 10 not in (3, 4) union all
            select 'lines', page_id // 1000, page_id, 2, url from pages where page_id % 10 = 5 union all
            select 'json', page_id // 50, page_id, 1, url from pages union all
            select 'json', page_id // 50, page_id, 2, url || '#2' from pages)
        select url, kind, part::bigint as part, row_number() over (partition by kind, part order by page_id, i) as place from u""",
    "extract_video_id": f"with {_LINKS} select pos, case when named then {_VIDEO.format('number')} end as bvid from link",
    "url_page_index": f"""
        with p as (
            select page_id, case when page_id % 8 = 4 then 1
                                 when url like '%?%page=%' then {_PAGE}
                                 when page_id % 8 = 1 then 7 when page_id % 8 = 3 then 4 else 1 end as page
            from pages)
        select page_id, page::int as page, least(page, 3)::int as clamped from p""",
    "select_part": f"""
        with t as (select conv_id * 8 + turn as v, text from conversations)
        select {_VIDEO.format('v')} as bvid,
               case when v % 17 = 3 then null when v % 3 = 0 or v % 5 = 1 then v * 100 + 50 else v * 100 + 2 end as cid,
               case when v % 17 <> 3 and v % 3 <> 0 and v % 4 <> 1 then '2. ' || text end as part
        from t""",
    "https_url": "select page_id, 'https:' || regexp_replace(url, '^https?:', '') as url from pages",
    "doc_base_name": f"""
        select page_id, {_safe(f'''(case when page_id % 3 + 1 = 1 then {_TITLE}
            when coalesce(trim({_PART}), '') = '' or {_PART} = {_TITLE} then {_TITLE} || '-P' || (page_id % 4 + 1)
            else {_TITLE} || '-P' || (page_id % 4 + 1) || '-' || {_PART} end)''')} as base
        from pages""",
    "safe_file_name": f"""
        with t as (select doc_id, case doc_id % 10 when 1 then ' ... ' when 2 then text || '..' else text end as t
                   from documents)
        select doc_id, {_safe('t')} as name from t""",
    "api_code_ok": f"""
        with t as (select conv_id * 8 + turn as v from conversations)
        select {_VIDEO.format('v')} as bvid, v % 10 <> 9 and v % 17 <> 3 as ok,
               case when v % 10 = 9 then 'code=-2147483648, message=' when v % 17 = 3 then 'code=-404, message=not found' end as error
        from t""",
    "caption_clean": f"""
        with l as (select conv_id, turn, unnest(string_split(chr(10) || ' ' || chr(10) || chr(9) || text, chr(10))) as c,
                          generate_subscripts(string_split(chr(10) || ' ' || chr(10) || chr(9) || text, chr(10)), 1) - 1 as i
                   from conversations)
        select conv_id, turn, i::int as line, {trimmed('c')} as content from l where {trimmed('c')} <> ''""",
    "caption_context": f"""
        with {_CONTEXT}
        select 0 as src, pos, bvid, case when e is null then v + 1 end as aid, case when e is null then c end as cid,
               case when e is null then t end as title, case when e is null then p end as page_index,
               case when e is null then pages::int end as page_count, case when e is null then part end as part_title, e as error
        from context""",
    "caption_tracks": f"""
        with {_ITEMS}
        select pos, case when e is null then c end as cid,
               case when e is null and track_cid is not null and lan is not null
                    then 'https://s.example.com/' || c || '/' || lan || '.json' end as subtitle_url, error,
               case when error is null then len(body_lines)::int end as n,
               case when error is null then array_to_string(body_lines, chr(10)) end as text
        from items""",
    "caption_doc": """
        select conv_id, count(*) as line_count, string_agg(coalesce(text, ''), chr(10) order by turn) as doc
        from conversations group by 1""",
    "item_outcomes": f"""
        with {_ITEMS}
        select case when error is null then 'ok' else 'failed' end as status, count(*) as items from items group by 1""",
    "pick_track": """
        select source, doc_id, lang, case when lang = 'de' then 1 else 3 end as tier from documents
        qualify row_number() over (partition by source order by lang <> 'de', doc_id) = 1""",
    "unique_names": """
        with n as (select doc_id, source || '_' || lang as base,
                          row_number() over (partition by source || '_' || lang order by doc_id) as k from documents)
        select doc_id, base, base || case when k = 1 then '' else '_' || k end || '.md' as name from n""",
    "unique_names_taken": """
        with recursive d as (
            select doc_id, concat_ws('_', source, lang) as plain, lang, length(coalesce(text, '')) as n from documents),
        t as (select doc_id, plain, case when n % 2 = 1 then 2 + n % 9 end as k,
                     plain || case when n % 2 = 1 then '_' || (2 + n % 9) else '' end as base from d),
        taken as (select distinct plain, case when lang = 'de' then 1 else 3 end as k from d),
        firsts as (select plain, base, k, min(doc_id) as first from t where k is not null group by all),
        claims as (
            select f.plain, f.k, f.base, (select count(*) from t where t.base = f.plain and t.doc_id < f.first) as earlier from firsts f
            where not exists (from taken x where x.plain = f.plain and x.k = f.k) and f.plain in (select base from t)
            union all select plain, k, null, -1 from taken),
        steps as (select *, row_number() over (partition by plain order by k) as i from claims),
        fold as (
            select plain, 0::bigint as i, 0::bigint as k, null::varchar as base, false as won, 0::bigint as below, 0::bigint as upto from (select distinct plain from steps)
            union all
            select s.plain, s.i, s.k, s.base, (s.earlier < 0 or s.earlier < s.k - f.upto), f.upto,
                   f.upto + (s.earlier < 0 or s.earlier < s.k - f.upto)::bigint
            from fold f join steps s on s.plain = f.plain and s.i = f.i + 1),
        blocks as (
            select plain as base, k - below as at from fold where won
            union all select base, 1 from fold where base is not null and not won
            union all select plain || '_' || k, 1 from taken where k > 1),
        r as (select doc_id, base, row_number() over (partition by base order by doc_id) as r from t),
        n as (select doc_id, base, r + (select count(*) from blocks b where b.base = r.base and b.at <= r.r) as k from r)
        select doc_id, base, base || case when k = 1 then '' else '_' || k end || '.md' as name from n""",
    "ordered_union": """
        with u as (select regexp_replace(url, '[?#].*$', '') as url, 0 as src, page_id as pos from pages
                   union all select url, 1, page_id from pages)
        select url, src, pos from u qualify row_number() over (partition by url order by src, pos) = 1""",
    "write_text_docs": f"""
        with {_ITEMS},
        b as (select pos, {_safe('''(case when pages = 1 then t when part is null or trim(part) = '' or part = t
                then t || '-P' || p else t || '-P' || p || '-' || part end)''')} as base, body_lines
              from items where error is null),
        n as (select base || case when k = 1 then '' else '_' || k end || '.md' as name, body_lines
              from (select *, row_number() over (partition by base order by pos) as k from b)),
        l as (select name, unnest(body_lines) as content, unnest(range(len(body_lines))) as line from n where len(body_lines) > 0
              union all select name, '', 0 from n where len(body_lines) = 0),
        p as (select name, line // 2 as piece, count(*) as line_count,
                     string_agg(coalesce(content, '') || chr(10), '' order by line) as text from l group by 1, 2)
        select name, piece, line_count, text, strlen(text) as byte_count,
               coalesce(sum(strlen(text)) over (partition by name order by piece rows between unbounded preceding and 1 preceding), 0)::bigint as byte_start
        from p""",
}
