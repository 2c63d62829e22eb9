"""String and date functions: queries and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkdesk.functions import jsons as J
from sparkdesk.functions import strings as S
from sparkdesk.plans.inputs import table


def _words():
    """Document sources, with absent, empty and blank ones by document number."""
    key = F.col("doc_id") % 7
    return (
        F.when(key == 1, F.lit(None)).when(key == 2, "").when(key == 3, " \t\n").when(key == 4, F.concat(F.lit("\t "), "source", F.lit("\n")))
        .otherwise(F.col("source"))
    )


def _docs(spark: SparkSession, d: str, **columns) -> DataFrame:
    return table(spark, d, "documents").select("doc_id", *[c.alias(name) for name, c in columns.items()])


def is_empty(spark, d):
    return _docs(spark, d, empty=S.is_empty(_words()), filled=S.is_not_empty(_words()))


def is_blank(spark, d):
    return _docs(spark, d, blank=S.is_blank(_words()), filled=S.is_not_blank(_words()))


def trim_ctl(spark, d):
    return _docs(spark, d, word=S.trim_ctl(_words()), text=S.trim_ctl(F.concat(F.lit("\r\n\t "), "text", F.lit(" \t\n"))))


def default_if_blank(spark, d):
    return _docs(spark, d, word=S.default_if_blank(_words(), F.col("lang")))


def equals_ignore_case(spark, d):
    other = F.when(F.col("doc_id") % 3 == 0, F.upper("source")).when(F.col("doc_id") % 3 == 1, F.lit(None)).otherwise("x")
    return _docs(spark, d, same=S.equals_ignore_case(_words(), other))


def first_non_blank(spark, d):
    return _docs(spark, d, word=S.first_non_blank(_words(), F.when(F.col("doc_id") % 2 == 0, F.col("lang")), F.lit(None)))


def array_join_nulls(spark, d):
    parts = F.array(F.col("source"), _words(), F.col("lang"))
    return _docs(
        spark, d, joined=S.join_nulls(parts, ","), none=S.join_nulls(F.when(F.col("doc_id") % 5 == 0, parts), "-")
    )


def escape_java(spark, d):
    return _docs(spark, d, text=S.escape_java(F.col("text")))


def single_quote(spark, d):
    return _docs(spark, d, word=S.single_quote(_words()))


def split_double_braces(spark, d):
    braces = F.translate("text", "ae", "{}")
    return _docs(spark, d, text=S.split_double_braces(braces))


def app_id_last(spark, d):
    pages = table(spark, d, "pages")
    line = F.concat(
        F.lit("seen "), F.when(F.col("page_id") % 3 > 0, F.concat(F.lit("application_1_"), "page_id")).otherwise("none"),
        F.when(F.col("page_id") % 3 == 2, F.concat(F.lit(" then application_17_"), "page_id", F.lit("_x"))).otherwise(""), F.col("html"),
    )
    return pages.select("page_id", S.last_application_id(line).alias("application_id"))


def date_formats(spark, d):
    return table(spark, d, "events").select("event_id", *[c.alias(name) for name, c in S.date_formats(F.col("ts")).items()])


def job_tags(spark, d):
    business = F.when(F.col("event_id") % 4 == 0, F.lit(None)).when(F.col("event_id") % 4 == 1, " ").otherwise(F.col("event_type"))
    tags = S.job_tags(F.concat(F.lit("sub-"), "event_id"), business)
    back = S.parse_job_tags(F.col("tags"))
    return (
        table(spark, d, "events").select("event_id", tags.alias("tags"))
        .withColumn("submission_id", F.try_element_at(back, F.lit("submissionId")))
        .withColumn("business_key", F.try_element_at(back, F.lit("businessKey")))
    )


def snippet(spark, d):
    return _docs(spark, d, text=S.snippet(F.col("text")))


def json_text_or(spark, d):
    events = table(spark, d, "events")
    return events.select(
        "event_id",
        J.json_text_or(F.col("props"), "$.k", "none").alias("k"),
        J.json_text_or(F.col("props"), "$.missing", F.col("event_type")).alias("other"),
    )


QUERIES = {
    "is_empty": is_empty,
    "is_blank": is_blank,
    "trim_ctl": trim_ctl,
    "default_if_blank": default_if_blank,
    "equals_ignore_case": equals_ignore_case,
    "first_non_blank": first_non_blank,
    "array_join_nulls": array_join_nulls,
    "escape_java": escape_java,
    "single_quote": single_quote,
    "split_double_braces": split_double_braces,
    "app_id_last": app_id_last,
    "date_formats": date_formats,
    "job_tags": job_tags,
    "snippet": snippet,
    "json_text_or": json_text_or,
}

_W = """w as (
    select *, case doc_id % 7 when 1 then null when 2 then '' when 3 then ' ' || chr(9) || chr(10)
              when 4 then chr(9) || ' ' || source || chr(10) else source end as word
    from documents)"""
_WS = "' ' || chr(9) || chr(10) || chr(13)"
_BLANK = f"(word is null or trim(word, {_WS}) = '')"
_CODE = "unicode(c)"

ORACLE = {
    "is_empty": f"with {_W} select doc_id, word is null or word = '' as empty, not (word is null or word = '') as filled from w",
    "is_blank": f"with {_W} select doc_id, {_BLANK} as blank, not {_BLANK} as filled from w",
    "trim_ctl": f"with {_W} select doc_id, trim(word, {_WS}) as word, trim(text, {_WS}) as text from w",
    "default_if_blank": f"with {_W} select doc_id, case when {_BLANK} then lang else word end as word from w",
    "equals_ignore_case": f"""
        with {_W}
        select doc_id, lower(word) is not distinct from
               lower(case doc_id % 3 when 0 then upper(source) when 1 then null else 'x' end) as same
        from w""",
    "first_non_blank": f"""
        with {_W}
        select doc_id, case when not {_BLANK} then trim(word, {_WS}) when doc_id % 2 = 0 then lang else '' end as word from w""",
    "array_join_nulls": f"""
        with {_W}
        select doc_id, source || ',' || coalesce(word, '') || ',' || lang as joined,
               case when doc_id % 5 = 0 then source || '-' || coalesce(word, '') || '-' || lang end as none
        from w""",
    "escape_java": f"""
        with c as (select doc_id, unnest(string_split(text, '')) as c, generate_subscripts(string_split(text, ''), 1) as i
                   from documents),
        e as (select doc_id, i, case when c = chr(8) then '\\b' when c = chr(9) then '\\t' when c = chr(10) then '\\n'
                     when c = chr(12) then '\\f' when c = chr(13) then '\\r' when c = '"' then '\\"' when c = '\\' then '\\\\'
                     when {_CODE} between 32 and 127 then c
                     when {_CODE} <= 65535 then printf('\\u%04X', {_CODE})
                     else printf('\\u%04X', 55296 + ({_CODE} - 65536) // 1024) || printf('\\u%04X', 56320 + ({_CODE} - 65536) % 1024)
                     end as e from c)
        select d.doc_id, coalesce(t, d.text) as text
        from documents d left join (select doc_id, string_agg(e, '' order by i) as t from e group by 1) x using (doc_id)""",
    "single_quote": f"with {_W} select doc_id, '''' || coalesce(word, 'null') || '''' as word from w",
    "split_double_braces": r"""
        select doc_id, replace(replace(replace(replace(translate(text, 'ae', '{}'), '{{', '{ {'), '{{', '{ {'),
                       '}}', '} }'), '}}', '} }') as text
        from documents""",
    "app_id_last": """
        select page_id, case when regexp_matches(html, 'application_[0-9]+_[0-9]+') then null
               when page_id % 3 = 2 then 'application_17_' || page_id when page_id % 3 = 1 then 'application_1_' || page_id end
               as application_id
        from pages""",
    "date_formats": """
        select event_id, strftime(ts, '%Y-%m-%d %H:%M:%S') as datetime_text, strftime(ts, '%Y%m%d') as date_compact,
               strftime(ts, '%Y%m%d%H%M%S') as datetime_compact,
               strftime(ts, '%Y%m%d%H%M%S') || lpad((extract(microseconds from ts)::bigint % 1000000 // 1000)::varchar, 3, '0')
               as millis_compact
        from events""",
    "job_tags": """
        select event_id, 'submissionId=sub-' || event_id || case when event_id % 4 in (0, 1) then '' else ',businessKey=' || event_type end as tags,
               'sub-' || event_id as submission_id, case when event_id % 4 in (0, 1) then null else event_type end as business_key
        from events""",
    "snippet": "select doc_id, substr(text, 1, 240) as text from documents",
    "json_text_or": "select event_id, props->>'$.k' as k, event_type as other from events",
}
