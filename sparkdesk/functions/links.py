"""Column functions for links and for names of files."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from sparkdesk.functions.strings import is_blank, trim_ctl

# Fixed values.
VIDEO_ID = r"(BV[0-9A-Za-z]{10})"
INVALID_NAME_CHARS = r'[\\/:*?"<>|]+'
NAME_LIMIT = 150
UNTITLED = "untitled"


def extract_video_id(url: Column, pattern: str = VIDEO_ID) -> Column:
    """First match of the pattern's first group, or null."""
    return F.nullif(F.regexp_extract(url, pattern, 1), F.lit(""))


def query_value(url: Column, name: str) -> Column:
    """Decoded value of the first query key of that name; null when absent or the URL is unreadable."""
    pairs = F.filter(
        F.split(F.try_parse_url(url, F.lit("QUERY")), "&"),
        lambda part: ~is_blank(part) & (F.try_url_decode(F.substring_index(part, "=", 1)) == name),
    )
    values = F.transform(pairs, lambda part: F.try_url_decode(F.regexp_replace(part, "^[^=]*=?", "")))
    return F.try_element_at(values, F.lit(1))


def url_page_index(url: Column, page_count: Column | None = None, name: str = "p") -> Column:
    """1-based page of a URL: 1 where it is missing, bad or not positive; at most ``page_count``."""
    digits = F.regexp_extract(query_value(url, name), r"\A[+-]?[0-9]+\z", 0)
    page = F.coalesce(digits.try_cast("int"), F.lit(1))
    return F.greatest(F.lit(1), page if page_count is None else F.least(page, page_count))


def https_url(url: Column) -> Column:
    return F.regexp_replace(url, "^(http:)?//", "https://")


def safe_file_name(c: Column) -> Column:
    name = F.regexp_replace(c, INVALID_NAME_CHARS, "_")
    name = trim_ctl(F.regexp_replace(name, r"\s+", " "))
    name = F.regexp_replace(F.rtrim(name, F.lit(".")), r"\A\p{javaWhitespace}*\z", UNTITLED)
    return F.substring(name, 1, NAME_LIMIT)


def doc_base_name(title: Column, page_index: Column, page_count: Column, part: Column) -> Column:
    """The title; with several parts the part number, and the part's own name where it says more."""
    numbered = F.concat(title, F.lit("-P"), page_index.cast("string"))
    named = F.when(is_blank(part) | (part == title), numbered).otherwise(F.concat(numbered, F.lit("-"), part))
    return safe_file_name(F.when(page_count > 1, named).otherwise(title))


def safe_entry_name(c: Column) -> Column:
    name = F.translate(c, "\\/", "__")
    return F.when(is_blank(c) | name.isin(".", ".."), "data.csv").otherwise(name)


def export_base_name(c: Column) -> Column:
    name = F.regexp_replace(c, r"\.parquet\z", "")
    return F.when(is_blank(c) | is_blank(name), "data").otherwise(name)
