"""String and date column functions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values.
CONTROL_CHARS = "".join(chr(i) for i in range(0x21))
JAVA_WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2008\u2009\u200a"
    "\u2028\u2029\u205f\u3000"
)
APPLICATION_ID = r"application_\d+_\d+"
DATE_PATTERNS = {
    "datetime_text": "yyyy-MM-dd HH:mm:ss",
    "date_compact": "yyyyMMdd",
    "datetime_compact": "yyyyMMddHHmmss",
    "millis_compact": "yyyyMMddHHmmssSSS",
}
ERROR_SNIPPET_CHARS = 240


def is_empty(c: Column) -> Column:
    return F.coalesce(c, F.lit("")) == ""


def is_not_empty(c: Column) -> Column:
    return ~is_empty(c)


def is_blank(c: Column) -> Column:
    """Null, empty, or only Java whitespace (a no-break space does not count)."""
    return F.coalesce(F.ltrim(c, F.lit(JAVA_WHITESPACE)), F.lit("")) == ""


def is_not_blank(c: Column) -> Column:
    return ~is_blank(c)


def trim_ctl(c: Column) -> Column:
    """Strip every character up to U+0020 from both ends."""
    return F.btrim(c, F.lit(CONTROL_CHARS))


def default_if_blank(c: Column, default) -> Column:
    return F.when(is_blank(c), default).otherwise(c)


def equals_ignore_case(a: Column, b: Column) -> Column:
    """Case-insensitive equality in which null equals null."""
    same_length = F.length(a).eqNullSafe(F.length(b))
    return same_length & F.lower(F.upper(a)).eqNullSafe(F.lower(F.upper(b)))


def join_nulls(c: Column, separator: str) -> Column:
    """Join an array as text, keeping the separators of null elements."""
    return F.array_join(c, separator, "")


def single_quote(c: Column) -> Column:
    return F.concat(F.lit("'"), F.coalesce(c, F.lit("null")), F.lit("'"))


def split_double_braces(c: Column) -> Column:
    """Put a space between adjacent equal braces."""
    return F.regexp_replace(F.regexp_replace(c, r"\{(?=\{)", "{ "), r"\}(?=\})", "} ")


def _unicode_escape(code: Column) -> Column:
    return F.concat(F.lit("\\u"), F.lpad(F.hex(code), 4, "0"))


def _escape_char(ch: Column) -> Column:
    code = F.ascii(ch).cast("bigint")
    above = code - 0x10000
    rule = F.when(ch == "\b", "\\b")
    for raw, text in {"\t": "\\t", "\n": "\\n", "\f": "\\f", "\r": "\\r"}.items():
        rule = rule.when(ch == raw, text)
    return rule.when(code <= 0xFFFF, _unicode_escape(code)).otherwise(
        F.concat(
            _unicode_escape(F.shiftright(above, 10) + 0xD800),
            _unicode_escape(above.bitwiseAND(F.lit(0x3FF)) + 0xDC00),
        )
    )


def escape_java(c: Column) -> Column:
    """Backslash escapes for quotes, control and non-ASCII characters.

    A text is replaced once per distinct special character it holds, backslashes
    and quotes first, as the other escapes hold a backslash.
    """
    plain = F.replace(F.replace(c, F.lit("\\"), F.lit("\\\\")), F.lit('"'), F.lit('\\"'))
    special = F.array_distinct(F.regexp_extract_all(c, F.lit(r"[^ -\x7f]"), F.lit(0)))
    return F.aggregate(special, plain, lambda text, ch: F.replace(text, ch, _escape_char(ch)))


def csv_escape(c: Column) -> Column:
    """Quote a cell that holds a comma, a quote, CR or LF; double its quotes."""
    special = c.contains(",") | c.contains('"') | c.contains("\n") | c.contains("\r")
    quoted = F.concat(F.lit('"'), F.replace(c, F.lit('"'), F.lit('""')), F.lit('"'))
    return F.when(special, quoted).otherwise(c)


def last_application_id(c: Column) -> Column:
    """The last application id in a text, or null."""
    return F.try_element_at(F.regexp_extract_all(c, F.lit(APPLICATION_ID), F.lit(0)), F.lit(-1))


def date_formats(c: Column) -> dict[str, Column]:
    return {name: F.date_format(c, pattern) for name, pattern in DATE_PATTERNS.items()}


def job_tags(submission_id: Column, business_key: Column) -> Column:
    head = F.concat(F.lit("submissionId="), submission_id)
    return F.when(is_blank(business_key), head).otherwise(F.concat(head, F.lit(",businessKey="), business_key))


def parse_job_tags(c: Column) -> Column:
    return F.str_to_map(c, F.lit(","), F.lit("="))


def snippet(c: Column, length: int = ERROR_SNIPPET_CHARS) -> Column:
    return F.substring(c, 1, length)


def first_non_blank(*columns: Column) -> Column:
    """The first value that is not blank, trimmed; else the empty text."""
    return F.coalesce(*[F.when(is_not_blank(c), trim_ctl(c)) for c in columns], F.lit(""))
