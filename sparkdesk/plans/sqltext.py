"""Pieces of oracle SQL that several modules use."""

from __future__ import annotations


def micros(ts: str) -> str:
    return f"(extract(microseconds from {ts})::bigint % 1000000)"


def fraction(ts: str) -> str:
    """'' or a dot and the 3 or 6 digits after the second."""
    part = micros(ts)
    return (
        f"case when {part} = 0 then '' when {part} % 1000 = 0 then '.' || lpad(({part} // 1000)::varchar, 3, '0') "
        f"else '.' || lpad({part}::varchar, 6, '0') end"
    )


def iso_instant(ts: str) -> str:
    return f"(strftime({ts}, '%Y-%m-%dT%H:%M:%S') || {fraction(ts)} || 'Z')"


def iso_clock(ts: str) -> str:
    return (
        f"(strftime({ts}, '%H:%M') || case when extract(microseconds from {ts})::bigint = 0 then '' "
        f"else strftime({ts}, ':%S') || {fraction(ts)} end)"
    )


def iso_local(ts: str) -> str:
    return f"(strftime({ts}, '%Y-%m-%dT') || {iso_clock(ts)})"


def escaped(text: str) -> str:
    return (
        f"case when contains({text}, ',') or contains({text}, '\"') or contains({text}, chr(10)) or contains({text}, chr(13)) "
        f"then '\"' || replace({text}, '\"', '\"\"') || '\"' else {text} end"
    )


def trimmed(text: str) -> str:
    return f"trim({text}, ' ' || chr(9) || chr(10) || chr(13))"
