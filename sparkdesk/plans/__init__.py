"""Every operator as a query on the provided tables, with the SQL that checks it.

A module holds ``QUERIES`` (name -> function of session and folder) and ``ORACLE``
(name -> SQL for the same tables).
"""

from __future__ import annotations

from importlib import import_module

MODULES = ("export", "cells", "strings", "jsons", "orders", "captions", "jobs", "tokens", "streams")


def _collect(attribute: str) -> dict:
    found: dict = {}
    for name in MODULES:
        entries = getattr(import_module(f"sparkdesk.plans.{name}"), attribute)
        twice = found.keys() & entries.keys()
        if twice:
            raise ValueError(f"registered twice: {sorted(twice)}")
        found.update(entries)
    return found


def all_queries() -> dict:
    return _collect("QUERIES")


def all_oracles() -> dict[str, str]:
    return _collect("ORACLE")
