"""All registered queries and their SQL."""

from __future__ import annotations

from lineweft.validation import calcviews, catalog, events, names, reports, scripts

_FAMILIES = (events, scripts, calcviews, reports, names, catalog)


def all_queries() -> dict:
    return {name: query for family in _FAMILIES for name, query in family.QUERIES.items()}


def all_oracles() -> dict[str, str]:
    return {name: sql for family in _FAMILIES for name, sql in family.ORACLE.items()}
