"""Check SQL: the catalogue's queries written again for DuckDB.

``TABLES`` are named subqueries over the given tables; ``CHECKS`` are the
queries. :func:`oracle_sql` puts in front of each query the subqueries it names.
"""

from __future__ import annotations

import re

from oracle.checks import CHECKS
from oracle.tables import TABLES


def _needed(text: str, found: list[str]) -> list[str]:
    for name, body in TABLES.items():
        if name not in found and re.search(rf"\b{name}\b", text):
            _needed(body, found)
            if name not in found:
                found.append(name)
    return found


def oracle_sql() -> dict[str, str]:
    out = {}
    for name, text in CHECKS.items():
        parts = [f"{t} as (\n{TABLES[t]}\n)" for t in _needed(text, [])]
        out[name] = ("with " + ",\n".join(parts) + "\n" if parts else "") + text
    return out
