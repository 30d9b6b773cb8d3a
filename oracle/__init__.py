"""Independent SQL for every registered query, as text that an ANSI engine can run.

`sql(name)` prefixes the query with the common table expressions it reaches.
"""

from __future__ import annotations

import re
from functools import cache

from tidemark.plans.tables import ANSI_TABLES

VIEWS: dict[str, str] = dict(ANSI_TABLES)
QUERIES: dict[str, str] = {}


def r(x: str, k: int = 2) -> str:
    """Round half away from zero on a decimal, so ties do not depend on binary noise."""
    return f"CAST(round(CAST({x} AS DECIMAL(38,{k + 4})), {k}) AS DOUBLE)"


def d(x: str) -> str:
    return f"CAST({x} AS DOUBLE)"


def mean(x: str) -> str:
    return f"(CAST(sum({x}) AS DOUBLE) / nullif(count({x}), 0))"


def pct(n: str, m: str, k: int = 2) -> str:
    return r(f"CAST({n} AS DOUBLE) * 100 / nullif(CAST({m} AS DOUBLE), 0)", k)


def same(name: str, drop: str = "") -> None:
    """The query is the view of the same name, with decimals shown as doubles by the view itself."""
    QUERIES[name] = f"SELECT * {('EXCLUDE (' + drop + ')') if drop else ''} FROM {name}"


@cache
def _reach(name: str) -> tuple[str, ...]:
    text = VIEWS[name]
    return tuple(v for v in VIEWS if v != name and re.search(rf"\b{v}\b", text))


def sql(name: str) -> str:
    text, order, seen = QUERIES[name], [], set()

    def visit(view: str) -> None:
        if view not in seen:
            seen.add(view)
            for dep in _reach(view):
                visit(dep)
            order.append(view)

    for view in VIEWS:
        if re.search(rf"\b{view}\b", text):
            visit(view)
    if not order:
        return text
    return "WITH " + ",\n".join(f"{v} AS ({VIEWS[v]})" for v in order) + "\n" + text


from oracle import bank, trades, liquidity, credit, loans, staff, reports  # noqa: E402,F401,I001
