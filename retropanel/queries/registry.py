"""Registered queries: a Spark callable and, where SQL can say it, the same thing as ANSI SQL."""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from retropanel.queries.sqlviews import VIEWS

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def with_views(body: str) -> str:
    """Prefix the shared view definitions a statement uses, in dependency order."""
    ordered: list[str] = []

    def visit(text: str) -> None:
        for name in re.findall(r"\bv_\w+", text):
            if name in VIEWS and name not in ordered:
                visit(VIEWS[name])
                if name not in ordered:
                    ordered.append(name)

    visit(body)
    if not ordered:
        return body.strip()
    heads = ",\n".join(f"{n} AS ({VIEWS[n].strip()})" for n in ordered)
    text = body.strip()
    if text.upper().startswith("WITH "):
        return f"WITH {heads},\n{text[5:]}"
    return f"WITH {heads}\n{text}"


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def register(fn: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = with_views(sql)
        return fn

    return register
