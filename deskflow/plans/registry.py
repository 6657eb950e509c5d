"""Named queries over the input tables, each with its SQL answer where SQL has one."""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ..sources.views import Desk
from .oracle_views import VIEWS

QueryFn = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, QueryFn] = {}
ORACLES: dict[str, str] = {}


def query(name: str, oracle: str | None = None):
    """Registers a function of a Desk under a name."""

    def wrap(fn: Callable[[Desk], DataFrame]):
        def run(spark: SparkSession, base: str) -> DataFrame:
            return fn(Desk(spark, base))

        run.__doc__ = fn.__doc__
        QUERIES[name] = run
        if oracle:
            ORACLES[name] = with_views(oracle)
        return fn

    return wrap


def with_views(sql: str) -> str:
    """The statement after the definitions of the views it uses."""
    needed: list[str] = []

    def visit(text: str) -> None:
        for name in re.findall(r"\bv_\w+\b", text):
            if name in VIEWS and name not in needed:
                visit(VIEWS[name])
                if name not in needed:
                    needed.append(name)

    visit(sql)
    if not needed:
        return sql.strip()
    definitions = ",\n".join(f"{name} AS (\n{VIEWS[name].strip()}\n)" for name in needed)
    body = sql.strip()
    if body.upper().startswith("WITH RECURSIVE "):
        return f"WITH RECURSIVE {definitions},\n{body[15:]}"
    if body.upper().startswith("WITH "):
        return f"WITH {definitions},\n{body[5:]}"
    return f"WITH {definitions}\n{body}"
