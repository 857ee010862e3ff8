"""Registry of named queries (Spark) and their DuckDB oracle SQL."""

from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ..session import ensure_defaults

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def _plus_zero(sql: str) -> str:
    """Wrap every ``round(...)`` as ``(round(...) + 0.0)``: DuckDB keeps the
    sign of a negative zero after rounding, Spark does not."""
    out, i, low = [], 0, sql.lower()
    while True:
        j = low.find("round(", i)
        if j < 0:
            out.append(sql[i:])
            return "".join(out)
        if j > 0 and (low[j - 1].isalnum() or low[j - 1] == "_"):
            out.append(sql[i:j + 6])
            i = j + 6
            continue
        depth, k = 0, j + 5
        while True:
            if sql[k] == "(":
                depth += 1
            elif sql[k] == ")":
                depth -= 1
                if depth == 0:
                    break
            k += 1
        inner = _plus_zero(sql[j + 6:k])
        out.append(sql[i:j] + "(round(" + inner + ") + 0.0)")
        i = k + 1


def register(name: str, sql: str | None = None):
    """Register ``fn(spark, sf_dir) -> DataFrame`` under ``name`` with an optional oracle."""
    def deco(fn):
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")

        @functools.wraps(fn)
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            ensure_defaults(spark)
            return fn(spark, sf_dir)

        QUERIES[name] = run
        if sql is not None:
            ORACLE[name] = _plus_zero(sql)
        return fn
    return deco


def load_all() -> None:
    """Import every query module so that their ``register`` calls run."""
    import importlib
    import pkgutil

    from .. import plans
    for m in sorted(pkgutil.iter_modules(plans.__path__)):
        if m.name.startswith("q_"):
            importlib.import_module(f"{plans.__name__}.{m.name}")
