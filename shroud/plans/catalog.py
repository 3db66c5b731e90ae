"""All registered queries of the privacy jobs and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from shroud.plans import governance, protection, streams

_ALL = [protection, governance, streams]


def queries() -> dict[str, Callable]:
    return {name: run for module in _ALL for name, (run, _) in module.QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    return {name: sql for module in _ALL for name, (_, sql) in module.QUERIES.items() if sql}
