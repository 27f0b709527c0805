"""Report dispatch: ``report(ws, name)`` -> typed DataFrame."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame

from verilens.plans import conversations as _conversations
from verilens.plans import items as _items
from verilens.plans import rejects as _rejects
from verilens.plans import tasks as _tasks

REPORTS: dict[str, Callable[..., DataFrame]] = {
    "items": _items.items,
    "tasks": _tasks.tasks,
    "conversations": _conversations.conversations,
    "rejects": _rejects.rejects,
}


def report(ws: dict[str, DataFrame], name: str, **options) -> DataFrame:
    """Build one report over a workspace.  Unknown names raise ``ValueError``
    (rather than silently producing another report)."""
    try:
        build = REPORTS[name]
    except KeyError:
        raise ValueError(f"unknown report {name!r}; expected one of {sorted(REPORTS)}") from None
    return build(ws, **options)
