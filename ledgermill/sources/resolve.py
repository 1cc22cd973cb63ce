"""Ordered source resolution: the first source that loads wins."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame


@dataclass(frozen=True)
class Resolved:
    table: str
    source: str
    frame: DataFrame


def resolve_table(
    table: str, sources: Sequence[tuple[str, Callable[[], DataFrame]]]
) -> Resolved:
    """Try the sources in order; nothing is ever made up when all fail.

    A source fails when its schema cannot be resolved, so a missing path or an
    unreachable warehouse is noticed here and not inside a later job.
    """
    tried = []
    for name, load in sources:
        try:
            frame = load()
            frame.schema
            return Resolved(table, name, frame)
        except Exception as error:
            tried.append(f"{name}: {str(error).splitlines()[0]}")
    raise LookupError(f"{table}: no source could be read ({'; '.join(tried)})")
