"""Small frame helpers shared by the corpus operators."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame


def without(df: DataFrame, *names: str) -> DataFrame:
    """``df`` without the columns an operator is about to add, whatever their case."""
    taken = {name.lower() for name in names}
    return df.drop(*[name for name in df.columns if name.lower() in taken])


def carrying(docs: DataFrame, core: tuple[str, ...], operate: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """``operate(docs)`` with all columns but ``core`` out of its way: renamed before, named back after."""
    away = {name: f"granary_carried_{i}" for i, name in enumerate(docs.columns) if name not in core}
    return operate(docs.withColumnsRenamed(away)).withColumnsRenamed({new: old for old, new in away.items()})


def shielded(operator: Callable[..., DataFrame]) -> Callable[..., DataFrame]:
    """Let a frame's own columns that begin with an underscore, as the operator's inner ones do, pass unharmed."""

    @wraps(operator)
    def run(docs: DataFrame, *args, **kwargs) -> DataFrame:
        named = {value for value in (*args, *kwargs.values()) if isinstance(value, str)}
        core = tuple(name for name in docs.columns if not name.startswith("_") or name in named)
        return carrying(docs, core, lambda frame: operator(frame, *args, **kwargs))

    return run
