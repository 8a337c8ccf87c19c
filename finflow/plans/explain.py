"""Reading a physical plan: which join was chosen, what reaches the scan."""

from __future__ import annotations

import contextlib
import io
import re

from pyspark.sql import DataFrame

_JOINS = (
    "BroadcastHashJoin",
    "BroadcastNestedLoopJoin",
    "CartesianProduct",
    "ShuffledHashJoin",
    "SortMergeJoin",
)


def plan_text(df: DataFrame, mode: str = "formatted") -> str:
    """What ``df.explain`` prints, as a string."""
    captured = io.StringIO()
    with contextlib.redirect_stdout(captured):
        df.explain(mode)
    return captured.getvalue()


def join_strategies(df: DataFrame) -> list[str]:
    """Join operators of the plan in the order of their numbers."""
    found = re.findall(r"^\(\d+\) (\w+)", plan_text(df), re.MULTILINE)
    return [name for name in found if name in _JOINS]


def shuffles(df: DataFrame) -> int:
    """Number of shuffles in the plan as first made."""
    return len(re.findall(r"^\(\d+\) Exchange", plan_text(df), re.MULTILINE))


def pushed_filters(df: DataFrame) -> list[str]:
    """Filters handed to the file scans."""
    return re.findall(r"^PushedFilters: \[(.*)\]", plan_text(df), re.MULTILINE)


def scanned_columns(df: DataFrame) -> list[str]:
    """Read schema of each file scan."""
    return re.findall(r"^ReadSchema: struct<(.*)>", plan_text(df), re.MULTILINE)
