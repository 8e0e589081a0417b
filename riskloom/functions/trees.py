"""Balanced CASE trees: a value finds its interval in log2(n) comparisons, inside codegen.

Built as SQL text and parsed once; the same tree put together from Column
objects costs one JVM call per node.
"""

from __future__ import annotations

import math


def quoted(name: str) -> str:
    """Column name for SQL text."""
    return "`" + name.replace("`", "``") + "`"


def number(value: float | int | None) -> str:
    """Literal for SQL text; doubles keep every digit."""
    if value is None:
        return "CAST(NULL AS DOUBLE)"
    if isinstance(value, float) and math.isinf(value):
        return f"CAST('{'' if value > 0 else '-'}Infinity' AS DOUBLE)"
    return f"{value!r}D" if isinstance(value, float) else str(value)


def text(value: str) -> str:
    escaped = value.replace("\\", "\\\\").replace("'", "\\'")
    return f"'{escaped}'"


def interval_case(value: str, edges: list[float], leaves: list[str]) -> str:
    """SQL for leaf ``i`` where ``edges[i-1] <= value < edges[i]``.

    There is one leaf more than edges. The value must not be NULL or NaN.
    """
    if not edges:
        return leaves[0]
    mid = len(edges) // 2
    below = interval_case(value, edges[:mid], leaves[: mid + 1])
    above = interval_case(value, edges[mid + 1 :], leaves[mid + 1 :])
    return f"CASE WHEN {value} < {number(float(edges[mid]))} THEN {below} ELSE {above} END"


def choice_case(value: str, options: dict[str, str], otherwise: str) -> str:
    """SQL choosing by a text value."""
    if not options:
        return otherwise
    whens = " ".join(f"WHEN {text(k)} THEN {v}" for k, v in options.items())
    return f"CASE {value} {whens} ELSE {otherwise} END"
