"""Statistics across the columns of one row, as SQL expressions.

The values of a family sit in one row (one column per service), so nothing is
shuffled. The expressions avoid lambda functions, which would drop the stage
out of code generation. They are text because hundreds of them are built per
plan and one parsed expression is much cheaper than a tree of column objects.
"""

from __future__ import annotations


def quoted(names: list[str]) -> list[str]:
    return [f"`{n}`" for n in names]


def row_count(names: list[str]) -> str:
    return " + ".join(f"int({c} IS NOT NULL)" for c in quoted(names))


def row_sum(names: list[str]) -> str:
    return " + ".join(f"coalesce({c}, 0D)" for c in quoted(names))


def row_max(names: list[str]) -> str:
    return f"greatest({', '.join(quoted(names))})" if len(names) > 1 else f"`{names[0]}`"


def row_min(names: list[str]) -> str:
    return f"least({', '.join(quoted(names))})" if len(names) > 1 else f"`{names[0]}`"


def row_mean(total: str, count: str) -> str:
    return f"try_divide({total}, nullif({count}, 0))"


def row_std(names: list[str], mean: str, count: str) -> str:
    """Sample standard deviation; fewer than two values give 0."""
    squares = " + ".join(f"coalesce(({c} - {mean}) * ({c} - {mean}), 0D)" for c in quoted(names))
    return f"CASE WHEN {count} > 1 THEN sqrt(try_divide({squares}, nullif({count} - 1, 0))) ELSE 0D END"


def row_sorted(names: list[str]) -> str:
    """Ascending array with the NULLs in front."""
    return f"sort_array(array({', '.join(quoted(names))}))"


def row_quantile(ordered: str, count: str, width: int, p: float) -> str:
    """Linear interpolation over the non-NULL tail of ``row_sorted``."""
    place = f"(({count} - 1) * {p}D)"
    skipped = f"({width} - {count})"
    low = f"get({ordered}, int({skipped} + floor({place})))"
    high = f"get({ordered}, int({skipped} + ceil({place})))"
    return f"CASE WHEN {count} > 0 THEN {low} + ({place} - floor({place})) * ({high} - {low}) END"
