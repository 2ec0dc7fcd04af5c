"""Dictionaries as SQL literals.

Expressions that carry whole dictionaries are written as SQL text: one parsed
string instead of a driver call for each of several hundred values.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def sql_string(value: str) -> str:
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def sql_array(values: Sequence[str]) -> str:
    if not values:
        return "cast(array() as array<string>)"
    return f"array({', '.join(map(sql_string, values))})"


def sql_arrays(groups: Iterable[Sequence[str]]) -> str:
    return f"array({', '.join(map(sql_array, groups))})"


def sql_map(mapping: dict[str, str]) -> str:
    if not mapping:
        return "cast(map() as map<string,string>)"
    return f"map({', '.join(f'{sql_string(k)}, {sql_string(v)}' for k, v in mapping.items())})"


def sql_let(names: dict[str, str], body: str) -> str:
    """``body`` with each name evaluated once per row, referred to as ``v.name``.

    The optimizer may otherwise inline an expression into a higher-order
    function, where it would be evaluated again for every array element.
    """
    fields = ", ".join(f"{sql_string(name)}, {value}" for name, value in names.items())
    return f"transform(array(named_struct({fields})), v -> {body})[0]"


def string_array(values: Sequence[str]) -> Column:
    return F.expr(sql_array(values))
