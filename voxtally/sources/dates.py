"""Dates in whatever spelling a dataset has, day and month settled for the whole column.

A value such as ``03/04/2024`` says nothing about which number is the month; the column it stands in mostly does, since
other values have a number above twelve in one place.  One pass counts these votes, together with how many values each
form reads and how many are read by none.  All values of the column are then read the same way.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from voxtally.functions.literals import sql_array, sql_let, sql_string
from voxtally.functions.text import aliased, missing_to_null, strip

# Names of months as they begin in English, in order.
MONTHS = ("jan", "feb", "mar", "apr", "may", "jun", "jul", "aug", "sep", "oct", "nov", "dec")

_MONTH = r"(january|february|march|april|may|june|july|august|september|october|november|december|jan|feb|mar|apr|jun|jul|aug|sept|sep|oct|nov|dec)\.?"
_CLOCK = r"(?:[t ,]+\d{1,2}:\d{2}.*)?"
#: Forms by name: an expression for the lower-cased value, and which of its groups are year, month and day.
FORMS: dict[str, tuple[str, tuple[int, int, int]]] = {
    "year_first": (r"^(\d{4})[-/.](\d{1,2})[-/.](\d{1,2})" + _CLOCK + "$", (1, 2, 3)),
    "compact": (r"^(\d{4})(\d{2})(\d{2})$", (1, 2, 3)),
    "year_last": (r"^(\d{1,2})[-/.](\d{1,2})[-/.](\d{4})" + _CLOCK + "$", (3, 1, 2)),
    "day_month_name": (r"^(\d{1,2})(?:st|nd|rd|th)?[-/ ]+(?:of )?" + _MONTH + r"[-/, ]+(\d{4})" + _CLOCK + "$", (3, 2, 1)),
    "month_name_day": (r"^" + _MONTH + r"[-/ ]+(\d{1,2})(?:st|nd|rd|th)?[-/, ]+(\d{4})" + _CLOCK + "$", (3, 1, 2)),
}
_AMBIGUOUS = "year_last"


def _number(value: str, regex: str, group: int) -> str:
    found = f"regexp_extract({value}, {sql_string(regex)}, {group})"
    if _MONTH in regex and regex[: regex.index(_MONTH)].count("(") - regex[: regex.index(_MONTH)].count("(?:") + 1 == group:
        return f"array_position({sql_array(MONTHS)}, left({found}, 3))"
    return f"try_cast({found} AS int)"


def _read(value: str, form: str, day_first: str = "false") -> str:
    """The date that a form reads in a lower-cased ``value``; null where the value has another form or names no day."""
    regex, (year, month, day) = FORMS[form]
    y, m, d = (_number(value, regex, g) for g in (year, month, day))
    if form == _AMBIGUOUS:
        m, d = f"IF({day_first}, {d}, {m})", f"IF({day_first}, {m}, {d})"
    text = f"concat(lpad(string({y}), 4, '0'), '-', lpad(string({m}), 2, '0'), '-', lpad(string({d}), 2, '0'))"
    return f"CASE WHEN rlike({value}, {sql_string(regex)}) AND {y} > 0 THEN try_cast({text} AS date) END"


def _prepared(value: str) -> str:
    return f"lower({missing_to_null(strip(f'string({value})'))})"


def date_profile(df: DataFrame, column: str, by: Sequence[str] = ()) -> DataFrame:
    """How a column's dates are spelled, in one pass: a row, or one for each value of ``by``.

    ``dated`` values that are not missing, how many of them each form reads, ``unread`` ones, and the ``day_votes`` and
    ``month_votes``: values with two numbers ahead of the year of which only one can be the month.
    """
    value = df.select(*by, F.expr(_prepared(_quoted(column))).alias("value"))
    ahead = [_number("value", FORMS[_AMBIGUOUS][0], g) for g in (1, 2)]
    is_form = f"rlike(value, {sql_string(FORMS[_AMBIGUOUS][0])})"
    read = {form: f"{_read('value', form)} IS NOT NULL" for form in FORMS}
    either = f"{_read('value', _AMBIGUOUS)} IS NOT NULL OR {_read('value', _AMBIGUOUS, 'true')} IS NOT NULL"
    read[_AMBIGUOUS] = either
    return value.groupBy(*by).agg(*aliased({
        "dated": "count(value)", **{form: f"count_if({test})" for form, test in read.items()},
        "unread": f"count_if(value IS NOT NULL AND NOT ({' OR '.join(f'({t})' for t in read.values())}))",
        "day_votes": f"count_if(CASE WHEN {is_form} THEN {ahead[0]} > 12 AND {ahead[1]} <= 12 END)",
        "month_votes": f"count_if(CASE WHEN {is_form} THEN {ahead[1]} > 12 AND {ahead[0]} <= 12 END)",
    }))


def _quoted(column: str) -> str:
    return "`" + column.replace("`", "``") + "`"


def day_first(df: DataFrame, column: str) -> Column:
    """Whether the column's votes are for the day ahead of the month; the month is first when they are even."""
    return date_profile(df, column).agg(F.expr("coalesce(max(day_votes > month_votes), false)")).scalar()


def read_date(value: str, day_is_first: str) -> str:
    """SQL for the date in ``value`` by the form it has; ``day_is_first`` is SQL for the column's order."""
    reads = ", ".join(_read("v.value", form, "v.day_first") for form in FORMS)
    return sql_let({"value": _prepared(value), "day_first": day_is_first}, f"coalesce({reads})")


def settle_dates(df: DataFrame, column: str, into: str | None = None) -> DataFrame:
    """``df`` with the dates of a text column as dates, in ``into`` or in its place.

    The column is read once for its votes and again with the rest of the table; both are one lazy plan.  Missing
    values and such as no form reads are null: :func:`date_profile` counts them.
    """
    marked = df.withColumn("_day_first", day_first(df, column))
    return marked.withColumn(into or column, F.expr(read_date(_quoted(column), "_day_first"))).drop("_day_first")
