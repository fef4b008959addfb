"""The first n rows of an order, for any n, without one task that sees them all.

Counts per range of the leading value narrow down where the n-th row lies, a few
thousand ranges at a time; what lies before it is then a filter. Rows that tie with it are
narrowed down in the same way by the leading characters of their key.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wiretide.sources.storage import materialize

#: Ranges counted at once; characters of a key counted at once, and rows that one task may order.
RANGES, CHARACTERS, TASK_ROWS = 4_096, 2, 10_000


def _nth(counts: list[tuple], n: int) -> tuple:
    """The first entry with which the counts reach n, and what of n is left before it."""
    for value, rows in counts:
        if n <= rows:
            return value, n, rows
        n -= rows
    raise ValueError("fewer rows than asked for")


def nth_largest(rows: DataFrame, value: str, n: int) -> tuple[int, int, int]:
    """The n-th largest of a long column, which of its equals that is, and how many equals there are."""
    low, high = rows.agg(F.min(value), F.max(value)).first()
    while True:
        width = -(-(high - low + 1) // RANGES)
        number = F.floor((F.lit(high) - F.col(value)) / F.lit(width)).cast("int")
        if width == 1:
            number = (F.lit(high) - F.col(value)).cast("int")
        counts = rows.filter(F.col(value).between(low, high)).groupBy(number.alias("range")).agg(F.count(F.lit(1)).alias("rows"))
        at, n, equals = _nth(sorted((r["range"], r["rows"]) for r in counts.collect()), n)
        high -= at * width
        low = max(low, high - width + 1)
        if width == 1:
            return high, n, equals


def first_by_key(rows: DataFrame, key: str, n: int, order: list[str], task_rows: int = TASK_ROWS) -> list[DataFrame]:
    """Parts that make up the first n rows by a text key, then by the rest of the order."""
    parts, prefix = [], ""
    while n:
        inside = rows.filter(F.col(key).startswith(prefix)) if prefix else rows
        digits = F.substring(key, len(prefix) + 1, CHARACTERS)
        counts = sorted((r["digits"], r["rows"]) for r in inside.groupBy(digits.alias("digits")).agg(F.count(F.lit(1)).alias("rows")).collect())
        at, n, equals = _nth(counts, n)
        parts.append(inside.filter(digits < at))
        found = inside.filter(digits == at)
        if n == equals:
            return [*parts, found]
        if equals <= task_rows or len(at) < CHARACTERS:
            return [*parts, found.orderBy(*order).limit(n)]
        prefix += at
    return parts


def largest_rows(rows: DataFrame, n: int, value: str, key: str, *more: str, task_rows: int = TASK_ROWS) -> DataFrame:
    """The n rows with the largest values, ties by the text key and the columns after it, in that order.

    n up to ``task_rows`` is an ordinary top-n list. Beyond, no task holds more than so many rows
    at once, unless more of them agree in value and key. Without so many rows all are given.
    """
    order = [F.desc(value), key, *more]
    if n <= task_rows:
        return rows.orderBy(*order).limit(max(n, 0))
    rows = materialize(rows, "to-select")
    if rows.count() <= n:
        return rows.orderBy(*order)
    least, left, equals = nth_largest(rows, value, n)
    if left == equals:
        return rows.filter(F.col(value) >= least).orderBy(*order)
    ties = first_by_key(rows.filter(F.col(value) == least), key, left, [key, *more], task_rows)
    return reduce(DataFrame.unionAll, [rows.filter(F.col(value) > least), *ties]).orderBy(*order)
