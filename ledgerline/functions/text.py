"""Case- and trailing-blank-insensitive string tests.

The reports were written against a case-insensitive collation that also ignores
trailing blanks in comparisons. Spark's default comparison is exact, so every string
equality, IN list, join key and group key goes through ``key`` and every pattern
goes through ``ilike``.

Helpers given a column *name* build the expression as one SQL string (one round trip
to the JVM however long the value list); given a ``Column`` they use the Column API.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F


def q(name: str) -> str:
    """Quoted column reference for SQL expression strings (blanks allowed)."""
    return "`" + name.replace("`", "``") + "`"


def s(value: str) -> str:
    """SQL string literal."""
    return "'" + value.replace("'", "''") + "'"


def norm(value: str) -> str:
    return value.rstrip().upper()


def key_sql(name: str) -> str:
    return f"upper(rtrim({q(name)}))"


def key(c: str | Column) -> Column:
    """Comparison key of a string: upper case, trailing blanks removed."""
    return F.expr(key_sql(c)) if isinstance(c, str) else F.upper(F.rtrim(c))


def eq(c: str | Column, value: str) -> Column:
    if isinstance(c, str):
        return F.expr(f"{key_sql(c)} = {s(norm(value))}")
    return key(c) == F.lit(norm(value))


def isin_sql(name: str, values: Iterable[str]) -> str:
    return f"{key_sql(name)} IN ({', '.join(s(norm(v)) for v in values)})"


def isin(c: str | Column, values: Iterable[str]) -> Column:
    """``c IN (values)`` under the collation; NULL stays NULL (so NOT IN drops it)."""
    values = list(values)
    if isinstance(c, str):
        return F.expr(isin_sql(c, values)) if values else F.lit(False)
    return key(c).isin([norm(v) for v in values])


def like(c: str | Column, pattern: str) -> Column:
    return F.expr(f"{q(c)} ILIKE {s(pattern)}") if isinstance(c, str) else c.ilike(pattern)
