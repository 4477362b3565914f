"""Column expressions used by the operators.

Everything here returns a native Catalyst ``Column``: no Python runs per row,
so each expression stays inside whole-stage code generation.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from churnlens.schemas import NA_TOKENS, OUTSIDE_LABEL


def as_col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def sql_ident(name: str) -> str:
    """A column name quoted for a SQL expression."""
    return "`" + name.replace("`", "``") + "`"


def sql_string(text: str) -> str:
    """A Python string as a SQL string literal."""
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def na_to_null(c: str | Column, tokens: Iterable[str] = NA_TOKENS) -> Column:
    """Text cell -> NULL when it is one of the missing-value tokens.

    For a column name the membership test is one SQL ``IN`` expression (one
    call to build; Catalyst turns the literal list into a hash set).
    """
    tokens = list(tokens)
    if isinstance(c, str):
        listed = ", ".join(sql_string(t) for t in tokens)
        hit = F.expr(f"{sql_ident(c)} IN ({listed})")
    else:
        hit = c.isin(tokens)
    col = as_col(c)
    return F.when(hit, F.lit(None)).otherwise(col)


def flag_equals(c: str | Column, value: str) -> Column:
    """1 when the column equals ``value`` exactly (case-sensitive), else 0.

    NULL counts as "not equal", so the flag itself is never NULL.
    """
    col = as_col(c)
    return F.when(col == F.lit(value), F.lit(1)).otherwise(F.lit(0))


def bin_right_closed(
    c: str | Column,
    edges: Sequence[float | None],
    labels: Sequence[str],
    outside: str | None = OUTSIDE_LABEL,
) -> Column:
    """Label bins ``(edges[i], edges[i+1]]``; ``None`` as the last edge is +inf.

    Values at or below the first edge, NULLs, and values above a finite last
    edge get ``outside``.
    """
    if len(edges) != len(labels) + 1:
        raise ValueError("need exactly one more edge than labels")
    col = as_col(c)
    expr = None
    for lo, hi, label in zip(edges[:-1], edges[1:], labels):
        cond = col > F.lit(lo)
        if hi is not None:
            cond = cond & (col <= F.lit(hi))
        expr = F.when(cond, F.lit(label)) if expr is None else expr.when(cond, F.lit(label))
    return expr.otherwise(F.lit(outside))


def band_left_closed(
    c: str | Column,
    bands: Sequence[tuple[float, str]],
    base: str,
) -> Column:
    """Threshold bands: the first ``(lower, label)`` with ``value >= lower`` wins.

    ``bands`` is ordered from the highest threshold down; values below every
    threshold (and NULL) get ``base``.
    """
    col = as_col(c)
    expr = None
    for lower, label in bands:
        cond = col >= F.lit(lower)
        expr = F.when(cond, F.lit(label)) if expr is None else expr.when(cond, F.lit(label))
    return F.lit(base) if expr is None else expr.otherwise(F.lit(base))


def falsy_to_zero(c: str | Column) -> Column:
    """NULL (or 0) -> 0, other values unchanged; the type is kept."""
    return F.coalesce(as_col(c), F.lit(0))


def exact_avg(c: str | Column) -> Column:
    """Average of an integer or decimal column as a double.

    The sum is taken in the column's exact type and divided once at the end,
    so the result does not depend on how rows are split into partitions or
    in what order partial sums are merged. NULLs are ignored; no rows or only
    NULLs give NULL.
    """
    col = as_col(c)
    return F.try_divide(F.sum(col).cast("double"), F.count(col))


def rate_percent(flag: str | Column) -> Column:
    """Average of a 0/1 flag times 100; a NULL flag is left out."""
    return exact_avg(flag) * F.lit(100)


def rate_percent_null_as_zero(flag: str | Column) -> Column:
    """``AVG(CASE WHEN flag = 1 THEN 1.0 ELSE 0.0 END) * 100``: NULL counts as 0."""
    hit = F.when(as_col(flag) == F.lit(1), F.lit(1)).otherwise(F.lit(0))
    return exact_avg(hit) * F.lit(100)


def python_timestamp_text(c: str | Column) -> Column:
    """Timestamp -> text as Python's ``str(datetime)`` writes it.

    ``YYYY-MM-DD HH:MM:SS`` when the microseconds are zero, otherwise
    ``YYYY-MM-DD HH:MM:SS.ffffff``.
    """
    # A cast never passes a zone-less timestamp through the session's zone.
    text = as_col(c).cast("string")
    return F.when(text.contains("."), F.rpad(text, 26, "0")).otherwise(text)


def utc_now() -> Column:
    """The query's start in UTC, as a zone-less timestamp: it never runs
    backwards when local clocks do, whatever the session's zone."""
    return F.expr(
        "TIMESTAMP_NTZ'1970-01-01 00:00:00' + "
        "make_dt_interval(0, 0, 0, CAST(unix_micros(current_timestamp()) / CAST(1000000 AS DECIMAL(8, 0)) AS DECIMAL(18, 6)))"
    )


def is_null_count(c: str | Column) -> Column:
    """Number of NULLs in a column, as a long (an aggregate)."""
    return F.sum(as_col(c).isNull().cast("long"))


def row_digest(columns: Iterable[str]) -> Column:
    """64-bit digest of some columns of a row; NULL differs from every value.

    Two versions of one row that differ have equal digests with probability
    2^-64. Spark's hash skips NULLs, so every column is hashed with its NULL flag.
    """
    parts = [x for c in columns for x in (F.col(sql_ident(c)), F.col(sql_ident(c)).isNull())]
    return F.xxhash64(F.lit(0), *parts)
