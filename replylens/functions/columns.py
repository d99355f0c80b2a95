"""Column expressions shared by several operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F


def text_or_empty(name: str) -> Column:
    return F.coalesce(F.col(name).cast("string"), F.lit(""))


def percent(part: Column, total: Column) -> Column:
    """Share in percent, two decimals, ties to even; null when the total is zero."""
    return F.bround(F.try_divide(part, total) * 100, 2)


def stable_hash(key: str | Column, seed: int = 42) -> Column:
    """Seeded order over keys that does not depend on partitioning or engine."""
    column = F.col(key) if isinstance(key, str) else key
    return F.md5(F.concat(column.cast("string"), F.lit(f":{seed}")))


def timestamp_text(column: Column) -> Column:
    """``yyyy-MM-dd HH:mm:ss``, followed by six fraction digits when there is a fraction."""
    text = column.cast("string")
    return F.when(F.length(text) > 19, F.rpad(text, 26, "0")).otherwise(text)


def labelled_line(lines: Column, label: str) -> Column:
    """Value of the last line that starts with ``label``; ``N/A`` without one."""
    hits = F.filter(lines, lambda line: line.startswith(label))
    last = F.try_element_at(hits, F.lit(-1))
    return F.coalesce(F.substring(last, len(label) + 1, 2147483647), F.lit("N/A"))


def keep_where(df: DataFrame, condition: Column) -> DataFrame:
    """Rows for which a costly computed ``condition`` holds.

    A plain filter is pushed below the columns it reads, which copies their
    expressions into it once per reference and evaluates them again. Emitting a row
    or none computes them once.
    """
    row = F.struct(*(F.col(c) for c in df.columns))
    return df.select(F.inline(F.when(condition, F.array(row))))
