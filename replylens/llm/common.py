"""Helpers of the pipeline operators; tables are stored with the library's ``cut_lineage``."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from replylens.session import cut_lineage, new_folder  # noqa: F401

SLICE = 500  # rows of a batch that are Python objects at a time


def store(df: DataFrame, name: str = "table") -> DataFrame:
    """``cut_lineage`` with the session's codec: these tables hold numbers rather than texts."""
    return cut_lineage(df, name, compression=None)


def same(left: Column, right: Column) -> Column:
    """Equality in which nulls are equal."""
    return left.eqNullSafe(right)


def each_value(column: pa.Array) -> Iterator:
    """The values of a batch's column; only a few rows' are Python objects at a time."""
    for at in range(0, len(column), SLICE):
        yield from column.slice(at, SLICE).to_pylist()


def map_batches(
    df: DataFrame,
    make: Callable[[], Callable[[pa.RecordBatch], Iterator[pa.RecordBatch]]],
    schema: str,
) -> DataFrame:
    """``make()`` runs once a task and gives the function applied to each Arrow batch."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        each = make()
        for batch in batches:
            yield from each(batch)

    return df.mapInArrow(run, schema)


def filter_batches(
    df: DataFrame, read: str | list[str], make: Callable[[], Callable[..., list]]
) -> DataFrame:
    """Rows of ``df`` that the function accepts by the columns ``read``; columns stay as
    they are."""
    names = [read] if isinstance(read, str) else read

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        accept = make()
        for batch in batches:
            for at in range(0, batch.num_rows, SLICE):
                part = batch.slice(at, SLICE)
                given = [part.column(part.schema.get_field_index(name)).to_pylist() for name in names]
                yield part.filter(pa.array(accept(*given), pa.bool_()))

    return df.mapInArrow(run, df.schema)


def numbered(df: DataFrame, by: list[str], name: str) -> DataFrame:
    """Number the distinct rows of ``by``: sorted inside each partition, then told apart by it.

    The result must be stored, or used in the same query only, as numbers follow the
    partitions.
    """
    return (
        df.select(*by).distinct().sortWithinPartitions(*by)
        .withColumn(name, F.monotonically_increasing_id())
    )
