"""Sharding by sampled splitters with equal bytes in every shard."""

from __future__ import annotations

import heapq
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from replylens.llm.common import map_batches, store

SHARDS = 8
RANGES = 2048
SAMPLES_PER_RANGE = 8
PARTS = 64  # of a large range; in one that is too large for a shard they go to several

ROW = "doc_id long, size long, text_crc32 long, key long, tie long"
RANGED = f"{ROW}, place int"


def _rows(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Key and size of each row. Equal texts have equal keys and so stay together."""
    text = F.coalesce(F.col(text_col), F.lit("")).cast("binary")
    return df.select(
        F.col(id_col).cast("long").alias("doc_id"),
        (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(text).alias("text_crc32"),
        F.xxhash64(text).alias("key"),
        F.xxhash64(F.col(id_col), F.lit("tie")).alias("tie"),
    )


def sampled_splitters(rows: DataFrame, total: int, ranges: int) -> np.ndarray:
    """Keys that cut the rows into ``ranges`` parts of about equal size.

    A row is drawn with a probability that is its share of the bytes times the number of
    draws, so the quantiles of the drawn keys are quantiles of the bytes. The draw depends
    on the row alone; about ``ranges * SAMPLES_PER_RANGE`` keys come to the driver.
    """
    draws = ranges * SAMPLES_PER_RANGE
    chance = F.col("size") * float(draws) / float(max(total, 1))
    even = F.pmod(F.xxhash64("key", "tie", F.lit("draw")), F.lit(1 << 30)) / float(1 << 30)
    drawn = rows.filter(even < chance).select("key", F.greatest(chance, F.lit(1.0)).alias("weight")).toPandas()
    drawn = drawn.sort_values("key")
    if drawn.empty:
        return np.zeros(0, np.int64)
    reached = np.cumsum(drawn["weight"].to_numpy())
    cuts = np.searchsorted(reached, np.arange(1, ranges) * reached[-1] / ranges)
    return np.unique(drawn["key"].to_numpy()[np.minimum(cuts, len(drawn) - 1)])


def _ranged(rows: DataFrame, splitters: np.ndarray) -> DataFrame:
    def make() -> Callable[[pa.RecordBatch], Iterator[pa.RecordBatch]]:
        def each(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
            key = batch.column(3).to_numpy(zero_copy_only=False)
            place = np.searchsorted(splitters, key, side="left").astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(place)], [*batch.schema.names, "place"]
            )

        return each

    return map_batches(rows, make, RANGED)


def assign_ranges(sizes: dict[tuple[int, int], int], shards: int) -> dict[tuple[int, int], int]:
    """Ranges to shards: the largest first, each to the shard with the fewest bytes."""
    heap = [(0, shard) for shard in range(shards)]
    chosen = {}
    for part in sorted(sizes, key=lambda p: (-sizes[p], p)):
        filled, shard = heapq.heappop(heap)
        chosen[part] = shard
        heapq.heappush(heap, (filled + sizes[part], shard))
    return chosen


def shard_rows(
    df: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    shards: int = SHARDS,
    ranges: int = RANGES,
) -> DataFrame:
    """``doc_id, size, text_crc32, law, shard, slot, grown_shard``: one row per row of ``df``.

    Law ``bytes``: the shards' sizes are nearly equal. Keys are hashes of the texts; drawn
    keys give splitters, the exact bytes of every range are summed, and a range with more
    than half of a shard's share (a text with very many copies) is divided further, by id.
    Ranges then go to shards by size. Copies of a text stay in one shard unless their range
    is divided. Slots number the rows of a shard without gaps, range after range.

    A null text has size 1, as an empty one has; null ids and repeated rows are rows like
    any other. Other columns are not read. An empty table gives no rows.
    """
    rows = store(_rows(df, id_col, text_col), "shard_rows")
    total = rows.agg(F.sum("size")).first()[0] or 0
    placed = store(_ranged(rows, sampled_splitters(rows, total, ranges)), "ranges")

    def sizes_of(frame: DataFrame) -> DataFrame:
        return frame.groupBy("place", "part").agg(F.sum("size").alias("size"), F.count("*").alias("n"))

    whole = {r["place"]: (r["size"], r["n"]) for r in sizes_of(placed.withColumn("part", F.lit(0))).collect()}
    count = sum(n for _, n in whole.values())
    # Less than ``ranges / 2`` ranges are so large; they are numbered in parts.
    large = [p for p, (s, n) in whole.items() if s * ranges > 4 * total or n * ranges > 4 * count]
    overfull = {p for p, (s, _) in whole.items() if s * 2 * shards > total}
    part = F.when(F.col("place").isin(large), F.pmod("tie", F.lit(PARTS))).otherwise(0).cast("int")
    placed = placed.withColumn("part", part)
    parts = {(r["place"], r["part"]): (r["size"], r["n"]) for r in sizes_of(placed).collect()}
    units: dict[tuple[int, int], int] = {}
    for (place, number), (size, _) in parts.items():
        unit = (place, number if place in overfull else 0)
        units[unit] = units.get(unit, 0) + size
    chosen = assign_ranges(units, shards)
    table, next_slot = [], [0] * shards
    for place, number in sorted(parts):
        shard = chosen[place, number if place in overfull else 0]
        table.append((place, number, shard, next_slot[shard]))
        next_slot[shard] += parts[place, number][1]
    lookup = df.sparkSession.createDataFrame(table, "place int, part int, shard int, first long")
    order = Window.partitionBy("place", "part").orderBy("key", "tie", "doc_id")
    return (
        placed.withColumn("inside", F.row_number().over(order))
        .join(F.broadcast(lookup), ["place", "part"])
        .select(
            "doc_id", "size", "text_crc32",
            F.lit("bytes").alias("law"),
            "shard",
            (F.col("first") + F.col("inside") - 1).alias("slot"),
            F.lit(None).cast("int").alias("grown_shard"),
        )
    )


def write_shards(df: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", **how: int) -> None:
    """Write ``df`` as Parquet, one folder ``shard=N`` for each shard.

    Rows find their shard by id, size and checksum of the text; all rows that agree in these are
    written with the first of their shards, and each row is written once.
    """
    where = shard_rows(df, id_col, text_col, **how).groupBy("doc_id", "size", "text_crc32").agg(
        F.min("shard").alias("shard")
    )
    text = F.coalesce(F.col(text_col), F.lit("")).cast("binary")
    packed = df.select(
        F.struct("*").alias("__row"),
        F.col(id_col).cast("long").alias("__id"),
        (F.octet_length(text) + 1).alias("__size"),
        F.crc32(text).alias("__crc"),
    )
    same_text = (F.col("__size") == F.col("size")) & (F.col("__crc") == F.col("text_crc32"))
    placed = packed.join(where, F.col("__id").eqNullSafe(F.col("doc_id")) & same_text)
    placed.select("__row.*", "shard").write.partitionBy("shard").parquet(path)
