"""Top-n and exact numbering that never put the whole table into one task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

# md5 values are cut into 16**digits ranges. 65,536 ranges keep the table of range
# sizes small (about 3 MB) whatever the log holds; 1,048,576 keep one range of a
# trillion rows near a million.
RANGE_DIGITS = 4
SAMPLE_DIGITS = 5

# Rows of one block of numbers: a block is sorted by one task.
BLOCK = 10_000

# Tasks over which a group is ranked before its best rows meet.
SALTS = 64


def smallest_n(df: DataFrame, key: str, n: int, keys: DataFrame | None = None) -> DataFrame:
    """The ``n`` rows with the smallest ``key`` (unique), in key order.

    The cut-off key is found on the key column alone and comes back as a scalar
    subquery, so the wide read is filtered at the scan instead of sending ``n``
    wide rows per partition to the final task. ``keys`` is a frame with the keys of ``df``
    that is cheaper to read, for instance without the joins that bring the wide columns.
    """
    if n <= 0:
        return df.limit(0)
    cutoff = (df if keys is None else keys).select(key).orderBy(key).limit(n).agg(F.max(key)).scalar()
    return df.filter(F.col(key) <= cutoff).orderBy(key).limit(n)


def row_hash(df: DataFrame) -> Column:
    """A hash of the whole row, which settles ties between rows with one key."""
    plain = [f.name for f in df.schema if "map<" not in f.dataType.simpleString()]
    return F.xxhash64(*(F.col(c) for c in plain))


def hashed_sample(df: DataFrame, key: str, order: Column, n: int) -> DataFrame:
    """Exactly ``n`` rows (all, when there are fewer) by ascending hash ``order``.

    A histogram over hash prefixes gives the first prefix at which ``n`` rows are
    reached. Rows below it are taken as they are, and only rows with that prefix, about
    one in ``16 ** SAMPLE_DIGITS`` of all, are ranked: no task gets the whole sample. The
    result is sorted in ranges.
    """
    if n <= 0:
        return df.limit(0)
    prefix = F.coalesce(F.substring(order, 1, SAMPLE_DIGITS), F.lit(""))
    sizes = df.select(prefix.alias("prefix")).groupBy("prefix").agg(F.count("*").alias("size"))
    running = F.sum("size").over(Window.orderBy("prefix").rowsBetween(Window.unboundedPreceding, 0))
    reached = sizes.select("prefix", "size", running.alias("reached")).filter(F.col("reached") >= n)
    # At most 16 ** SAMPLE_DIGITS counts; one row comes back.
    boundary = reached.orderBy("prefix").first()
    if boundary is None:
        return df.orderBy(order, key)
    missing = n - (boundary["reached"] - boundary["size"])
    below = df.filter(prefix < boundary["prefix"])
    last = df.filter(prefix == boundary["prefix"]).withColumn("_all", F.lit(0))
    ranked = per_group_sample(last, "_all", key, order, missing).drop("_all", "pick")
    return below.unionByName(ranked).orderBy(order, key)


def per_group_sample(df: DataFrame, group: str, key: str, order: Column, n: int) -> DataFrame:
    """Up to ``n`` rows per group by ascending hash, with their rank in ``pick``.

    Ranked in two steps, inside (group, salt) and then inside the group, with at most ``n``
    rows kept after each. A group with a third of all rows is thus split over ``SALTS``
    tasks, whatever ``n`` is, and the second step sees ``SALTS * n`` rows of a group. Rows
    are never joined back by key: repeated and null keys are rows like any other.
    """
    numbered = df.withColumns({"_order": order, "_row": row_hash(df)}).withColumn(
        "_salt", F.pmod("_row", F.lit(SALTS))
    )
    inside = Window.partitionBy(group, "_salt").orderBy("_order", key, "_row")
    overall = Window.partitionBy(group).orderBy("_order", key, "_row")
    return (
        numbered.withColumn("_place", F.row_number().over(inside))
        .filter(F.col("_place") <= n)
        .withColumn("pick", F.row_number().over(overall))
        .filter(F.col("pick") <= n)
        .drop("_order", "_row", "_salt", "_place")
    )


def up_to_nth(df: DataFrame, keys: DataFrame, group: str, key: str, order: Column, n: int) -> DataFrame:
    """Rows of ``df`` up to the ``n``-th of their group by ascending hash ``order``, ties included.

    ``keys`` is a frame with group and key of the same rows that is cheap to read; the n-th of each
    group is found on it. What is sorted by group after that has few wide rows left. The n-th
    are broadcast: for groups that are a fixed handful. ``order`` follows from the key.
    """
    place = F.struct(order, F.col(key))
    first = per_group_sample(keys.select(group, key), group, key, order, n)
    ends = first.groupBy(F.col(group).alias("_group")).agg(F.max(place).alias("_end"))
    within = df.join(F.broadcast(ends), F.col(group).eqNullSafe(F.col("_group"))).filter(place <= F.col("_end"))
    return within.select(*df.columns)


def dense_position(
    df: DataFrame, key: str, name: str = "position", group: int = 1, part: str | None = None
) -> DataFrame:
    """Number all rows 0, 1, 2, ... in the order of ``md5(key)``, then ``key``, then row hash.

    Keys and row hashes are numbered alone first: inside hash ranges in parallel, shifted by the
    number of rows in the ranges before. Only the table of range sizes (at most 16**4 rows) meets
    in one task. Every ``BLOCK``-th number gives a cut, and the cuts, by range, are broadcast. They
    tell a row its block; the other columns move once, to their block, which is numbered from its
    cut. ``part`` keeps the block's number as a column, by which the rows are dealt out, and no
    run of ``group`` numbers is in two blocks. Rows alike in all columns stay in one block.
    ``df`` is read twice, for the cuts and for the rows; a costly one should be a stored table.
    """
    marked = df.withColumn("_row", row_hash(df))
    digest = F.md5(F.col(key).cast("string"))
    prefix = F.coalesce(F.substring("_digest", 1, RANGE_DIGITS), F.lit(""))
    entries = marked.select(F.col(key).alias("_key"), F.col("_row").alias("_entry")).groupBy("_key", "_entry").agg(
        F.count("*").alias("_copies")
    )
    ranged = entries.withColumn("_digest", F.md5(F.col("_key").cast("string"))).withColumn("_range", prefix)
    sizes = ranged.groupBy("_range").agg(F.sum("_copies").alias("_size"))
    before = F.sum("_size").over(Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1))
    offsets = sizes.select("_range", F.coalesce(before, F.lit(0)).alias("_before"))
    smaller = Window.partitionBy("_range").orderBy("_digest", "_key", "_entry")
    inside = F.coalesce(F.sum("_copies").over(smaller.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    numbered = ranged.withColumn("_inside", inside).join(F.broadcast(offsets), "_range")
    first = F.col("_before") + F.col("_inside")
    # Copies of one row that go beyond a multiple leave it without a cut, and the block is longer.
    is_cut = first % (group * max(1, BLOCK // group)) == 0
    cut = F.when(is_cut, F.struct("_digest", "_key", "_entry", first.alias("_first")))
    # The first entry of each range names a range without a cut. Taken from ``offsets``, whose sizes
    # no one reads here, ranges would be those of the rows of ``df``, computed once more.
    named = numbered.filter(is_cut | (F.col("_inside") == 0)).select("_range", cut.alias("_cut"))
    inner = named.groupBy("_range").agg(F.sort_array(F.collect_list("_cut")).alias("_cuts"))
    last = F.max(F.try_element_at("_cuts", F.lit(-1))["_first"]).over(
        Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    )
    known = inner.select("_range", "_cuts", last.alias("_last"))
    me = F.struct(F.col("_digest"), F.col(key), F.col("_row"))
    passed = F.filter("_cuts", lambda c: F.struct(c["_digest"], c["_key"], c["_entry"]) <= me)
    start = F.coalesce(F.try_element_at(passed, F.lit(-1))["_first"], F.col("_last"))
    placed = (
        marked.withColumn("_digest", digest).withColumn("_range", prefix)
        .join(F.broadcast(known), "_range").withColumn("_start", start)
    )
    order = Window.partitionBy("_start").orderBy("_digest", F.col(key), "_row")
    found = placed.withColumn(name, F.col("_start") + F.row_number().over(order) - 1)
    kept = [*df.columns, name]
    return found.select(*kept, *([F.col("_start").alias(part)] if part else []))
