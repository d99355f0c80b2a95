"""Exact deduplication by deterministic naming of blocks."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window, functions as F

from replylens.llm.common import numbered, same, store

BLOCK_BYTES = 4096

# A block counts as frequent when it makes up more than one of FREQUENT_SHARE blocks;
# hence there are fewer than FREQUENT_SHARE frequent ones, whatever the input.
FREQUENT_SHARE = 2000

# Rows repeated with one id and text are written out by at most so many at once.
COPIES_AT_ONCE = 1 << 16

NO_PARTNER = -(2**63)


def _blocks(df: DataFrame, block_bytes: int) -> DataFrame:
    last = F.greatest(F.ceil(F.col("size") / block_bytes) - 1, F.lit(0)).cast("int")
    cut = F.transform(
        F.sequence(F.lit(0), last),
        lambda i: F.substring(F.col("body"), i * block_bytes + 1, F.lit(block_bytes)),
    )
    return df.select("id", "sha", F.posexplode(cut).alias("i", "block")).withColumn(
        "hash", F.xxhash64("block")
    )


def _name_blocks(blocks: DataFrame, total: int) -> DataFrame:
    """Each block as an integer; two blocks have the same one only if their bytes are equal.

    Hashes merely tell which blocks are frequent. Those few are named by a broadcast
    table, in negative numbers, without moving a row; all others are sorted and named
    after a shuffle in which no block can be hot.
    """
    hashes = blocks.groupBy("hash").agg(F.count("*").alias("n"))
    frequent = store(
        hashes.filter(F.col("n") * FREQUENT_SHARE > total).select("hash"), "frequent_blocks"
    )
    heavy = blocks.join(F.broadcast(frequent), "hash", "left_semi")
    heavy_names = store(
        heavy.select("block").distinct()
        .withColumn("name", -F.row_number().over(Window.orderBy("block")).cast("long")),
        "frequent_names",
    )
    light = blocks.join(F.broadcast(frequent), "hash", "left_anti")
    columns = ["id", "sha", "i", "name"]
    return (
        heavy.join(F.broadcast(heavy_names), "block").select(columns)
        .unionByName(light.join(numbered(light, ["block"], "name"), "block").select(columns))
    )


def text_identities(
    df: DataFrame, id_col: str = "doc_id", text_col: str = "text", block_bytes: int = BLOCK_BYTES
) -> DataFrame:
    """``id, sha, copies, blocks, name``: rows with the same ``(blocks, name)`` have equal texts.

    Each text is cut into blocks of ``block_bytes`` bytes, which get integer names by
    sorting. Then names of adjacent blocks are paired and the distinct pairs named in the
    same way, until each document has one name. Documents leave the recursion as soon as
    they have one, so that each round handles half the names of the round before.
    """
    body = F.coalesce(F.col(text_col), F.lit("")).cast("binary")
    texts = df.select(F.col(id_col).alias("id"), body.alias("body")).withColumns(
        {"sha": F.sha2("body", 256), "size": F.octet_length("body")}
    )
    rows = store(texts.groupBy("id", "sha", "size").agg(F.count("*").alias("copies")), "texts")
    rows = rows.select(
        "id", "sha", "copies",
        F.greatest(F.ceil(F.col("size") / block_bytes), F.lit(1)).cast("long").alias("blocks"),
    )
    total, most = rows.agg(F.sum(F.col("blocks") * F.col("copies")), F.max("blocks")).first()
    level = store(_name_blocks(_blocks(texts, block_bytes), total or 0), "block_names")
    level = level.join(
        rows.select(F.col("id").alias("of"), F.col("sha").alias("text"), "blocks"),
        same(F.col("id"), F.col("of")) & (F.col("sha") == F.col("text")),
    ).select("id", "sha", "blocks", F.col("blocks").alias("left"), "i", "name")

    found = []
    for depth in range(math.ceil(math.log2(most or 1)) + 1):
        found.append(level.filter("left = 1").select("id", "sha", "blocks", "name").distinct())
        if 2**depth >= (most or 1):
            break
        at = F.col("i") % 2
        pairs = store(
            level.filter("left > 1")
            .groupBy("id", "sha", "blocks", "left", F.floor(F.col("i") / 2).cast("int").alias("i"))
            .agg(
                F.max(F.when(at == 0, F.col("name"))).alias("a"),
                F.coalesce(F.max(F.when(at == 1, F.col("name"))), F.lit(NO_PARTNER)).alias("b"),
            ),
            "pairs",
        )
        names = store(numbered(pairs, ["a", "b"], "name"), "pair_names")
        level = store(
            pairs.join(names, ["a", "b"]).select(
                "id", "sha", "blocks", F.ceil(F.col("left") / 2).cast("long").alias("left"), "i", "name"
            ),
            "names",
        )
    named = found[0]
    for part in found[1:]:
        named = named.unionByName(part)
    named = named.select(F.col("id").alias("of"), F.col("sha").alias("text"), "blocks", "name")
    return rows.drop("blocks").join(
        named, same(F.col("id"), F.col("of")) & (F.col("sha") == F.col("text"))
    ).select("id", "sha", "copies", "blocks", "name")


def _grouped(df: DataFrame, id_col: str, text_col: str, block_bytes: int) -> DataFrame:
    """``id, sha, copies, keep_id, group_size``: the rows of one id and text are one row here."""
    members = store(text_identities(df, id_col, text_col, block_bytes), "identities")
    groups = store(
        members.groupBy("blocks", "name").agg(
            F.max("id").alias("keep_id"), F.sum("copies").alias("group_size")
        ),
        "groups",
    )
    return members.join(groups, ["blocks", "name"]).drop("blocks", "name")


def _written_out(rows: DataFrame) -> DataFrame:
    """Each row as often as ``copies`` says, numbered from 1 in ``copy``. What is repeated more than
    ``COPIES_AT_ONCE`` times is dealt to tasks in parts of that many."""
    few = rows.filter(F.col("copies") <= COPIES_AT_ONCE).withColumn(
        "copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies")))
    )
    parts = (
        rows.filter(F.col("copies") > COPIES_AT_ONCE)
        .withColumn("part", F.explode(F.sequence(F.lit(0).cast("long"), F.expr(f"(copies - 1) div {COPIES_AT_ONCE}"))))
        .repartition("id", "sha", "part")
    )
    first = F.col("part") * COPIES_AT_ONCE
    last = F.least(F.col("copies"), first + COPIES_AT_ONCE)
    many = parts.withColumn("copy", F.explode(F.sequence(first + 1, last))).drop("part")
    return few.unionByName(many)


def exact_duplicates(
    df: DataFrame, id_col: str = "doc_id", text_col: str = "text", block_bytes: int = BLOCK_BYTES
) -> DataFrame:
    """``doc_id, keep_id, group_size, kept, text_sha256``: one row per row of ``df``.

    Of equal texts the row with the largest id stays. A null text counts as empty, and all
    empty texts are equal. A null id is smaller than any other; a group of null ids has a
    null ``keep_id``, and its first row stays. Of rows repeated with the same id and text
    exactly one is kept. Other columns are not read. An empty table gives no rows.
    """
    return _written_out(_grouped(df, id_col, text_col, block_bytes)).select(
        F.col("id").alias("doc_id"),
        "keep_id",
        "group_size",
        (same(F.col("id"), F.col("keep_id")) & (F.col("copy") == 1)).alias("kept"),
        F.col("sha").alias("text_sha256"),
    )


def drop_exact_duplicates(
    df: DataFrame, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """The rows of ``df`` that stay, with its columns. Of repeated rows (same id, same text)
    the one stays whose other columns come first in sorted order; each task offers one, so that
    no task gets all of them. Ids, nulls and empty tables are as in ``exact_duplicates``."""
    grouped = _grouped(df, id_col, text_col, BLOCK_BYTES)
    stay = store(
        grouped.filter(same(F.col("id"), F.col("keep_id")))
        .select(F.col("id").alias("__id"), F.col("sha").alias("__sha"), "copies"),
        "kept",
    )
    sha = F.sha2(F.coalesce(F.col(text_col), F.lit("")).cast("binary"), 256)
    packed = df.select(F.struct("*").alias("__row"), F.col(id_col).alias("__of"), sha.alias("__text"))
    match = same(F.col("__of"), F.col("__id")) & (F.col("__text") == F.col("__sha"))
    single = packed.join(stay.filter("copies = 1"), match)
    repeated = (
        packed.join(stay.filter("copies > 1"), match)
        .groupBy("__id", "__sha").agg(F.min_by("__row", F.to_json("__row")).alias("__row"))
    )
    return single.select("__row.*").unionByName(repeated.select("__row.*"))
