"""Keyed collections of texts with metadata and vectors, as Parquet tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from replylens.functions.columns import labelled_line, text_or_empty, timestamp_text
from replylens.functions.ordering import smallest_n
from replylens.operators.embedding import Encoder, text_vectors, with_vectors

FETCH_LIMIT = 100

# Collection names, key prefixes and the labels of a pair document.
COLLECTIONS = ["customer_messages", "suggested_responses", "final_responses", "rejected_pairs"]
EXTRAS = ["customer_message", "suggested_response", "final_response", "sequence"]
KEY_PREFIX = {
    "customer_messages": "",
    "suggested_responses": "sugg_",
    "final_responses": "final_",
    "rejected_pairs": "pair_",
}
PAIR_ACTIONS = ["EDITED", "IGNORED"]
PAIR_TEXTS = {
    "customer_message": "message_input",
    "suggested_response": "message_output",
    "final_response": "final_message_sent",
}
LABELS = {
    "customer_message": "CUSTOMER: ",
    "suggested_response": "SUGGESTION: ",
    "final_response": "FINAL: ",
}


def _text_or_sentinel(df: DataFrame, name: str) -> Column:
    if name not in df.columns:
        return F.lit("N/A")
    return F.coalesce(F.col(name).cast("string"), F.lit("N/A"))


def _metadata(df: DataFrame, pairs: bool = False) -> Column:
    """Job, intent, outcome, agent; creation time, or edit distance for pairs."""
    intent = (
        F.coalesce(F.col("detected_intent").cast("int"), F.lit(-1))
        if "detected_intent" in df.columns
        else F.lit(-1)
    )
    if pairs:
        distance = (
            F.coalesce(F.col("edit_distance").cast("double"), F.lit(0.0))
            if "edit_distance" in df.columns
            else F.lit(0.0)
        )
        extra = distance.alias("edit_distance")
    else:
        created = (
            F.coalesce(timestamp_text(F.col("created_at")), F.lit("N/A"))
            if "created_at" in df.columns
            else F.lit("N/A")
        )
        extra = created.alias("created_at")
    return F.struct(
        _text_or_sentinel(df, "job_id").alias("job_id"),
        intent.alias("detected_intent"),
        _text_or_sentinel(df, "sender_action").alias("sender_action"),
        extra,
        _text_or_sentinel(df, "sender_id").alias("sender_id"),
    )


def _sequence(df: DataFrame) -> list[Column]:
    """Orders rows with one key: the one synchronised, then created last is the newest."""
    times = [c for c in ("synced_at", "created_at") if c in df.columns]
    return [F.struct(*times).alias("sequence")] if times else []


def _is_sent() -> Column:
    return text_or_empty("final_message_sent") != ""


def _is_pair() -> Column:
    """Edited or ignored suggestions with the text sent instead; skipped ones are no pairs."""
    return F.col("sender_action").isin(*PAIR_ACTIONS) & _is_sent()


def _key(prefix: str) -> Column:
    return F.concat(F.lit(prefix), F.col("id").cast("string"))


def _text_collection(df: DataFrame, name: str, text: str) -> DataFrame:
    return df.select(
        _key(KEY_PREFIX[name]).alias("id"),
        F.col(text).alias("document"),
        F.col(text).alias("embed_text"),
        _metadata(df).alias("metadata"),
        *_sequence(df),
    )


def customer_messages(df: DataFrame) -> DataFrame:
    return _text_collection(df, "customer_messages", "message_input")


def suggested_responses(df: DataFrame) -> DataFrame:
    return _text_collection(df, "suggested_responses", "message_output")


def final_responses(df: DataFrame) -> DataFrame:
    return _text_collection(df.filter(_is_sent()), "final_responses", "final_message_sent")


def rejected_pairs(df: DataFrame) -> DataFrame:
    """Rejected suggestions as one labelled document each."""
    lines = [F.concat(F.lit(label), text_or_empty(PAIR_TEXTS[f])) for f, label in LABELS.items()]
    return df.filter(_is_pair()).select(
        _key(KEY_PREFIX["rejected_pairs"]).alias("id"),
        F.concat_ws("\n", *lines).alias("document"),
        F.concat_ws(" ", text_or_empty("message_output"), text_or_empty("final_message_sent")).alias(
            "embed_text"
        ),
        _metadata(df, pairs=True).alias("metadata"),
        *(text_or_empty(column).alias(field) for field, column in PAIR_TEXTS.items()),
        *_sequence(df),
    )


def stored_pair_items(pairs: DataFrame) -> DataFrame:
    """The rejected pairs as columns, from the stored collection and without loss.

    A pair document read back with :func:`parse_pairs` loses everything after a line
    break inside a message; the annotation step therefore uses the text columns that are
    stored beside it.
    """
    return pairs.select(
        "id",
        *PAIR_TEXTS,
        F.col("metadata.detected_intent").alias("detected_intent"),
        F.col("metadata.sender_action").alias("action"),
        F.coalesce(F.col("metadata.edit_distance"), F.lit(0.0)).alias("edit_distance"),
    )


def project_collections(df: DataFrame) -> dict[str, DataFrame]:
    """The collections a frame has the text columns for, not yet embedded."""
    parts = {}
    if "message_input" in df.columns:
        parts["customer_messages"] = customer_messages(df)
    if "message_output" in df.columns:
        parts["suggested_responses"] = suggested_responses(df)
    if "final_message_sent" in df.columns:
        parts["final_responses"] = final_responses(df)
        parts["rejected_pairs"] = rejected_pairs(df)
    return parts


def build_collections(df: DataFrame, encoder: Encoder | None = None) -> dict[str, DataFrame]:
    """The collections with an ``embedding`` per row, ready to be stored.

    All collections share one table of distinct texts.
    """
    parts = project_collections(df)
    vectors = text_vectors(embedded_texts(parts), "embed_text", encoder)
    return {
        name: with_vectors(part, "embed_text", vectors).select(
            "id", "embedding", "document", "metadata", *(c for c in EXTRAS if c in part.columns)
        )
        for name, part in parts.items()
    }


def embedded_texts(parts: dict[str, DataFrame]) -> DataFrame:
    """``collection, id, embed_text`` of all collections."""
    texts = [part.select(F.lit(name).alias("collection"), "id", "embed_text") for name, part in parts.items()]
    united = texts[0]
    for part in texts[1:]:
        united = united.unionByName(part)
    return united


def upsert(
    existing: DataFrame, incoming: DataFrame, order: Column | None = None, dealt_by: str | None = None
) -> DataFrame:
    """Rows of ``incoming`` replace rows of ``existing`` with the same id.

    Of several incoming rows with one id the highest ``order`` wins, by default the
    ``sequence`` if there is one; the document settles ties. Both sides move once, by id or by
    ``dealt_by``, a column that follows from the id. Rows without an id replace none.
    """
    if order is None:
        # Without a rank of its own the document decides, which moves anyway.
        order = F.col("sequence") if "sequence" in incoming.columns else F.lit(0)
    ranked = incoming.withColumn("_rank", order)
    kind = ranked.schema["_rank"].dataType
    rows = existing.select("*", F.lit(None).cast(kind).alias("_rank"), F.lit(False).alias("_new")).unionByName(
        ranked.select(*existing.columns, "_rank", F.lit(True).alias("_new"))
    )
    keys = [dealt_by, "id"] if dealt_by else ["id"]
    dealt = rows.repartition(dealt_by) if dealt_by else rows
    # Incoming rows come first.
    latest = Window.partitionBy(*keys).orderBy(
        F.col("_new").desc(), F.col("_rank").desc_nulls_last(), F.col("document").desc()
    )
    replaced = F.max("_new").over(latest.rowsBetween(Window.unboundedPreceding, 0))
    marked = dealt.withColumns({"_place": F.row_number().over(latest), "_replaced": replaced})
    kept = F.when(F.col("_new"), F.col("_place") == 1).otherwise(~F.col("_replaced") | F.col("id").isNull())
    return marked.filter(kept).select(*existing.columns)


def collection_counts(parts: dict[str, DataFrame]) -> DataFrame:
    """Rows per collection; an empty collection counts zero."""
    counts = [
        part.agg(F.count("*").alias("entries")).select(F.lit(name).alias("collection"), "entries")
        for name, part in parts.items()
    ]
    stacked = counts[0]
    for count in counts[1:]:
        stacked = stacked.unionByName(count)
    return stacked


def projected_counts(df: DataFrame) -> DataFrame:
    """The rows each collection will get from ``df``, counted in one pass over it."""
    members = {
        "customer_messages": F.lit(True),
        "suggested_responses": F.lit(True),
        "final_responses": _is_sent(),
        "rejected_pairs": _is_pair(),
    }
    counts = df.agg(*(F.count_if(condition).alias(name) for name, condition in members.items()))
    return counts.unpivot([], list(members), "collection", "entries")


def fetch_pairs(pairs: DataFrame, limit: int = FETCH_LIMIT) -> DataFrame:
    """The first ``limit`` stored pairs by id that have a document and metadata.

    ``pairs`` is a stored collection: the cut-off is found without reading texts into rows,
    and then only files' parts with smaller ids are read in full.
    """
    usable = pairs.select("id", "document", "metadata").dropna(subset=["document", "metadata"])
    return smallest_n(usable, "id", limit, keys=usable.select("id"))


def parse_pairs(pairs: DataFrame) -> DataFrame:
    """Stored pair documents back to columns, line by line.

    The last line with a label wins, a missing label gives ``N/A`` and lines without
    a label are ignored.
    """
    lines = F.split("document", "\n")
    return pairs.select(
        "id",
        *(labelled_line(lines, label).alias(field) for field, label in LABELS.items()),
        F.col("metadata.detected_intent").alias("detected_intent"),
        F.col("metadata.sender_action").alias("action"),
        F.coalesce(F.col("metadata.edit_distance"), F.lit(0.0)).alias("edit_distance"),
    )
