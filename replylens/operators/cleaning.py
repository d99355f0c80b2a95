"""Typing the log, outcome flags, text lengths and the not-accepted subsets."""

from __future__ import annotations

import logging

from pyspark.sql import Column, DataFrame, functions as F, types as T

from replylens.functions.columns import text_or_empty
from replylens.schema import ACTION_FLAGS, TEXT_COLUMNS, TIME_COLUMNS

log = logging.getLogger(__name__)


def clean_texts(df: DataFrame) -> DataFrame:
    """Null texts become empty strings; outcomes are trimmed and upper-cased."""
    fixed = {c: text_or_empty(c) for c in TEXT_COLUMNS if c in df.columns}
    if "sender_action" in df.columns:
        fixed["sender_action"] = F.upper(F.trim(text_or_empty("sender_action")))
    return df.withColumns(fixed)


def coerce_times(df: DataFrame) -> DataFrame:
    """Text timestamps are parsed, unreadable ones become null.

    Columns that are timestamps already stay untouched, which keeps range filters
    on them pushable to the scan.
    """
    typed = (T.TimestampType, T.TimestampNTZType)
    text_times = [
        c for c in TIME_COLUMNS if c in df.columns and not isinstance(df.schema[c].dataType, typed)
    ]
    return df.withColumns(
        {c: F.col(c).cast("string").try_cast("timestamp_ntz") for c in text_times}
    )


def add_action_flags(df: DataFrame) -> DataFrame:
    """One boolean per outcome, and ``needs_analysis`` for the three unused ones."""
    flags = {flag: F.col("sender_action") == action for action, flag in ACTION_FLAGS.items()}
    unused = F.col("sender_action").isin("EDITED", "IGNORED", "SKIPPED")
    return df.withColumns({**flags, "needs_analysis": unused})


def with_action_flags(df: DataFrame) -> DataFrame:
    """Flags from an outcome in any spelling, for logs that were not cleaned here."""
    tidy = F.upper(F.trim(text_or_empty("sender_action")))
    return add_action_flags(df.withColumn("sender_action", tidy))


def ensure_flags(df: DataFrame) -> DataFrame:
    """Flag columns that are absent are added as FALSE."""
    absent = [flag for flag in ACTION_FLAGS.values() if flag not in df.columns]
    for flag in absent:
        log.warning("flag column %s is absent; using FALSE", flag)
    return df.withColumns({flag: F.lit(False) for flag in absent})


def add_edit_distance(df: DataFrame) -> DataFrame:
    """Length difference in percent of the suggestion, for edited rows with both texts."""
    suggested, final = F.length("message_output"), F.length("final_message_sent")
    comparable = F.col("suggestion_edited") & (suggested > 0) & (final > 0)
    change = F.abs(suggested - final) / F.greatest(suggested, F.lit(1)) * 100
    return df.withColumn("edit_distance", F.when(comparable, change).otherwise(F.lit(0.0)))


def clean_messages(df: DataFrame) -> DataFrame:
    """Raw log -> typed log with outcome flags and edit distance."""
    cleaned = add_action_flags(coerce_times(clean_texts(df)))
    if {"message_output", "final_message_sent"} <= set(cleaned.columns):
        cleaned = add_edit_distance(cleaned)
    return cleaned


def _present(df: DataFrame, name: str) -> Column:
    """Text is not empty; a column that does not exist restricts nothing."""
    return F.col(name) != "" if name in df.columns else F.lit(True)


def analysis_set(df: DataFrame) -> DataFrame:
    """Rows with input and suggestion whose suggestion was not accepted.

    Unknown outcomes count as not accepted.
    """
    df = ensure_flags(clean_texts(df))
    return df.filter(
        _present(df, "message_input")
        & _present(df, "message_output")
        & ~F.col("suggestion_accepted")
    )


def comparison_set(df: DataFrame) -> DataFrame:
    """The analysis set restricted to rows with a sent text, plus text lengths."""
    kept = analysis_set(df)
    kept = kept.filter(_present(kept, "final_message_sent"))
    lengths = {
        "message_input": "message_length",
        "message_output": "suggestion_length",
        "final_message_sent": "final_length",
    }
    return kept.withColumns(
        {name: F.length(c) for c, name in lengths.items() if c in kept.columns}
    )


def coerce_for_collections(df: DataFrame) -> DataFrame:
    """Sentinels for a re-read comparison set: ``N/A``, intent -1, distance 0.0."""
    sentinels = [*TEXT_COLUMNS, "sender_action", "sender_id", "job_id"]
    fixed = {
        c: F.coalesce(F.col(c).cast("string"), F.lit("N/A")) for c in sentinels if c in df.columns
    }
    if "detected_intent" in df.columns:
        number = F.col("detected_intent").cast("string").try_cast("double")
        fixed["detected_intent"] = F.coalesce(number.try_cast("int"), F.lit(-1))
    if "edit_distance" in df.columns:
        number = F.col("edit_distance").cast("string").try_cast("double")
        fixed["edit_distance"] = F.coalesce(number, F.lit(0.0))
    return coerce_times(df.withColumns(fixed))


def date_range(df: DataFrame, spec: str | None, end_inclusive_day: bool = False) -> DataFrame:
    """Keep ``start:end`` of ``created_at``; a malformed range keeps everything.

    Both ends are inclusive instants, so a plain end date means its midnight.
    ``end_inclusive_day`` takes the whole last day instead.
    """
    if not spec:
        return df
    parts = [p.strip() for p in spec.split(":")]
    bounds = None
    if len(parts) == 2:
        probe = df.sparkSession.range(1).select(
            *(F.lit(p).try_cast("timestamp_ntz") for p in parts)
        )
        bounds = probe.first()
    if bounds is None or None in tuple(bounds):
        log.warning("date range %r is malformed; using all rows", spec)
        return df
    start, end = (F.lit(str(b)).cast("timestamp_ntz") for b in bounds)
    created = F.col("created_at")
    if end_inclusive_day:
        return df.filter((created >= start) & (created < end + F.expr("INTERVAL 1 DAY")))
    return df.filter((created >= start) & (created <= end))


def is_low_volume(df: DataFrame, threshold: int = 100) -> bool:
    """Whether fewer than ``threshold`` rows are left; stops reading once they are found."""
    low = df.limit(threshold).count() < threshold
    if low:
        log.warning("fewer than %d rows in the selected range", threshold)
    return low
