"""Reading the raw log, stored datasets and annotated rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.utils import AnalysisException

from replylens.operators.cleaning import clean_messages, with_action_flags
from replylens.schema import (
    ACTION_FLAGS,
    MESSAGE_SCHEMA,
    TEXT_COLUMNS,
    TIME_COLUMNS,
    TIME_STEP_COLUMNS,
    require_columns,
)

UNKNOWN_CATEGORY = "desconocido"

# Fields that mean "missing" in a CSV log (the usual markers of data-frame
# libraries).
MISSING_MARKERS = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
]


CSV_OPTIONS = {"quote": '"', "escape": '"', "nullValue": "", "encoding": "UTF-8"}


def scan_messages_csv(
    spark: SparkSession,
    path: str,
    multi_line: bool = True,
    missing: list[str] = MISSING_MARKERS,
) -> DataFrame:
    """The raw log from CSV with a fixed schema; columns are matched by header name.

    Quoted line breaks need ``multi_line``, which makes each file one task: a large
    log should come as many files, or without line breaks and ``multi_line=False``.
    Timestamps are read as text and coerced per value, so one bad value does not void
    the row. Fields holding one of the ``missing`` markers are null, but for the texts of
    messages: there a marker is what somebody wrote.
    """
    return convert_text(_read_csv(spark, path, multi_line), missing)


def convert_text(raw: DataFrame, missing: list[str] = MISSING_MARKERS) -> DataFrame:
    """Columns that are all text, as a flat file gives them, with the types of the log."""
    typed_only = [
        F.col(c) if c in TEXT_COLUMNS else F.when(~F.col(c).isin(missing), F.col(c)).alias(c)
        for c in raw.columns
    ]
    return _typed(raw.select(*typed_only))


def _read_csv(spark: SparkSession, path: str, multi_line: bool) -> DataFrame:
    # Without inference every column is text; the header decides which is which.
    return spark.read.options(header=True, multiLine=multi_line, **CSV_OPTIONS).csv(path)


def _typed(raw: DataFrame) -> DataFrame:
    typed = {}
    for field in MESSAGE_SCHEMA:
        if field.name not in raw.columns:
            continue
        column = F.col(field.name)
        kind = field.dataType.simpleString()
        if kind in ("int", "bigint"):
            # Integers that went through a nullable float column read "3.0".
            typed[field.name] = F.coalesce(
                column.try_cast(kind), column.try_cast("double").try_cast(kind)
            )
        elif field.name in TIME_COLUMNS:
            typed[field.name] = column.try_cast("timestamp_ntz")
    return raw.withColumns(typed)


def load_messages(
    spark: SparkSession, path: str, format: str = "csv", multi_line: bool = True
) -> DataFrame:
    """The cleaned log from CSV, Parquet or any other format Spark reads."""
    if format == "csv":
        raw = scan_messages_csv(spark, path, multi_line)
    else:
        raw = spark.read.format(format).load(path)
    return clean_messages(raw)


def read_stored(spark: SparkSession, path: str) -> DataFrame | None:
    """A dataset written by an earlier step, or None when there is none."""
    try:
        return spark.read.parquet(path)
    except AnalysisException as error:
        if error.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return None
        raise


def repair_analysis(df: DataFrame) -> DataFrame:
    """Null categories become ``desconocido``; clusters that are no number become null."""
    fixed = {}
    if "rejection_category" in df.columns:
        fixed["rejection_category"] = F.coalesce("rejection_category", F.lit(UNKNOWN_CATEGORY))
    if "cluster" in df.columns:
        number = F.col("cluster").cast("string").try_cast("double")
        fixed["cluster"] = number.try_cast("int")
    return df.withColumns(fixed)


def load_analysis(spark: SparkSession, path: str) -> DataFrame | None:
    """Stored annotated rows, repaired; None when nothing is stored."""
    stored = read_stored(spark, path)
    return None if stored is None else repair_analysis(stored)


def resolve_time_input(
    spark: SparkSession,
    in_memory: DataFrame | None = None,
    cleaned_path: str | None = None,
    raw_path: str | None = None,
    format: str = "csv",
    multi_line: bool = True,
) -> DataFrame:
    """Input of the time step: a frame at hand, the stored cleaned log, or the raw log.

    Always the full log: the not-accepted subset would make every rate zero. Flags of the
    outcome are derived where the frame has only the outcome.
    """
    df = in_memory
    if df is None and cleaned_path is not None:
        df = read_stored(spark, cleaned_path)
    if df is None and raw_path is not None:
        df = load_messages(spark, raw_path, format, multi_line)
    if df is None:
        raise FileNotFoundError("no cleaned log and no raw log to analyse")
    if "sender_action" in df.columns and not set(ACTION_FLAGS.values()) <= set(df.columns):
        df = with_action_flags(df)
    return require_columns(df, TIME_STEP_COLUMNS)
