"""The five steps as plain functions, and a runner that a spark-submit job calls."""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import DataFrame, SparkSession, functions as F

from replylens.functions.ordering import smallest_n
from replylens.operators import annotation, cleaning, collections, insights, profiling, timestats, topics
from replylens.operators.embedding import Encoder, project_2d, text_vectors, with_vectors
from replylens.session import cut_lineage
from replylens.sources import messages as sources, writers

STEPS = ["preprocess", "embed", "analyze", "insights", "time"]
ALL = -1


def preprocess(
    spark: SparkSession,
    input_path: str,
    output: str,
    sample_size: int = ALL,
    format: str = "csv",
    multi_line: bool = True,
) -> DataFrame:
    """Clean the log, store all of it, profile it and store the two subsets.

    With a ``sample_size`` profile and subsets are those of a sample; the stored log, which
    the time step reads, is whole in any case.
    """
    cleaned = sources.load_messages(spark, input_path, format, multi_line)
    writers.write_table(cleaned, f"{output}/messages")
    stored = spark.read.parquet(f"{output}/messages")
    if sample_size > 0:
        writers.write_table(profiling.sample_messages(stored, sample_size), f"{output}/sample")
        stored = spark.read.parquet(f"{output}/sample")
    writers.write_profile(profiling.profile(stored), f"{output}/dataset_stats")
    writers.write_table(cleaning.analysis_set(stored), f"{output}/analysis_dataset")
    writers.write_table(cleaning.comparison_set(stored), f"{output}/comparison_dataset")
    return stored


def embed_step(spark: SparkSession, output: str, encoder: Encoder | None = None) -> DataFrame:
    """Upsert the comparison set into the four collections; returns their row counts."""
    comparison = sources.read_stored(spark, f"{output}/comparison_dataset")
    if comparison is None:
        raise FileNotFoundError("the embed step needs the comparison set of the preprocess step")
    ready = cleaning.coerce_for_collections(comparison)
    parts = collections.build_collections(ready, encoder)
    for name, part in parts.items():
        writers.upsert_collection(part, f"{output}/collections/{name}")
    return collections.collection_counts(
        {name: writers.read_collection(spark, f"{output}/collections/{name}") for name in parts}
    )


def analyze(
    spark: SparkSession,
    output: str,
    call: Callable[[str], str],
    limit: int = ALL,
    backoff_seconds: float = 1.0,
    parallel_calls: int | None = None,
    instructions: str = annotation.INSTRUCTIONS,
) -> DataFrame:
    """Annotate stored pairs and store them; unreadable replies go to a table of their own.

    All pairs with their whole texts, or the first ``limit`` by id. Replies are written before
    they are used, so the annotator is not called again for every reader.
    """
    pairs = writers.read_collection(spark, f"{output}/collections/rejected_pairs")
    if pairs is None:
        raise FileNotFoundError("the analyze step needs the collections of the embed step")
    if limit > 0:
        pairs = smallest_n(pairs, "id", limit)
    items = collections.stored_pair_items(pairs)
    writers.write_table(annotation.annotation_batches(items), f"{output}/annotation/batches")
    batched = spark.read.parquet(f"{output}/annotation/batches")
    prompts = annotation.annotation_prompts(batched, instructions)
    replies = annotation.run_annotator(
        prompts, call, backoff_seconds=backoff_seconds, parallel_calls=parallel_calls
    )
    writers.write_table(replies, f"{output}/annotation/replies")
    classified = annotation.classify_replies(spark.read.parquet(f"{output}/annotation/replies"))
    writers.write_table(classified, f"{output}/annotation/classified")
    classified = spark.read.parquet(f"{output}/annotation/classified")
    writers.write_table(annotation.quarantine_replies(classified), f"{output}/annotation/quarantine")
    annotated = annotation.attach_annotations(batched, classified)
    writers.write_table(annotated, f"{output}/rejection_analysis")
    return spark.read.parquet(f"{output}/rejection_analysis")


def insights_step(
    spark: SparkSession,
    output: str,
    documents: DataFrame | None = None,
    encoder: Encoder | None = None,
    call: Callable[[str], str] | None = None,
    backoff_seconds: float = 1.0,
) -> dict[str, DataFrame]:
    """Cluster the annotated reasons and store their summaries and the insight prompt.

    ``documents`` are insight replies (id, document) obtained elsewhere; without them
    ``call``, if given, answers the prompt. They are stored, flattened, and quarantined
    where they cannot be read.
    """
    annotated = sources.load_analysis(spark, f"{output}/rejection_analysis")
    if annotated is None:
        raise FileNotFoundError("the insights step needs the rows of the analyze step")
    clustering = topics.cluster_reasons(annotated)
    writers.write_table(clustering.rows, f"{output}/clustered")
    rows = spark.read.parquet(f"{output}/clustered")
    tables = {
        "cluster_counts": topics.cluster_counts(rows),
        "category_distribution": topics.category_distribution(rows),
        "category_by_cluster": topics.category_by_cluster(rows),
        "cluster_examples": topics.cluster_examples(rows),
    }
    if clustering.terms is not None:
        tables["cluster_terms"] = clustering.terms
        tables["cluster_centres"] = clustering.centres
        tables["cluster_summary"] = topics.cluster_summary(rows, clustering.terms)
        filled = rows.withColumn(
            "_reason", F.coalesce("rejection_reason", F.lit(topics.NO_REASON))
        )
        vectors = with_vectors(filled, "_reason", text_vectors(filled, "_reason", encoder))
        plane = project_2d(vectors.drop("_reason"), "embedding").drop("embedding")
        writers.write_table(plane, f"{output}/insights/reasons_2d")
    tables["prompt"] = insights.insight_prompt(
        tables["cluster_counts"], clustering.terms, tables["cluster_examples"], tables["category_distribution"]
    )
    for name, part in tables.items():
        writers.write_table(part, f"{output}/insights/{name}", single_file=True)
    if documents is None and call is not None:
        asked = spark.read.parquet(f"{output}/insights/prompt").select(F.lit(0).alias("batch"), "prompt")
        replies = annotation.run_annotator(asked, call, backoff_seconds=backoff_seconds)
        documents = cut_lineage(
            replies.select(F.col("batch").alias("id"), F.col("reply").alias("document")), "insight_replies"
        )
    if documents is not None:
        writers.write_table(
            insights.parse_insights(documents).select("id", "insights"),
            f"{output}/insights/system_insights",
            format="json",
        )
        writers.write_table(
            insights.quarantine_insights(documents), f"{output}/insights/quarantine"
        )
        tables["report"] = insights.flatten_insights(documents)
        writers.write_table(tables["report"], f"{output}/insights/report")
    return tables


def statistics_tables(measures: DataFrame) -> dict[str, DataFrame]:
    """All statistics tables over a rollup (or per-message measures)."""
    agents = timestats.agent_stats(measures)
    return {
        "daily_stats": timestats.daily_stats(measures),
        "weekday_stats": timestats.weekday_stats(measures),
        "hourly_stats": timestats.hourly_stats(measures),
        "daypart_stats": timestats.daypart_stats(measures),
        "agent_stats": agents,
        "top_agents": timestats.top_agents(measures),
        "intent_daily": timestats.intent_daily(measures),
        "intent_trend": timestats.intent_trend(measures),
        "weekday_volumes_long": timestats.action_volumes_long(
            timestats.weekday_stats(measures), "day_of_week"
        ),
        "agent_volumes_long": timestats.action_volumes_long(agents, "sender_id"),
        "weekly_stats": timestats.weekly_stats(measures),
        "time_summary": timestats.time_summary(measures),
        "agent_summary": timestats.agent_summary(agents),
    }


def time_step(
    spark: SparkSession,
    output: str,
    date_range: str | None = None,
    end_inclusive_day: bool = False,
    in_memory: DataFrame | None = None,
    raw_path: str | None = None,
    format: str = "csv",
    multi_line: bool = True,
) -> dict[str, DataFrame]:
    """Statistics tables of the (optionally date-filtered) log, as CSV.

    The log is read once into a stored rollup; the tables are sums over that.
    """
    log = sources.resolve_time_input(spark, in_memory, f"{output}/messages", raw_path, format, multi_line)
    selected = cleaning.date_range(log, date_range, end_inclusive_day)
    if date_range:
        cleaning.is_low_volume(selected)
    writers.write_table(timestats.rollup(selected), f"{output}/time/rollup")
    tables = statistics_tables(spark.read.parquet(f"{output}/time/rollup"))
    for name, part in tables.items():
        writers.write_table(part, f"{output}/time/{name}", format="csv")
    return tables


def run(
    spark: SparkSession,
    input_path: str,
    output: str,
    call: Callable[[str], str] | None = None,
    steps: Iterable[str] = STEPS,
    sample_size: int = ALL,
    date_range: str | None = None,
    encoder: Encoder | None = None,
    format: str = "csv",
    multi_line: bool = True,
    documents: DataFrame | None = None,
    end_inclusive_day: bool = False,
    pair_limit: int = ALL,
    parallel_calls: int | None = None,
    backoff_seconds: float = 1.0,
    instructions: str = annotation.INSTRUCTIONS,
    insight_call: Callable[[str], str] | None = None,
) -> None:
    """Run the chosen steps in order; each reads what the steps before it stored."""
    chosen = set(steps)
    unknown = chosen - set(STEPS)
    if unknown:
        raise ValueError(f"unknown steps: {', '.join(sorted(unknown))}")
    if "preprocess" in chosen:
        preprocess(spark, input_path, output, sample_size, format, multi_line)
    if "embed" in chosen:
        embed_step(spark, output, encoder)
    if "analyze" in chosen:
        if call is None:
            raise ValueError("the analyze step needs an annotator")
        analyze(spark, output, call, pair_limit, backoff_seconds, parallel_calls, instructions)
    if "insights" in chosen:
        insights_step(spark, output, documents, encoder, insight_call, backoff_seconds)
    if "time" in chosen:
        time_step(
            spark, output, date_range, end_inclusive_day,
            raw_path=input_path, format=format, multi_line=multi_line,
        )
