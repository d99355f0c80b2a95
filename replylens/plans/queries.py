"""Every operator as a named query over the driver tables."""

from __future__ import annotations

import dataclasses
import json
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from replylens.operators import (
    annotation,
    cleaning,
    collections,
    embedding,
    insights,
    profiling,
    timestats,
    topics,
)
from replylens.functions.columns import stable_hash
from replylens.functions.ordering import per_group_sample
from replylens.schema import ACTION_FLAGS
from replylens.plans import pipeline
from replylens.session import cut_lineage, new_folder
from replylens.sources import driver_tables as tables, messages as sources, writers
from replylens.sources.messages import repair_analysis

DATE_RANGE = "2024-01-10:2024-01-20"
FETCH_LIMIT = 200

Query = Callable[[SparkSession, str], DataFrame]


def _measures(spark: SparkSession, sf_dir: str) -> DataFrame:
    return timestats.to_measures(tables.actions(spark, sf_dir))


# Sources and cleaning


def scan_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tables.raw_messages(spark, sf_dir)


def csv_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tables.csv_log(spark, sf_dir)


def clean_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tables.messages(spark, sf_dir)


def action_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    flags = [*ACTION_FLAGS.values(), "needs_analysis"]
    return tables.actions(spark, sf_dir).select("id", "sender_action", *flags)


def edit_distance(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tables.messages(spark, sf_dir).select("id", "sender_action", "edit_distance")


def analysis_set(spark: SparkSession, sf_dir: str) -> DataFrame:
    flags = [*ACTION_FLAGS.values(), "needs_analysis"]
    return cleaning.analysis_set(tables.messages(spark, sf_dir)).select(
        "id", "detected_intent", "sender_action", *flags, "edit_distance"
    )


def comparison_set(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tables.comparison(spark, sf_dir).select(
        "id", "sender_action", "edit_distance", "message_length", "suggestion_length", "final_length"
    )


def coerce_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cleaning.coerce_for_collections(tables.reread_log(spark, sf_dir))


def preview_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profiling.preview_rejects(
        tables.messages(spark, sf_dir), keys=tables.actions(spark, sf_dir)
    )


def date_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    selected = cleaning.date_range(tables.actions(spark, sf_dir), DATE_RANGE)
    return selected.select("id", "created_at", "sender_action", "sender_id")


# Profile


def dataset_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    stats = profiling.dataset_stats(tables.messages(spark, sf_dir))
    return stats.select(
        *(
            F.round(f.name, 6).alias(f.name) if f.dataType.typeName() == "double" else f.name
            for f in stats.schema
        )
    )


def intent_distribution(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profiling.intent_distribution(tables.actions(spark, sf_dir))


def action_breakdown(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profiling.action_breakdown(tables.raw_actions(spark, sf_dir))


def presence_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profiling.presence_counts(tables.raw_messages(spark, sf_dir))


def sample_by_action(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profiling.sample_by_action(tables.messages(spark, sf_dir))


def sample_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profiling.sample_messages(tables.actions(spark, sf_dir)).select(
        "id", "job_id", "detected_intent", "sender_action", "sender_id", "created_at"
    )


def _sample_by_user(spark: SparkSession, sf_dir: str, n: int) -> DataFrame:
    """A log whose key repeats: events by user, sampled for each kind of event."""
    events = tables.table(spark, sf_dir, "events").select("event_type", "user_id", "event_id")
    picked = per_group_sample(events, "event_type", "user_id", stable_hash("user_id"), n)
    return picked.select("event_type", "pick", "user_id")


def sample_by_user(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _sample_by_user(spark, sf_dir, 5)


def sample_by_user_large(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _sample_by_user(spark, sf_dir, 2000)


# Time statistics


def time_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    return timestats.time_features(tables.actions(spark, sf_dir)).select(
        "id", "date", "day_of_week", "hour_of_day", "week_of_year", "month", "month_name", "day_part"
    )


def daily_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    stats = timestats.daily_stats(_measures(spark, sf_dir))
    return stats.withColumns(
        {c: F.round(c, 6) for c in ("rejection_rate", "acceptance_ma7")}
    )


def weekday_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return timestats.weekday_stats(_measures(spark, sf_dir))


def hourly_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return timestats.hourly_stats(_measures(spark, sf_dir))


def daypart_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return timestats.daypart_stats(_measures(spark, sf_dir))


def agent_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return timestats.agent_stats(_measures(spark, sf_dir))


def top_agents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return timestats.top_agents(_measures(spark, sf_dir))


def intent_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    return timestats.intent_daily(_measures(spark, sf_dir))


def intent_trend_top5(spark: SparkSession, sf_dir: str) -> DataFrame:
    return timestats.intent_trend(_measures(spark, sf_dir))


def weekly_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return timestats.weekly_stats(_measures(spark, sf_dir))


def action_volumes_long(spark: SparkSession, sf_dir: str) -> DataFrame:
    return timestats.action_volumes_long(timestats.daily_stats(_measures(spark, sf_dir)), "date")


def weekday_volumes_long(spark: SparkSession, sf_dir: str) -> DataFrame:
    return timestats.action_volumes_long(timestats.weekday_stats(_measures(spark, sf_dir)), "day_of_week")


def agent_volumes_long(spark: SparkSession, sf_dir: str) -> DataFrame:
    return timestats.action_volumes_long(timestats.agent_stats(_measures(spark, sf_dir)), "sender_id")


def time_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    summary = timestats.time_summary(_measures(spark, sf_dir))
    return summary.withColumn("overall_acceptance", F.round("overall_acceptance", 6))


def agent_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return timestats.agent_summary(timestats.agent_stats(_measures(spark, sf_dir)))


# Collections


def _flat(part: DataFrame) -> DataFrame:
    return part.select("id", "document", "metadata.*")


def collection_customer(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _flat(collections.customer_messages(tables.comparison(spark, sf_dir)))


def collection_suggested(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _flat(collections.suggested_responses(tables.comparison(spark, sf_dir)))


def collection_final(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _flat(collections.final_responses(tables.comparison(spark, sf_dir)))


def collection_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    pairs = collections.rejected_pairs(tables.comparison(spark, sf_dir))
    return pairs.select("id", "document", "embed_text", "metadata.*")


def collection_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collections.projected_counts(tables.comparison(spark, sf_dir))


def upsert_collection(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Final responses replace the customer text of their message or come in as new keys."""
    existing, incoming = _loads(cut_lineage(tables.comparison(spark, sf_dir), "comparison"))
    return collections.upsert(existing, incoming, order=F.col("sequence"))


def stored_collection(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same two loads through the sink, read back from the stored collection."""
    existing, incoming = _loads(cut_lineage(tables.comparison(spark, sf_dir), "comparison"))
    root = new_folder(spark, "collection")
    writers.upsert_collection(existing, root)
    writers.upsert_collection(incoming, root, order=F.col("sequence"))
    return writers.read_collection(spark, root)


def _loads(comparison: DataFrame) -> tuple[DataFrame, DataFrame]:
    """A collection's first load, and one that replaces and adds rows."""
    existing = collections.customer_messages(comparison).select("id", "document")
    first = comparison.select(
        F.col("id").cast("string").alias("id"), F.col("message_output").alias("document")
    ).withColumn("sequence", F.lit(1))
    edited = comparison.filter("suggestion_edited")
    second = edited.select(
        F.col("id").cast("string").alias("id"), F.col("final_message_sent").alias("document")
    ).withColumn("sequence", F.lit(2))
    new = (
        collections.final_responses(edited)
        .select("id", "document")
        .withColumn("sequence", F.lit(1))
    )
    return existing, first.filter("document LIKE '%the%'").unionByName(second).unionByName(new)


def fetch_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """From the collection as it is stored."""
    pairs = collections.rejected_pairs(tables.comparison(spark, sf_dir))
    stored = cut_lineage(pairs.select("id", "document", "metadata"), "pairs")
    return _flat(collections.fetch_pairs(stored, FETCH_LIMIT))


def parse_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collections.parse_pairs(collections.rejected_pairs(tables.comparison(spark, sf_dir)))


def embed_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The entries, other than zero, of the vectors of all four collections."""
    parts = collections.project_collections(cut_lineage(tables.comparison(spark, sf_dir), "comparison"))
    texts = collections.embedded_texts(parts)
    entries = F.transform(
        "embedding", lambda v, i: F.struct(i.alias("place"), F.round(v.cast("double"), 5).alias("value"))
    )
    kept = F.filter(entries, lambda e: e["value"] != 0)
    # Two plain arrays take less room than one of structs where they are moved.
    vectors = embedding.text_vectors(texts, "embed_text").select("digest", kept.alias("kept")).select(
        "digest", F.col("kept.place").alias("place"), F.col("kept.value").alias("value")
    )
    named = texts.select("collection", "id", embedding.text_digest("embed_text").alias("digest"))
    return named.join(vectors, "digest").select("collection", "id", F.inline(F.arrays_zip("place", "value")))


# Annotation


def _batched(spark: SparkSession, sf_dir: str) -> DataFrame:
    # Joined once more for the cuts between blocks: a stored copy of all texts takes more disk.
    return annotation.annotation_batches(tables.pairs(spark, sf_dir), part="part")


def _classified(spark: SparkSession, sf_dir: str) -> DataFrame:
    return annotation.classify_replies(tables.scripted_replies(_batched(spark, sf_dir)))


def annotation_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _batched(spark, sf_dir).select("id", "batch", "j", "detected_intent", "action")


def annotation_prompts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return annotation.annotation_prompts(_batched(spark, sf_dir))


def classify_replies(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _classified(spark, sf_dir).select("batch", "status")


def parse_replies(spark: SparkSession, sf_dir: str) -> DataFrame:
    return annotation.parse_replies(_classified(spark, sf_dir))


def quarantine_replies(spark: SparkSession, sf_dir: str) -> DataFrame:
    return annotation.quarantine_replies(_classified(spark, sf_dir))


def attach_annotations(spark: SparkSession, sf_dir: str) -> DataFrame:
    batched = _batched(spark, sf_dir)
    classified = annotation.classify_replies(tables.scripted_replies(batched))
    return annotation.attach_annotations(batched, classified).select(
        "id",
        "batch",
        "j",
        "action",
        "rejection_reason",
        "improvement_areas",
        "intent_accuracy",
        "rejection_category",
    )


def run_annotator(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The annotator hook with a stand-in that answers every item and fails on some lengths."""

    def measure(prompt: str) -> str:
        if len(prompt) % 7 == 1:
            raise TimeoutError
        items = range(annotation.BATCH_SIZE)
        return json.dumps([{"id": j, "rejection_reason": f"{len(prompt)}:{j}"} for j in items])

    annotated = annotation.annotate_pairs(tables.pairs(spark, sf_dir), measure, backoff_seconds=0)
    return annotated.select("id", "batch", "j", "rejection_reason", "rejection_category")


# Reasons, clusters and insights


def _analysis(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repair_analysis(tables.stored_analysis(spark, sf_dir))


def load_analysis(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _analysis(spark, sf_dir).select(
        "id", "rejection_reason", "rejection_category", "cluster"
    )


def tfidf_vocab(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topics.vocabulary(_analysis(spark, sf_dir))


def _vectors(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, topics.TermSpace]:
    counted = topics.count_terms(_analysis(spark, sf_dir).select("id", "cluster", "rejection_reason"))
    space = topics.fit_terms(counted)
    return topics.tfidf_vectors(counted, space), space


def tfidf_weights(spark: SparkSession, sf_dir: str) -> DataFrame:
    weights = topics.tfidf_weights(*_vectors(spark, sf_dir))
    return weights.withColumn("weight", F.round("weight", 6))


def cluster_terms(spark: SparkSession, sf_dir: str) -> DataFrame:
    terms = topics.cluster_terms(*_vectors(spark, sf_dir))
    return terms.withColumn("weight", F.round("weight", 6))


def cluster_reasons(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whether each row is in the cluster whose centre is nearest to it."""
    counted, space, clustering = _clustered(spark, sf_dir)
    vectors = topics.tfidf_vectors(counted, space).select("id", "features").join(
        clustering.rows.select("id", "cluster"), "id"
    )
    weights = topics.tfidf_weights(vectors, space).join(vectors.select("id", "cluster"), "id")
    centres = clustering.centres
    length = centres.groupBy(F.col("cluster").alias("near")).agg(F.sum(F.col("weight") ** 2).alias("length"))
    # At most clusters x terms rows. A squared distance without the row's own length.
    products = weights.withColumnRenamed("weight", "w").join(F.broadcast(centres.withColumnRenamed("cluster", "near")), "term")
    near = products.groupBy("id", "cluster", "near").agg(F.sum(F.col("w") * F.col("weight")).alias("product"))
    # Rows without any term are as far from each centre as it is long.
    every = vectors.select("id", "cluster").join(F.broadcast(length)).join(near, ["id", "cluster", "near"], "left")
    distance = F.col("length") - 2 * F.coalesce("product", F.lit(0.0))
    own = F.max(F.when(F.col("near") == F.col("cluster"), distance))
    return every.groupBy("id").agg((own <= F.min(distance) + 1e-9).alias("at_nearest"))


def cluster_centres(spark: SparkSession, sf_dir: str) -> DataFrame:
    """For each term, the clusters whose centre has the mean of its rows' weights."""
    counted, space, clustering = _clustered(spark, sf_dir)
    labelled = clustering.rows.select("id", "cluster")
    weights = topics.tfidf_weights(topics.tfidf_vectors(counted, space).select("id", "features"), space)
    sums = weights.join(labelled, "id").groupBy("cluster", "term").agg(F.sum("weight").alias("total"))
    means = clustering.centres.join(sums, ["cluster", "term"], "left").join(
        labelled.groupBy("cluster").agg(F.count("*").alias("rows")), "cluster", "left"
    )
    off = F.abs(F.col("weight") - F.coalesce("total", F.lit(0.0)) / F.col("rows"))
    return means.groupBy("term").agg(
        F.count("*").alias("centres"), F.count_if(off < 1e-6).alias("means")
    )


def _clustered(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, topics.TermSpace, topics.Clustering]:
    """Counted reasons, their terms, and the clustering with its rows stored."""
    counted = topics.count_terms(_analysis(spark, sf_dir).select("id", "rejection_reason"))
    clustering = topics.cluster_reasons(counted)
    rows = cut_lineage(clustering.rows.select("id", "cluster"), "clustered")
    space = clustering.space or topics.fit_terms(counted)
    return counted, space, dataclasses.replace(clustering, rows=rows)


def cluster_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = topics.cluster_counts(_analysis(spark, sf_dir))
    return counts.withColumn("percentage", F.round("percentage", 6))


def category_distribution(spark: SparkSession, sf_dir: str) -> DataFrame:
    distribution = topics.category_distribution(_analysis(spark, sf_dir))
    return distribution.withColumn("percentage", F.round("percentage", 6))


def category_by_cluster(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topics.category_by_cluster(_analysis(spark, sf_dir))


def cluster_examples(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topics.cluster_examples(_analysis(spark, sf_dir))


def cluster_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = cut_lineage(_analysis(spark, sf_dir), "analysis")
    counted = topics.count_terms(rows.select("cluster", "rejection_reason"))
    space = topics.fit_terms(counted)
    vectors = topics.tfidf_vectors(counted, space)
    summary = topics.cluster_summary(rows, topics.cluster_terms(vectors, space))
    return summary.select(
        "cluster",
        "examples",
        F.round("percentage", 6).alias("percentage"),
        "key_terms",
        F.array_join(F.col("example_ids").cast("array<string>"), ", ").alias("example_ids"),
        F.array_join("example_reasons", "\n", null_replacement=topics.NO_REASON).alias(
            "example_reasons"
        ),
    )


def insight_prompt(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = cut_lineage(_analysis(spark, sf_dir), "analysis")
    counted = topics.count_terms(rows.select("cluster", "rejection_reason"))
    space = topics.fit_terms(counted)
    vectors = topics.tfidf_vectors(counted, space)
    return insights.insight_prompt(
        topics.cluster_counts(rows),
        topics.cluster_terms(vectors, space),
        topics.cluster_examples(rows),
        topics.category_distribution(rows),
    )


def pca_2d(spark: SparkSession, sf_dir: str) -> DataFrame:
    plane = embedding.project_2d(tables.table(spark, sf_dir, "embeddings"), "embedding")
    # Adding zero turns a negative zero into a plain one.
    return plane.select(
        "vec_id", "label", *((F.round(c, 4) + F.lit(0.0)).alias(c) for c in ("x_pca", "y_pca"))
    )


def flatten_insights(spark: SparkSession, sf_dir: str) -> DataFrame:
    return insights.flatten_insights(tables.insight_documents(spark, sf_dir))


def quarantine_insights(spark: SparkSession, sf_dir: str) -> DataFrame:
    return insights.quarantine_insights(tables.insight_documents(spark, sf_dir))


# Stored outputs, read back, and the whole run


def csv_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The raw log as CSV files, line breaks in quotes included, through the library's reader."""
    return sources.scan_messages_csv(spark, _csv_log(spark, sf_dir))


def _csv_log(spark: SparkSession, sf_dir: str) -> str:
    path = new_folder(spark, "log")
    writers.write_table(tables.raw_messages(spark, sf_dir), path, format="csv", compression="gzip")
    return path


def stored_sets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The two subsets of the log as the preprocess step stores them."""
    rows, found = tables.messages(spark, sf_dir), []
    # The second set is a subset of the first one and is taken from it as it is stored.
    for name, part in (("analysis", cleaning.analysis_set), ("comparison", cleaning.comparison_set)):
        path = new_folder(spark, name)
        writers.write_table(part(rows), path)
        rows = sources.read_stored(spark, path)
        found.append(rows.select(F.lit(name).alias("dataset"), "id", "sender_action", "edit_distance"))
    return found[0].unionByName(found[1])


def stored_annotations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Annotated pairs as CSV, read back."""
    annotated = attach_annotations(spark, sf_dir)
    path = new_folder(spark, "annotated")
    writers.write_table(annotated, path, format="csv", compression="gzip")
    # Texts may have line breaks.
    return spark.read.options(header=True, multiLine=True, escape='"').schema(annotated.schema).csv(path)


def stored_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The parts of the profile as JSON lines, read back: totals, outcomes and intents."""
    path = new_folder(spark, "profile")
    writers.write_profile(profiling.profile(cut_lineage(tables.messages(spark, sf_dir), "messages")), path)
    parts = {
        "stats": (F.lit("total_messages"), "total_messages"),
        "action_breakdown": (F.col("sender_action"), "messages"),
        "intent_distribution": (F.col("detected_intent").cast("string"), "messages"),
    }
    found = [
        spark.read.json(f"{path}/{part}").select(F.lit(part).alias("part"), key.alias("item"), F.col(n).alias("value"))
        for part, (key, n) in parts.items()
    ]
    return found[0].unionByName(found[1]).unionByName(found[2])


def stored_statistics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The statistics tables as CSV, read back: rows and sums of each."""
    rollup = cut_lineage(timestats.rollup(tables.actions(spark, sf_dir)), "rollup")
    kept = ["daily_stats", "weekday_stats", "hourly_stats", "daypart_stats", "agent_stats", "weekly_stats"]
    root = new_folder(spark, "time")
    found = None
    for name, part in pipeline.statistics_tables(rollup).items():
        if name not in kept:
            continue
        writers.write_table(part, f"{root}/{name}", format="csv")
        back = spark.read.option("header", True).csv(f"{root}/{name}").select(
            *(F.col(c).cast("long") for c in ("total_messages", "accepted", "edited")), F.col("acceptance_rate").cast("double")
        )
        row = back.agg(
            F.lit(name).alias("name"),
            F.count("*").alias("rows"),
            F.sum("total_messages").alias("messages"),
            F.sum("accepted").alias("accepted"),
            F.sum("edited").alias("edited"),
            F.round(F.sum("acceptance_rate"), 4).alias("rates"),
        )
        found = row if found is None else found.unionByName(row)
    return found


def stored_insights(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parsed insights as JSON lines, read back: each one's summary and number of findings."""
    parsed = insights.parse_insights(tables.insight_documents(spark, sf_dir)).select("id", "insights")
    path = new_folder(spark, "insights")
    writers.write_table(parsed, path, format="json")
    back = spark.read.schema(parsed.schema).json(path).filter("insights IS NOT NULL")
    return back.select(
        "id",
        F.col("insights.resumen_ejecutivo").alias("summary"),
        F.coalesce(F.size("insights.hallazgos_clave"), F.lit(0)).alias("findings"),
    )


def whole_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All five steps over the log as CSV files; what each of them stored, counted."""

    def answer(prompt: str) -> str:
        items = range(annotation.BATCH_SIZE)
        reasons = [f"la respuesta {'larga' if j % 2 else 'corta'} no dice el precio {len(prompt) % 7}" for j in items]
        return json.dumps(
            [{"id": j, "rejection_reason": r, "rejection_category": "tono"} for j, r in enumerate(reasons)]
        )

    out = new_folder(spark, "run")
    pipeline.run(spark, _csv_log(spark, sf_dir), out, call=answer, date_range=DATE_RANGE, backoff_seconds=0)
    folders = [
        "messages", "analysis_dataset", "comparison_dataset", "annotation/batches", "annotation/quarantine",
        "rejection_analysis", "clustered", "insights/reasons_2d",
    ]
    stored = {name: spark.read.parquet(f"{out}/{name}") for name in folders}
    stored |= {name: writers.read_collection(spark, f"{out}/collections/{name}") for name in collections.COLLECTIONS}
    counts = collections.collection_counts(stored).withColumnRenamed("collection", "item")
    centres = spark.read.parquet(f"{out}/insights/cluster_centres")
    days = spark.read.option("header", True).csv(f"{out}/time/daily_stats")
    return (
        counts.unionByName(days.agg(F.lit("messages in range").alias("item"), F.sum(F.col("total_messages").cast("long")).alias("entries")))
        .unionByName(centres.agg(F.lit("clusters").alias("item"), F.count_distinct("cluster").alias("entries")))
    )


REGISTERED: list[Query] = [
    scan_messages,
    csv_messages,
    csv_files,
    stored_sets,
    stored_annotations,
    stored_profile,
    stored_statistics,
    stored_insights,
    whole_run,
    clean_messages,
    action_flags,
    edit_distance,
    analysis_set,
    comparison_set,
    coerce_columns,
    preview_rejects,
    date_range,
    dataset_stats,
    intent_distribution,
    action_breakdown,
    presence_counts,
    sample_by_action,
    sample_messages,
    sample_by_user,
    sample_by_user_large,
    time_features,
    daily_stats,
    weekday_stats,
    hourly_stats,
    daypart_stats,
    agent_stats,
    top_agents,
    intent_daily,
    intent_trend_top5,
    weekly_stats,
    action_volumes_long,
    weekday_volumes_long,
    agent_volumes_long,
    time_summary,
    agent_summary,
    collection_customer,
    collection_suggested,
    collection_final,
    collection_pairs,
    collection_counts,
    upsert_collection,
    stored_collection,
    fetch_pairs,
    parse_pairs,
    embed_texts,
    annotation_batches,
    annotation_prompts,
    classify_replies,
    parse_replies,
    quarantine_replies,
    attach_annotations,
    run_annotator,
    load_analysis,
    tfidf_vocab,
    tfidf_weights,
    cluster_terms,
    cluster_reasons,
    cluster_centres,
    cluster_counts,
    category_distribution,
    category_by_cluster,
    cluster_examples,
    cluster_summary,
    insight_prompt,
    pca_2d,
    flatten_insights,
    quarantine_insights,
]


def queries() -> dict[str, Query]:
    return {query.__name__: query for query in REGISTERED}
