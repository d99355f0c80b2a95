"""The driver's TPC-H-like tables seen as a message log, replies and insights.

The tables hold no support log, so one is derived from them: each event is a message,
and its texts are whole documents. Every event and every document is used, and the log
grows with the tables.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from replylens.operators.annotation import batch_keys
from replylens.operators.cleaning import clean_messages, comparison_set
from replylens.operators.collections import rejected_pairs, stored_pair_items
from replylens.sources.messages import CSV_OPTIONS, convert_text


def _number() -> Column:
    """The number in an event's properties, from which gaps and intents follow."""
    return F.get_json_object("props", "$.k").cast("int")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def documents_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents dealt out by their id, which is also what most queries join them on.

    A file with a single row group is read by one task, and all work on its long texts
    would stay there.
    """
    return table(spark, sf_dir, "documents").repartition("doc_id")


def _event_columns(events: DataFrame) -> DataFrame:
    k = F.col("k")
    return events.withColumn("k", _number()).select(
        F.col("event_id").alias("id"),
        F.floor(F.col("event_id") / 8).cast("long").alias("job_id"),
        F.when(k < 90, F.pmod(k, F.lit(17))).cast("int").alias("detected_intent"),
        F.when(F.col("event_type") == "purchase", "accepted")
        .when(F.col("event_type") == "click", "EDITED")
        .when(F.col("event_type") == "error", " Ignored")
        .when(F.col("event_type") == "view", "SKIPPED")
        .alias("sender_action"),
        F.when(F.col("value") >= 1, F.col("user_id")).alias("sender_id"),
        F.col("ts").alias("created_at"),
        F.col("ts").alias("synced_at"),
        F.col("event_type"),
        "k",
    )


def raw_actions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The raw log without its texts, for operators that read none."""
    return _event_columns(table(spark, sf_dir, "events")).drop("event_type", "k")


def actions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The cleaned log without its texts."""
    return clean_messages(raw_actions(spark, sf_dir))


def text_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each document with the document that serves as the reply suggested to it.

    Texts are dealt out by their own id, and replies once more by the id of the document they
    answer. Which document that is comes from a join of the replies with ids alone. The pairs
    are dealt out by ``doc_id``, as their readers need them.
    """
    size = table(spark, sf_dir, "documents").select(F.count("*")).scalar()
    documents = documents_table(spark, sf_dir).select("doc_id", "text")
    answered = (
        table(spark, sf_dir, "documents").select(F.col("doc_id").alias("asked_id")).distinct()
        .withColumn("reply_id", F.pmod(F.col("asked_id") * 7 + 3, size))
    )
    suggested = documents.join(answered, F.col("doc_id") == F.col("reply_id")).select(
        "asked_id", F.col("text").alias("suggested")
    )
    asked = documents.withColumnRenamed("text", "asked")
    return asked.join(suggested, F.col("doc_id") == F.col("asked_id"), "left").drop("asked_id")


def raw_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The raw log: outcomes in mixed case, nulls in texts, intents and agents.

    The two texts of a message are joined to each other first (documents only), so
    the events meet long texts in a single join.
    """
    events = _event_columns(table(spark, sf_dir, "events"))
    size = table(spark, sf_dir, "documents").select(F.count("*")).scalar()
    joined = events.withColumn("doc_id", F.pmod(F.col("id"), size)).join(
        text_pairs(spark, sf_dir), "doc_id", "left"
    )
    k, kind = F.col("k"), F.col("event_type")
    shorter = F.replace(F.col("suggested"), F.lit("e"), F.lit(""))
    longer = F.concat_ws(" ", "suggested", "asked")
    final = (
        F.when(kind == "purchase", F.col("suggested"))
        .when((kind == "click") & (k < 50), shorter)
        .when(kind == "click", longer)
        .when((kind == "error") & (k >= 20), F.replace(F.col("asked"), F.lit("a"), F.lit("")))
    )
    return joined.select(
        "id",
        "job_id",
        "detected_intent",
        F.when(k != 7, F.col("asked")).alias("message_input"),
        F.when(k != 13, F.col("suggested")).alias("message_output"),
        "sender_action",
        final.alias("final_message_sent"),
        "sender_id",
        "created_at",
        "synced_at",
    )


def messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The cleaned log."""
    return clean_messages(raw_messages(spark, sf_dir))


def comparison(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The comparison set of the log, which the collections are built from."""
    return comparison_set(messages(spark, sf_dir))


def pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All rejected pairs as columns, from the collection's rows."""
    return stored_pair_items(rejected_pairs(comparison(spark, sf_dir)))


def csv_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The raw log as lines of CSV, then parsed with the reader's options and conversion."""
    raw = raw_messages(spark, sf_dir)
    texts = [F.col(c).cast("string").alias(c) for c in raw.columns]
    options = {**CSV_OPTIONS, "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"}
    lines = raw.select(F.to_csv(F.struct(*texts), options).alias("line"))
    schema = ", ".join(f"{c} string" for c in raw.columns)
    parsed = lines.select(F.from_csv("line", schema, options).alias("row")).select("row.*")
    return convert_text(parsed)


def reread_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The log as text columns with gaps and junk, as a flat-file round trip leaves it."""
    k = F.col("k")
    events = table(spark, sf_dir, "events").withColumn("k", _number())
    return events.select(
        F.col("event_id").alias("id"),
        F.when(k != 3, F.floor(F.col("event_id") / 8).cast("long")).alias("job_id"),
        F.when(k < 90, F.concat(F.pmod(k, F.lit(17)).cast("string"), F.lit(".0")))
        .otherwise("sin dato")
        .alias("detected_intent"),
        F.when(F.col("event_type") != "signup", F.upper("event_type")).alias("sender_action"),
        F.when(F.col("value") >= 1, F.col("user_id")).alias("sender_id"),
        F.when(k >= 5, F.col("value").cast("string")).otherwise("n/a").alias("edit_distance"),
        F.when(k != 0, F.col("ts").cast("string")).otherwise("ayer").alias("created_at"),
    )


def scripted_replies(batched: DataFrame) -> DataFrame:
    """A model reply per batch, built from the pairs, in all shapes a model gives.

    The shape follows from the batch number: fenced list, bare list, lone object,
    prose, no reply, a repeated id, a left-out id, a cut-off list, a list of numbers.
    """
    item = F.to_json(
        F.struct(
            F.col("j").alias("id"),
            F.col("suggested_response").alias("rejection_reason"),
            F.col("action").alias("improvement_areas"),
            (F.col("detected_intent") >= 0).alias("intent_accuracy"),
            F.when(F.col("action") == "EDITED", "tono").otherwise("inexacto").alias(
                "rejection_category"
            ),
        )
    )
    grouped = batched.groupBy(*batch_keys(batched)).agg(
        F.sort_array(F.collect_list(F.struct("j", item.alias("item")))).alias("entries")
    )
    items = F.transform("entries", lambda e: e["item"])
    others = F.transform(F.filter("entries", lambda e: e["j"] != 1), lambda e: e["item"])

    def listed(values: Column, end: str = "]") -> Column:
        return F.concat(F.lit("["), F.array_join(values, ", "), F.lit(end))

    again = F.lit(
        '{"id": 0, "rejection_reason": "segunda respuesta", "improvement_areas": "ninguna", '
        '"intent_accuracy": false, "rejection_category": "otro"}'
    )
    shapes = [
        F.concat(F.lit("Claro:\n```json\n"), listed(items), F.lit("\n```\nSaludos")),
        listed(items),
        F.try_element_at(items, F.lit(1)),
        F.concat(F.lit("Sin respuesta para el lote "), F.col("batch").cast("string")),
        F.lit(None).cast("string"),
        listed(F.concat(items, F.array(again))),
        listed(others),
        listed(items, end=""),
        F.lit("[1, 2]"),
    ]
    shape = F.pmod("batch", F.lit(len(shapes)))
    reply = F.when(shape == 0, shapes[0])
    for number, text in enumerate(shapes[1:], start=1):
        reply = reply.when(shape == number, text)
    return grouped.select("batch", reply.alias("reply"))


def stored_analysis(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Annotated rows as an earlier run would have stored them, flaws included.

    One row per document: reasons are whole documents (null where labelled toxic),
    categories follow language and quality label (null without a label), clusters are
    text, partly not a number.
    """
    documents = table(spark, sf_dir, "documents").select("doc_id", "lang", "source")
    labels = table(spark, sf_dir, "labels")
    texts = text_pairs(spark, sf_dir)
    source = F.substring("source", 4, 10).cast("int")
    return (
        texts.join(documents, "doc_id")
        .join(labels, "doc_id", "left")
        .select(
            F.col("doc_id").alias("id"),
            F.col("asked").alias("customer_message"),
            F.col("suggested").alias("suggested_response"),
            F.replace(F.col("suggested"), F.lit("e"), F.lit("")).alias("final_response"),
            F.when(F.coalesce("toxic", F.lit(0)) == 0, F.col("asked")).alias("rejection_reason"),
            F.when(F.col("quality").isNull(), F.lit(None))
            .when(F.col("quality") == 0, "otro")
            .when(F.col("lang") == "en", "tono")
            .when(F.col("lang") == "fr", "información_faltante")
            .when(F.col("lang") == "de", "formato")
            .otherwise("inexacto")
            .alias("rejection_category"),
            F.when(source == 19, "sin dato")
            .when(source == 18, "-1")
            .otherwise(F.concat(F.pmod(source, F.lit(5)).cast("string"), F.lit(".0")))
            .alias("cluster"),
        )
    )


def insight_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An insights reply per document, built from its text, in several shapes.

    English: full document, fenced. French: bare, without improvements and steps.
    German: only a recommendation without fields. Spanish: prose.
    """
    documents = documents_table(spark, sf_dir)
    lines = F.split("text", "\n")
    source = F.col("source")
    full = F.struct(
        F.col("text").alias("resumen_ejecutivo"),
        lines.alias("hallazgos_clave"),
        F.array(
            F.struct(
                source.alias("recomendacion"),
                F.lit("Alto").alias("impacto_esperado"),
                F.lit("Bajo").alias("esfuerzo_estimado"),
                F.array(F.lit(0), F.lit(2)).alias("clusters_relacionados"),
            )
        ).alias("recomendaciones_priorizadas"),
        F.create_map(F.lit("0"), lines, F.lit("1"), F.array().cast("array<string>")).alias(
            "mejoras_especificas_por_cluster"
        ),
        F.array(F.col("lang")).alias("sugerencias_sistema_intencion"),
        F.array(source, F.col("lang")).alias("proximos_pasos_sugeridos"),
    )
    short = F.struct(
        F.col("text").alias("resumen_ejecutivo"),
        lines.alias("hallazgos_clave"),
        F.array(F.struct(source.alias("recomendacion"))).alias("recomendaciones_priorizadas"),
    )
    document = (
        F.when(
            F.col("lang") == "en", F.concat(F.lit("```json\n"), F.to_json(full), F.lit("\n```"))
        )
        .when(F.col("lang") == "fr", F.to_json(short))
        .when(F.col("lang") == "de", '{"recomendaciones_priorizadas": [{}]}')
        .otherwise(F.concat(F.lit("Sin JSON: "), F.col("text")))
    )
    return documents.select(F.col("doc_id").alias("id"), document.alias("document"))
