"""What is written: no second copies of texts, and no shuffles of writes that have ended."""

from __future__ import annotations

import os
import re
import time

import pytest
from pyspark.sql import functions as F

from replylens import session
from replylens.operators import collections, topics
from replylens.plans import queries
from replylens.schema import MESSAGE_SCHEMA
from replylens.sources import driver_tables, writers


@pytest.fixture
def tables(spark, tmp_path):
    """Twelve documents and forty events, all of them edited or ignored."""
    documents = [(i, f"texto the {i} " + "palabra " * i) for i in range(12)]
    spark.createDataFrame(documents, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    events = spark.range(40).select(
        F.col("id").alias("event_id"),
        F.lit("2024-01-01").cast("timestamp").alias("ts"),
        F.lit(7).cast("long").alias("user_id"),
        F.when(F.col("id") % 4 == 0, "error").otherwise("click").alias("event_type"),
        F.lit(2.0).alias("value"),
        F.concat(F.lit('{"k": '), (F.col("id") + 20).cast("string"), F.lit("}")).alias("props"),
    )
    events.write.parquet(f"{tmp_path}/events.parquet")
    return str(tmp_path)


def shuffle_files(spark) -> set[str]:
    files = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    names = (files.apply(i).getName() for i in range(files.size()))
    return {name for name in names if name.startswith("shuffle_")}


def test_shuffles_of_a_write_go_when_it_ends(spark, tmp_path):
    before = shuffle_files(spark)
    rows = spark.range(100).withColumn("document", F.lit("a")).repartition(3, "id")
    writers.write_table(rows, f"{tmp_path}/table")
    session.cut_lineage(rows)
    writers.upsert_collection(rows.withColumn("id", F.col("id").cast("string")), f"{tmp_path}/kept")
    # Spark removes the files in the background.
    until = time.time() + 20
    while shuffle_files(spark) - before and time.time() < until:
        time.sleep(0.2)
    assert not shuffle_files(spark) - before


def test_settings_are_as_before_after_a_write(spark, tmp_path):
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name, None)
    with pytest.raises(ValueError), session.shuffles_end(spark):
        assert spark.conf.get(name) == "true"
        raise ValueError
    assert spark.conf.get(name, None) == before


def copies(monkeypatch, module) -> list[tuple[str, list[str]]]:
    """Names and columns of the tables that ``module`` stores on its way."""
    made, stored = [], session.cut_lineage
    monkeypatch.setattr(module, "cut_lineage", lambda df, name="table": made.append((name, df.columns)) or stored(df, name))
    return made


def test_sets_and_prompts_without_a_copy_of_the_log(spark, tables, monkeypatch):
    made = copies(monkeypatch, queries)
    sets = queries.stored_sets(spark, tables).groupBy("dataset").count().collect()
    assert {r["dataset"]: r["count"] for r in sets} == {"analysis": 40, "comparison": 40}
    assert queries.annotation_prompts(spark, tables).agg(F.sum("examples")).first()[0] == 40
    assert queries.attach_annotations(spark, tables).count() == 40
    assert made == []


def test_comparison_of_the_stored_set_is_that_of_the_log(spark, log, tables, monkeypatch):
    rows = log(
        {"sender_action": " edited"}, {"sender_action": "ACCEPTED"}, {"sender_action": "ignored ", "final_message_sent": None},
        {"sender_action": None}, {"sender_action": "SKIPPED", "message_output": " "}, {"message_input": "", "sender_action": "EDITED"},
    )
    monkeypatch.setattr(driver_tables, "raw_messages", lambda *_: rows.select(*MESSAGE_SCHEMA.fieldNames()))
    found = queries.stored_sets(spark, tables).collect()
    assert sorted((r["dataset"], r["id"]) for r in found) == [
        ("analysis", 0), ("analysis", 2), ("analysis", 3), ("analysis", 4), ("comparison", 0), ("comparison", 3), ("comparison", 4),
    ]


def test_loads_are_not_stored_before_they_are_merged(spark, tmp_path, monkeypatch):
    folders = []
    monkeypatch.setattr(session, "new_folder", lambda *a: folders.append(a) or f"{tmp_path}/copy{len(folders)}")
    old = spark.createDataFrame([("1", "a"), ("2", "b"), (None, "c")], "id string, document string")
    writers.upsert_collection(old, f"{tmp_path}/kept")
    writers.upsert_collection(old.filter("id = '2'").withColumn("document", F.lit("x")), f"{tmp_path}/kept")
    found = {tuple(r) for r in writers.read_collection(spark, f"{tmp_path}/kept").select("id", "document").collect()}
    assert found == {("1", "a"), ("2", "x"), (None, "c")} and not folders


def test_a_load_that_changes_while_it_is_merged_replaces_nothing(spark, tmp_path):
    ids = spark.range(300).select(F.col("id").cast("string").alias("id"), F.lit("0").alias("document"))
    writers.upsert_collection(ids, f"{tmp_path}/kept")

    @F.udf("boolean")
    def later(n):
        # One row in the first reading, which is for ids alone, and all of them in the second one.
        return n == 7 or os.path.exists(f"{tmp_path}/read")

    changed = spark.range(300).filter(later.asNondeterministic()("id"))
    load = changed.select(F.col("id").cast("string").alias("id"), F.lit("1").alias("document"))
    upsert = writers.upsert

    def merge(*args, **kwargs):
        open(f"{tmp_path}/read", "w").close()
        return upsert(*args, **kwargs)

    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(writers, "upsert", merge)
        with pytest.raises(Exception, match="changed while it was merged"):
            writers.upsert_collection(load, f"{tmp_path}/kept")
    kept = writers.read_collection(spark, f"{tmp_path}/kept")
    assert kept.count() == 300 and kept.filter("document = '1'").count() == 0


def test_documents_move_once_without_a_rank(spark):
    rows = spark.createDataFrame([("1", "a"), ("1", "c"), ("1", "b")], "id string, document string")
    merged = collections.upsert(rows.limit(0), rows)
    assert [tuple(r) for r in merged.collect()] == [("1", "c")]
    plan = merged._jdf.queryExecution().optimizedPlan().toString()
    assert not re.search(r"document#\d+ AS _rank", plan)


def test_clustering_stores_words_alone(spark, monkeypatch):
    made = copies(monkeypatch, topics)
    rows = [(i, f"precio alto {'lento' if i % 2 else 'rápido'} {'tono malo' if i % 2 else 'falta dato'}", "largo " * 9) for i in range(20)]
    reasons = spark.createDataFrame(rows, "id long, rejection_reason string, customer_message string")
    clustering = topics.cluster_reasons(reasons, k=2, restarts=2)
    assert sorted(clustering.rows.columns) == ["cluster", "customer_message", "id", "rejection_reason"]
    assert clustering.rows.count() == 20 and clustering.rows.select("cluster").distinct().count() == 2
    assert made and all("customer_message" not in columns and "id" not in columns for _, columns in made)
