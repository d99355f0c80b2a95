import csv
import json
import os

import pytest
from pyspark.sql import functions as F

from replylens.plans import pipeline
from replylens.schema import ACTION_FLAGS, MissingColumnsError
from replylens.sources import messages as sources, writers

HEADER = [
    "id", "job_id", "detected_intent", "message_input", "message_output", "sender_action",
    "final_message_sent", "sender_id", "created_at", "synced_at",
]


@pytest.fixture
def raw_csv(tmp_path):
    path = tmp_path / "log.csv"
    actions = ["accepted", "EDITED", "Ignored", "skipped", ""]
    with open(path, "w", newline="", encoding="utf-8") as file:
        out = csv.writer(file)
        out.writerow(HEADER)
        for i in range(100):
            out.writerow(
                [
                    i, i // 4, "" if i % 9 == 0 else f"{i % 5}.0",
                    f'pregunta {i}, con "comillas"\ny línea', f"respuesta sugerida {i}", actions[i % 5],
                    "" if i % 5 == 3 else f"respuesta enviada {i} ñ", "" if i % 11 == 0 else i % 6,
                    "ayer" if i == 7 else f"2024-01-{1 + i % 20:02d} {i % 24:02d}:15:00", "2024-02-01",
                ]
            )
    return str(path)


def test_csv_scan(spark, raw_csv):
    rows = {r["id"]: r for r in sources.load_messages(spark, raw_csv).collect()}
    assert len(rows) == 100
    assert rows[1]["message_input"] == 'pregunta 1, con "comillas"\ny línea'
    assert (rows[1]["detected_intent"], rows[9]["detected_intent"]) == (1, None)
    assert rows[7]["created_at"] is None and rows[8]["created_at"].hour == 8
    assert rows[0]["sender_id"] is None
    assert rows[1]["suggestion_edited"] and rows[0]["suggestion_accepted"]
    assert rows[3]["final_message_sent"] == ""


@pytest.fixture
def call():
    def answer(prompt):
        if "pregunta 41," in prompt:
            return "no puedo"
        reasons = [f"falta precio y tono {j}" for j in range(5)]
        return json.dumps(
            [{"id": j, "rejection_reason": r, "rejection_category": "tono"} for j, r in enumerate(reasons)]
        )

    return answer


def test_all_steps(spark, raw_csv, call, tmp_path):
    out = str(tmp_path / "out")
    pipeline.run(spark, raw_csv, out, call=call, sample_size=-1, date_range="2024-01-01:2024-01-31")

    def read(name, format="parquet"):
        return spark.read.option("header", True).format(format).load(f"{out}/{name}")

    assert read("messages").count() == 100
    assert read("dataset_stats/stats", "json").first()["total_messages"] == 100
    assert read("analysis_dataset").count() == 80
    assert read("comparison_dataset").count() == 60
    pairs = writers.read_collection(spark, f"{out}/collections/rejected_pairs")
    assert pairs.count() == 40
    assert read("rejection_analysis").count() == 40
    assert read("annotation/quarantine").count() == 1
    assert read("clustered").filter("cluster >= 0").count() == 40
    assert read("insights/cluster_summary").count() == read("clustered").select("cluster").distinct().count()
    assert {"x_pca", "y_pca"} <= set(read("insights/reasons_2d").columns)
    for name in ("daily_stats", "weekday_stats", "hourly_stats", "daypart_stats", "agent_stats", "weekly_stats"):
        files = [f for f in os.listdir(f"{out}/time/{name}") if f.endswith(".csv")]
        assert len(files) == 1
    daily = read("time/daily_stats", "csv")
    assert sum(int(r["total_messages"]) for r in daily.collect()) == 99

    # A second load of the same data leaves the collections as they are.
    counts = {r["collection"]: r["entries"] for r in pipeline.embed_step(spark, out).collect()}
    assert counts == {
        "customer_messages": 60, "suggested_responses": 60, "final_responses": 60, "rejected_pairs": 40,
    }


def test_missing_markers_read_as_null(spark, tmp_path):
    path = tmp_path / "log.csv"
    path.write_text('id,message_input,sender_action\n1,N/A,None\n2,"nada",null\n3,NA pues,ACCEPTED\n')
    rows = {r["id"]: (r["message_input"], r["sender_action"]) for r in sources.scan_messages_csv(spark, str(path)).collect()}
    assert rows == {1: ("N/A", None), 2: ("nada", None), 3: ("NA pues", "ACCEPTED")}
    kept = sources.scan_messages_csv(spark, str(path), missing=[""]).filter("id = 1").first()
    assert (kept["message_input"], kept["sender_action"]) == ("N/A", "None")


def test_prompts_hold_whole_texts(spark, raw_csv, call, tmp_path):
    out = str(tmp_path / "out")
    pipeline.run(spark, raw_csv, out, call=call, steps=["preprocess", "embed", "analyze"])
    batches = spark.read.parquet(f"{out}/annotation/batches").collect()
    assert len(batches) == 40
    assert all(r["customer_message"] == f'pregunta {r["id"][5:]}, con "comillas"\ny línea' for r in batches)


def test_a_sample_does_not_reach_the_statistics(spark, raw_csv, tmp_path):
    out = str(tmp_path / "out")
    pipeline.run(spark, raw_csv, out, steps=["preprocess", "time"], sample_size=10)
    assert spark.read.parquet(f"{out}/messages").count() == 100
    assert spark.read.parquet(f"{out}/sample").count() == 10
    daily = spark.read.option("header", True).csv(f"{out}/time/daily_stats")
    assert sum(int(r["total_messages"]) for r in daily.collect()) == 99


def test_flags_are_derived_for_the_time_step(spark, raw_csv):
    cleaned = sources.load_messages(spark, raw_csv)
    bare = cleaned.drop(*ACTION_FLAGS.values()).withColumn("sender_action", F.lower("sender_action"))
    ready = sources.resolve_time_input(spark, bare)
    assert ready.filter("suggestion_edited").count() == cleaned.filter("suggestion_edited").count() == 20


def test_the_insight_prompt_is_answered(spark, raw_csv, call, tmp_path):
    out = str(tmp_path / "out")
    pipeline.run(
        spark, raw_csv, out, call=call, steps=["preprocess", "embed", "analyze", "insights"],
        insight_call=lambda prompt: json.dumps({"resumen_ejecutivo": prompt[-12:], "hallazgos_clave": ["h"]}),
    )
    prompt = spark.read.parquet(f"{out}/insights/prompt").first()["prompt"]
    assert "## cluster 0: " in prompt and "[reason] falta precio" in prompt and "- tono: " in prompt
    assert spark.read.parquet(f"{out}/insights/report").count() == 2


def test_steps_need_what_comes_before(spark, call, tmp_path):
    out = str(tmp_path / "out")
    for step in (pipeline.embed_step, lambda s, o: pipeline.analyze(s, o, call), pipeline.insights_step):
        with pytest.raises(FileNotFoundError):
            step(spark, out)
    with pytest.raises(ValueError, match="unknown"):
        pipeline.run(spark, "x", out, steps=["nothing"])
    assert sources.load_analysis(spark, out) is None


def test_time_step_input_order(spark, raw_csv, tmp_path):
    cleaned = sources.load_messages(spark, raw_csv)
    cleaned.limit(10).write.parquet(str(tmp_path / "messages"))
    stored = str(tmp_path / "messages")
    assert sources.resolve_time_input(spark, cleaned.limit(3), stored, raw_csv).count() == 3
    assert sources.resolve_time_input(spark, None, stored, raw_csv).count() == 10
    assert sources.resolve_time_input(spark, None, str(tmp_path / "none"), raw_csv).count() == 100
    with pytest.raises(FileNotFoundError):
        sources.resolve_time_input(spark)
    with pytest.raises(MissingColumnsError):
        sources.resolve_time_input(spark, cleaned.drop("sender_id"))


def test_insight_documents_are_stored(spark, raw_csv, call, tmp_path):
    out = str(tmp_path / "out")
    pipeline.run(spark, raw_csv, out, call=call, steps=["preprocess", "embed", "analyze"])
    documents = spark.createDataFrame(
        [(1, '{"resumen_ejecutivo": "r", "hallazgos_clave": ["h"]}'), (2, "prosa")], "id int, document string"
    )
    tables = pipeline.insights_step(spark, out, documents)
    assert tables["report"].count() == 2
    assert spark.read.parquet(f"{out}/insights/quarantine").first()["document"] == "prosa"
    assert spark.read.json(f"{out}/insights/system_insights").count() == 2


def test_csv_sink_keeps_quotes(spark, tmp_path):
    df = spark.createDataFrame([(1, 'a "b", c')], "id int, text string")
    writers.write_table(df, str(tmp_path / "t"), format="csv", single_file=True)
    with open(next((tmp_path / "t").glob("*.csv")), newline="", encoding="utf-8") as file:
        assert list(csv.reader(file)) == [["id", "text"], ["1", 'a "b", c']]
