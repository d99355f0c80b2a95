import datetime as dt

import numpy as np
import pytest
from pyspark.sql import functions as F

from replylens.operators import cleaning, collections, embedding
from replylens.sources import writers


@pytest.fixture
def cleaned(log):
    created = dt.datetime(2024, 1, 2, 3, 4, 5)
    return cleaning.clean_messages(
        log(
            {"sender_action": "EDITED", "created_at": created},
            {"sender_action": "IGNORED", "created_at": created.replace(microsecond=120), "job_id": None},
            {"sender_action": "SKIPPED", "detected_intent": None, "sender_id": None},
            {"sender_action": "EDITED", "final_message_sent": None},
        )
    )


def test_keys_filters_and_metadata(cleaned):
    parts = collections.project_collections(cleaned)
    ids = {name: sorted(r["id"] for r in part.collect()) for name, part in parts.items()}
    assert ids == {
        "customer_messages": ["0", "1", "2", "3"],
        "suggested_responses": ["sugg_0", "sugg_1", "sugg_2", "sugg_3"],
        "final_responses": ["final_0", "final_1", "final_2"],
        "rejected_pairs": ["pair_0", "pair_1"],
    }
    meta = {r["id"]: r["metadata"].asDict() for r in parts["customer_messages"].collect()}
    assert meta["0"]["created_at"] == "2024-01-02 03:04:05"
    assert meta["1"]["created_at"] == "2024-01-02 03:04:05.000120"
    assert meta["1"]["job_id"] == "N/A"
    assert (meta["2"]["created_at"], meta["2"]["detected_intent"], meta["2"]["sender_id"]) == ("N/A", -1, "N/A")
    counts = {r["collection"]: r["entries"] for r in collections.collection_counts(parts).collect()}
    assert counts == {name: len(keys) for name, keys in ids.items()}
    projected = {r["collection"]: r["entries"] for r in collections.projected_counts(cleaned).collect()}
    assert projected == counts


def test_pair_document_and_embedded_text(cleaned):
    row = collections.rejected_pairs(cleaned).filter("id = 'pair_0'").first()
    assert row["document"] == "CUSTOMER: hola\nSUGGESTION: buenos días\nFINAL: buenas"
    assert row["embed_text"] == "buenos días buenas"
    assert row["metadata"]["edit_distance"] == pytest.approx(5 / 11 * 100)


def test_missing_columns_read_na(cleaned):
    row = collections.customer_messages(cleaned.select("id", "message_input")).first()
    assert row["metadata"].asDict() == {
        "job_id": "N/A", "detected_intent": -1, "sender_action": "N/A", "created_at": "N/A", "sender_id": "N/A",
    }


def pair_table(spark, *documents):
    rows = [(f"pair_{i}", d, (1, "EDITED", 2.0)) for i, d in enumerate(documents)]
    return spark.createDataFrame(
        rows,
        "id string, document string,"
        "metadata struct<detected_intent:int,sender_action:string,edit_distance:double>",
    )


def test_parser_is_line_based(spark):
    parsed = collections.parse_pairs(
        pair_table(
            spark,
            "CUSTOMER: uno\ndos\nSUGGESTION: tres\nFINAL: cuatro",
            "CUSTOMER: a\nCUSTOMER: CUSTOMER: b\nFINAL: ",
        )
    )
    first, second = parsed.orderBy("id").collect()
    assert (first["customer_message"], first["suggested_response"], first["final_response"]) == ("uno", "tres", "cuatro")
    assert (second["customer_message"], second["suggested_response"], second["final_response"]) == ("CUSTOMER: b", "N/A", "")


def test_fetch_skips_incomplete_rows_and_limits(spark):
    pairs = pair_table(spark, "a", None, "c", "d")
    assert [r["id"] for r in collections.fetch_pairs(pairs, 2).collect()] == ["pair_0", "pair_2"]


def test_columns_of_a_pair_keep_line_breaks(log):
    cleaned = cleaning.clean_messages(log({"sender_action": "EDITED", "message_input": "uno\ndos"}))
    pairs = collections.rejected_pairs(cleaned)
    assert collections.stored_pair_items(pairs).first()["customer_message"] == "uno\ndos"


def docs(spark, **texts):
    return spark.createDataFrame(list(texts.items()), "id string, document string")


def test_upsert_is_idempotent_and_new_wins(spark):
    old, new = docs(spark, a="1", b="2"), docs(spark, b="3", c="4")
    once = collections.upsert(old, new)
    twice = collections.upsert(once, new)
    for result in (once, twice):
        assert {r["id"]: r["document"] for r in result.collect()} == {"a": "1", "b": "3", "c": "4"}
        assert result.count() == 3


def test_upsert_takes_the_latest_of_duplicates(spark):
    new = spark.createDataFrame([("a", "x", 1), ("a", "y", 3), ("a", "z", 2)], "id string, document string, n int")
    assert collections.upsert(docs(spark, a="0"), new, F.col("n")).collect()[0]["document"] == "y"


def test_loads_on_disk(spark, tmp_path):
    root = str(tmp_path / "collection")
    assert writers.read_collection(spark, root) is None
    writers.upsert_collection(docs(spark, a="1"), root)
    writers.upsert_collection(docs(spark, a="2", b="3"), root)
    stored = writers.read_collection(spark, root)
    assert stored.columns == ["id", "document"]
    assert {r["id"]: r["document"] for r in stored.collect()} == {"a": "2", "b": "3"}
    writers.upsert_collection(docs(spark, a="2").limit(0), root)
    assert writers.read_collection(spark, root).count() == 2


def test_the_later_row_of_a_load_wins(spark, log, tmp_path):
    times = ["2024-01-01", "2024-01-03", "2024-01-02"]
    rows = log(
        *({"id": 7, "sender_action": "EDITED", "message_input": text} for text in ("zzz-old", "aaa-new", "mmm"))
    )
    cleaned = cleaning.clean_messages(rows.withColumn("synced_at", F.expr(
        "CASE message_input " + " ".join(f"WHEN '{m}' THEN timestamp_ntz'{t}'" for m, t in zip(("zzz-old", "aaa-new", "mmm"), times)) + " END"
    )))
    root = str(tmp_path / "c")
    writers.upsert_collection(collections.build_collections(cleaned)["customer_messages"], root)
    assert [r["document"] for r in writers.read_collection(spark, root).collect()] == ["aaa-new"]


def test_a_failed_load_changes_nothing(spark, tmp_path):
    root = str(tmp_path / "collection")
    writers.upsert_collection(docs(spark, a="1", b="1"), root)
    broken = docs(spark, a="2").withColumn("document", F.raise_error(F.lit("stop")))
    with pytest.raises(Exception, match="stop"):
        writers.upsert_collection(broken, root)
    assert {r["id"]: r["document"] for r in writers.read_collection(spark, root).collect()} == {"a": "1", "b": "1"}


def test_only_touched_buckets_are_written(spark, tmp_path):
    root = tmp_path / "collection"
    writers.upsert_collection(docs(spark, **{f"k{i}": "0" for i in range(300)}), str(root))
    files = lambda: {f for f in root.glob("bucket=*/*.parquet")}
    before = files()
    for n in range(1, 4):
        writers.upsert_collection(docs(spark, k1=str(n)), str(root))
    assert len(before - files()) == 1 and len(files()) == len(before)
    rows = {r["id"]: r["document"] for r in writers.read_collection(spark, str(root)).collect()}
    assert len(rows) == 300 and rows["k1"] == "3" and rows["k2"] == "0"


def test_texts_are_embedded_once(spark):
    """Vectors by way of distinct texts are those of each row."""
    texts = ["Hola hola mundo", "", None, "hola", "hola"] * 20
    df = spark.createDataFrame(list(enumerate(texts)), "id int, text string")
    seen = spark.sparkContext.accumulator(0)

    def encoder(batch):
        seen.add(len(batch))
        return [[1.0, float(len(t))] for t in batch]

    vectors = embedding.text_vectors(df, "text", encoder)
    found = {r["id"]: r["embedding"] for r in embedding.with_vectors(df, "text", vectors).collect()}
    direct = {r["id"]: r["embedding"] for r in embedding.embed(df, "text", encoder=lambda b: [[1.0, float(len(t))] for t in b]).collect()}
    assert found == direct and vectors.count() == seen.value == 3


def test_default_vectors_are_unit_length_counts(spark):
    df = docs(spark, a="Hola hola mundo", b="", c=None, d="hola HOLA mundo")
    rows = {r["id"]: np.array(r["embedding"]) for r in embedding.embed(df, "document").collect()}
    assert all(len(v) == embedding.DIMENSIONS for v in rows.values())
    assert np.linalg.norm(rows["a"]) == pytest.approx(1, abs=1e-6)
    assert sorted(rows["a"][rows["a"] > 0]) == pytest.approx([1 / 5**0.5, 2 / 5**0.5])
    assert not rows["b"].any() and not rows["c"].any()
    assert np.array_equal(rows["a"], rows["d"])


def test_own_encoder(spark):
    def encoder(texts):
        return [[3.0 * len(t), 4.0 * len(t)] for t in texts]

    rows = embedding.embed(docs(spark, a="xy", b=None), "document", encoder=encoder).collect()
    assert {r["id"]: r["embedding"] for r in rows} == {
        "a": pytest.approx([0.6, 0.8]),
        "b": [0.0, 0.0],
    }


def test_built_collections_have_the_stored_columns(cleaned):
    parts = collections.build_collections(cleaned)
    assert set(parts) == set(collections.COLLECTIONS)
    for part in parts.values():
        assert part.columns[:4] == ["id", "embedding", "document", "metadata"]
    assert parts["rejected_pairs"].columns[4:] == collections.EXTRAS


def test_projection_matches_numpy(spark):
    rng = np.random.default_rng(7)
    data = rng.normal(size=(200, 6)) * [9, 5, 1, 1, 1, 1] + 3
    df = spark.createDataFrame([(i, row.tolist()) for i, row in enumerate(data)], "id int, v array<double>")
    rows = sorted(embedding.project_2d(df, "v").collect(), key=lambda r: r["id"])
    found = np.array([[r["x_pca"], r["y_pca"]] for r in rows])
    centred = data - data.mean(axis=0)
    expected = centred @ np.linalg.svd(centred, full_matrices=False)[2][:2].T
    assert np.abs(found) == pytest.approx(np.abs(expected), abs=1e-8)
    assert found.mean(axis=0) == pytest.approx([0, 0], abs=1e-9)
