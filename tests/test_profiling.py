import hashlib

from pyspark.sql import functions as F

from replylens.functions.columns import stable_hash
from replylens.functions.ordering import dense_position, hashed_sample, per_group_sample, smallest_n, up_to_nth
from replylens.operators import cleaning, profiling


def md5(value, seed=42):
    return hashlib.md5(f"{value}:{seed}".encode()).hexdigest()


def test_stats_of_a_small_log(log):
    cleaned = cleaning.clean_messages(
        log(
            {"detected_intent": 1, "sender_id": 7, "message_input": None},
            {"detected_intent": None, "sender_id": 7, "sender_action": "EDITED"},
            {"detected_intent": 1, "sender_id": None, "sender_action": "SKIPPED"},
            {"detected_intent": 2, "sender_id": 8, "sender_action": None},
        )
    )
    stats = profiling.dataset_stats(cleaned).first()
    assert stats["total_messages"] == 4
    assert (stats["unique_intents"], stats["unique_agents"]) == (2, 2)
    assert (stats["acceptance_rate"], stats["ignore_rate"]) == (25.0, 0.0)
    assert stats["avg_message_length"] == 3.0


def test_stats_without_optional_columns_and_rows(log):
    cleaned = cleaning.clean_messages(log({}))
    bare = profiling.dataset_stats(cleaned.select("id")).first()
    assert (bare["total_messages"], bare["unique_intents"], bare["avg_final_length"]) == (1, 0, 0.0)
    empty = profiling.dataset_stats(cleaned.limit(0)).first()
    assert empty["total_messages"] == 0 and empty["acceptance_rate"] is None


def test_distributions_treat_nulls_differently(log):
    raw = log({"detected_intent": None, "sender_action": None}, {"detected_intent": 3})
    assert [tuple(r) for r in profiling.intent_distribution(raw).collect()] == [(3, 1)]
    assert {tuple(r) for r in profiling.action_breakdown(raw).collect()} == {(None, 1), ("ACCEPTED", 1)}


def test_samples_are_complete_and_seeded(log):
    actions = ["ACCEPTED"] * 20 + ["EDITED"] * 3 + ["OTHER"] * 5
    cleaned = cleaning.clean_messages(log(*({"sender_action": a} for a in actions)))
    picked = profiling.sample_by_action(cleaned).collect()
    accepted = {r["id"] for r in picked if r["sender_action"] == "ACCEPTED"}
    assert accepted == set(sorted(range(20), key=md5)[:5])
    assert {r["id"] for r in picked if r["sender_action"] == "EDITED"} == {20, 21, 22}
    assert len(picked) == 8


def test_samples_of_a_stored_log_sort_few_texts(spark, log, tmp_path):
    """The profile finds the last example on outcomes and ids; the examples are those of the whole log."""
    actions = ["ACCEPTED"] * 20 + ["EDITED"] * 3 + ["OTHER"] * 5 + ["SKIPPED"] * 30 + [None] * 2
    rows = [{"sender_action": a, "message_input": f"texto {i}"} for i, a in enumerate(actions)]
    # Repeated and null ids, with texts alike and not.
    rows += [{"id": i, "sender_action": "SKIPPED", "message_input": t} for i in (7, None) for t in ("a", "b", "b", None)]
    cleaning.clean_messages(log(*rows)).repartition(3, "message_input").write.parquet(f"{tmp_path}/log")
    stored = spark.read.parquet(f"{tmp_path}/log")
    samples = profiling.profile(stored)["samples"]
    plan = samples._jdf.queryExecution().executedPlan().toString().split("\n")
    join = next(i for i, line in enumerate(plan) if "BroadcastHashJoin" in line)
    scans = [i for i, line in enumerate(plan) if "FileScan" in line]
    assert join < scans[0] and not [line for line in plan[join : scans[0]] if "Sort" in line]
    assert ["message_input" in plan[i] for i in scans] == [True, False]
    for n in (0, 1, 5, 100):
        with_keys = profiling.sample_by_action(stored, n, keys=stored).collect()
        assert sorted(map(str, with_keys)) == sorted(map(str, profiling.sample_by_action(stored, n).collect()))
    assert len(with_keys) == 20 + 3 + 30 + 8 and len(samples.collect()) == 5 + 3 + 5


def test_ends_of_null_groups_and_keys(spark):
    rows = [(i, "A" if i % 3 else None) for i in range(40)] + [(None, "A"), (None, None), (3, None), (3, None)]
    df = spark.createDataFrame(rows, "id long, g string").withColumn("text", F.lit("x"))
    kept = up_to_nth(df, df, "g", "id", stable_hash("id"), 4)
    assert kept.columns == df.columns
    best = {g: sorted((i for i, h in rows if h == g), key=lambda i: "" if i is None else md5(i)) for g in ("A", None)}
    expected = [(i, g) for g, ids in best.items() for i in ids if ids.index(i) < 4]
    assert sorted(map(str, kept.select("id", "g").collect())) == sorted(f"Row(id={i}, g={g!r})" for i, g in expected)


def test_sample_has_exact_size(spark):
    df = spark.range(3000).repartition(7)
    sampled = [r["id"] for r in hashed_sample(df, "id", stable_hash("id"), 137).collect()]
    assert sampled == sorted(range(3000), key=md5)[:137]
    assert hashed_sample(df, "id", stable_hash("id"), 5000).count() == 3000
    assert profiling.sample_messages(df, -1).count() == 3000
    assert profiling.sample_messages(df, 10).count() == 10


def test_smallest_n(spark):
    df = spark.range(100).withColumn("text", F.lit("x"))
    assert [r["id"] for r in smallest_n(df, "id", 3).collect()] == [0, 1, 2]
    assert smallest_n(df, "id", 500).count() == 100
    assert smallest_n(df, "id", 0).count() == 0
    assert smallest_n(df.filter("id < 0"), "id", 3).count() == 0


def test_positions_are_dense_and_in_hash_order(spark):
    rows = dense_position(spark.range(2000).repartition(5), "id").collect()
    expected = sorted(range(2000), key=lambda i: (hashlib.md5(str(i).encode()).hexdigest(), i))
    assert [r["id"] for r in sorted(rows, key=lambda r: r["position"])] == expected
    assert sorted(r["position"] for r in rows) == list(range(2000))


def test_hot_group_is_trimmed_before_the_shuffle(spark):
    df = spark.range(900).withColumn("g", F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")))
    wide = per_group_sample(df, "g", "id", stable_hash("id"), 2)
    plan = wide._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan
    hot = {r["id"] for r in wide.filter("g = 'hot'").collect()}
    assert hot == set(sorted(range(0, 900, 3), key=md5)[:2])
    assert wide.count() == 602


def test_repeated_and_null_ids_stay_in_their_group(spark):
    rows = [(1, "A"), (1, "A"), (1, "B"), (2, "B"), (3, "B"), (4, "B"), (None, "C"), (None, "C")]
    df = spark.createDataFrame(rows, "id long, g string")
    found = per_group_sample(df, "g", "id", stable_hash("id"), 2).collect()
    assert sorted(r["g"] for r in found) == ["A", "A", "B", "B", "C", "C"]
    best = sorted([1, 2, 3, 4], key=md5)[:2]
    assert sorted(r["id"] for r in found if r["g"] == "B") == sorted(best)


def test_large_samples_of_a_hot_group(spark):
    df = spark.range(9000).withColumn("g", F.when(F.col("id") < 8000, "hot").otherwise("cold"))
    found = per_group_sample(df, "g", "id", stable_hash("id"), 1500).collect()
    assert {r["id"] for r in found if r["g"] == "hot"} == set(sorted(range(8000), key=md5)[:1500])
    assert len(found) == 2500


def test_preview_is_cut_at_fifty(log):
    cleaned = cleaning.clean_messages(
        log(*({"sender_action": "SKIPPED", "message_input": "ñ" * 80} for _ in range(7)), {})
    )
    rows = profiling.preview_rejects(cleaned).collect()
    assert [r["id"] for r in rows] == [0, 1, 2, 3, 4]
    assert rows[0]["input_preview"] == "ñ" * 50


def test_presence_counts_nulls_only(log):
    row = profiling.presence_counts(log({"message_input": ""}, {"message_input": None})).first()
    assert (row["message_input_present"], row["message_output_present"]) == (1, 2)


def test_positions_of_repeated_rows_and_null_keys(spark):
    """Rows alike take as many numbers, and texts take no part in the numbering's shuffle."""
    rows = [(1, "a"), (1, "a"), (1, "b"), (2, "a"), (None, "x"), (None, "x"), (None, None)]
    df = spark.createDataFrame(rows * 3, "id long, text string")
    numbered = dense_position(df, "id")
    found = numbered.collect()
    assert sorted(r["position"] for r in found) == list(range(21))
    assert sorted((str(r["id"]), str(r["text"])) for r in found) == sorted((str(i), str(t)) for i, t in rows * 3)
    by_place = [r["id"] for r in sorted(found, key=lambda r: r["position"])]
    assert by_place == sorted(by_place, key=lambda i: "" if i is None else hashlib.md5(str(i).encode()).hexdigest())
    exchanges = numbered._jdf.queryExecution().executedPlan().toString().split("Exchange hashpartitioning(_range")
    assert len(exchanges) > 1 and all("text" not in part.split("\n")[0] for part in exchanges[1:])
