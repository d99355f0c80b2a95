import datetime as dt

import pytest
from pyspark.sql import functions as F

from replylens.operators import cleaning
from replylens.schema import MissingColumnsError, require_columns


def by_id(df):
    return {row["id"]: row for row in df.collect()}


def test_actions_are_trimmed_and_upper_cased(log):
    rows = by_id(
        cleaning.clean_messages(
            log(
                {"sender_action": "accepted"},
                {"sender_action": " Edited"},
                {"sender_action": None},
                {"sender_action": "OTHER"},
            )
        )
    )
    assert rows[0]["suggestion_accepted"] and not rows[0]["needs_analysis"]
    assert rows[1]["suggestion_edited"] and rows[1]["needs_analysis"]
    for i in (2, 3):
        assert not rows[i]["needs_analysis"]
        assert not any(rows[i][f"suggestion_{a}"] for a in ("accepted", "edited", "ignored", "skipped"))
    assert rows[2]["sender_action"] == ""


def test_unknown_outcome_counts_as_not_accepted(log):
    cleaned = cleaning.clean_messages(log({"sender_action": None}, {"sender_action": "OTHER"}, {}))
    assert set(by_id(cleaning.analysis_set(cleaned))) == {0, 1}


def test_edit_distance_counts_code_points(log):
    edited = {"sender_action": "EDITED"}
    rows = by_id(
        cleaning.clean_messages(
            log(
                {**edited, "message_output": "", "final_message_sent": "algo"},
                {**edited, "message_output": "abcd", "final_message_sent": "wxyz"},
                {**edited, "message_output": "ñ😀ab", "final_message_sent": "ñ"},
                {**edited, "message_output": "abcd", "final_message_sent": None},
                {"message_output": "abcd", "final_message_sent": "a"},
            )
        )
    )
    assert [rows[i]["edit_distance"] for i in range(5)] == [0.0, 0.0, 75.0, 0.0, 0.0]


def test_comparison_set_needs_all_texts_and_adds_lengths(log):
    edited = {"sender_action": "EDITED"}
    cleaned = cleaning.clean_messages(
        log(
            edited,
            {**edited, "message_input": None},
            {**edited, "message_output": ""},
            {**edited, "final_message_sent": None},
        )
    )
    rows = by_id(cleaning.comparison_set(cleaned))
    assert set(rows) == {0}
    assert (rows[0]["message_length"], rows[0]["suggestion_length"], rows[0]["final_length"]) == (4, 11, 6)


def test_missing_text_column_restricts_nothing(log):
    cleaned = cleaning.clean_messages(log({"sender_action": "EDITED"}, {"sender_action": "IGNORED"}))
    assert cleaning.analysis_set(cleaned.drop("message_input")).count() == 2
    assert cleaning.comparison_set(cleaned.drop("final_message_sent")).count() == 2


def test_missing_flags_become_false(spark):
    df = cleaning.ensure_flags(spark.createDataFrame([(1,)], "id long"))
    assert df.first()["suggestion_skipped"] is False


def test_bad_timestamps_become_null(spark):
    df = spark.createDataFrame(
        [(1, "2024-01-02 03:04:05"), (2, "2024-01-02T03:04:05"), (3, "2024-01-02"), (4, "ayer")],
        "id long, created_at string",
    )
    values = {r["id"]: r["created_at"] for r in cleaning.coerce_times(df).collect()}
    assert values[1] == values[2] == dt.datetime(2024, 1, 2, 3, 4, 5)
    assert values[3] == dt.datetime(2024, 1, 2)
    assert values[4] is None


def test_sentinels_of_a_reread_comparison_set(spark):
    df = spark.createDataFrame(
        [(1, None, "3.0", "x", None), (2, "hola", None, "2.5", "7"), (3, "a", "9", None, "8")],
        "id long, message_input string, detected_intent string, edit_distance string, sender_id string",
    )
    rows = by_id(cleaning.coerce_for_collections(df))
    assert (rows[1]["message_input"], rows[1]["detected_intent"], rows[1]["edit_distance"]) == ("N/A", 3, 0.0)
    assert (rows[2]["detected_intent"], rows[2]["edit_distance"]) == (-1, 2.5)
    assert (rows[1]["sender_id"], rows[3]["detected_intent"]) == ("N/A", 9)


@pytest.fixture
def dated(log):
    return log(
        {"created_at": dt.datetime(2022, 12, 31, 23, 59)},
        {"created_at": dt.datetime(2023, 1, 1)},
        {"created_at": dt.datetime(2023, 1, 31)},
        {"created_at": dt.datetime(2023, 1, 31, 10)},
        {"created_at": None},
    )


def test_date_range_ends_at_midnight_unless_asked(dated):
    assert set(by_id(cleaning.date_range(dated, "2023-01-01:2023-01-31"))) == {1, 2}
    whole_day = cleaning.date_range(dated, "2023-01-01:2023-01-31", end_inclusive_day=True)
    assert set(by_id(whole_day)) == {1, 2, 3}


@pytest.mark.parametrize("spec", ["2023-01-01", "hoy:ayer", "a:b:c", None, ""])
def test_malformed_range_keeps_everything(dated, spec):
    assert cleaning.date_range(dated, spec).count() == 5


def test_date_range_reaches_the_scan(spark, dated, tmp_path):
    dated.write.parquet(str(tmp_path / "log"))
    stored = cleaning.clean_messages(spark.read.parquet(str(tmp_path / "log")))
    selected = cleaning.date_range(stored, "2023-01-01:2023-01-31").select("id")
    plan = selected._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(created_at" in plan
    assert "message_input" not in plan


def test_low_volume(log):
    assert cleaning.is_low_volume(log({}), 2)
    assert not cleaning.is_low_volume(log({}, {}), 2)


def test_required_columns(log):
    with pytest.raises(MissingColumnsError, match="nothing"):
        require_columns(log({}), ["id", "nothing"])
    assert require_columns(log({}), ["id"]).select(F.count("*")).first()[0] == 1
