import datetime as dt

import pytest

from replylens.operators import cleaning, timestats


def at(day, hour=9, **row):
    return {"created_at": dt.datetime(2024, 1, day, hour), **row}


@pytest.fixture
def measures(log):
    def build(*rows):
        return timestats.to_measures(cleaning.clean_messages(log(*rows)))

    return build


def test_day_parts_are_right_closed(log):
    hours = [0, 6, 7, 12, 13, 18, 19, 23]
    rows = timestats.time_features(log(*(at(1, h) for h in hours))).orderBy("id").collect()
    assert [r["day_part"] for r in rows] == [
        "Madrugada", "Madrugada", "Mañana", "Mañana", "Tarde", "Tarde", "Noche", "Noche",
    ]


def test_calendar_features(log):
    days = [dt.datetime(2023, 1, 1), dt.datetime(2024, 12, 30, 5)]
    rows = timestats.time_features(log(*({"created_at": d} for d in days))).orderBy("id").collect()
    assert [r["week_of_year"] for r in rows] == [52, 1]
    assert [r["day_of_week"] for r in rows] == ["Sunday", "Monday"]
    assert [r["month_name"] for r in rows] == ["January", "December"]


def test_features_do_not_depend_on_the_session_zone(spark, log):
    df = log({"created_at": dt.datetime(2024, 3, 10, 2, 30)})
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        row = timestats.time_features(df).first()
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert (row["hour_of_day"], row["day_of_week"]) == (2, "Sunday")


def test_features_without_created_at(log):
    assert "date" not in timestats.time_features(log({}).drop("created_at")).columns


def test_rate_is_half_even(measures):
    rows = [at(1)] + [at(1, sender_action="EDITED")] * 31
    assert timestats.daily_stats(measures(*rows)).first()["acceptance_rate"] == 3.12


def test_moving_mean_is_over_rows_not_days(measures):
    days = [1, 2, 3, 4, 5, 6, 7, 20]
    rows = [at(d, sender_action="ACCEPTED" if d == 1 else "IGNORED") for d in days]
    stats = timestats.daily_stats(measures(*rows)).collect()
    assert [r["date"].day for r in stats] == days
    assert stats[6]["acceptance_ma7"] == pytest.approx(100 / 7)
    assert stats[7]["acceptance_ma7"] == 0
    assert stats[1]["rejection_rate"] == 100


def test_empty_day_parts_appear(measures):
    rows = timestats.daypart_stats(measures(at(1, 8), at(1, 9))).collect()
    assert [r["day_part"] for r in rows] == ["Madrugada", "Mañana", "Tarde", "Noche"]
    assert [r["total_messages"] for r in rows] == [0, 2, 0, 0]
    assert [r["acceptance_rate"] for r in rows] == [None, 100.0, None, None]


def test_null_keys_drop_out(measures):
    m = measures(at(1), at(1, sender_id=None, detected_intent=None), {"created_at": None})
    assert timestats.agent_stats(m).first()["total_messages"] == 2
    assert timestats.intent_daily(m).first()["total_messages"] == 1
    for table in (timestats.daily_stats, timestats.hourly_stats, timestats.weekly_stats):
        assert table(m).first()["total_messages"] == 2


def test_rollup_gives_the_same_tables(log):
    cleaned = cleaning.clean_messages(
        log(
            *(
                at(1 + i % 9, i % 24, sender_id=i % 4 or None, detected_intent=i % 3 or None,
                   sender_action=["ACCEPTED", "EDITED", "IGNORED", "SKIPPED", None][i % 5])
                for i in range(120)
            ),
            {"created_at": None},
        )
    )
    single, summed = timestats.to_measures(cleaned), timestats.rollup(cleaned)
    tables = [
        timestats.daily_stats, timestats.weekday_stats, timestats.hourly_stats,
        timestats.daypart_stats, timestats.agent_stats, timestats.intent_daily,
        timestats.intent_trend, timestats.weekly_stats, timestats.time_summary,
    ]
    for table in tables:
        assert sorted(map(str, table(single).collect())) == sorted(map(str, table(summed).collect()))


def test_top_agents_break_ties_by_id(measures):
    rows = [at(1, sender_id=i) for i in range(30, 0, -1)]
    assert [r["sender_id"] for r in timestats.top_agents(measures(*rows)).collect()] == list(range(1, 21))


def test_intent_trend_keeps_five(measures):
    rows = [at(1, detected_intent=i) for i in range(8) for _ in range(8 - i)]
    kept = {r["detected_intent"] for r in timestats.intent_trend(measures(*rows)).collect()}
    assert kept == {0, 1, 2, 3, 4}


def test_volumes_are_unpivoted(measures):
    stats = timestats.daily_stats(measures(at(1), at(1, sender_action="SKIPPED")))
    rows = {r["variable"]: r["value"] for r in timestats.action_volumes_long(stats, "date").collect()}
    assert rows == {"accepted": 1, "edited": 0, "ignored": 0, "skipped": 1}


def test_summary_is_positional(measures):
    # Monday to Wednesday only: no sixth weekday row, so the comparison is false.
    row = timestats.time_summary(
        measures(at(1, 8), at(2, 8, sender_action="EDITED"), at(3, 23, sender_action="EDITED"), at(3, 23))
    ).first()
    assert row["overall_acceptance"] == 50
    assert (row["best_day"], row["worst_day"]) == ("2024-01-01", "2024-01-02")
    assert (row["best_weekday"], row["worst_weekday"]) == ("Lunes", "Martes")
    assert (row["best_hour"], row["worst_hour"], row["worst_hour_end"]) == ("8", "8", 10)
    assert row["trend_rising"] is False
    assert row["first_five_weekdays_better"] is False
    assert row["morning_better"] is False


def test_summary_compares_row_ranges(measures):
    rows = [at(1, h, sender_action="ACCEPTED" if 6 <= h < 12 else "EDITED") for h in range(24)]
    row = timestats.time_summary(measures(*rows)).first()
    assert row["morning_better"] is True
    assert row["worst_hour_end"] == 2


def test_agent_summary(measures):
    rows = []
    for agent in range(1, 13):
        accepted = agent > 6
        rows += [at(1, sender_id=agent, sender_action="ACCEPTED" if accepted else "EDITED")] * agent
    row = timestats.agent_summary(timestats.agent_stats(measures(*rows))).first()
    assert (row["min_rate"], row["max_rate"], row["agents_on_target"]) == (0, 100, 6)
    assert row["busiest_agents_better"] is True
