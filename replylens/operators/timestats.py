"""Acceptance statistics over time, agents and intents."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from replylens.functions.columns import percent
from replylens.functions.dimensions import dimension
from replylens.operators.cleaning import coerce_times
from replylens.schema import ACTION_FLAGS

TARGET_RATE = 80
TOP_AGENTS = 20
TOP_INTENTS = 5
MOVING_AVERAGE_ROWS = 7

# Weekday names and their order.
WEEKDAYS = [
    ("Monday", "Lunes", 0),
    ("Tuesday", "Martes", 1),
    ("Wednesday", "Miércoles", 2),
    ("Thursday", "Jueves", 3),
    ("Friday", "Viernes", 4),
    ("Saturday", "Sábado", 5),
    ("Sunday", "Domingo", 6),
]

# Day parts with the last hour that belongs to each.
DAY_PARTS = [("Madrugada", 6), ("Mañana", 12), ("Tarde", 18), ("Noche", 23)]

COUNTS = ["accepted", "edited", "ignored", "skipped"]
MEASURES = ["total_messages", *COUNTS]
ROLLUP_KEYS = ["date", "hour_of_day", "sender_id", "detected_intent"]


def _calendar(created: Column) -> dict[str, Column]:
    return {
        "date": F.to_date(created),
        "day_of_week": F.date_format(F.to_date(created), "EEEE"),
        "hour_of_day": F.hour(created),
        "week_of_year": F.weekofyear(F.to_date(created)),
        "month": F.month(F.to_date(created)),
        "month_name": F.date_format(F.to_date(created), "MMMM"),
    }


def _day_part(hour: Column) -> Column:
    expression = F.when(hour <= DAY_PARTS[0][1], DAY_PARTS[0][0])
    for name, last_hour in DAY_PARTS[1:]:
        expression = expression.when(hour <= last_hour, name)
    return expression


def time_features(df: DataFrame) -> DataFrame:
    """Calendar columns of ``created_at``; unchanged when there is no such column."""
    df = coerce_times(df)
    if "created_at" not in df.columns:
        return df
    features = df.withColumns(_calendar(F.col("created_at")))
    return features.withColumn("day_part", _day_part(F.col("hour_of_day")))


def to_measures(df: DataFrame) -> DataFrame:
    """Calendar columns and one summable column per count, for each message."""
    summable = {
        "total_messages": F.col("id").isNotNull().cast("long"),
        **{
            count: F.coalesce(F.col(flag).cast("long"), F.lit(0))
            for count, flag in zip(COUNTS, ACTION_FLAGS.values())
        },
    }
    return time_features(df).withColumns(summable)


def rollup(df: DataFrame) -> DataFrame:
    """Counts per (date, hour, agent, intent): one pass over the log for all tables.

    Every statistics table below is a coarser sum of this one. Combining happens
    before the shuffle, so a busy agent, intent or day is no hot spot.
    """
    keyed = to_measures(df).groupBy(*ROLLUP_KEYS).agg(*(F.sum(m).alias(m) for m in MEASURES))
    derived = _calendar(F.col("date"))
    return keyed.withColumns(
        {
            "day_of_week": derived["day_of_week"],
            "week_of_year": derived["week_of_year"],
            "day_part": _day_part(F.col("hour_of_day")),
        }
    )


def action_stats(measures: DataFrame, *keys: str, counts: list[str] = COUNTS) -> DataFrame:
    """Message count, outcome counts and acceptance rate per key; null keys drop out.

    ``measures`` is either :func:`to_measures` (one row per message) or
    :func:`rollup`.
    """
    known = measures
    for key in keys:
        known = known.filter(F.col(key).isNotNull())
    stats = known.groupBy(*keys).agg(*(F.sum(c).alias(c) for c in ["total_messages", *counts]))
    return stats.withColumn("acceptance_rate", percent(F.col("accepted"), F.col("total_messages")))


def daily_stats(measures: DataFrame) -> DataFrame:
    """Per day, with rejection rate and the mean rate of the last seven rows.

    The window holds one row per calendar day, whatever the size of the log.
    """
    last_rows = Window.orderBy("date").rowsBetween(1 - MOVING_AVERAGE_ROWS, 0)
    return (
        action_stats(measures, "date")
        .withColumn("rejection_rate", F.lit(100.0) - F.col("acceptance_rate"))
        .withColumn("acceptance_ma7", F.avg("acceptance_rate").over(last_rows))
        .orderBy("date")
    )


def weekday_stats(measures: DataFrame) -> DataFrame:
    """Per weekday, with Spanish name, Monday first."""
    names = dimension(measures.sparkSession, ["day_of_week", "day_of_week_es", "day_order"], WEEKDAYS)
    return (
        action_stats(measures, "day_of_week")
        .join(F.broadcast(names), "day_of_week", "left")
        .orderBy("day_order")
    )


def hourly_stats(measures: DataFrame) -> DataFrame:
    return action_stats(measures, "hour_of_day").orderBy("hour_of_day")


def daypart_stats(measures: DataFrame) -> DataFrame:
    """All four day parts; one without messages has zero counts and a null rate."""
    parts = dimension(
        measures.sparkSession,
        ["day_part", "part_order"],
        [(name, order) for order, (name, _) in enumerate(DAY_PARTS)],
    )
    stats = action_stats(measures, "day_part")
    return (
        parts.join(stats, "day_part", "left")
        .fillna(0, subset=MEASURES)
        .orderBy("part_order")
        .drop("part_order")
    )


def agent_stats(measures: DataFrame) -> DataFrame:
    return action_stats(measures, "sender_id").orderBy(F.desc("total_messages"), "sender_id")


def top_agents(measures: DataFrame, n: int = TOP_AGENTS) -> DataFrame:
    """The ``n`` agents with the most messages."""
    return agent_stats(measures).limit(n)


def intent_daily(measures: DataFrame) -> DataFrame:
    return action_stats(measures, "date", "detected_intent", counts=["accepted"]).orderBy(
        "date", "detected_intent"
    )


def intent_trend(measures: DataFrame, n: int = TOP_INTENTS) -> DataFrame:
    """Daily rows of the ``n`` most frequent intents (over all rows, dated or not)."""
    top = (
        measures.filter(F.col("detected_intent").isNotNull())
        .groupBy("detected_intent")
        .agg(F.sum("total_messages").alias("messages"))
        .orderBy(F.desc("messages"), "detected_intent")
        .limit(n)
    )
    return intent_daily(measures).join(
        F.broadcast(top.select("detected_intent")), "detected_intent", "left_semi"
    )


def weekly_stats(measures: DataFrame) -> DataFrame:
    """Per ISO week number; the same week of different years is one group."""
    return action_stats(measures, "week_of_year").orderBy("week_of_year")


def action_volumes_long(stats: DataFrame, *ids: str) -> DataFrame:
    """Wide outcome counts to rows of (ids, variable, value), as stacked charts want."""
    return stats.unpivot(list(ids), COUNTS, "variable", "value")


def _calendar_rows(measures: DataFrame) -> DataFrame:
    """Rates per day, weekday and hour in one table: (grain, place, label, counts, rate).

    The log is summed per (date, hour) once; three rows made of each sum then feed the
    three grains, instead of three passes over the log.
    """
    hours = (
        measures.filter(F.col("date").isNotNull())
        .groupBy("date", "hour_of_day")
        .agg(*(F.sum(c).alias(c) for c in ("total_messages", "accepted")))
    )
    weekday = F.weekday("date")
    spanish = F.array(*(F.lit(name) for _, name, _ in WEEKDAYS))
    hour = F.col("hour_of_day")
    grains = [
        ("day", F.unix_date("date"), F.col("date").cast("string")),
        ("weekday", weekday, F.element_at(spanish, weekday + 1)),
        ("hour", hour, hour.cast("string")),
    ]
    tagged = F.array(
        *(
            F.struct(F.lit(g).alias("grain"), place.alias("place"), label.alias("label"))
            for g, place, label in grains
        )
    )
    stats = (
        hours.select(F.inline(tagged), "total_messages", "accepted")
        .groupBy("grain", "place", "label")
        .agg(*(F.sum(c).alias(c) for c in ("total_messages", "accepted")))
    )
    return stats.withColumn("acceptance_rate", percent(F.col("accepted"), F.col("total_messages")))


def time_summary(measures: DataFrame) -> DataFrame:
    """One row: overall rate, best and worst day, weekday and hour, and trends.

    Comparisons are positional: "first five weekday rows", "rows 7 to 12 of the
    hours"; an empty side compares as false.
    """
    row = F.row_number().over(Window.partitionBy("grain").orderBy("place"))
    stacked = _calendar_rows(measures).withColumn("row", row)

    rate = F.col("acceptance_rate")

    def only(grain: str, value: Column) -> Column:
        return F.when(F.col("grain") == grain, value)

    def best(grain: str) -> Column:
        # Highest rate, earliest row on ties.
        ranked = F.struct(rate.alias("rate"), (-F.col("row")).alias("tie"))
        return F.max_by(
            F.struct("label", rate.alias("rate")), only(grain, F.when(rate.isNotNull(), ranked))
        )

    def worst(grain: str) -> Column:
        ranked = F.struct(rate.alias("rate"), F.col("row").alias("tie"))
        return F.min_by(
            F.struct("label", rate.alias("rate")), only(grain, F.when(rate.isNotNull(), ranked))
        )

    def mean_of_rows(grain: str, first: int, last: int | None = None) -> Column:
        rows = F.col("row") >= first
        if last is not None:
            rows = rows & (F.col("row") <= last)
        return F.avg(F.when(rows & (F.col("grain") == grain), rate))

    def higher(a: Column, b: Column) -> Column:
        return F.coalesce(a > b, F.lit(False))

    accepted = F.sum(only("day", F.col("accepted")))
    total = F.sum(only("day", F.col("total_messages")))
    first_day = F.min_by(F.struct(rate.alias("rate")), only("day", F.col("row")))
    last_day = F.max_by(F.struct(rate.alias("rate")), only("day", F.col("row")))
    summary = stacked.agg(
        (F.try_divide(accepted, total) * 100).alias("overall_acceptance"),
        *(best(g).alias(f"best_{g}") for g in ("day", "weekday", "hour")),
        *(worst(g).alias(f"worst_{g}") for g in ("day", "weekday", "hour")),
        higher(last_day["rate"], first_day["rate"]).alias("trend_rising"),
        higher(mean_of_rows("weekday", 1, 5), mean_of_rows("weekday", 6)).alias(
            "first_five_weekdays_better"
        ),
        higher(mean_of_rows("hour", 7, 12), mean_of_rows("hour", 13, 18)).alias("morning_better"),
    )
    flat = [
        F.col(f"{end}_{g}.{field}").alias(name)
        for g in ("day", "weekday", "hour")
        for end in ("best", "worst")
        for field, name in (("label", f"{end}_{g}"), ("rate", f"{end}_{g}_rate"))
    ]
    return summary.select(
        "overall_acceptance",
        *flat,
        F.pmod(F.col("worst_hour.label").cast("int") + 2, F.lit(24)).alias("worst_hour_end"),
        "trend_rising",
        "first_five_weekdays_better",
        "morning_better",
    )


def agent_summary(agents: DataFrame, target: float = TARGET_RATE, ends: int = 5) -> DataFrame:
    """One row: range of agent rates, agents on target, busiest against quietest five.

    The two ends are found with top-k, never by numbering all agents. All three parts
    read the same columns, so that Spark shuffles the log once and reuses it.
    """
    rate = F.col("acceptance_rate")
    stats = agents.select("sender_id", "total_messages", "acceptance_rate")
    overall = stats.agg(
        F.min(rate).alias("min_rate"),
        F.max(rate).alias("max_rate"),
        F.count_if((F.col("total_messages") > 0) & (rate >= target)).alias("agents_on_target"),
    )
    busiest = stats.orderBy(F.desc("total_messages"), F.asc("sender_id")).limit(ends)
    quietest = stats.orderBy(F.asc("total_messages"), F.desc("sender_id")).limit(ends)
    stacked = overall.unionByName(
        busiest.select(rate.alias("busy_rate")), allowMissingColumns=True
    ).unionByName(quietest.select(rate.alias("quiet_rate")), allowMissingColumns=True)
    return stacked.agg(
        F.max("min_rate").alias("min_rate"),
        F.max("max_rate").alias("max_rate"),
        F.max("agents_on_target").alias("agents_on_target"),
        F.coalesce(F.avg("busy_rate") > F.avg("quiet_rate"), F.lit(False)).alias(
            "busiest_agents_better"
        ),
    )
