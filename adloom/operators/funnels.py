"""Ordered funnels: sessions of events per person, and how far each went through the steps in their order."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

SECOND = 1_000_000


def _stretches(events: DataFrame, user: str, at: str, kind: str, steps: list[str], gap: int, bin_width: int) -> DataFrame:
    """(user, bin, first, last, events, moves): events of one person and time bin without a pause longer than the gap.

    ``moves[s]`` is the number of steps done at the end if ``s`` were done at the start, so
    stretches of neighbouring bins can be put together without their events.
    """
    place = F.coalesce(F.array_position(F.array(*[F.lit(s) for s in steps]), F.col(kind)), F.lit(0)).cast("int")
    rows = events.select(F.col(user), F.unix_micros(F.col(at).cast("timestamp")).alias("__at"), place.alias("__step"))
    rows = rows.where(F.col(user).isNotNull() & F.col("__at").isNotNull())
    rows = rows.withColumn("__bin", F.floor(F.col("__at") / bin_width))
    in_bin = Window.partitionBy(user, "__bin").orderBy("__at")
    opens = F.coalesce(F.col("__at") - F.lag("__at").over(in_bin) > gap, F.lit(True))
    rows = rows.withColumn("__opens", opens.cast("int"))
    rows = rows.withColumn("__stretch", F.sum("__opens").over(in_bin))
    # A step repeated right after itself changes nothing, so runs of it are held as one event.
    again = F.lag("__step").over(Window.partitionBy(user, "__bin", "__stretch").orderBy("__at", "__step")).eqNullSafe(F.col("__step"))
    rows = rows.withColumn("__again", again)
    met = F.array_sort(F.collect_list(F.when((F.col("__step") > 0) & ~F.col("__again"), F.struct("__at", "__step"))))
    grouped = rows.groupBy(user, "__bin", "__stretch").agg(
        F.min("__at").alias("first"), F.max("__at").alias("last"), F.count(F.lit(1)).alias("events"), met.alias("__met")
    )
    fold = lambda start: F.aggregate(
        F.col("__met"), start, lambda done, event: F.when(event["__step"] == done + 1, done + 1).otherwise(done)
    )
    moves = F.array(*[fold(F.lit(s)) for s in range(len(steps) + 1)])
    return grouped.select(user, "__bin", "first", "last", "events", moves.alias("moves"))


def session_funnel(
    events: DataFrame, user: str, at: str, kind: str, steps: list[str], gap_seconds: int, bin_seconds: int = 86_400
) -> DataFrame:
    """(user, session_start, session_end, events, reached): one row per session, ``reached`` steps done in order.

    A session ends where its person pauses longer than ``gap_seconds``. Step i + 1 counts once
    step i is done, at the same moment at the earliest; events between them do no harm, and
    kinds that are no step (NULL included) only keep the session going. Events without a person
    or time belong to no session.

    A person may own any share of the rows: events are cut into time bins and shuffled once by
    (person, bin); a bin folds to one short array per stretch of events. A task holds the steps of
    one stretch at a time, so take shorter bins where single persons are very busy. Only stretches that
    come within the gap of a bin's edge can go on in the next bin, so only a few a bin meet
    again by person; all others are complete and spread by their beginning.
    """
    if len(set(steps)) != len(steps) or not steps:
        raise ValueError("steps must be distinct, one at least")
    gap, bin_width = gap_seconds * SECOND, bin_seconds * SECOND
    parts = _stretches(events, user, at, kind, steps, gap, bin_width)
    edge = (F.col("first") - F.col("__bin") * bin_width <= gap) | ((F.col("__bin") + 1) * bin_width - F.col("last") <= gap)
    parts = parts.withColumn("__alone", F.when(~edge, F.col("first")))

    by_time = Window.partitionBy(user, "__alone").orderBy("first")
    opens = F.coalesce(F.col("first") - F.lag("last").over(by_time) > gap, F.lit(True)).cast("int")
    joined = parts.withColumn("__opens", opens).withColumn("__session", F.sum("__opens").over(by_time))
    chain = F.transform(F.array_sort(F.collect_list(F.struct("first", "moves"))), lambda part: part["moves"])
    joined = joined.groupBy(user, "__alone", "__session").agg(
        F.min("first").alias("first"), F.max("last").alias("last"), F.sum("events").alias("events"), chain.alias("__chain")
    )
    return joined.select(
        user,
        F.timestamp_micros("first").alias("session_start"),
        F.timestamp_micros("last").alias("session_end"),
        "events",
        # moves[s] leads from the steps done before a stretch to those done after it.
        F.aggregate("__chain", F.lit(0), lambda done, moves: F.get(moves, done)).alias("reached"),
    )


def funnel_report(sessions: DataFrame, steps: list[str], by: list[str] | None = None) -> DataFrame:
    """(by, position, step, sessions, from_previous, from_first): a row per step of each group.

    Sessions that reach a step in order, and their share of those at the step before and at the
    first step; NULL where nobody was there. One aggregate with a counter per step: a hot group
    is summed ahead of the shuffle.
    """
    by = by or []
    counted = sessions.groupBy(*by).agg(*[F.count_if(F.col("reached") >= i).alias(f"__{i}") for i in range(1, len(steps) + 1)])
    share = lambda i, base: F.try_divide(F.col(f"__{i}").cast("double"), F.col(f"__{base}").cast("double"))
    lines = [
        F.struct(
            F.lit(i).alias("position"),
            F.lit(step).alias("step"),
            F.col(f"__{i}").alias("sessions"),
            share(i, max(i - 1, 1)).alias("from_previous"),
            share(i, 1).alias("from_first"),
        )
        for i, step in enumerate(steps, 1)
    ]
    return counted.select(*by, F.inline(F.array(*lines)))
