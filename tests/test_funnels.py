"""Ordered funnels against a walk through each person's events."""

from __future__ import annotations

import datetime
import random
from collections import defaultdict

import pytest

from adloom.operators import funnels
from tests.conftest import plan, rows

STEPS = ["view", "click", "buy"]
SCHEMA = "who string, at timestamp, kind string, reached int"
START = datetime.datetime(2026, 3, 1)


def walked(data, gap):
    """Sessions by brute force."""
    by_person = defaultdict(list)
    for who, at, kind, _ in data:
        if who is not None and at is not None:
            by_person[who].append((at, STEPS.index(kind) + 1 if kind in STEPS else 0))
    found = []
    for who, events in by_person.items():
        open_session = None
        for at, step in sorted(events):
            if open_session is None or (at - open_session[2]).total_seconds() > gap:
                open_session = [who, at, at, 0, 0]
                found.append(open_session)
            open_session[2], open_session[3] = at, open_session[3] + 1
            if step == open_session[4] + 1:
                open_session[4] = step
    return sorted(map(tuple, found))


@pytest.mark.parametrize(("gap", "width"), [(1800, 3600), (600, 86_400), (7200, 1800), (60, 60)])
def test_sessions_equal_brute_force(spark, gap, width):
    rng = random.Random(gap)
    data = []
    for n in range(4000):
        # One person owns a third of all events; minutes make ties and pauses of exactly the gap.
        who = "hot" if n % 3 == 0 else f"u{rng.randint(0, 60)}"
        at = START + datetime.timedelta(minutes=rng.randint(0, 4 * 1440))
        data.append((who, at, rng.choice([*STEPS, *STEPS, "other", None]), 9))
    data += [(None, START, "view", 1), ("u1", None, "view", 1), ("odd", START, None, None), ("odd", START, None, None)]
    df = spark.createDataFrame(data, SCHEMA)
    found = funnels.session_funnel(df, "who", "at", "kind", STEPS, gap, width)
    assert found.columns == ["who", "session_start", "session_end", "events", "reached"]
    assert rows(found) == walked(data, gap)


def test_report_counts_each_step_and_its_shares(spark):
    sessions = spark.createDataFrame([("a", 0), ("a", 1), ("a", 3), ("a", 3), ("b", 0)], "grp string, reached int")
    assert rows(funnels.funnel_report(sessions, STEPS, ["grp"])) == [
        ("a", 1, "view", 3, 1.0, 1.0),
        ("a", 2, "click", 2, 2 / 3, 2 / 3),
        ("a", 3, "buy", 2, 1.0, 2 / 3),
        ("b", 1, "view", 0, None, None),
        ("b", 2, "click", 0, None, None),
        ("b", 3, "buy", 0, None, None),
    ]
    nobody = funnels.funnel_report(sessions.where("false"), STEPS)
    assert rows(nobody) == [(i, step, 0, None, None) for i, step in enumerate(STEPS, 1)]


def test_empty_and_wrong_steps(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert funnels.session_funnel(empty, "who", "at", "kind", STEPS, 60).count() == 0
    with pytest.raises(ValueError):
        funnels.session_funnel(empty, "who", "at", "kind", ["view", "view"], 60)


def test_events_are_shuffled_once(spark):
    df = spark.createDataFrame([("u", START, "view", 1)], SCHEMA)
    found = funnels.session_funnel(df, "who", "at", "kind", STEPS, 60)
    found.collect()
    # The second shuffle is that of the folded stretches.
    assert plan(found).split("Initial Plan")[0].count("Exchange hashpartitioning(who#") == 2
