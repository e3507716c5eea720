"""Alarm reduction against a plain walk over the events in order."""

import random

import pytest

from eventloom.operators.alarms import reduce_alarms

SCHEMA = "event_id long, time long, reduction_key string, clear_key string, alarm_type int, severity string"


def plain(rows):
    """One walk in order of (time, id), nulls first: counts go up with events, and clears note their time."""
    place = lambda r: ((r[1] is not None, r[1] or 0), r[0])
    alarms, order = {}, sorted(rows, key=place)
    for r in order:
        if r[2] is not None:
            a = alarms.setdefault(r[2], {"n": 0, "times": [], "open": 0, "cleared": False, "at": None})
            a["n"] += 1
            a["times"] += [r[1]] if r[1] is not None else []
            a.update(type=r[4], severity=r[5], open=a["open"] + 1, cleared=False, at=None)
        if r[4] == 2 and r[3] in alarms and r[3] is not None:
            a = alarms[r[3]]
            a["open"] = 0
            if not a["cleared"] and r[3] != r[2]:
                a.update(cleared=True, at=r[1])
    return {k: (a["type"], a["n"], min(a["times"], default=None), max(a["times"], default=None), a["severity"], a["cleared"], a["at"], a["open"])
            for k, a in alarms.items()}


def reduced(spark, rows):
    got = reduce_alarms(spark.createDataFrame(rows, SCHEMA)).collect()
    assert len({r.reduction_key for r in got}) == len(got)
    return {r.reduction_key: (r.alarm_type, r.n_events, r.first_time, r.last_time, r.last_severity, r.cleared, r.cleared_time, r.n_open) for r in got}


@pytest.mark.parametrize("seed", range(4))
def test_random_events(spark, seed):
    draw = random.Random(seed)
    keys = ["a", "b", "c", "hot", "hot", "hot", None]
    rows = [(k, draw.choice([None, *range(12)]), draw.choice(keys), draw.choice(keys), draw.choice([1, 2, 3, None]), draw.choice(["Minor", "Major", None]))
            for k in range(draw.choice([20, 150]))]
    draw.shuffle(rows)
    assert reduced(spark, rows) == plain(rows)


def test_edges(spark):
    assert reduced(spark, []) == {}
    assert reduced(spark, [(1, 5, None, "a", 2, "Minor")]) == {}
    raised, clear = (1, 5, "a", None, 1, "Major"), (2, 5, None, "a", 2, None)
    assert reduced(spark, [raised, clear]) == {"a": (1, 1, 5, 5, "Major", True, 5, 0)}
    # A clear before the event, one of another type, and one that is the event itself.
    assert reduced(spark, [(3, 5, "a", None, 1, "Major"), clear]) == {"a": (1, 1, 5, 5, "Major", False, None, 1)}
    assert reduced(spark, [raised, (2, 6, None, "a", 1, None)]) == {"a": (1, 1, 5, 5, "Major", False, None, 1)}
    assert reduced(spark, [(1, 5, "a", "a", 2, "Normal")]) == {"a": (2, 1, 5, 5, "Normal", False, None, 0)}
    # Repeated rows count; the greater severity wins a tie.
    assert reduced(spark, [raised, raised, (1, 5, "a", None, 1, "Minor")]) == {"a": (1, 3, 5, 5, "Minor", False, None, 3)}
