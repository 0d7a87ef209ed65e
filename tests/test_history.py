"""State advanced by new events against runs over all history."""

import random

import pytest
from pyspark.sql import functions as F

from racecast.functions import flag
from racecast.operators import features, history
from racecast.operators.ordered import Split


def counts():
    return {"wins": flag(F.col("place") == 1), "podiums": flag(F.col("place") <= 3)}


@pytest.fixture(scope="module")
def events(spark):
    rng = random.Random(4)
    rows = [(f"d{rng.choice([0] * 5 + list(range(1, 9)))}", rng.randint(1, 60), rng.randint(1, 6)) for _ in range(900)]
    rows += [("late", 55, 1), (None, 3, 1), ("d1", None, 1)]
    return spark.createDataFrame(rows, "driver string, race int, place int")


def rows(df):
    return sorted(map(repr, (tuple(r) for r in df.select(*sorted(df.columns)).collect())))


@pytest.mark.parametrize("split", [None, Split(rows_per_segment=8, sampled=4)])
def test_state_plus_delta_is_the_full_run(events, split):
    extra = {} if split is None else {"split": split}
    old, new = events.filter("race <= 40 OR race IS NULL"), events.filter("race > 40")
    state = history.history_state(old, "driver", "race", counts())
    got = history.advance(state, new, "driver", "race", counts(), **extra)
    assert rows(got.state) == rows(history.history_state(events, "driver", "race", counts()))
    known = events.filter("driver IS NOT NULL AND race IS NOT NULL")
    full = features.win_rate_as_of(known, "driver", "race", F.col("place") == 1).filter("race > 40")
    mine = history.rate(got.features, "wins", "win_rate_before")
    assert rows(mine.select(*full.columns)) == rows(full)


def test_many_small_steps(events):
    state = history.history_state(events.filter("race <= 10"), "driver", "race", counts())
    for start in range(11, 61, 25):
        step = events.filter(F.col("race").between(start, start + 24))
        state = history.advance(state, step, "driver", "race", counts()).state
    assert rows(state) == rows(history.history_state(events, "driver", "race", counts()))


def test_nothing_new_and_nothing_old(events):
    state = history.history_state(events, "driver", "race", counts())
    same = history.advance(state, events.limit(0), "driver", "race", counts())
    assert rows(same.state) == rows(state) and same.features.count() == 0
    none = history.history_state(events.limit(0), "driver", "race", counts())
    assert rows(history.advance(none, events, "driver", "race", counts()).state) == rows(state)


def test_late_events_are_listed_and_refused(events, spark):
    state = history.history_state(events, "driver", "race", counts())
    new = spark.createDataFrame([("d1", 60, 1), ("d1", 99, 1), ("new", 1, 1)], "driver string, race int, place int")
    late = history.late_events(state, new, "driver", "race")
    last = state.filter("driver = 'd1'").first().last_event
    assert [tuple(r) for r in late.collect()] == ([("d1", 60, 1)] if last >= 60 else [])
    bad = spark.createDataFrame([("d1", 1, 1)], "driver string, race int, place int")
    with pytest.raises(Exception, match="not after the last one"):
        history.advance(state, bad, "driver", "race", counts()).features.collect()
