import random
from collections import Counter
from datetime import date

import pytest
from conftest import values

from chatterlens.operators import heavy as h

DAYS = [date(2024, 1, day) for day in (1, 2, 3, 4)]


def exact(data, first, last, n):
    counts = Counter(user for user, day in data if user is not None and day is not None and first <= day <= last)
    return sorted(counts.items(), key=lambda item: (-item[1], item[0]))[:n]


def skewed(seed):
    rng = random.Random(seed)
    return [(rng.choice(["a", "b", *["c"] * 5, *["d"] * 9, None, f"x{rng.randrange(40)}"]), rng.choice([*DAYS, None])) for _ in range(600)]


def flat(seed):
    rng = random.Random(seed)
    return [(f"u{i % 50}", rng.choice(DAYS)) for i in range(500)]


@pytest.fixture
def table(rows):
    return lambda data: rows([(user, day) for user, day in data], "user string, day date").withColumnRenamed("day", "event_time")


@pytest.mark.parametrize("data, size", [(skewed(1), 6), (skewed(2), 1000), (flat(3), 5), ([], 5)])
def test_top_of_any_range_is_exact(table, data, size):
    rows = table(data)
    summaries = h.day_summaries(rows, "user", size=size)
    for first, last, n in ((0, 3, 3), (1, 2, 2), (2, 2, 100)):
        got = [tuple(r) for r in h.top_between(summaries, rows, "user", DAYS[first], DAYS[last], n).collect()]
        assert got == exact(data, DAYS[first], DAYS[last], n)


def test_only_candidates_are_counted_where_the_bounds_prove_them(table):
    rows = table(skewed(1))
    found = h.possible(h.day_summaries(rows, "user", size=6), DAYS[0], DAYS[3], 2)
    assert {r.value for r in found.collect()} <= {"d", "c"}
    assert h.possible(h.day_summaries(table(flat(3)), "user", size=5), DAYS[0], DAYS[3], 3) is None


def test_bounds_hold(table):
    data = skewed(4)
    held = h.day_summaries(table(data), "user", size=4).collect()
    for day in DAYS:
        counts = Counter(user for user, d in data if d == day and user)
        named = {r.value: r.n for r in held if r.day == day}
        rest = {r.rest for r in held if r.day == day}
        assert all(counts[user] == n for user, n in named.items())
        assert rest == {max((n for user, n in counts.items() if user not in named), default=0)}


def test_days_written_again_are_replaced(spark, table, tmp_path):
    path, data = str(tmp_path / "summaries"), flat(5)
    h.write_summaries(table(data), path, "user")
    h.write_summaries(table([row for row in data if row[1] == DAYS[1]]), path, "user")
    assert values(h.read_summaries(spark, path).select("day", "value", "n", "rest")) == values(h.day_summaries(table(data), "user"))
