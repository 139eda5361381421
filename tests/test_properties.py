"""Property: publishing disjoint windows that tile a range, in any order,
leaves the same table as publishing the whole range at once."""

import datetime as dt

from hypothesis import given, settings
from hypothesis import strategies as st

from strata.operators.compare import compare
from strata.operators.publish import publish_window

DAYS = [dt.date(2025, 3, 1) + dt.timedelta(days=i) for i in range(8)]


@st.composite
def tilings(draw):
    cuts = sorted(draw(st.sets(st.integers(min_value=1, max_value=len(DAYS) - 1), max_size=4)))
    bounds = [0, *cuts, len(DAYS)]
    windows = [(DAYS[a], DAYS[b - 1] + dt.timedelta(days=1)) for a, b in zip(bounds, bounds[1:])]
    return draw(st.permutations(windows))


@settings(max_examples=8, deadline=None)
@given(windows=tilings())
def test_disjoint_windows_compose(spark, windows):
    rows = [(d, k, i * 10 + k) for i, d in enumerate(DAYS) for k in range(3) if (i + k) % 4]
    candidate = spark.createDataFrame(rows, "event_date date, k int, v int")
    old = spark.createDataFrame([(d, 9, -1) for d in DAYS], "event_date date, k int, v int")
    whole = publish_window(candidate, old, DAYS[0], DAYS[-1] + dt.timedelta(days=1))
    table = old
    for start, end in windows:
        table = publish_window(candidate, table, start, end)
    assert compare(table, whole).first()["identical"]
