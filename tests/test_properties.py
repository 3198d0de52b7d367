"""Step functions against invariants on generated bars."""

from __future__ import annotations

from hypothesis import given
from hypothesis import strategies as st

from tapeline.operators.folds import candle_step, half_up, sar_step

PRICE = st.integers(min_value=1, max_value=10**8)


@st.composite
def bar(draw):
    low, high = sorted((draw(PRICE), draw(PRICE)))
    inside = st.integers(min_value=low, max_value=high)
    return draw(inside), high, low, draw(inside)


@given(st.lists(bar(), min_size=1, max_size=40))
def test_candle_contains_its_open_and_close(bars):
    state = None
    for b in bars:
        state = candle_step(state, b)
        o, h, low, c = state
        assert low <= min(o, c) and max(o, c) <= h
        assert h >= b[1] and low <= b[2]


@given(st.lists(bar(), min_size=1, max_size=60), st.sampled_from([(5, 50), (2, 20), (3, 30)]))
def test_stop_turns_only_when_crossed_and_accelerates_within_its_cap(bars, setting):
    step, cap = setting
    run, state = sar_step(step, cap), None
    for _, high, low, _ in bars:
        before = state
        state = run(state, (high, low))
        assert step <= state[2] <= cap
        if before is not None:
            crossed = before[4] > low if before[1] else before[4] < high
            assert (state[1] != before[1]) == crossed


@given(st.integers(min_value=-(10**15), max_value=10**15), st.integers(min_value=1, max_value=1000))
def test_half_up_is_symmetric_and_nearest(n, d):
    q = half_up(n, d)
    assert half_up(-n, d) == -q
    assert abs(2 * (q * d - n)) <= d
