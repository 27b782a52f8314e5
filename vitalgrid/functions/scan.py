"""Which extrema of a sequence stand out by a given prominence, in one pass per direction.

Looking left from a peak of height v, the peak stands out when a value <= v - p comes before any
value > v. For a fixed place that test is monotone in v, so one number describes everything to
the left: the lowest v that passes. Stepping over a value x moves that number into [x, x + p],
and such steps compose, so a slice of a long sequence is summarised by the interval it clamps to.
"""

from __future__ import annotations

import numpy as np

INF = float("inf")


def thresholds(x: np.ndarray, prominence: float, start: float = INF) -> np.ndarray:
    """For each place the lowest height that stands out against all values before it; one more
    element at the end gives the state after the last value."""
    out = np.empty(len(x) + 1)
    state = start
    for i, v in enumerate(x.tolist()):
        out[i] = state
        state = v if state < v else min(state, v + prominence)
    out[-1] = state
    return out


def clamp_of(x: np.ndarray, prominence: float) -> tuple[float, float]:
    """The interval a whole slice clamps an incoming state to."""
    return thresholds(x, prominence, -INF)[-1], thresholds(x, prominence, INF)[-1]


def stands_out(x: np.ndarray, prominence: float, left: float = INF, right: float = INF) -> np.ndarray:
    before = thresholds(x, prominence, left)[:-1]
    behind = thresholds(x[::-1], prominence, right)[:-1][::-1]
    return (x >= before) & (x >= behind)
