"""The packing plan against the dual bound of its linear program."""

import math

import numpy as np
import pytest

from vitrine.llm import packing


def lognormal(n, seed=3):
    v = np.clip(np.random.default_rng(seed).lognormal(5.5, 0.9, n).astype(int) + 1, 1, 1024)
    return dict(zip(*(x.tolist() for x in np.unique(v, return_counts=True))))


SHAPES = {
    "no configuration is full": ({400: 600, 320: 600, 300: 600}, 0.0),
    "evenly spread": ({int(s): 5000 for s in np.linspace(200, 697, 72)}, 0.01),
    "lognormal": (lognormal(100_000), 0.01),
    "thirds and large ones": ({342: 9000, 341: 9000, 340: 5000, 700: 3000, 20: 100}, 0.01),
    "one length": ({600: 777}, 0.0),
    "two or three to a sequence": ({int(s): 999 for s in range(257, 512, 5)}, 0.02),
}


@pytest.mark.parametrize("name", SHAPES)
def test_plans_are_near_the_dual_bound(name):
    histogram, gap = SHAPES[name]
    plan, bound = packing.bounded_plan(histogram)
    held = {}
    for lengths, copies in plan:
        assert sum(lengths) <= packing.CAPACITY and copies > 0
        for s in lengths:
            held[s] = held.get(s, 0) + copies
    assert held == histogram
    n = sum(copies for _, copies in plan)
    assert bound <= n + 1e-6 and n <= math.ceil(bound * (1 + gap) - 1e-6)


def test_dual_prices_are_feasible():
    """No filling of a sequence costs more than 1, by the textbook knapsack."""
    for histogram in (SHAPES["evenly spread"][0], SHAPES["thirds and large ones"][0], lognormal(500)):
        sizes = np.array(sorted(s for s in histogram if s < packing.CAPACITY))
        demand = np.array([histogram[s] for s in sizes.tolist()])
        prices, bound = packing.dual_prices(demand, sizes, packing.CAPACITY, float("inf"), 60)
        best = [0.0] * (packing.CAPACITY + 1)
        for room in range(1, packing.CAPACITY + 1):
            best[room] = max([best[room - 1]] + [best[room - s] + p for s, p in zip(sizes.tolist(), prices.tolist()) if s <= room])
        assert best[-1] <= 1 + 1e-9 and abs(float(demand @ prices) - bound) < 1e-6 * bound
        assert bound >= float(demand @ sizes) / packing.CAPACITY - 1e-6


def test_full_pieces_count_in_the_bound():
    plan, bound = packing.bounded_plan({1024: 5, 600: 2})
    assert sum(n for _, n in plan) == 7 == round(bound)
    assert packing.bounded_plan({}) == ([], 0.0) and packing.bounded_plan({1024: 3}) == ([((1024,), 3)], 3.0)
