"""Dependent rounding in a node of the tree: words, means, residuals, and steps whatever the fraction."""

from random import Random
from statistics import mean

import pytest

from snapfeed.llm import mixing

FRACTIONS = (0.5, 0.1, 0.01, 0.001, 0.0003, 0.9, 0.9995)


def sized(n, p, size=None):
    random = Random(3)
    sizes = sorted((size or max(1, int(random.lognormvariate(5, 1.2))) for _ in range(n)), reverse=True)
    return [[k * 7919, s, p] for k, s in enumerate(sizes)]


def words(rows):
    return sum(row[1] * row[2] for row in rows)


@pytest.mark.parametrize("p", FRACTIONS)
@pytest.mark.parametrize("size", [None, 100])
def test_words_stay_and_one_row_is_left(p, size):
    rows = sized(2000, p, size)
    before = words(rows)
    mixing.pivot(rows, 5)
    assert words(rows) == pytest.approx(before, rel=1e-9)
    assert sum(0 < row[2] < 1 for row in rows) <= 1 and all(0 <= row[2] <= 1 for row in rows)


def test_steps_grow_with_the_rows_alone(monkeypatch):
    """Whatever the fraction, a row takes a few dozen steps; they were the square of the rows near 0 and 1."""
    steps = 0
    whole = mixing._whole

    def counted(p):
        nonlocal steps
        steps += 1
        return whole(p)

    monkeypatch.setattr(mixing, "_whole", counted)
    for p in FRACTIONS:
        steps = 0
        mixing.pivot(sized(4096, p, 100), 1)
        assert steps <= 40 * 4096, p


@pytest.mark.parametrize("p", [0.02, 0.3, 0.97])
def test_every_row_keeps_its_mean(p):
    """Over many seeds each row is taken as often as its fraction says, large and small ones."""
    seeds, rounds = 4000, []
    for seed in range(seeds):
        rows = [[k, size, p] for k, size in enumerate((900, 300, 290, 120, 100, 100, 31, 30, 8, 1))]
        mixing.pivot(rows, seed)
        rounds.append([row[2] for row in rows])
    for column in zip(*rounds, strict=True):
        assert abs(mean(column) - p) < 5 * (p * (1 - p) / seeds) ** 0.5


def test_mixed_fractions():
    """As at an inner node: any fractions, some of them settled already."""
    random = Random(8)
    rows = [[k, random.randint(1, 500), random.choice([0.0, 1.0, 1e-4, 1 - 1e-4, random.random()])] for k in range(3000)]
    settled = {row[0]: row[2] for row in rows if row[2] in (0.0, 1.0)}
    before = words(rows)
    mixing.pivot(rows, 2)
    assert words(rows) == pytest.approx(before, rel=1e-9) and sum(0 < row[2] < 1 for row in rows) <= 1
    assert all(row[2] == settled.get(row[0], row[2]) for row in rows)
    mixing.pivot([], 1)
