"""The number of sequences that best-fit rounds open, against plain best fit by falling size."""

from bisect import bisect_left, insort
from collections import Counter, defaultdict

import numpy as np
import pytest

from debutlens.llm.packing import best_fit_rounds


def plain_fit(sizes, capacity):
    gaps, opened = [], 0
    for size in sorted(sizes, reverse=True):
        i = bisect_left(gaps, size)
        gap = gaps.pop(i) if i < len(gaps) else capacity
        opened += gap == capacity
        if gap > size:
            insort(gaps, gap - size)
    return opened


def spans_of(sizes, capacity):
    """Each sequence's (offset, size), from the places of the classes."""
    counts = Counter(sizes)
    runs, out = defaultdict(list), defaultdict(list)
    for size, rank, first, offset in best_fit_rounds(dict(counts), capacity):
        runs[size].append((rank, first, offset))
    for size, found in runs.items():
        ends = [r[0] for r in found[1:]] + [counts[size]]
        for (rank, first, offset), end in zip(found, ends, strict=True):
            for k in range(end - rank):
                out[first + k].append((offset, size))
    return out


RNG = np.random.default_rng(5)
CASES = {
    "around half": RNG.integers(300, 701, 20000),
    "any": RNG.integers(1, 1025, 20000),
    "two to five": RNG.integers(200, 501, 20000),
    "a third": np.clip(RNG.normal(345, 20, 20000).astype(int), 1, 1024),
    "many small": RNG.integers(1, 9, 20000),
    "log-normal": np.clip(RNG.lognormal(5, 1, 20000).astype(int), 1, 1024),
    "one": np.array([7]),
    "whole": np.full(50, 1024),
}


@pytest.mark.parametrize("case", CASES)
def test_no_more_sequences_than_plain_best_fit(case):
    sizes = CASES[case].tolist()
    spans = spans_of(sizes, 1024)
    assert sum(map(len, spans.values())) == len(sizes)
    for own in spans.values():
        own.sort()
        ends = [offset + size for offset, size in own]
        assert [offset for offset, _ in own] == [0, *ends[:-1]] and ends[-1] <= 1024
    assert len(spans) <= plain_fit(sizes, 1024) + 2
