"""The sums and alignments that the operators' inner loops rest on, against plain ones."""

from __future__ import annotations

import numpy as np
import pytest

from twinledger.llm import decontaminate
from twinledger.llm.linededup import common_words


@pytest.mark.parametrize("longest", [1, 16, 400])
def test_sums_of_runs(longest):
    rng = np.random.default_rng(longest)
    rows = rng.integers(-9, 9, (50, 7)).astype(np.float32)
    size = rng.integers(1, longest + 1, 3000)
    edges = np.cumsum(size) - size
    number = rng.integers(0, len(rows), size.sum())
    want = [rows[number[e : e + n]].sum(axis=0) for e, n in zip(edges, size)]
    assert np.array_equal(decontaminate.row_totals(rows, number, edges), want)
    assert np.array_equal(decontaminate.row_sums(rows, number, edges), want)


def test_common_words_of_unlike_lines():
    rng = np.random.default_rng(5)
    for _ in range(200):
        a, b = rng.integers(0, 12, rng.integers(0, 15)).tolist(), rng.integers(4, 30, rng.integers(0, 25)).tolist()
        row = [0] * (len(b) + 1)
        for x in a:
            above = row[:]
            for j, y in enumerate(b):
                row[j + 1] = above[j] + 1 if x == y else max(row[j], above[j + 1])
        assert common_words(a, b) == row[-1]
