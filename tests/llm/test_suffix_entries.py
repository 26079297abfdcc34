"""The passes of the suffix sorting hand on whole lists, also where queues are on disk."""

import random

import numpy as np
import pytest

from churnpanel.llm.induced_sort import CAP, sorted_entries


@pytest.mark.parametrize("memory", [1, 2, 5, 1 << 18])
def test_entries_come_in_lists(memory):
    rng = random.Random(memory)
    for size, kinds in ((0, 1), (1, 1), (40, 1), (200, 2), (300, 3), (400, 200)):
        t = [rng.randrange(1, kinds + 1) for _ in range(size)] + [0]
        parts = list(sorted_entries(np.array(t, np.uint16), memory))
        assert all(parts) and sum(map(len, parts)) == len(t)
        # a list is a queue or a part of one, not one entry
        assert memory < 5 or len(parts) <= 2 * (kinds + 1) + len(t) // memory
        order = [entry >> 8 for part in parts for entry in part]
        assert order == sorted(range(len(t)), key=lambda p: t[p:], reverse=True)
        for a, b, entry in zip(order, order[1:], [e for part in parts for e in part][1:]):
            same = next(i for i in range(len(t)) if t[a + i:a + i + 1] != t[b + i:b + i + 1])
            assert entry & 255 == min(same, CAP)
