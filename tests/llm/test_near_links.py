"""A large group of near copies gives few links, and loses none that joins components."""

from __future__ import annotations

import random

from churnpanel.llm.near_dedup import NearDuplicates


def test_members_of_a_band_give_links_not_pairs(spark, monkeypatch):
    rng = random.Random(5)
    base = [f"w{rng.randrange(10 ** 6)}" for _ in range(200)]
    rows = []
    for i in range(60):
        w = list(base)
        for at in rng.sample(range(200), 5):  # the likeness of two copies lies about the threshold
            w[at] = f"n{i}-{at}"
        rows.append((i, " ".join(w)))
    sets = [{tuple(t.split()[k:k + 3]) for k in range(198)} for _, t in rows]
    root = list(range(60))
    for a in range(60):
        for b in range(a):
            if 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
                old, new = max(root[a], root[b]), min(root[a], root[b])
                root = [new if r == old else r for r in root]
    seen = []
    real = NearDuplicates._linked_in_bands

    def spy(self, members, reps):
        found = real(self, members, reps)
        seen.append((found.count(), members.count()))
        return found

    monkeypatch.setattr(NearDuplicates, "_linked_in_bands", spy)
    got = NearDuplicates(spark.createDataFrame(rows, "doc_id long, text string"), shingle=3, percent=80).run().collect()
    assert {r.doc_id: r.component_id for r in got} == dict(enumerate(root))
    assert len(seen) == 1 and seen[0][0] < seen[0][1]
