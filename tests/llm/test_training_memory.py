"""Training on a bounded sample keeps no second copy of the texts' hashes."""

from __future__ import annotations

import tracemalloc

import numpy as np

from quizlake.llm import toxicity


def test_fit_holds_one_copy_of_the_hashes():
    rng = np.random.default_rng(7)
    common = rng.integers(0, 2**63, 2_000, dtype=np.uint64)
    rows = [np.unique(np.append(rng.choice(common, 800), rng.integers(0, 2**63, 6_000, dtype=np.uint64))) for _ in range(1_500)]
    size, labels = sum(r.nbytes for r in rows), [i % 2 for i in range(len(rows))]
    tracemalloc.start()
    keys, weights, _ = toxicity.fit(rows, labels, epochs=1)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert not rows and len(keys) == len(weights)
    # the sketch of counts takes 2**24 bytes
    assert peak - 2**24 < size


def test_fit_finds_what_separates_the_texts():
    marks = np.arange(100, 140, dtype=np.uint64)
    rows = [np.append(marks[i % 20 : i % 20 + 3], np.uint64(7 if i % 3 else 9)) for i in range(3_000)]
    keys, weights, _ = toxicity.fit(rows, [int(i % 3 == 0) for i in range(3_000)])
    found = dict(zip(keys.tolist(), weights.tolist(), strict=True))
    assert found[7] < 0 < found[9]
    assert toxicity.fit([np.zeros(0, np.uint64)], [1])[0].size == 0
