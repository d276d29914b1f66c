"""Orders of tokens that are made by sorting numbers."""

from __future__ import annotations

import numpy as np

from kpiforge.llm import lm


def test_equal_keys_are_together():
    some = np.random.default_rng(5)
    for n in (0, 1, 2, 1000, 70_000):
        key = lm.mix(some.integers(0, 300, n).astype(np.uint64))
        near = key & np.uint64(0xFF_0000_00FF)  # many alike in their first bits
        for keys in (key, near):
            at = lm._together(keys)
            assert sorted(at.tolist()) == list(range(n))
            assert set(keys[lm._once(keys)].tolist()) == set(keys.tolist())
            one, of = lm._distinct(keys)
            assert (keys[one][of] == keys).all()
        assert (lm._together(key) == np.argsort(key >> np.uint64(n.bit_length()), kind="stable")).all()
