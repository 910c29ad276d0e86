"""Every training position is a target."""

import numpy as np

from terraflux.llm import lm


def test_rounds_use_every_position():
    for n in (0, 1, 2, 7, 1000):
        used = np.sort(np.concatenate([lm.positions(n, r) for r in range(lm.ROUNDS)]))
        assert used.tolist() == list(range(n))
