"""What a task adds up for the clusters."""

from __future__ import annotations

import numpy as np
import pandas as pd

from dockflow.operators import clusters


def test_a_task_sends_one_frame_for_all_candidates():
    rng = np.random.default_rng(3)
    x = rng.normal(size=(500, 2))
    centres = {k: rng.normal(size=(k, 2)) for k in (1, 4, 30)}
    batches = [pd.DataFrame(x[a:b]) for a, b in ((0, 200), (200, 200), (200, 500))]
    (got,) = clusters._added_up(iter(batches), centres, ["n", "psi", "cost", "s0", "s1"])
    wanted = []
    for k, c in centres.items():
        d = ((x[:, None] - c) ** 2).sum(2)
        for i in range(k):
            own = x[d.argmin(1) == i]
            if len(own):
                wanted.append((k, i, len(own), (own ** 2).sum(), ((own - c[i]) ** 2).sum(), *own.sum(0)))
    assert np.allclose(got.to_numpy(dtype=float), np.array(wanted))
    assert list(clusters._added_up(iter([]), centres, ["n", "psi", "cost", "s0", "s1"])) == []
