"""Connected components: of tables by the library's rounds, inside a task in numpy."""

from __future__ import annotations

import numpy as np

from broadsheet.plans.graph import connected

__all__ = ["connected", "forest"]


def forest(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Least place reachable for each of ``n`` places over links ``a[i]`` - ``b[i]``."""
    label = np.arange(n)
    while True:
        low = label.copy()
        np.minimum.at(low, a, label[b])
        np.minimum.at(low, b, label[a])
        low = low[low]
        if (low == label).all():
            return label
        label = low
