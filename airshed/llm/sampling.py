"""Windows of a fixed length, sampled by content.

Every window of `length` items is represented by the place of its smallest k-gram hash
(the first, on ties). Equal windows have their representative at the same offset, so
equal windows can only be found among equal representatives, and neighbouring windows
share one: a run of them is one row. About two of `length - k` places are representatives.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np

from . import arrays as A


class Runs(NamedTuple):
    first: np.ndarray  # place of the first window of the run
    last: np.ndarray  # place of its last window
    at: np.ndarray  # place of the representative
    seed: np.ndarray  # hash of the k items there


def runs(grams: np.ndarray, offsets: np.ndarray, length: int, k: int) -> Runs:
    """Runs of all windows that lie inside a row; `grams` are the k-gram hashes of all places."""
    places = A.inside_rows(offsets, length)
    if len(places) == 0:
        z = np.zeros(0, np.int64)
        return Runs(z, z, z, np.zeros(0, np.uint64))
    at = A.first_minima(grams, length - k + 1)[places]
    new = np.ones(len(places), dtype=bool)
    new[1:] = (at[1:] != at[:-1]) | (places[1:] != places[:-1] + 1)
    begin = np.flatnonzero(new)
    end = np.append(begin[1:], len(places)) - 1
    return Runs(places[begin], places[end], at[begin], grams[at[begin]])
