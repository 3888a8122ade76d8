"""SuperMinHash signatures (Ertl 2017) of many sets at once.

Each element draws a random permutation of the slots, and in its round j puts the rank value j plus
a random fraction into slot perm[j]; a slot keeps the least value.  Ranks of one element are
correlated, so no slot is left out and the estimate has a lower variance than MinHash.  All sets
take round j together; a set stops as soon as each of its slots holds a value below the next round,
so large sets need one round and the work is about max(size, slots * ln(slots)) for each set.
"""

from __future__ import annotations

import numpy as np

from wayflux.llm.shingles import mixed

_ODD = 0x9E3779B97F4A7C15
_LOW = np.uint64(0xFFFFFFFF)


def signatures(sets: list[np.ndarray], slots: int) -> np.ndarray:
    """One row of ``slots`` values for each set: round in the high, fraction in the low 32 bits.
    The row of an empty set holds the largest value throughout.  ``slots`` is at most 256."""
    sizes = np.fromiter(map(len, sets), dtype=np.int64, count=len(sets))
    signs = np.full(len(sets) * slots, np.iinfo(np.uint64).max, dtype=np.uint64)
    element = np.concatenate(sets) if sets else np.zeros(0, np.uint64)
    owner = np.repeat(np.arange(len(sets)), sizes)
    perm = None
    for j in range(slots):
        drawn = mixed(element + np.uint64((j + 1) * _ODD % 2**64))
        k = j + (((drawn & _LOW) * np.uint64(slots - j)) >> np.uint64(32)).astype(np.int64)
        slot = k
        if perm is not None:
            rows = np.arange(len(element))
            slot = perm[rows, k].astype(np.int64)
            perm[rows, k] = perm[:, j]
            perm[:, j] = slot
        np.minimum.at(signs, owner * slots + slot, (drawn >> np.uint64(32)) | np.uint64(j << 32))
        open_sets = (signs.reshape(len(sets), slots).max(axis=1, initial=0)
                     > np.uint64((j << 32) | int(_LOW)))
        stay = open_sets[owner]
        if not stay.any():
            break
        if perm is None:
            perm = np.tile(np.arange(slots, dtype=np.uint8), (int(stay.sum()), 1))
            rows = np.arange(len(perm))
            k = k[stay]
            perm[rows, k] = 0
            perm[:, 0] = k
        else:
            perm = perm[stay]
        element, owner = element[stay], owner[stay]
    return signs.reshape(len(sets), slots)
