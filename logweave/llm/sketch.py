"""Fast similarity sketches (Dahlgaard, Knudsen and Thorup, FOCS 2017)."""

from __future__ import annotations

import numpy as np

from logweave.llm.common import GOLD, mix

BINS = 128
EMPTY = np.uint64(0xFFFFFFFFFFFFFFFF)


def similarity_sketch(sets: list[np.ndarray], bins: int = BINS) -> np.ndarray:
    """(len(sets), bins) uint64 sketch; rows of empty sets stay EMPTY. ``bins``: a power of two."""
    out = np.full(len(sets) * bins, EMPTY, np.uint64)
    owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    items = np.concatenate(sets) if sets else np.empty(0, np.uint64)
    round_shift = np.uint64(64 - (2 * bins - 1).bit_length())
    shift = np.uint64(64 - bins.bit_length() + 1)
    for i in range(2 * bins):
        if not len(items):
            break
        x = mix(items + np.uint64((i + 1) * int(GOLD) % 2**64))
        slot = (x >> shift).astype(np.int64) if i < bins else i - bins
        value = (np.uint64(i) << round_shift) | (mix(x + GOLD) >> (np.uint64(64) - round_shift))
        np.minimum.at(out, owner * bins + slot, value)
        if i < 4 or i % 8 == 0 or i >= bins:  # rows whose bins are all filled are done
            active = (out.reshape(-1, bins) == EMPTY).any(axis=1)[owner]
            if not active.all():
                items, owner = items[active], owner[active]
    return out.reshape(-1, bins)


def sketch_bits(sets: list[np.ndarray], bits: int) -> np.ndarray:
    """(len(sets), bits // 64) int64: one bit of each coordinate of a sketch of ``bits`` bins.

    Two sets' bits agree with probability (1 + similarity) / 2.
    """
    low = (similarity_sketch(sets, bits) & np.uint64(1)).astype(np.uint8)
    return np.packbits(low, axis=1).view(np.int64)
