"""An exact hash table from short byte strings to numbers, looked up many at a time.

A string of up to ``LONGEST`` bytes is three 64-bit words: its bytes, zeros, and
its length in the last byte, so equal keys mean equal strings. Slots are found
by open addressing in plain arrays, which is compact to send and needs no
object per string.
"""

from __future__ import annotations

import numpy as np

WIDTH = 3
LONGEST = 8 * WIDTH - 1

_MULTIPLIERS = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9], np.uint64)


def padded(data: bytes) -> np.ndarray:
    """The bytes with as many zeros behind them as a key may reach over."""
    return np.frombuffer(data + bytes(8 * WIDTH), np.uint8)


def keys_of(buffer: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Keys of the strings at those places of a ``padded`` buffer, none longer than ``LONGEST``."""
    windows = np.lib.stride_tricks.sliding_window_view(buffer, 8)
    keys = np.empty((len(starts), WIDTH), np.uint64)
    for i in range(WIDTH):
        own = np.clip(lengths - 8 * i, 0, 8)
        some = own > 0
        word = np.zeros(len(starts), np.uint64)
        spare = (8 * (8 - own[some])).astype(np.uint64)
        word[some] = (windows[starts[some] + 8 * i].view("<u8").ravel() << spare) >> spare
        keys[:, i] = word
    keys[:, WIDTH - 1] |= lengths.astype(np.uint64) << np.uint64(56)
    return keys


class ByteTable:
    """Keys to numbers from 0; an unknown key gives -1."""

    def __init__(self, entries: int):
        slots = 1 << max(4, (2 * entries - 1).bit_length())
        self.room = slots // 2
        self.size = 0
        self.keys = np.zeros((slots, WIDTH), np.uint64)
        self.values = np.full(slots, -1, np.int32)

    def _slots(self, keys: np.ndarray) -> np.ndarray:
        mixed = keys[:, 0] * _MULTIPLIERS[0]
        for i in range(1, WIDTH):
            mixed += keys[:, i] * _MULTIPLIERS[i]
        mixed ^= mixed >> np.uint64(31)
        mixed *= np.uint64(0xD6E8FEB86659FD93)
        return (mixed >> np.uint64(32)).astype(np.int64) & (len(self.values) - 1)

    def find(self, keys: np.ndarray) -> np.ndarray:
        slot = self._slots(keys)
        # Most are found or found missing at their first slot; the others go on alone.
        found, on = self._at(slot, keys)
        at = np.flatnonzero(on)
        while len(at):
            slot = (slot[on] + 1) & (len(self.values) - 1)
            found[at], on = self._at(slot, keys[at])
            at = at[on]
        return found

    def _at(self, slot: np.ndarray, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The number of each key if it is in its slot, or -1; and whether another key is there."""
        values, stored = self.values[slot], self.keys[slot]
        same = values >= 0
        taken = same.copy()
        for i in range(WIDTH):
            same &= stored[:, i] == keys[:, i]
        return np.where(same, values, np.int32(-1)), taken & ~same

    def add(self, keys: np.ndarray, values: np.ndarray) -> None:
        """Put in different keys that are not there yet; ``room`` says how many fit."""
        if self.size + len(keys) > self.room:
            raise ValueError("the table is full")
        self.size += len(keys)
        slot = self._slots(keys)
        at = np.arange(len(keys))
        while len(at):
            free = self.values[slot] < 0
            # Of several keys at one free slot the last one written has it; the rest go on.
            self.values[slot[free]] = at[free]
            owner = free & (self.values[slot] == at)
            self.keys[slot[owner]] = keys[at[owner]]
            self.values[slot[owner]] = values[at[owner]]
            # The value may equal a waiting key's number, so owners are taken out at once.
            at, slot = at[~owner], (slot[~owner] + 1) & (len(self.values) - 1)
