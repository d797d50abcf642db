"""A minimal perfect hash over 64-bit keys: cascaded bit arrays, vectorised.

Level by level, every key still unplaced is hashed into a bit array of `GAMMA`
bits per key.  A key alone on its bit is placed there; the others go on to the
next level.  A key's slot is the rank of its bit, so n keys fill slots 0..n-1;
ranks are stored per block of `BLOCK` bits, so finding one costs a few probes,
whatever n is.  Keys outside the set get
some slot too: a stored fingerprint tells them apart.
"""

from __future__ import annotations

import numpy as np

GAMMA = 2
BLOCK = 512
_LEVELS = 64


def mixed(keys: np.ndarray, seed: int) -> np.ndarray:
    """A bijective mix of 64-bit keys per seed (splitmix64)."""
    h = keys.astype(np.int64).view(np.uint64) + np.uint64((0x9E3779B97F4A7C15 * (seed + 1)) & (2**64 - 1))
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def fingerprints(keys: np.ndarray) -> np.ndarray:
    return (mixed(keys, 1000) >> np.uint64(32)).astype("<u4")


def build(keys: np.ndarray) -> list[tuple[bytes, bytes]]:
    """Per level its bit array and the ranks before each block, for distinct keys."""
    levels, rest, placed = [], np.asarray(keys, np.int64), 0
    while len(rest):
        if len(levels) == _LEVELS:
            raise ValueError("keys must be distinct")
        bits = BLOCK * -(-GAMMA * len(rest) // BLOCK)
        spot = (mixed(rest, len(levels)) % np.uint64(bits)).astype(np.int64)
        hits = np.bincount(spot, minlength=bits)
        alone = hits == 1
        in_block = alone.reshape(-1, BLOCK).sum(axis=1)
        ranks = placed + np.cumsum(in_block) - in_block
        levels.append((np.packbits(alone, bitorder="little").tobytes(), ranks.astype("<u4").tobytes()))
        placed += int(in_block.sum())
        rest = rest[hits[spot] > 1]
    return levels


def slots(levels: list[tuple[bytes, bytes]], keys: np.ndarray) -> np.ndarray:
    """The slot of each key; -1 where no level has it.  Reads one block and one rank a level and key."""
    keys = np.asarray(keys, np.int64)
    found, open_ = np.full(len(keys), -1, np.int64), np.arange(len(keys))
    for number, (bits, ranks) in enumerate(levels):
        words = np.frombuffer(bits, "<u8").reshape(-1, BLOCK // 64)
        spot = (mixed(keys[open_], number) % np.uint64(8 * len(bits))).astype(np.int64)
        block, word, bit = spot // BLOCK, spot % BLOCK // 64, (spot % 64).astype(np.uint64)
        here = (words[block, word] >> bit & np.uint64(1)) == 1
        block, word, bit = block[here], word[here], bit[here]
        ones = np.bitwise_count(words[block]).astype(np.int64)
        ones[np.arange(BLOCK // 64) >= word[:, None]] = 0
        inside = np.bitwise_count(words[block, word] & ((np.uint64(1) << bit) - np.uint64(1)))
        found[open_[here]] = np.frombuffer(ranks, "<u4")[block] + ones.sum(axis=1) + inside
        open_ = open_[~here]
    return found
