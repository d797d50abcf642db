"""Vectorised word and line handling on Arrow string arrays, inside tasks."""

from __future__ import annotations

import sys
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from types import ModuleType

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc

SLICE_BYTES = 1 << 20


def filled(texts: pa.Array) -> pa.Array:
    """The texts as one large-string array, null as empty."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    return pc.fill_null(texts.cast(pa.large_string()), "")


def slices(texts: pa.Array, limit: int = SLICE_BYTES) -> Iterator[tuple[int, pa.Array]]:
    """(first row, texts) in runs of about `limit` bytes; a longer text is a run of its own, never cut."""
    whole = filled(texts)
    ends = np.cumsum(pc.binary_length(whole).to_numpy(zero_copy_only=False))
    start = 0
    while start < len(whole):
        done = ends[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(ends, done + limit, "right")))
        yield start, whole.slice(start, stop - start)
        start = stop


@dataclass
class Pieces:
    """Pieces of several texts in order: code of each piece, its text's row, and the distinct pieces."""

    codes: np.ndarray
    rows: np.ndarray
    distinct: pa.Array
    n_rows: int

    def per_row(self, weights: np.ndarray | None = None) -> np.ndarray:
        return np.bincount(self.rows, weights, self.n_rows).astype(np.int64)


def listed(lists: pa.Array, drop_empty: bool = False) -> Pieces:
    """The strings of a list array."""
    encoded = pc.dictionary_encode(lists.flatten())
    codes = encoded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    offsets = lists.offsets.to_numpy(zero_copy_only=False).astype(np.int64)
    rows = np.repeat(np.arange(len(lists)), np.diff(offsets))
    distinct = encoded.dictionary
    if drop_empty and len(distinct):
        empty = pc.index(distinct, pa.scalar("", distinct.type)).as_py()
        if empty >= 0:
            there = codes != empty
            codes, rows = codes[there], rows[there]
    return Pieces(codes, rows, distinct, len(lists))


def words(texts: pa.Array) -> Pieces:
    """Runs of characters other than U+0020 and U+0009 to U+000D."""
    return listed(pc.ascii_split_whitespace(texts), True)


def split_on(texts: pa.Array, separator: str) -> Pieces:
    return listed(pc.split_pattern(texts, separator))


def pair_codes(left: np.ndarray, right: np.ndarray, n_right: int) -> tuple[np.ndarray, int]:
    """Dense codes of (left, right) and their number; exact while codes stay below 2**31."""
    codes, distinct = pd.factorize(left.astype(np.int64) * max(n_right, 1) + right)
    return codes, len(distinct)


def string_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of large strings and the row of each byte."""
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset:texts.offset + len(texts) + 1]
    data = texts.buffers()[2]
    raw = np.frombuffer(data, np.uint8)[offsets[0]:offsets[-1]] if data is not None else np.zeros(0, np.uint8)
    return raw, np.repeat(np.arange(len(texts), dtype=np.int32), np.diff(offsets))


def process_state(key, build: Callable):
    """What `build` gives, made once per Python process and kept across tasks."""
    kept = sys.modules.setdefault("_kinfold_llm_state", ModuleType("_kinfold_llm_state")).__dict__
    if key not in kept:
        kept[key] = build()
    return kept[key]
