"""String similarity for pair scoring.

Tokenizing, sorting and the weighting are Spark expressions; only comparing two
short canonical texts needs Python.  Both measures follow the published
token-ratio definitions over the normalized indel similarity
`2 * LCS(a, b) / (|a| + |b|)`.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F, types as T

# Characters that separate tokens: Java's \s plus the Unicode separators.
SEPARATORS = r"[\s\x1c-\x1f\x85\p{Z}]+"


def _measures():
    """(LCS lengths, token_set ratios) of two lists of canonical texts, pair by pair.

    The LCS is bit-parallel: texts of up to 64 characters side by side in numpy
    words, longer ones with Python integers of any width.  Everything is nested, so a kernel ships by value and works without
    the package being installed on the executors.
    """
    import numpy as np

    def lcs(a: str, b: str) -> int:
        if a == b:
            return len(a)
        positions: dict[str, int] = {}
        for i, ch in enumerate(a):
            positions[ch] = positions.get(ch, 0) | (1 << i)
        full = (1 << len(a)) - 1
        row = full
        for ch in b:
            hits = row & positions.get(ch, 0)
            row = ((row + hits) | (row - hits)) & full
        return len(a) - row.bit_count()

    def codes(texts: list[str], width: int, filler: int) -> np.ndarray:
        """Code points of texts of at most `width` characters, one row each; `filler` is no code point."""
        joined = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
        out = np.full((len(texts), width), filler, dtype=np.uint32)
        out[np.arange(width) < np.fromiter(map(len, texts), dtype=np.int64, count=len(texts))[:, None]] = joined
        return out

    def lcs_all(left: list[str], right: list[str]) -> np.ndarray:
        """`lcs` of many pairs side by side: the same recurrence, a machine word per pair."""
        out = np.zeros(len(left), dtype=np.int64)
        longest = np.maximum(*(np.fromiter(map(len, side), dtype=np.int64, count=len(side)) for side in (left, right)))
        for i in np.flatnonzero(longest > 64):
            out[i] = lcs(left[i], right[i])
        below = 0
        for width, word in ((8, np.uint8), (16, np.uint16), (32, np.uint32), (64, np.uint64)):
            rows = np.flatnonzero((longest > below) & (longest <= width))
            below = width
            if not len(rows):
                continue
            one, other = [left[i] for i in rows], [right[i] for i in rows]
            mine, yours = codes(one, width, 0xFFFFFFFF), codes(other, width, 0xFFFFFFFE).T.copy()
            full = np.packbits(mine != 0xFFFFFFFF, axis=1, bitorder="little").view(word)[:, 0]
            row = full.copy()
            for j in range(max(map(len, other))):
                hits = row & np.packbits(mine == yours[j][:, None], axis=1, bitorder="little").view(word)[:, 0]
                row = ((row + hits) | (row - hits)) & full
            out[rows] = np.bitwise_count(full).astype(np.int64) - np.bitwise_count(row)
        return out

    def token_set_all(left: list[str], right: list[str]) -> np.ndarray:
        texts: dict[str, tuple[set, str]] = {}
        for text in {*left, *right}:
            words = set(text.split())
            texts[text] = words, " ".join(sorted(words))
        out = np.zeros(len(left))
        at, commons, rests_a, rests_b = [], [], [], []
        for i, (a, b) in enumerate(zip(left, right)):
            (mine, all_a), (yours, all_b) = texts[a], texts[b]
            if not mine or not yours:
                continue
            if mine.isdisjoint(yours):
                common, rest_a, rest_b = 0, all_a, all_b
            else:
                common = len(" ".join(mine & yours))
                rest_a, rest_b = " ".join(sorted(mine - yours)), " ".join(sorted(yours - mine))
                if not (rest_a and rest_b):
                    out[i] = 1.0
                    continue
            at.append(i)
            commons.append(common)
            rests_a.append(rest_a)
            rests_b.append(rest_b)
        if at:
            common = np.array(commons)
            a, b = (np.array([len(t) for t in rests]) for rests in (rests_a, rests_b))
            gap = (common > 0).astype(np.int64)
            whole_a, whole_b = common + gap + a, common + gap + b
            apart = 1.0 - (a + b - 2 * lcs_all(rests_a, rests_b)) / (whole_a + whole_b)
            met = np.maximum(apart, np.maximum(1.0 - (1 + a) / (common + whole_a), 1.0 - (1 + b) / (common + whole_b)))
            out[at] = np.where(common > 0, met, apart)
        return out

    return lcs_all, token_set_all


def make_kernel(measure: str):
    """Arrow UDF over two canonical texts: the LCS length (`lcs`) or the token_set ratio (`token_set`)."""
    import numpy as np
    import pandas as pd

    compare = dict(zip(("lcs", "token_set"), _measures()))[measure]

    def batch(left: pd.Series, right: pd.Series) -> pd.Series:
        there = np.flatnonzero(left.notna().to_numpy() & right.notna().to_numpy())
        out = pd.Series([None] * len(left), dtype="Float64")
        if len(there):
            out.iloc[there] = compare(left.to_numpy()[there].tolist(), right.to_numpy()[there].tolist())
        return out

    # The annotations above are text in this module; Spark needs the classes.
    batch.__annotations__ = dict.fromkeys(("left", "right", "return"), pd.Series)
    # Marked nondeterministic so that a filter on the result is not pushed below
    # the projection, which would run the kernel twice.
    return F.pandas_udf(batch, T.DoubleType()).asNondeterministic()


def tokens(value: Column) -> Column:
    return F.filter(F.split(value, SEPARATORS), lambda t: F.length(t) > 0)


def sorted_tokens(value: Column) -> Column:
    """Tokens in code-point order joined by one space: the canonical form token_sort compares."""
    return F.array_join(F.sort_array(tokens(value)), " ")


def distinct_tokens(value: Column) -> Column:
    """Distinct tokens joined by one space: the canonical form token_set compares."""
    return F.array_join(F.array_distinct(tokens(value)), " ")


def sort_ratio(a: Column, b: Column, lcs: Column) -> Column:
    """Normalized indel similarity of two canonical forms."""
    total = F.length(a) + F.length(b)
    return F.when(total == 0, F.lit(1.0)).otherwise(2.0 * lcs / total)


def sort_ratio_bound(a: Column, b: Column) -> Column:
    """Upper bound of `sort_ratio` from the lengths alone."""
    return sort_ratio(a, b, F.least(F.length(a), F.length(b)))


def ratio(method: str, a: Column, b: Column) -> Column:
    """Similarity of two canonical forms by either token measure."""
    if method == "token_sort_ratio":
        return sort_ratio(a, b, make_kernel("lcs")(a, b))
    return make_kernel("token_set")(a, b)
