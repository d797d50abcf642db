"""All pairs of a tile of records, scored as matrices.

Where every record of a block meets every other, a row per pair costs more than
its comparison.  A tile is compared as a whole instead: texts once per pair of
distinct texts, agreement of exact columns as matrices, and only the pairs that
reach the floor (or, counted, the number of pairs per score) leave it.
"""

from __future__ import annotations

from collections.abc import Callable

from kinfold.functions.similarity import _measures

LEFT, RIGHT, BOTH = 1, 2, 3
SMALL = 128          # rows of small groups that are compared as one tile
CELLS = 1_000_000    # pairs looked at together
OUT_ROWS = 32_768    # pairs per batch that leaves
REMEMBERED = 1_024   # distinct texts whose token_set ratios a task keeps from tile to tile


def make_tiles(features: list[tuple[str, str, float]], keys: list[tuple[str, ...]], guarded: tuple[str, ...], floor: float,
               same: tuple[str, ...] = (), carried: tuple[str, ...] = (), sure_pairs: bool = False, counted: str | None = None,
               without: tuple[int, int] | None = None) -> Callable:
    """A function for `mapInArrow` over rows in the order of (`__block`, `__row`, `__tile`).

    `features` are (column, method, weight) in the order of the sum, `keys` the deterministic keys, `guarded` the columns
    whose difference is told.  A row is on the left side of its tile, the right one or both (`__side`); two rows
    marked `__once` are taken in the order of their uids only.  Blocks are met in the order of `__blocks`: a pair is taken in the
    first that both are in.  Pairs that a key decides are left out, unless `sure_pairs`; then they come with score 1.

    Rows: uid_1, uid_2, n (product of `n`), score, sim_* of the features that are texts, `equal` and `differ` (bits in the order of
    `exact_columns`), and `<carried>_1`, `<carried>_2`.  `counted` by "score": score, `equal` (one bit per column of `same`) and the sum
    of n, or by "features": sim_* of the texts, `equal` (all bits) and the number of pairs, both summed per task.  Counted pairs
    whose xxhash64(uid_1, uid_2) modulo the first of `without` is the second are left out.
    """
    import numpy as np
    import pyarrow as pa
    import pyarrow.compute as pc

    lcs_all, token_set_all = _measures()
    fuzzy = [(f, method) for f, method, _ in features if method != "exact"]
    columns = exact_columns(features, keys, guarded, same)
    bit = {c: 1 << i for i, c in enumerate(columns)}
    left_side, right_side, small, cells, out_rows, remembered = LEFT, RIGHT, SMALL, CELLS, OUT_ROWS, REMEMBERED

    # ------------------------------------------------------------ texts

    def lcs_matrix(one: list[str], other: list[str]) -> np.ndarray:
        """LCS lengths of all pairs, as in `lcs_all`: bits run along the texts of `other`, steps along those of `one`."""
        out = np.zeros((len(one), len(other)), dtype=np.int32)
        size_one, size_other = (np.fromiter(map(len, side), dtype=np.int64, count=len(side)) for side in (one, other))
        points = [np.frombuffer("".join(side).encode("utf-32-le", "surrogatepass"), dtype=np.uint32) for side in (one, other)]
        chars = np.unique(points[1])
        nothing = len(chars)
        if not nothing:
            return out
        place = np.searchsorted(chars, points[0]).clip(max=nothing - 1)
        place[chars[place] != points[0]] = nothing
        by_size = np.argsort(size_one, kind="stable")
        steps = np.full((len(one), int(size_one.max(initial=0))), nothing, dtype=np.int32)
        steps[np.arange(steps.shape[1]) < size_one[:, None]] = place
        spots = np.full((len(other), int(size_other.max(initial=0))), nothing, dtype=np.int32)
        spots[np.arange(spots.shape[1]) < size_other[:, None]] = np.searchsorted(chars, points[1])
        below = 0
        for width, word in ((8, np.uint8), (16, np.uint16), (32, np.uint32), (64, np.uint64), (int(size_other.max(initial=0)), np.uint64)):
            some = np.flatnonzero((size_other > below) & (size_other <= width))
            below = max(below, width)
            if not len(some):
                continue
            bits = np.dtype(word).itemsize * 8
            words = -(-width // bits)
            marks = np.zeros((words, nothing + 1, len(some)), dtype=word)
            for at in range(min(width, spots.shape[1])):
                marks[at // bits, spots[some, at], np.arange(len(some))] |= word(1 << at % bits)
            marks[:, nothing] = 0
            full = np.bitwise_or.reduce(marks, axis=1)
            most = max(1, 131_072 // (len(some) * words))
            for start in range(0, len(one), most):
                rows = by_size[start:start + most]
                row = np.repeat(full[:, None], len(rows), axis=1)
                for j in range(int(size_one[rows[-1]])):
                    carry = None
                    for w in range(words):
                        hits = marks[w].take(steps[rows, j], axis=0)
                        hits &= row[w]
                        total = row[w] + hits
                        if words > 1:
                            over = total < hits
                            if carry is not None:
                                total += carry
                                over |= total < carry
                            carry = over.astype(word)
                        row[w] -= hits
                        row[w] |= total
                left_out = np.bitwise_count(row & full[:, None]).sum(axis=0, dtype=np.int32)
                out[np.ix_(rows, some)] = size_other[some].astype(np.int32) - left_out
        return out

    def sort_ratios(one: list[str], other: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(codes, ratio of each code) of all pairs of canonical forms."""
        lengths = [np.fromiter(map(len, side), dtype=np.int64, count=len(side)) for side in (one, other)]
        found = lcs_matrix(one, other)
        base = int(max(side.max(initial=0) for side in lengths)) + 1
        kind = np.int32 if base < 30_000 else np.int64
        found = found.astype(kind, copy=False)
        found += (lengths[0].astype(kind) * base)[:, None]
        found += (lengths[1].astype(kind) * base)[None, :]
        there = np.flatnonzero(np.bincount(found.ravel(), minlength=1)) if base < 500 else np.unique(found)
        total, common = np.divmod(there, base)
        values = np.where(total == 0, 1.0, 2.0 * common / np.maximum(total, 1))
        return np.searchsorted(there, found).astype(np.int32) if base >= 500 else placed(there, found), values

    def placed(there: np.ndarray, found: np.ndarray) -> np.ndarray:
        place = np.zeros(int(there.max(initial=0)) + 1, dtype=np.int32)
        place[there] = np.arange(len(there), dtype=np.int32)
        return place[found]

    def set_ratios(one: list[str], other: list[str]) -> np.ndarray:
        words = [[set(t.split()) for t in side] for side in (one, other)]
        joined = [[" ".join(sorted(w)) for w in side] for side in words]
        lengths = [np.fromiter(map(len, side), dtype=np.int64, count=len(side)) for side in joined]
        total = lengths[0][:, None] + lengths[1][None, :]
        out = 1.0 - (total - 2 * lcs_matrix(*joined)) / np.maximum(total, 1)
        for side, axis in ((0, out), (1, out.T)):
            axis[lengths[side] == 0] = 0.0
        holders: dict[str, list[int]] = {}
        for j, w in enumerate(words[1]):
            for token in w:
                holders.setdefault(token, []).append(j)
        for i, w in enumerate(words[0]):
            near = sorted(set().union(*[holders.get(token, ()) for token in w])) if w else []
            if near:
                out[i, near] = token_set_all([one[i]] * len(near), [other[j] for j in near])
        return out

    known: dict[str, int] = {}
    numbers: dict[float, int] = {}
    memory = np.zeros((0, 0), dtype=np.int32)

    def kept_set_ratios(one: list[str], other: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """`set_ratios` as codes and values; texts that come again in other tiles are measured once."""
        nonlocal memory
        news = list(dict.fromkeys(t for side in (one, other) for t in side if t not in known))
        if len(known) + len(news) > remembered:
            known.clear()
            numbers.clear()
            news = list(dict.fromkeys([*one, *other]))
        if len(news) > remembered:
            values, codes = np.unique(set_ratios(one, other), return_inverse=True)
            return codes.reshape(len(one), len(other)).astype(np.int32), values
        if news:
            olds = list(known)
            for t in news:
                known[t] = len(known)
            values, codes = np.unique(set_ratios(news, [*olds, *news]), return_inverse=True)
            number = np.fromiter((numbers.setdefault(float(v), len(numbers)) for v in values), dtype=np.int32, count=len(values))
            grown = np.zeros((len(known), len(known)), dtype=np.int32)
            grown[:len(olds), :len(olds)] = memory[:len(olds), :len(olds)]
            grown[len(olds):] = number[codes].reshape(len(news), len(known))
            grown[:len(olds), len(olds):] = grown[len(olds):, :len(olds)].T
            memory = grown
        at = [np.fromiter((known[t] for t in side), dtype=np.int64, count=len(side)) for side in (one, other)]
        found = memory[np.ix_(*at)]
        there = np.flatnonzero(np.bincount(found.ravel(), minlength=1))
        return placed(there, found), np.fromiter(numbers, dtype=np.float64, count=len(numbers))[there]

    def similarities(method: str, texts: pa.Array, li: np.ndarray, ri: np.ndarray):
        """(code matrix of distinct texts, its left and right index per row, ratio per code); NULL contributes nothing."""
        coded = texts.dictionary_encode()
        names = coded.dictionary.to_pylist()
        number = coded.indices.fill_null(len(names)).to_numpy(zero_copy_only=False)
        (mine, at_l), (yours, at_r) = (np.unique(number[side], return_inverse=True) for side in (li, ri))
        one, other = ([names[i] for i in side if i < len(names)] for side in (mine, yours))
        codes, values = (sort_ratios if method == "token_sort_ratio" else kept_set_ratios)(one, other)
        if len(one) < len(mine) or len(other) < len(yours):
            wide = np.full((len(mine), len(yours)), len(values), dtype=np.int32)
            wide[:len(one), :len(other)] = codes
            codes, values = wide, np.append(values, 0.0)
        return codes, at_l, at_r, values

    # ------------------------------------------------------------ scores

    def rounded(x: np.ndarray) -> np.ndarray:
        """Four digits, halves up in the decimal form of the number, as Spark rounds."""
        from decimal import ROUND_HALF_UP, Decimal

        scaled = x * 1e4
        out = np.floor(scaled + 0.5)
        for i in np.flatnonzero(np.abs(scaled - np.floor(scaled) - 0.5) < 1e-6):
            out[i] = int(Decimal(repr(float(x[i]))).scaleb(4).quantize(Decimal(1), rounding=ROUND_HALF_UP))
        return out / 1e4

    def is_sure(equal: np.ndarray) -> np.ndarray:
        out = np.zeros(len(equal), dtype=bool)
        for key in keys:
            wanted = sum(bit[c] for c in set(key))
            out |= (equal & wanted) == wanted
        return out

    def scores(texts: np.ndarray, equal: np.ndarray, values: list[np.ndarray]) -> tuple[np.ndarray, list[np.ndarray]]:
        """(score, or -1 for pairs left out; similarity per text feature) of numbered combinations of ratios and equal columns."""
        sims: dict[str, np.ndarray] = {}
        for (f, _), v in reversed(list(zip(fuzzy, values))):
            texts, code = np.divmod(texts, len(v))
            sims[f] = v[code]
        total = np.zeros(len(texts))
        for f, method, weight in features:
            total = total + weight * (sims[f] if method != "exact" else ((equal & bit[f]) > 0).astype(np.float64))
        score = rounded(total)
        left_out = np.where(is_sure(equal), 1.0 if sure_pairs else -1.0, np.where(score >= floor, score, -1.0))
        return left_out, [sims[f] for f, _ in fuzzy]

    # ------------------------------------------------------------ tiles

    def codes_of(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
        column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
        return column.dictionary_encode().indices.fill_null(-1).to_numpy(zero_copy_only=False).astype(np.int32)

    def block_codes(t: pa.Table) -> tuple[np.ndarray, np.ndarray]:
        """(blocks of each row as numbers in their order, -1 beyond the last; the block it is met in)."""
        lists = t.column("__blocks").combine_chunks()
        flat = lists.flatten().to_pylist()
        names = {b: i for i, b in enumerate(sorted(set(flat)))}
        lengths = lists.value_lengths().to_numpy(zero_copy_only=False)
        out = np.full((len(t), int(lengths.max(initial=0))), -1, dtype=np.int32)
        out[np.arange(out.shape[1]) < lengths[:, None]] = [names[b] for b in flat]
        return out, np.fromiter((names[b] for b in t.column("__block").to_pylist()), dtype=np.int32, count=len(t))

    def tile(t: pa.Table, group: np.ndarray | None):
        """(left rows, right rows, score, similarities, equal, differ) of the pairs of a tile, in pieces."""
        side = t.column("__side").to_numpy()
        li, ri = np.flatnonzero(side & left_side), np.flatnonzero(side & right_side)
        if not len(li) or not len(ri):
            return
        rank = pc.rank(t.column("uid").combine_chunks(), tiebreaker="dense").to_numpy().astype(np.int32)
        once = t.column("__once").to_numpy(zero_copy_only=False)
        weight = t.column("n").to_numpy()
        blocks, block = block_codes(t)
        exact = [codes_of(t.column(c)) for c in columns]
        texts = [similarities(m, t.column(f"__{f}").combine_chunks(), li, ri) for f, m in fuzzy]
        values = [v for *_, v in texts]
        strides = np.cumprod([1, *[len(v) for v in reversed(values)]], dtype=np.int64)[::-1]
        spread = int(strides[0])
        # Few ratios occur in a tile: scores are then looked up, per set of equal columns that is met.
        is_short = spread <= 1 << 22 and spread <= 4 * len(li) * len(ri)
        places = [(codes.astype(np.int64) * stride).astype(np.int32) if is_short else codes * stride
                  for (codes, *_), stride in zip(texts, strides[1:])]
        slots = np.full(1 << len(columns), -1, dtype=np.int64)
        score, sims, equal = np.zeros(0), [np.zeros(0) for _ in fuzzy], np.zeros(0, dtype=np.int64)
        ordered = bool(once.all())
        earlier = [(x, y) for x in range(blocks.shape[1]) for y in range(blocks.shape[1])
                   if ((blocks[li, x] >= 0) & (blocks[li, x] < block[li])).any() and ((blocks[ri, y] >= 0) & (blocks[ri, y] < block[ri])).any()]
        most = max(1, cells // len(ri))
        for start in range(0, len(li), most):
            rows = li[start:start + most]
            before = rank[rows][:, None] < rank[ri][None, :]
            taken = before if ordered else before | ((rank[rows][:, None] != rank[ri][None, :]) & ~(once[rows][:, None] & once[ri][None, :]))
            if group is not None:
                taken &= group[rows][:, None] == group[ri][None, :]
            for x, y in earlier:
                mine = blocks[rows, x]
                taken &= (mine[:, None] != blocks[ri, y][None, :]) | ((mine < 0) | (mine >= block[rows]))[:, None]
            same_as = np.zeros(taken.shape, dtype=np.uint8 if len(columns) <= 8 else np.int32)
            for c, code in zip(columns, exact):
                mine = code[rows]
                agree = mine[:, None] == code[ri][None, :]
                if (mine < 0).any():
                    agree &= (mine >= 0)[:, None]
                same_as |= agree.astype(same_as.dtype) * same_as.dtype.type(bit[c])
            combo = np.zeros(taken.shape, dtype=np.int32 if is_short else np.int64)
            for (_, at_l, at_r, _), place in zip(texts, places):
                combo += place.take(at_l[start:start + most], axis=0).take(at_r, axis=1)
            if is_short:
                for mask in np.flatnonzero(np.bincount(same_as.ravel())):
                    if slots[mask] < 0:
                        slots[mask] = len(score)
                        more, ratios = scores(np.arange(spread), np.full(spread, mask), values)
                        score, equal = np.append(score, more), np.append(equal, np.full(spread, mask))
                        sims = [np.append(x, y) for x, y in zip(sims, ratios)]
                number = slots.take(same_as.ravel())
                number += combo.ravel()
                at = np.flatnonzero((score >= 0).take(number) & taken.ravel())
                number = number[at]
            else:
                at = np.flatnonzero(taken)
                there, number = np.unique((combo.ravel()[at] << len(columns)) + same_as.ravel()[at], return_inverse=True)
                equal = there & ((1 << len(columns)) - 1)
                score, sims = scores(there >> len(columns), equal, values)
                met = np.flatnonzero(score.take(number) >= 0)
                at, number = at[met], number[met]
            if len(at):
                l, r = np.divmod(at, len(ri))
                yield rows[l], ri[r], number, score, sims, equal, rank, weight, exact

    def listed(t: pa.Table, found):
        for left, right, number, score, sims, equal, rank, weight, exact in found:
            flip = rank[left] > rank[right]
            one, other = np.where(flip, right, left), np.where(flip, left, right)
            for start in range(0, len(one), out_rows):
                a, b, at = (x[start:start + out_rows] for x in (one, other, number))
                differ = np.zeros(len(a), dtype=np.int32)
                for c, code in zip(columns, exact):
                    if c in guarded:
                        differ |= np.where((code[a] >= 0) & (code[b] >= 0) & (code[a] != code[b]), bit[c], 0).astype(np.int32)
                first, second = (t.take(pa.array(x)) for x in (a, b))
                arrays = {"uid_1": first.column("uid"), "uid_2": second.column("uid"), "n": weight[a] * weight[b], "score": score[at]}
                arrays |= {f"sim_{f}": s[at] for (f, _), s in zip(fuzzy, sims)}
                arrays |= {"equal": equal[at].astype(np.int32), "differ": differ}
                for c in carried:
                    arrays |= {f"{c}_1": first.column(c), f"{c}_2": second.column(c)}
                whole = {k: v.combine_chunks() if isinstance(v, pa.ChunkedArray) else pa.array(v) for k, v in arrays.items()}
                yield pa.RecordBatch.from_arrays(list(whole.values()), names=list(whole))

    def tiles(held: pa.Table, starts: np.ndarray):
        """Tiles of whole groups; small groups in succession go together."""
        at = 0
        while at < len(starts) - 1:
            last = at + 1
            while last < len(starts) - 1 and starts[last + 1] - starts[at] <= small:
                last += 1
            piece = held.slice(starts[at], starts[last] - starts[at]).combine_chunks()
            group = None
            if last > at + 1:
                group = np.repeat(np.arange(last - at, dtype=np.int32), np.diff(starts[at:last + 1]))
            yield piece, group
            at = last

    def run(batches):
        by_score, by_features = np.zeros(10_001 << len(same), dtype=np.int64), {}
        for piece, group in arrived(batches):
            found = tile(piece, group)
            if counted is None:
                yield from listed(piece.select(["uid", *carried]), found)
                continue
            held = pair_hashes(piece.column("uid")) if without else None
            for left, right, number, score, sims, equal, rank, weight, _ in found:
                if held:
                    flip = rank[left] > rank[right]
                    inside = held(np.where(flip, right, left), np.where(flip, left, right)) % without[0] != without[1]
                    left, right, number = left[inside], right[inside], number[inside]
                single = counted == "features" or (weight == 1).all()
                n = np.bincount(number, weights=None if single else (weight[left] * weight[right]).astype(np.float64))
                there = np.flatnonzero(n)
                if counted == "features":
                    for kind in zip(*[x[there].tolist() for x in (*sims, equal, n)]):
                        by_features[kind[:-1]] = by_features.get(kind[:-1], 0) + kind[-1]
                    continue
                place = np.rint(score[there] * 1e4).astype(np.int64) << len(same)
                for i, c in enumerate(same):
                    place |= ((equal[there] & bit[c]) > 0).astype(np.int64) << i
                by_score += np.rint(np.bincount(place, weights=n[there], minlength=len(by_score))).astype(np.int64)
        there = np.flatnonzero(by_score)
        if len(there):
            yield pa.RecordBatch.from_arrays([pa.array((there >> len(same)) / 1e4), pa.array((there & ((1 << len(same)) - 1)).astype(np.int32)),
                                              pa.array(by_score[there])], names=["score", "equal", "n"])
        kinds = list(by_features)
        for start in range(0, len(kinds), out_rows):
            some = kinds[start:start + out_rows]
            types = [*[pa.float64()] * len(fuzzy), pa.int32()]
            yield pa.RecordBatch.from_arrays([*[pa.array(x, t) for x, t in zip(zip(*some), types)], pa.array([by_features[k] for k in some], pa.int64())],
                                             names=[*[f"sim_{f}" for f, _ in fuzzy], "equal", "n"])

    def pair_hashes(uids: pa.ChunkedArray):
        """xxhash64(uid_1, uid_2) of pairs of rows: the hash of the first seeds that of the second."""
        P1, P2, P3, P4, P5 = (np.uint64(p) for p in (0x9E3779B185EBCA87, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x85EBCA77C2B2AE63, 0x27D4EB2F165667C5))
        texts = [u.encode() for u in uids.to_pylist()]
        size = np.fromiter(map(len, texts), dtype=np.int64, count=len(texts))
        lengths = np.unique(size)
        place = np.zeros(len(texts), dtype=np.int64)
        words, rests = {}, {}
        for length in lengths:
            rows = np.flatnonzero(size == length)
            place[rows] = np.arange(len(rows))
            data = np.frombuffer(b"".join(texts[i] for i in rows), dtype=np.uint8).reshape(len(rows), length)
            words[length] = np.ascontiguousarray(data[:, :length // 8 * 8]).view("<u8").T * P2
            rests[length] = np.ascontiguousarray(data[:, length // 8 * 8:])

        def turned(x, n):
            return (x << np.uint64(n)) | (x >> np.uint64(64 - n))

        def hashed(seed, rows, length):
            """Hash of texts of one length, with a seed each."""
            at, lanes, rest = place[rows], words[length], rests[length]
            done = 0
            if length >= 32:
                v = [seed + P1 + P2, seed + P2, seed.copy(), seed - P1]
                while done + 4 <= len(lanes):
                    v = [turned(x + lanes[done + k].take(at), 31) * P1 for k, x in enumerate(v)]
                    done += 4
                out = turned(v[0], 1) + turned(v[1], 7) + turned(v[2], 12) + turned(v[3], 18)
                for x in v:
                    out = (out ^ (turned(x * P2, 31) * P1)) * P1 + P4
            else:
                out = seed + P5
            out = out + np.uint64(length)
            for lane in lanes[done:]:
                out = turned(out ^ (turned(lane.take(at), 31) * P1), 27) * P1 + P4
            done = 0
            if rest.shape[1] >= 4:
                whole = np.ascontiguousarray(rest[:, :4]).view("<u4")[:, 0].astype(np.uint64)
                out = turned(out ^ (whole.take(at) * P1), 23) * P2 + P3
                done = 4
            for k in range(done, rest.shape[1]):
                out = turned(out ^ (rest[:, k].astype(np.uint64).take(at) * P5), 11) * P1
            out = (out ^ (out >> np.uint64(33))) * P2
            out = (out ^ (out >> np.uint64(29))) * P3
            return out ^ (out >> np.uint64(32))

        def by_length(seed, rows):
            out = np.zeros(len(rows), dtype=np.uint64)
            for length in lengths:
                some = np.flatnonzero(size[rows] == length) if len(lengths) > 1 else slice(None)
                out[some] = hashed(seed[some], rows[some], int(length))
            return out

        every = np.arange(len(texts))
        first = by_length(np.full(len(texts), 42, dtype=np.uint64), every)
        return lambda one, other: by_length(first[one], other).view(np.int64)

    def arrived(batches):
        """Whole tiles, from rows in their order."""
        held = None
        for batch in batches:
            held = pa.Table.from_batches([*(held.to_batches() if held is not None else []), batch])
            if not len(held):
                continue
            new = np.zeros(len(held), dtype=bool)
            new[0] = True
            for c in ("__block", "__row", "__tile"):
                column = held.column(c).combine_chunks()
                new[1:] |= pc.not_equal(column[1:], column[:-1]).to_numpy(zero_copy_only=False)
            starts = np.flatnonzero(new)
            yield from tiles(held, starts)
            held = held.slice(starts[-1])
        if held is not None and len(held):
            yield from tiles(held, np.array([0, len(held)]))

    return run


def exact_columns(features: list[tuple[str, str, float]], keys: list[tuple[str, ...]], guarded: tuple[str, ...],
                  same: tuple[str, ...] = ()) -> list[str]:
    """Columns compared for equality, in the order of their bits."""
    exact = [f for f, method, _ in features if method == "exact"]
    return list(dict.fromkeys([*exact, *[c for key in keys for c in key], *guarded, *same]))
