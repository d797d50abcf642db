"""BPE encoding and decoding: speculate and verify, per distinct word.

Words are split at ASCII white space, which the tokenizer drops and which no
token crosses, so a text's ids are the ids of its words in a row.  A batch works
on its distinct words.  For each pre-token, greedy longest match over the
vocabulary proposes tokens; all adjacent pairs of the batch are then tested at
once for compatibility (merging the two tokens' symbols gives those two tokens
again).  A sequence whose pairs are all compatible is what exact merging gives;
only the other words are merged exactly, by rank with a heap.

Ids equal those of the tokenizers library with the same file and
add_special_tokens=False; decoding equals its decode(ids, skip_special_tokens=
False) for files without a decoder: the tokens joined by spaces.  Ids are binary,
little-endian unsigned 32-bit.

Defined results: a null or empty text has no ids and decodes to an empty text;
null ids decode to an empty text; special tokens written out in a text get their
id, as the library does; unknown ids are skipped in decoding; words and texts
may have any length.  Memory: a cache of at most `CACHE_WORDS` words per process.
"""

from __future__ import annotations

import heapq
import json
import re
import sys
from array import array

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F

from kinfold.llm import arrow_text
from kinfold.llm.arrow_text import process_state

TOKENIZER = public_tokenizers.path("word_bpe_49k.json")
CACHE_WORDS = 150_000
SLICE_BYTES = 2 << 20
END = "</w>"
#: Below this code point, Unicode categories and case are settled, so the pattern is applied here directly.
PLAIN_BELOW = "ɐ"


def byte_symbols() -> list[str]:
    """The printable character that stands for each byte: itself, or the next free one from U+0100."""
    own = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    spare = iter(range(0x100, 0x200))
    return [chr(b) if b in own else chr(next(spare)) for b in range(256)]


class WordBpe:
    """One tokenizer file: its word pattern, vocabulary and merges."""

    def __init__(self, path: str):
        import regex
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        self.library = Tokenizer.from_file(path)
        self.vocab: dict[str, int] = spec["model"]["vocab"]
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.tokens = {i: t for t, i in [*self.vocab.items(), *self.special.items()]}
        vocab = self.vocab
        self.merges = {(vocab[a], vocab[b]): (rank, vocab[a + b])
                       for rank, (a, b) in enumerate(map(tuple, spec["model"]["merges"]))}
        self.longest = max(map(len, vocab))
        self.pattern = regex.compile(spec["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"])
        self.cut = re.compile("(" + "|".join(map(re.escape, self.special)) + ")") if self.special else None
        self.bytes = byte_symbols()
        self.known: dict[str, bytes] = {s: np.array([i], "<u4").tobytes() for s, i in self.special.items()}
        self.pairs: dict[int, bool] = {}
        self.sound: dict[int, bool] = {}

    def pretokens(self, word: str) -> list[str]:
        """Pre-tokens of a word in byte symbols; a special token as such."""
        if word.isascii():  # the two commonest forms need no pattern: letters, and letters with one mark behind
            if word.isalpha():
                return [word.lower()]
            if word[-1] in ".," and word[:-1].isalpha():
                return [word[:-1].lower(), word[-1]]
        if max(word) < PLAIN_BELOW and "<|" not in word:
            found = self.pattern.findall(word.lower())
            return found if word.isascii() and word.isprintable() else ["".join(map(self.bytes.__getitem__, p.encode())) for p in found]
        out = []
        for part in self.cut.split(word) if self.cut else [word]:
            if part in self.special:
                out.append(part)
            elif part:
                plain = self.library.normalizer.normalize_str(part)
                out += [p for p, _ in self.library.pre_tokenizer.pre_tokenize_str(plain)]
        return out

    def symbols(self, pretoken: str) -> list[int]:
        return [self.vocab[c] for c in pretoken[:-1]] + [self.vocab[pretoken[-1] + END]]

    def token_symbols(self, token: int) -> list[int]:
        text = self.tokens[token]
        return self.symbols(text.removesuffix(END)) if text.endswith(END) and text != END else [self.vocab[c] for c in text]

    def merged(self, ids: list[int]) -> list[int]:
        """Exact merging: lowest rank first, leftmost among equals."""
        n, merges = len(ids), self.merges
        if n <= 32:
            return self._merged_short(list(ids))
        ids, after, before = list(ids), list(range(1, n + 1)), list(range(-1, n - 1))
        heap = [(m[0], i, ids[i], ids[i + 1], m[1]) for i in range(n - 1) if (m := merges.get((ids[i], ids[i + 1])))]
        heapq.heapify(heap)
        while heap:
            _, i, left, right, new = heapq.heappop(heap)
            j = after[i]
            if ids[i] != left or j >= n or ids[j] != right:
                continue
            ids[i], ids[j], after[i] = new, -1, after[j]
            if after[j] < n:
                before[after[j]] = i
                if m := merges.get((new, ids[after[j]])):
                    heapq.heappush(heap, (m[0], i, new, ids[after[j]], m[1]))
            if before[i] >= 0 and (m := merges.get((ids[before[i]], new))):
                heapq.heappush(heap, (m[0], before[i], ids[before[i]], new, m[1]))
        return [i for i in ids if i >= 0]

    def _merged_short(self, ids: list[int]) -> list[int]:
        """The same by scanning all ranks, quicker for few symbols."""
        get, none = self.merges.get, (1 << 30, 0)
        moves = [get(pair, none) for pair in zip(ids, ids[1:])]
        while moves:
            best = min(moves)
            if best is none:
                break
            i = moves.index(best)
            ids[i] = best[1]
            del ids[i + 1], moves[i]
            if i < len(moves):
                moves[i] = get((ids[i], ids[i + 1]), none)
            if i:
                moves[i - 1] = get((ids[i - 1], ids[i]), none)
        return ids

    def proposed(self, pretoken: str) -> list[int]:
        """Greedy longest match; the last piece carries the word end."""
        vocab, longest, n, at, out = self.vocab, self.longest, len(pretoken), 0, []
        while n - at > longest or (piece := pretoken[at:] + END) not in vocab:
            end = min(n - 1, at + longest)
            while (piece := pretoken[at:end]) not in vocab:
                end -= 1
            out.append(vocab[piece])
            at = end
        out.append(vocab[piece])
        return out

    def _compatible(self, left: int, right: int) -> bool:
        return self.merged(self.token_symbols(left) + self.token_symbols(right)) == [left, right]

    def _sound(self, token: int) -> bool:
        """Does merging a token's own symbols give the token?"""
        if token not in self.sound:
            self.sound[token] = self.merged(self.token_symbols(token)) == [token]
        return self.sound[token]

    def verified(self, proposals: list[list[int]]) -> np.ndarray:
        """Which proposals hold: every token sound, every adjacent pair compatible."""
        flat = np.fromiter((t for p in proposals for t in p), np.int64)
        lengths = np.fromiter(map(len, proposals), np.int64, len(proposals))
        owner = np.repeat(np.arange(len(proposals)), lengths)
        good = np.ones(len(proposals), bool)
        tokens, at = np.unique(flat, return_inverse=True)
        sound = np.fromiter(map(self._sound, tokens.tolist()), bool, len(tokens))
        good[owner[~sound[at]]] = False
        inside = np.flatnonzero(owner[:-1] == owner[1:])
        pairs, at = np.unique(flat[inside] << 20 | flat[inside + 1], return_inverse=True)
        known, fits = self.pairs, np.empty(len(pairs), bool)
        for k, pair in enumerate(pairs.tolist()):
            fit = known.get(pair)
            if fit is None:
                fit = self._compatible(pair >> 20, pair & 0xFFFFF)
                if len(known) < CACHE_WORDS:
                    known[pair] = fit
            fits[k] = fit
        good[owner[inside[~fits[at]]]] = False
        return good

    def encode_words(self, words: list[str]) -> list[bytes]:
        """Id bytes of each word."""
        known, pretokens = self.known, self.pretokens
        split = [pretokens(w) if w else [] for w in words]
        new = list({p for s in split for p in s if p not in known})
        proposals = list(map(self.proposed, new))
        good = self.verified(proposals) if proposals else ()
        found = {p: array("I", q if ok else self.merged(self.symbols(p))).tobytes() for p, q, ok in zip(new, proposals, good)}
        known.update(found)
        raw = known.__getitem__
        out = [raw(s[0]) if len(s) == 1 else b"".join(map(raw, s)) for s in split]
        if len(known) > CACHE_WORDS + len(found):  # what came last goes first; the early words are the frequent ones
            for p in found:
                del known[p]
        return out


def loaded(path: str) -> WordBpe:
    return process_state(("word-bpe", path), lambda: WordBpe(path))


def spread_ids(parts: list[bytes], codes: np.ndarray, dtype: str) -> tuple[np.ndarray, np.ndarray]:
    """Ids of the coded pieces in a row, and the number of ids of each piece."""
    flat = np.frombuffer(b"".join(parts), dtype)
    lengths = np.fromiter(map(len, parts), np.int64, len(parts)) // np.dtype(dtype).itemsize
    starts = np.cumsum(lengths) - lengths
    n = lengths[codes]
    before = np.cumsum(n) - n
    return flat[np.repeat(starts[codes] - before, n) + np.arange(int(n.sum()))], n


def encoded(texts: pa.Array, path: str) -> pa.Array:
    """Ids of each text as binary."""
    bpe, out = loaded(path), []
    for _, some in arrow_text.slices(texts, SLICE_BYTES):
        words = arrow_text.words(some)
        ids, n = spread_ids(bpe.encode_words(words.distinct.to_pylist()), words.codes, "<u4")
        ends = np.concatenate([[0], np.cumsum(words.per_row(n))])
        raw = ids.tobytes()
        out += [raw[4 * a:4 * b] for a, b in zip(ends[:-1].tolist(), ends[1:].tolist())]
    return pa.array(out, pa.binary())


def decoded(ids: pa.Array, path: str) -> pa.Array:
    """The tokens of each list of ids, joined by spaces."""
    bpe = loaded(path)
    table = process_state(("word-bpe-tokens", path), lambda: pa.array(
        [bpe.tokens.get(i) for i in range(max(bpe.tokens) + 1)], pa.string()))
    out = []
    for raw in ids.to_pylist():
        known = np.frombuffer(raw or b"", "<u4").astype(np.int64)
        tokens = table.take(pa.array(known[known < len(table)])).drop_null()
        out.append(pc.binary_join(pa.ListArray.from_arrays(pa.array([0, len(tokens)], pa.int32()), tokens), " ")[0].as_py())
    return pa.array(out, pa.string())


def encode(text: Column, tokenizer: str = TOKENIZER) -> Column:
    return F.arrow_udf(lambda texts: encoded(texts, tokenizer), "binary")(text)


def decode(ids: Column, tokenizer: str = TOKENIZER) -> Column:
    return F.arrow_udf(lambda some: decoded(some, tokenizer), "string")(ids)


def encode_and_decode(text: Column, tokenizer: str = TOKENIZER) -> Column:
    """`ids` and `decoded` in one call: Spark would run `encode` a second time as the input of `decode`."""
    def both(texts: pa.Array) -> pa.Array:
        ids = encoded(texts, tokenizer)
        return pa.StructArray.from_arrays([ids, decoded(ids, tokenizer)], ["ids", "decoded"])
    return F.arrow_udf(both, "struct<ids: binary, decoded: string>")(text)


def n_ids(ids: Column) -> Column:
    return (F.octet_length(ids) / 4).cast("long")


def report(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", tokenizer: str = TOKENIZER) -> DataFrame:
    """Per document: number of ids, and the hashes of its ids and of the text they decode to."""
    coded = docs.select(F.col(doc_id).alias("doc_id"), encode_and_decode(F.col(text), tokenizer).alias("coded"))
    return coded.select("doc_id", n_ids(F.col("coded.ids")).alias("n_tokens"), F.sha2("coded.ids", 256).alias("ids_sha256"),
                        F.sha2("coded.decoded", 256).alias("decoded_sha256"))
