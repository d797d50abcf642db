"""Token counts of greedy word pieces by a linear longest-match automaton.

The vocabulary is a trie: pieces that begin a word (with the mark of a leading
space) and pieces inside a word.  A node where a word may stop matching has a
failure link: pop the pieces that greedy longest match takes from the node's
string, and go on from the node of what is left of it.  Popped pieces are counted
when the automaton is built, so a word's length in pieces is a sum of stored
numbers along one walk, and no piece is ever built.  Every symbol is read once and
every failure shortens the held string, so a word takes linear time.

Defined results: a null or empty text has no words and no tokens; a word that
greedy longest match cannot cover with pieces is one unknown token; words may
have any length; repeated rows are counted alike; an empty table gives no rows;
other columns are not read.  Memory: the automaton, and a cache of at most
`CACHE_WORDS` words per process.
"""

from __future__ import annotations

import json

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from kinfold.llm import arrow_text
from kinfold.llm.arrow_text import process_state
from kinfold.llm.bpe import byte_symbols

TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")
SPACE = "Ġ"
CACHE_WORDS = 150_000
SLICE_BYTES = 2 << 20


class Automaton:
    """Trie with failure links and popped counts over pieces of byte symbols.

    Node 0 holds the word's start mark, which may be a piece of its own, node 1 nothing.
    """

    def __init__(self, starts: list[str], inside: list[str], bare_start: bool):
        self.steps: list[dict[str, int]] = [{}, {}]
        final = [False, False]
        for root, pieces in ((0, starts), (1, inside)):
            for piece in pieces:
                node = root
                for symbol in piece:
                    if symbol not in self.steps[node]:
                        self.steps[node][symbol] = len(self.steps)
                        self.steps.append({})
                        final.append(False)
                    node = self.steps[node][symbol]
                final[node] = True
        # Breadth first, so the links of shorter strings are there when needed.
        self.fail = [-1] * len(self.steps)
        self.popped = [0] * len(self.steps)
        if bare_start:
            self.fail[0], self.popped[0] = 1, 1
        queue = [0, 1]
        for node in queue:
            for symbol, child in self.steps[node].items():
                if final[child]:
                    self.fail[child], self.popped[child] = 1, 1
                else:
                    at, count = self.fail[node], self.popped[node]
                    while at >= 0 and symbol not in self.steps[at]:
                        count += self.popped[at]
                        at = self.fail[at]
                    if at >= 0:
                        self.fail[child], self.popped[child] = self.steps[at][symbol], count
                queue.append(child)

    def count(self, word: str) -> int:
        """Pieces of a word; 0 if it cannot be covered."""
        steps, fail, popped = self.steps, self.fail, self.popped
        node, total = 0, 0
        for symbol in word:
            while (child := steps[node].get(symbol)) is None:
                total += popped[node]
                node = fail[node]
                if node < 0:
                    return 0
            node = child
        while node != 1:  # pop what is still held
            total += popped[node]
            node = fail[node]
            if node < 0:
                return 0
        return total


class Counter:
    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            vocab = json.load(f)["model"]["vocab"]
        self.automaton = Automaton([p[len(SPACE):] for p in vocab if p.startswith(SPACE) and p != SPACE],
                                   [p for p in vocab if not p.startswith(SPACE)], SPACE in vocab)
        self.bytes = byte_symbols()
        self.seen: dict[str, int] = {}

    def counts(self, words: list[str]) -> np.ndarray:
        """Pieces of each word, 0 for unknown ones."""
        seen, count, found = self.seen, self.automaton.count, {}
        for word in words:
            if word not in seen:
                plain = word.isascii() and word.isprintable()
                found[word] = count(word if plain else "".join(map(self.bytes.__getitem__, word.encode())))
        out = np.fromiter((seen[w] if w in seen else found[w] for w in words), np.int64, len(words))
        if len(seen) < CACHE_WORDS:
            seen.update(found)
        return out


def counted(texts: pa.Array, path: str) -> pa.Array:
    counter = process_state(("word-pieces", path), lambda: Counter(path))
    columns = [[], [], []]
    for _, some in arrow_text.slices(texts, SLICE_BYTES):
        words = arrow_text.words(some)
        n = counter.counts(words.distinct.to_pylist())[words.codes] if len(words.codes) else words.codes
        for column, values in zip(columns, (words.per_row(), words.per_row(np.maximum(n, 1)), words.per_row(n == 0))):
            column.append(values)
    return pa.StructArray.from_arrays([pa.array(np.concatenate(c) if c else [], pa.int64()) for c in columns],
                                      ["n_words", "n_tokens", "n_unknown"])


def counts_of(text: Column, tokenizer: str = TOKENIZER) -> Column:
    """Struct of words, tokens (an unknown word is one) and unknown words."""
    return F.arrow_udf(lambda texts: counted(texts, tokenizer), "struct<n_words: long, n_tokens: long, n_unknown: long>")(text)


def report(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", tokenizer: str = TOKENIZER) -> DataFrame:
    return (docs.select(F.col(doc_id).alias("doc_id"), counts_of(F.col(text), tokenizer).alias("n"))
            .select("doc_id", "n.n_words", "n.n_tokens", "n.n_unknown"))
