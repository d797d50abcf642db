"""Plain-Python answers to hold the operators against."""

from __future__ import annotations

import re
from collections import Counter, defaultdict

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def words(text):
    return WORD.findall(text or "")


def components(rows):
    """doc_id -> (set size, smallest reachable id) by comparing all pairs that share a shingle."""
    sets = {}
    for doc_id, text in rows:
        w = words(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
        sets[doc_id] = frozenset(tuple(w[i:i + 5]) for i in range(len(w) - 4)) if len(w) >= 5 else frozenset([tuple(w)] if w else [])
    posted = defaultdict(list)
    for doc_id, s in sets.items():
        for x in s:
            posted[x].append(doc_id)
    parent = {d: d for d in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x
    for doc_id, s in sets.items():
        for other, common in Counter(o for x in s for o in posted[x] if o < doc_id).items():
            if 100 * common >= 75 * (len(s) + len(sets[other]) - common):
                a, b = sorted((find(doc_id), find(other)))
                parent[b] = a
    return {d: (len(s), find(d)) for d, s in sets.items()}


def quality(text):
    """(n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words)."""
    text = text or ""
    w = words(text)
    seen, dup = set(), 0
    for line in text.split("\n"):
        if words(line):
            dup += line in seen
            seen.add(line)
    windows = Counter(zip(w, w[1:], w[2:]))
    covered = {i + k for i in range(len(w) - 2) if windows[tuple(w[i:i + 3])] > 1 for k in range(3)}
    return len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text), dup, len(covered)


BASE = [("assign", re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A),
         lambda m: len(m[2]) >= 6),
        ("access", re.compile("AKIA[A-Z0-9]+"), lambda m: len(m[0]) >= 20),
        ("hex", re.compile("[0-9a-f]+"), lambda m: len(m[0]) >= 24)]


def secrets(text):
    found = sorted((m.start(), k, m.end()) for k, (_, p, ok) in enumerate(BASE) for m in p.finditer(text or "") if ok(m))
    return [f"{BASE[k][0]}:{a}:{b}" for a, k, b in found]


def line_drops(rows, depth, least, similar):
    """(doc_id, text) -> remaining text, by the rules of the line-template tree with exact words."""
    lines = []
    for doc_id, text in rows:
        for n, line in enumerate((text or "").split("\n")):
            w = words(re.sub("[0-9]+", "0", line))
            if len(w) >= least:
                lines.append((doc_id, n, (len(w), tuple(w[:depth])), tuple(w)))
    leaves = defaultdict(set)
    forms = defaultdict(set)
    for doc_id, _, leaf, w in lines:
        leaves[leaf].add(doc_id)
        forms[leaf].add(w)
    template = {leaf: [Counter(col).most_common() for col in zip(*f)] for leaf, f in forms.items()}
    cluster = defaultdict(list)
    for doc_id, n, leaf, w in lines:
        if len(leaves[leaf]) < 2:
            continue
        votes = template[leaf]
        clear = [len(c) == 1 or c[0][1] > c[1][1] for c in votes]
        same = sum(x == c[0][0] for x, c, ok in zip(w, votes, clear) if ok)
        tied = sum(dict(c)[x] == c[0][1] for x, c, ok in zip(w, votes, clear) if not ok)
        assert (same >= similar * len(w)) == (same + tied >= similar * len(w)), "the fixture must not depend on tied votes"
        cluster[leaf if same >= similar * len(w) else (leaf, w)].append((doc_id, n))
    gone = defaultdict(set)
    for hits in cluster.values():
        first = min(d for d, _ in hits)
        for d, n in hits:
            if d != first:
                gone[d].add(n)
    return {d: "\n".join(x for n, x in enumerate((t or "").split("\n")) if n not in gone[d]) for d, t in rows}
