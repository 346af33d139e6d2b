"""The operators' results by plain loops over small inputs."""

from __future__ import annotations

import hashlib
import re
from collections import Counter, defaultdict

FOLD = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
WORD = re.compile(r"[^\x20\x09-\x0D]+")
TERM = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


class Groups:
    def __init__(self):
        self.up = {}

    def find(self, x):
        self.up.setdefault(x, x)
        while self.up[x] != x:
            x = self.up[x]
        return x

    def join(self, a, b):
        a, b = self.find(a), self.find(b)
        self.up[max(a, b)] = min(a, b)


def shingle_set(text, k=3):
    w = WORD.findall((text or "").translate(FOLD))
    if not w:
        return frozenset()
    return frozenset(tuple(w[i : i + k]) for i in range(max(1, len(w) - k + 1)))


def near(rows, percent=85):
    """Sorted (doc_id, n_shingles, component_id) of (doc_id, text) rows."""
    sets = [(d, shingle_set(t)) for d, t in rows]
    groups, holders = Groups(), defaultdict(list)
    for i, (d, s) in enumerate(sets):
        for x in s:
            holders[x].append(i)
    for i, (d, s) in enumerate(sets):
        common = Counter(j for x in s for j in holders[x] if j > i)
        for j, n in common.items():
            e, other = sets[j]
            if d is not None and e is not None and 100 * n >= percent * (len(s) + len(other) - n):
                groups.join(d, e)
    return sorted(((d, len(s), groups.find(d) if s and d is not None else d) for d, s in sets), key=repr)


def removed_bytes(rows, span=200):
    """Sorted (doc_id, n_bytes, n_removed, n_spans, sha256 of the rest)."""
    data = [(t or "").encode() for _, t in rows]
    seen = Counter(b[i : i + span] for b in data for i in range(len(b) - span + 1))
    out = []
    for (d, _), b in zip(rows, data):
        covered = bytearray(len(b))
        for i in range(len(b) - span + 1):
            if seen[b[i : i + span]] > 1:
                covered[i : i + span] = b"\1" * span
        kept = bytes(x for x, c in zip(b, covered) if not c)
        spans = len(re.findall(b"\1+", bytes(covered)))
        out.append((d, len(b), sum(covered), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=repr)


def contaminated(rows, bench, width=10):
    """Sorted (doc_id, n_words, n_hit, n_items, sha256 of the items, contaminated)."""
    windows = defaultdict(set)
    for item, t in bench:
        w = TERM.findall((t or "").translate(FOLD))
        for i in range(max(1, len(w) - width + 1) if w else 0):
            windows[tuple(w[i : i + width])].add(item)
    sizes = {len(w) for w in windows}
    out = []
    for d, t in rows:
        w, hit, items = TERM.findall((t or "").translate(FOLD)), set(), set()
        for i in range(len(w)):
            for n in sizes:
                found = tuple(w[i : i + n])
                if len(found) == n and found in windows:
                    hit.update(range(i, i + n))
                    items |= windows[found]
        named = sorted(str(x) for x in items if x is not None)
        digest = hashlib.sha256(",".join(named).encode()).hexdigest()
        out.append((d, len(w), len(hit), len(named), digest, bool(hit)))
    return sorted(out, key=repr)


def base_counts(text, width=8):
    """(n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words)."""
    text = text or ""
    w, at, covered = WORD.findall(text), defaultdict(list), set()
    for i in range(len(w) - width + 1):
        at[tuple(w[i : i + width])].append(i)
    for starts in at.values():
        if len(starts) > 1:
            for i in starts:
                covered.update(range(i, i + width))
    lines = [x for x in text.split("\n") if WORD.search(x)]
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered)


def exact_passages(rows, width=50):
    """doc_id -> words inside a run of `width` words that another row has too."""
    words = {d: WORD.findall((t or "").translate(FOLD)) for d, t in rows}
    holders = defaultdict(set)
    for d, w in words.items():
        for i in range(len(w) - width + 1):
            holders[tuple(w[i : i + width])].add(d)
    out = {}
    for d, w in words.items():
        covered = set()
        for i in range(len(w) - width + 1):
            if len(holders[tuple(w[i : i + width])]) > 1:
                covered.update(range(i, i + width))
        out[d] = len(covered)
    return out


def mix_targets(sizes, weights=(1, 2, 3), most=3):
    """source -> target by sharing the excess again and again; sizes in order of sources."""
    total, open_, target = sum(sizes.values()), list(sizes), {}
    weight = {s: weights[i % len(weights)] for i, s in enumerate(sizes)}
    while open_:
        left = total - sum(target.values())
        share = left / sum(weight[s] for s in open_)
        over = [s for s in open_ if share * weight[s] > most * sizes[s]]
        if not over:
            target.update({s: share * weight[s] for s in open_})
            break
        target.update({s: most * sizes[s] for s in over})
        open_ = [s for s in open_ if s not in over]
    return target
