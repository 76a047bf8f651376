"""Plain Python versions of what the operators return."""

import hashlib
import re
import zlib
from collections import Counter, defaultdict
from itertools import combinations

UPPER = {i: i + 32 for i in range(65, 91)}


def crc(doc_id, m):
    return None if doc_id is None else zlib.crc32(str(doc_id).encode()) % m


def sha(text):
    return hashlib.sha256(text if isinstance(text, bytes) else text.encode()).hexdigest()


ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
ACCESS, HEX = re.compile("AKIA[A-Z0-9]+"), re.compile("[0-9a-f]+")


def secrets(text):
    text = text or ""
    out = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    out += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if len(m[0]) >= 20]
    out += [(m.start(), 2, m.end()) for m in HEX.finditer(text) if len(m[0]) >= 24]
    return sorted(out)


def repeated(docs, length=100):
    """docs: {doc_id: text}; {doc_id: (removed mask, bytes)}"""
    seen, out = set(), {}
    for i in sorted(docs):
        a = (docs[i] or "").encode()
        mask = [False] * len(a)
        for s in range(len(a) - length + 1):
            w = a[s:s + length]
            if w in seen:
                mask[s:s + length] = [True] * length
            seen.add(w)
        out[i] = (mask, a)
    return out


def runs(mask):
    return sum(1 for i, x in enumerate(mask) if x and (i == 0 or not mask[i - 1]))


def shingles(text, k):
    ws = re.findall("[^\x20\x09-\x0d]+", (text or "").translate(UPPER))
    return {tuple(ws[i:i + k]) for i in range(max(1, len(ws) - k + 1))} if ws else set()


def jaccard(docs, k=3, num=90, den=100):
    """docs: {doc_id: text}; {doc_id: (n_shingles, component_id)}"""
    sets = {i: shingles(t, k) for i, t in docs.items()}
    up = {i: i for i in docs}

    def find(i):
        while up[i] != i:
            i = up[i]
        return i

    for a, b in combinations(sorted(docs), 2):
        both = len(sets[a] & sets[b])
        if sets[a] and sets[b] and den * both >= num * (len(sets[a]) + len(sets[b]) - both):
            x, y = sorted((find(a), find(b)))
            up[y] = x
    return {i: (len(sets[i]), find(i)) for i in docs}


def line_dedup(docs, min_chars=40, min_docs=5):
    """docs: [(doc_id, text)] with distinct ids; {doc_id: (lines, dropped, kept)}"""
    holders = defaultdict(set)

    def key(line):
        return line.strip(" \t\n\x0b\x0c\r").translate(UPPER)

    for i, t in docs:
        for line in (t or "").split("\n"):
            if len(key(line)) >= min_chars:
                holders[key(line)].add(i)
    last = {k: max(v) for k, v in holders.items() if len(v) >= min_docs}
    out = {}
    for i, t in docs:
        lines = (t or "").split("\n")
        kept = [x for x in lines if last.get(key(x), i) == i]
        out[i] = (len(lines), len(lines) - len(kept), "\n".join(kept))
    return out


WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def contamination(docs, items):
    wins = defaultdict(set)
    for i, t in items:
        ws = WORD.findall((t or "").translate(UPPER))
        if i is not None and ws:
            for s in range(max(1, len(ws) - 12)):
                wins[tuple(ws[s:s + 13])].add(str(i))
    sizes = {len(w) for w in wins}
    out = {}
    for d, t in docs:
        ws = WORD.findall((t or "").translate(UPPER))
        hit, found = set(), set()
        for k in sizes:
            for s in range(len(ws) - k + 1):
                if tuple(ws[s:s + k]) in wins:
                    hit.update(range(s, s + k))
                    found |= wins[tuple(ws[s:s + k])]
        out[d] = (len(ws), len(hit), len(found), sha(",".join(sorted(found))), bool(hit) and 20 * len(hit) >= len(ws))
    return out


def mix_targets(sizes, weights=(3, 1, 2), share=1.5):
    """sizes: {source: words}; {source: target} by handing the excess on until none is above twice its size."""
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    w = {s: weights[i % 3] for i, s in enumerate(order)}
    full, budget = set(), share * sum(sizes.values())
    while True:
        free = [s for s in order if s not in full]
        left = budget - sum(2 * sizes[s] for s in full)
        t = {s: 2 * sizes[s] if s in full else left * w[s] / sum(w[x] for x in free) for s in order}
        more = {s for s in free if t[s] > 2 * sizes[s]}
        if not more:
            return t
        full |= more


def base_scores(docs, held_out=10):
    """docs: [(doc_id, text)]; [(n_tokens, n_known, N, base score)]"""
    from math import log10

    ends = 0
    c = Counter()
    words = [re.findall("[^\x20\x09-\x0d]+", (t or "").translate(UPPER)) for _, t in docs]
    for (i, _), ws in zip(docs, words):
        if crc(i, held_out) not in (0, None):
            c.update(ws)
            ends += 1
    n, v = sum(c.values()) + ends, len(c) + (ends > 0)
    p = lambda x: log10((x + 0.1) / (n + 0.1 * (v + 1)))
    return [(len(ws) + 1, sum(c[w] > 0 for w in ws) + (ends > 0), n, sum(p(c[w]) for w in ws) + p(ends)) for ws in words]
