"""Plain versions of what the operators must give."""

import re
from collections import Counter
from functools import cache
from math import log2


def shingles(text, k):
    w = (text or "").encode().lower().split()
    return frozenset(zip(*(w[i:] for i in range(k)))) if len(w) >= k else frozenset([tuple(w)] if w else [])


def components(texts, k, percent=80):
    """{id: smallest id reachable}; texts: {id: text}."""
    sets = {i: shingles(t, k) for i, t in texts.items()}
    label = {i: i for i in texts}

    def find(x):
        while label[x] != x:
            x = label[x]
        return x

    ids = sorted(texts)
    for n, i in enumerate(ids):
        for j in ids[:n]:
            both = len(sets[i] & sets[j])
            if sets[i] and sets[j] and 100 * both >= percent * (len(sets[i]) + len(sets[j]) - both):
                a, b = sorted((find(i), find(j)))
                label[b] = a
    return {i: find(i) for i in ids}


def repeats(rows, length=50):
    """[(removed mask)] in rows' order; rows: (id, text)."""
    first = {}
    for i, t in rows:
        b = (t or "").encode()
        for k in range(len(b) - length + 1):
            s = b[k : k + length]
            first[s] = min(first.get(s, i), i)
    out = []
    for i, t in rows:
        b = (t or "").encode()
        mask = bytearray(len(b))
        for k in range(len(b) - length + 1):
            if first[b[k : k + length]] < i:
                mask[k : k + length] = b"\1" * length
        out.append(mask)
    return out


_WORD = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def hits(text, items, size=10):
    """(words, hit words, items found)."""
    words = _WORD.findall((text or "").encode().lower())
    hit, found = set(), set()
    for item, t in items:
        w = _WORD.findall((t or "").encode().lower())
        for window in {tuple(w[i : i + size]) for i in range(max(1, len(w) - size + 1))} if w else ():
            for i in range(len(words) - len(window) + 1):
                if tuple(words[i : i + len(window)]) == window:
                    hit.update(range(i, i + len(window)))
                    found.add(str(item))
    return len(words), len(hit), sorted(found)


def ppm_bits(samples, text, order):
    """Bits of text after samples: method C with exclusion, contexts longest first."""
    trees = {}
    pad = (256,) * order
    for t in samples:
        s = pad + tuple(t.lower())
        for i in range(order, len(s)):
            for k in range(order + 1):
                trees.setdefault(s[i - k : i], Counter())[s[i]] += 1

    @cache
    def p(context, symbol):
        after = trees.get(context)
        shorter = lambda x: p(context[1:], x) if context else 1 / 256
        if not after:
            return shorter(symbol)
        total = sum(after.values())
        if symbol in after:
            return after[symbol] / (total + len(after))
        return len(after) / (total + len(after)) * shorter(symbol) / (1 - sum(map(shorter, after)))

    s = pad + tuple(text.lower())
    return -sum(log2(p(s[i - order : i], s[i])) for i in range(order, len(s)))
