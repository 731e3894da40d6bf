"""Near copies by brute force."""

import re
from collections import defaultdict


def shingles(text):
    words = re.findall(rb"[^\x20\x09-\x0d]+", re.sub(rb"[A-Z]", lambda m: m.group().lower(), (text or "").encode()))
    return {tuple(words[i : i + 5]) for i in range(max(len(words) - 4, 1))} if words else set()


def brute_pairs(texts, least=0.8):
    sets = {i: shingles(t) for i, t in texts.items()}
    by_shingle = defaultdict(list)
    for i, own in sets.items():
        for s in own or {()}:
            by_shingle[s].append(i)
    shared = defaultdict(int)
    for ids in by_shingle.values():
        for a in ids:
            for b in ids:
                if a < b:
                    shared[a, b] += 1
    return {(a, b): 1.0 if not sets[a] else n / (len(sets[a]) + len(sets[b]) - n) for (a, b), n in shared.items() if not sets[a] or n >= least * (len(sets[a]) + len(sets[b]) - n)}
