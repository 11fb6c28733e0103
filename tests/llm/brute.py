"""Plain Python versions of the operators' results."""

import math
import re
import string
from collections import Counter, defaultdict

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOW = str.maketrans(string.ascii_uppercase, string.ascii_lowercase)


def words(text):
    return WORD.findall((text or "").translate(LOW))


def shingles(text, k=5):
    w = words(text)
    if len(w) >= k:
        return {tuple(w[i:i + k]) for i in range(len(w) - k + 1)}
    return {tuple(w)} if w else set()


def components(texts, per_cent=75):
    """``{row: smallest id reachable}`` over rows ``[(id, text)]``."""
    sets = [shingles(t) for _, t in texts]
    root = list(range(len(texts)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    held = defaultdict(list)
    for i, s in enumerate(sets):
        shared = Counter(j for t in s for j in held[t])
        for t in s:
            held[t].append(i)
        for j, c in shared.items():
            if 100 * c >= per_cent * (len(s) + len(sets[j]) - c):
                root[find(i)] = find(j)
    ids = defaultdict(list)
    for i, (d, _) in enumerate(texts):
        ids[find(i)].append(d)
    least = {r: min((d for d in v if d is not None), default=None) for r, v in ids.items()}
    return [(d, len(sets[i]), least[find(i)] if sets[i] else d) for i, (d, _) in enumerate(texts)]


def base_scores(rows, learn):
    """``{id: (n_tokens, n_known, N, base)}`` of add-one word counts."""
    count = Counter()
    for d, t in rows:
        if learn(d):
            count.update(words(t) + [None])
    n, v = sum(count.values()), len(count)
    out = {}
    for d, t in rows:
        w = words(t) + [None]
        out[d] = (len(w), sum(count[x] > 0 for x in w), n, sum(math.log10((count[x] + 1) / (n + v + 1)) for x in w))
    return out
