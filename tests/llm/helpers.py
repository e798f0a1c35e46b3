"""Plain versions of the definitions, for comparison."""

import random
import re
from collections import Counter, defaultdict

BLANKS = re.compile(rb"[^\x20\x09-\x0D]+")
ITEM = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")


def words(text, pattern=BLANKS, lower=True):
    raw = (text or "").encode()
    return pattern.findall(raw.translate(LOWER) if lower else raw)


def shingles(text, width):
    w = words(text)
    return {tuple(w)} if 0 < len(w) < width else {tuple(w[i:i + width]) for i in range(len(w) - width + 1)}


def components(docs, width, percent=80):
    """Smallest id reachable over similar sets, by comparing all pairs."""
    sets = [(i, shingles(t, width)) for i, t in docs]
    parent = {i: i for i, _ in docs}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i
    for a, x in sets:
        for b, y in sets:
            if a < b and x and y and 100 * len(x & y) >= percent * len(x | y):
                ra, rb = root(a), root(b)
                parent[max(ra, rb)] = min(ra, rb)
    return {i: root(i) for i, _ in docs}


def covered(texts, size):
    """Mask of bytes inside strings of ``size`` bytes that start twice or more."""
    raw = [(t or "").encode() for t in texts]
    count = Counter(r[i:i + size] for r in raw for i in range(len(r) - size + 1))
    out = []
    for r in raw:
        mask = [False] * len(r)
        for i in range(len(r) - size + 1):
            if count[r[i:i + size]] > 1:
                mask[i:i + size] = [True] * size
        out.append(mask)
    return raw, out


def prose(draw: random.Random, n):
    return " ".join(draw.choice(["the", "of", "and", "éa", "Tion", "er", "in,", "lo.\nna", "zu", "que"]) + draw.choice(["", "", "ba", "x", "ly"]) for _ in range(n))


def near_copies(seed=3):
    """Texts with exact and near copies, nulls, blanks and ties."""
    draw, docs = random.Random(seed), []
    for _ in range(12):
        base = prose(draw, draw.choice([1, 2, 3, 8, 40, 90])).split(" ")
        for _ in range(draw.choice([1, 2, 5])):
            copy = list(base)
            for _ in range(draw.choice([0, 0, 1, 2])):
                copy[draw.randrange(len(copy))] = "new" + str(draw.randrange(99))
            docs.append(" ".join(copy))
    docs += [None, "", "  \n ", "One", "one", "one two", "ONE two", "one two three"]
    draw.shuffle(docs)
    return list(enumerate(docs))


def counts(keys):
    out = defaultdict(int)
    for k in keys:
        out[k] += 1
    return out
