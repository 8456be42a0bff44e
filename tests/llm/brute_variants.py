"""Brute-force spelling variants, for the tests: every rule of the contract in plain Python."""

import re
import zlib
from collections import Counter

RUN = re.compile("[A-Za-zÀ-ÿ]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def vocabulary(rows):
    counts = Counter()
    for doc_id, text in rows:
        for run in RUN.findall(text or ""):
            low = run.translate(LOWER)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{low}".encode())
            if h % 199 == 0:
                p = h % len(low)
                low = low[:p] + low[p + 1:]
            counts[low] += 1
    return {w: n for w, n in counts.items() if len(w) >= 6 and n >= 5}


def one_edit(a, b):
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    if len(a) > len(b):
        a, b = b, a
    return any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def variants(rows):
    vocab = vocabulary(rows)
    by_len = {}
    for w in vocab:
        by_len.setdefault(len(w), []).append(w)
    near = {w: [v for d in (-1, 0, 1) for v in by_len.get(len(w) + d, []) if one_edit(w, v)] for w in vocab}
    form = {}
    for w, vs in near.items():
        form[w] = None
        if vs:
            top = min(vs, key=lambda v: (-vocab[v], v))
            if vocab[top] >= 5 * vocab[w]:
                form[w] = top
    out = {}
    for w in vocab:
        root = w
        while form[root] is not None:
            root = form[root]
        f = form[w]
        out[w] = (f, root, vocab[w], len(near[w]), vocab[f] if f else None)
    return out
