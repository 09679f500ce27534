"""Fixtures and brute-force versions for the corpus operators."""

import random

import xxhash

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
#: names that operators use inside
CLASHING = ("fp", "size", "taken", "uid", "range", "score", "rank", "key", "shard", "doc", "id")


def documents(spark, rows, clash=False):
    """rows: (doc_id, text[, source])"""
    full = [(r[0], r[1], "en", r[2] if len(r) > 2 else "s", len(r[1]) if r[1] is not None else None) for r in rows]
    df = spark.createDataFrame(full, DOCS)
    if clash:
        for c in CLASHING:
            df = df.selectExpr("*", f"'x' as {c}")
    return df


def prose(seed, words, vocabulary=4000):
    r = random.Random(seed)
    return " ".join(f"w{r.randrange(vocabulary)}" for _ in range(words))


def edge_rows():
    long = prose(1, 9000)
    return [(5, None), (6, ""), (7, " \t\n"), (8, "one"), (9, "one two"), (1, prose(2, 120)), (2, prose(2, 120)),
            (2, prose(2, 120)), (3, prose(2, 120) + " tail"), (4, long), (10, long[:-3] + "xyz"), (11, "é ß 中文 🎉 " * 30),
            (None, prose(3, 80)), (12, prose(3, 80)), (13, "a" * 3000)]


class Union:
    def __init__(self):
        self.up = {}

    def find(self, x):
        while self.up.setdefault(x, x) != x:
            x = self.up[x]
        return x

    def join(self, a, b):
        a, b = self.find(a), self.find(b)
        self.up[max(a, b)] = min(a, b)


def brute_fingerprint(text, k=3):
    w = (text or "").encode().lower().split()
    s = [b" ".join(w[i: i + k]) for i in range(max(1, len(w) - k + 1))] if w else []
    h = [xxhash.xxh64_intdigest(x, 42) for x in s]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def brute_components(rows, bits=3):
    """rows: (doc_id, text) -> sorted (doc_id, fingerprint, component)"""
    fps = [brute_fingerprint(t) for _, t in rows]
    u = Union()
    for i in range(len(rows)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= bits:
                u.join(i, j)
    least = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            least[u.find(i)] = min(d, least.get(u.find(i), d))
    out = [(d, f"{fps[i]:016x}", least.get(u.find(i))) for i, (d, _) in enumerate(rows)]
    return sorted(out, key=lambda r: (r[0] is None, r[0] or 0, r[1]))


def brute_kept(rows, width=50):
    """rows: (doc_id, text) -> [(doc_id, mask of removed bytes, bytes)]"""
    first = {}
    for d, t in rows:
        b = (t or "").encode()
        if d is not None:
            for i in range(len(b) - width + 1):
                s = b[i: i + width]
                first[s] = min(d, first.get(s, d))
    out = []
    for d, t in rows:
        b = (t or "").encode()
        mask = bytearray(len(b))
        for i in range(len(b) - width + 1 if d is not None else 0):
            if first[b[i: i + width]] < d:
                mask[i: i + width] = b"\1" * width
        out.append((d, bytes(mask), b))
    return out
