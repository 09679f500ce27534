"""Near-duplicate passages by compact windows.

A passage is ``PASSAGE`` words in a row; two are near duplicates if the sets of their
five-word shingles have a Jaccard similarity of ``similarity`` or more.  For each of
``HASHES`` hash functions, the compact window (l, c, r) stands for all stretches
of shingles that begin in [l, c], end in [c, r] and have their least hash at c;
windows come from a Cartesian tree over the hashes, of which only the
nodes whose subtree is as wide as a passage are kept (two in a passage's length).

1. For each pair of hash functions, the windows' intervals of passage starts are
   joined: stretches of starts on which both minima stay the same.  The two minima
   are the stretch's key.  Blocks exchange packed keys; those that no second document
   has are dropped.
2. Equal stretches under one key are one member (the smallest document's; the others
   are linked to it at once), first in each block, then over all blocks.  Stretches
   of a heavy key meet by their content's salt.
3. Members of a key with several send their shingles and meet.  Members with an equal
   passage are linked; those of one document are one class under all keys that meet there.  Of the other pairs, those whose signatures (the minima under all
   hash functions) agree in ``AGREE`` or more are candidates, and each is verified there
   on all starts that the two stretches have in common, unless verified links join its
   two ends already.  Only verified pairs are links, so no candidate displaces another.
   Many members of a heavy key are dealt as pairs of chunks.
4. Verified pairs make classes of documents.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from acctlens.llm.blocks import batch_of
from acctlens.llm.common import stored
from acctlens.llm.exchange import KEYS_DDL, firsts, found, key_of, packed_keys, shared_keys
from acctlens.llm.graph import components
from acctlens.llm.simhash import join
from acctlens.llm.suffixes import RANGE_BYTES, SALTS, Block, to_blocks

PASSAGE, SHINGLE, HASHES, AGREE = 50, 5, 8, 4
SPAN = PASSAGE - SHINGLE + 1  # shingles in a passage
PAIRS = tuple((i, i + 1) for i in range(0, HASHES, 2))
SLICE = 1 << 18  # bytes of words hashed at a time
FEW, CELLS = 64, 1 << 20  # groups up to FEW list their pairs together; compared at a time in larger ones
CHUNK = 4096  # members of a heavy key in a chunk
EDGES_HELD = 1 << 20
EQUAL = HASHES + 1  # agreement of passages with the same shingles

U64 = np.uint64
_MULTIPLIERS = np.random.default_rng(50).integers(1, 1 << 63, 64, dtype=U64) | U64(1)
_BACK = U64(pow(int(_MULTIPLIERS[27]), -1, 1 << 64))
_BYTES = np.random.default_rng(51).integers(0, 1 << 64, 256, dtype=U64)

#: Stretches of a block under the keys of a range (``key`` names the one of a heavy key's
#: members, else -1), or links.
ENTRY_DDL = ("range int, salt int, uid long, key long, n long, keys binary, signatures binary, doc binary, place binary, "
             "around binary, content binary, edges binary")
ENTRIES = pa.schema([("range", pa.int32()), ("salt", pa.int32()), ("uid", pa.int64()), ("key", pa.int64()), ("n", pa.int64()),
                     *[(n, pa.binary()) for n in ("keys", "signatures", "doc", "place", "around", "content", "edges")]])
MEMBER_DDL = "range int, key long, cell long, keys binary, signatures binary, doc binary, place binary, around binary, codes binary"
MEMBERS = pa.schema([("range", pa.int32()), ("key", pa.int64()), ("cell", pa.int64()),
                     *[(n, pa.binary()) for n in ("keys", "signatures", "doc", "place", "around", "codes")]])
EDGE_DDL = "a_doc long, a_start int, b_doc long, b_start int, agree int, similarity double"
EDGES = pa.schema([("a_doc", pa.int64()), ("a_start", pa.int32()), ("b_doc", pa.int64()), ("b_start", pa.int32()),
                   ("agree", pa.int32()), ("similarity", pa.float64())])


def mix(x: np.ndarray, seed: int) -> np.ndarray:
    h = x * _MULTIPLIERS[seed]
    h ^= h >> U64(32)
    h *= _MULTIPLIERS[seed + 32]
    return h ^ (h >> U64(29))


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first ``n`` powers of a multiplier and of its inverse."""
    up, down = (np.cumprod(np.concatenate((np.ones(1, U64), np.full(n - 1, m, U64))), dtype=U64) for m in (_MULTIPLIERS[27], _BACK))
    return up, down


def word_hashes(data: bytes, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the lower-cased words of the documents that end at ``ends`` in
    ``data``, and the number of words of each."""
    text = np.frombuffer(data.lower(), np.uint8)
    letter = (text != 32) & ((text < 9) | (text > 13))
    opens, closes = letter.copy(), letter.copy()
    opens[1:] &= ~letter[:-1]
    closes[:-1] &= ~letter[1:]
    edges = np.concatenate(([0], ends))
    at = edges[edges < len(text)]
    opens[at] = letter[at]
    at = edges[edges > 0] - 1
    closes[at] = letter[at]
    begin, end = np.flatnonzero(opens), np.flatnonzero(closes) + 1
    out = np.zeros(len(begin), U64)
    up, down = powers(max(1, min(SLICE, len(text))))
    i = 0
    while i < len(begin):
        j = int(np.searchsorted(end, begin[i] + SLICE, side="right"))
        if j == i:  # a word longer than a slice
            out[i] = xxhash.xxh64_intdigest(text[begin[i]: end[i]].tobytes(), 7)
            i += 1
            continue
        part = text[begin[i]: end[j - 1]]
        sums = np.concatenate((np.zeros(1, U64), np.cumsum(_BYTES[part] * up[: len(part)], dtype=U64)))
        x, y = begin[i:j] - begin[i], end[i:j] - begin[i]
        out[i:j] = mix((sums[y] - sums[x]) * down[x], 24)
        i = j
    return out, np.diff(np.searchsorted(begin, edges))


def shingles(words: np.ndarray) -> np.ndarray:
    """Hashes of SHINGLE words from each word on."""
    n = max(0, len(words) - SHINGLE + 1)
    h = np.zeros(n, U64)
    for j in range(SHINGLE):
        h = h * _MULTIPLIERS[31] + words[j: j + n]
    return mix(h, 30)


POSITION = U64(0xFFFFFFFF)  # low bits that hold a place in the block


def least_at(values: np.ndarray, width: int) -> np.ndarray:
    """Position of the least of ``width`` values from each position on (the
    first of equals)."""
    v = (values & ~POSITION) | np.arange(len(values), dtype=U64)
    have = 1
    while have < width:
        more = min(have, width - have)
        v = np.minimum(v[:-more], v[more:])
        have += more
    return (v & POSITION).astype(np.int64)


def compact_windows(values: np.ndarray, low: np.ndarray, starts: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Rows (l, c, r) in the order of c: the nodes of each document's Cartesian tree
    that span a passage or more.

    ``low``: least position of the passage at each start; ``starts``: the starts
    that lie in a document; ``begin`` and ``end``: of those documents, the first and last
    shingle.  Of equal values the first is the lesser.
    """
    nodes = low[starts]
    nodes = nodes[firsts(nodes)]
    of = np.searchsorted(begin, nodes, side="right") - 1
    key = values[nodes] & ~POSITION
    # a wide node's lesser neighbours are its ancestors, which are wide as well
    before, after = ancestors(key, of), len(nodes) - 1 - ancestors(key[::-1], of[::-1], strict=True)[::-1]
    left, right = begin[of], end[of]
    inner = (before >= 0) & (of[before] == of)
    left[inner] = nodes[before[inner]] + 1
    inner = after < len(nodes)
    inner[inner] = of[after[inner]] == of[inner]
    right[inner] = nodes[after[inner]] - 1
    return np.stack([left, nodes, right], axis=1)


def ancestors(key: np.ndarray, of: np.ndarray, strict: bool = False) -> np.ndarray:
    """For each node the nearest one before it that is no greater (``strict``: lesser), or that
    belongs to another document; -1 if there is none.  Pointers jump over greater nodes to where those point."""
    up = np.arange(-1, len(key) - 1)
    open_ = np.flatnonzero(up >= 0)
    while len(open_):
        to = up[open_]
        over = (of[to] == of[open_]) & ((key[to] >= key[open_]) if strict else (key[to] > key[open_]))
        open_, to = open_[over], up[to[over]]
        up[open_] = to
        open_ = open_[to >= 0]
    return up


class Passages:
    """Keyed stretches of passage starts in a block; positions count words
    from the block's first."""

    def __init__(self, row: dict, ranges: int):
        b = Block(row, 0)
        self.ids = b.ids
        words, sizes = word_hashes(row["data"], b.ends)
        self.first_word = np.concatenate(([0], np.cumsum(sizes)))
        self.shingles = shingles(words)
        docs = np.flatnonzero(b.known & (sizes >= PASSAGE))
        none = np.zeros(0, np.int64)
        self.key, self.doc, self.first, self.last, self.c, self.low = none.astype(U64), none, none, none, none, []
        if not len(docs):
            return
        begin, end = self.first_word[docs], self.first_word[docs + 1] - SHINGLE
        inside = np.zeros(len(self.shingles) + 1, np.int8)
        inside[begin] += 1
        inside[end - SPAN + 2] -= 1
        starts = np.flatnonzero(np.cumsum(inside[:-1]) > 0)
        intervals = []
        for k in range(HASHES):
            values = mix(self.shingles, k)
            low = least_at(values, SPAN)
            left, c, right = compact_windows(values, low, starts, begin, end).T
            # passages in the window begin from max(l, c - SPAN + 1) to min(c, r - SPAN + 1)
            intervals.append((np.maximum(left, c - SPAN + 1), c))
            self.low.append(low.astype(np.int32))
        key, at, last, c = [], [], [], []
        for p, (i, j) in enumerate(PAIRS):
            (f1, c1), (f2, c2) = intervals[i], intervals[j]
            first = np.sort(np.concatenate((f1, f2)), kind="stable")  # intervals of one function follow each other without gaps
            first = first[firsts(first)]
            a = c1[np.searchsorted(f1, first, side="right") - 1]
            d = c2[np.searchsorted(f2, first, side="right") - 1]
            key.append(mix(self.shingles[a] ^ mix(self.shingles[d] + U64(p), 29), 28))
            at.append(first)
            last.append(np.append(first[1:] - 1, len(self.shingles)))
            c.append(a)
        self.key, self.first, self.last, self.c = key_of(np.concatenate(key), ranges), *map(np.concatenate, (at, last, c))
        self.doc = np.searchsorted(self.first_word, self.first, side="right") - 1
        self.last = np.minimum(self.last, self.first_word[self.doc + 1] - PASSAGE)

    def signed_at(self, rows: np.ndarray) -> np.ndarray:
        """Where the passage begins that stands for a stretch: as near as can be
        to half its length before the stretch's first minimum."""
        return np.clip(self.c[rows] - SPAN // 2, self.first[rows], self.last[rows])

    def signatures(self, at: np.ndarray) -> np.ndarray:
        """(rows, HASHES) of 16 bits each, of the passages that begin at ``at``."""
        return np.stack([(mix(self.shingles[low[at]], k) >> U64(40)).astype(np.uint16) for k, low in enumerate(self.low)],
                        axis=1) if len(at) else np.zeros((0, HASHES), np.uint16)

    def contents(self, rows: np.ndarray) -> np.ndarray:
        """A hash of all shingles of a stretch in their order, and of where in it
        its first minimum is."""
        n = len(self.shingles)
        up, down = powers(n + 1)
        sums = np.concatenate((np.zeros(1, U64), np.cumsum(self.shingles * up[:n], dtype=U64)))
        first, end = self.first[rows], self.last[rows] + SPAN
        where = (self.c[rows] - first + SPAN) * 4 * SPAN + end - first
        return mix((sums[end] - sums[first]) * down[first] ^ mix(where.astype(U64), 26), 25)


def nth_of(groups: np.ndarray) -> np.ndarray:
    """Place of each row in its run of equal values."""
    begin = np.flatnonzero(firsts(groups))
    return np.arange(len(groups)) - np.repeat(begin, np.diff(np.append(begin, len(groups))))


def spanning(label: np.ndarray, a: np.ndarray, b: np.ndarray, agree: np.ndarray, verify=None):
    """Of candidate pairs those that hold by ``verify``, the most alike first; a pair is
    left out only if pairs that hold join its ends already.  Each round tries a few
    candidates of each class, of different partners first; the next round twice as many."""
    kept = []
    for level in range(HASHES, AGREE - 1, -1):
        u, v = a[agree == level], b[agree == level]
        tried = 1
        while True:
            apart = label[u] != label[v]
            u, v = u[apart], v[apart]
            if not len(u):
                break
            low, high = np.minimum(label[u], label[v]), np.maximum(label[u], label[v])
            order = np.lexsort((low, high))
            order = order[nth_of(high[order] * len(label) + low[order]) < tried]
            order = order[nth_of(high[order]) < tried]
            x, y = u[order], v[order]
            rest = np.ones(len(u), bool)
            rest[order] = False
            u, v = u[rest], v[rest]
            if verify is not None:
                good = verify(x, y)
                x, y = x[good], y[good]
            kept.append((x, y, np.full(len(x), level)))
            join(label, x, y)
            tried *= 2
    return kept


def candidates(signatures: np.ndarray, groups: np.ndarray, label: np.ndarray | None = None, verify=None):
    """Edges (a, b, agreement) between rows of one group (``groups`` is sorted) that agree in
    AGREE numbers or more and that ``verify`` confirms, as many as ``spanning`` needs.  Rows of
    one ``label`` are joined already."""
    kept = []
    begin = np.flatnonzero(firsts(groups))
    size = np.diff(np.append(begin, len(groups)))
    row = np.arange(len(groups)) - np.repeat(begin, size)
    size_of = np.repeat(size, size)
    label = np.arange(len(groups)) if label is None else label
    listed = [(np.zeros(0, np.int64),) * 3]
    for step in range(1, min(FEW, int(size.max(initial=1)))):  # row i with row i + step
        i = np.flatnonzero((size_of <= FEW) & (row + step < size_of))
        i = i[label[i] != label[i + step]]
        same = (signatures[i] == signatures[i + step]).sum(axis=1)
        near = same >= AGREE
        listed.append((i[near], i[near] + step, same[near]))
    kept += spanning(label, *(np.concatenate(x) for x in zip(*listed)), verify)
    for g, n in zip(begin[size > FEW], size[size > FEW]):
        own = signatures[g: g + n]
        rows = max(1, CELLS // n)
        for level in range(HASHES, AGREE - 1, -1):
            # pairs within the largest class are joined already
            _, of, many = np.unique(label[g: g + n], return_inverse=True, return_counts=True)
            outside = of != np.argmax(many)
            at = np.flatnonzero(outside)
            for a in range(0, len(at), rows):
                if (label[g: g + n] == label[g]).all():
                    break
                part = at[a: a + rows]
                same = sum((own[part, k][:, None] == own[None, :, k]).astype(np.uint8) for k in range(HASHES))
                i, j = np.nonzero(same == level)
                i = part[i]
                once = ~outside[j] | (i < j)
                i, j = i[once], j[once]
                kept += spanning(label, g + i, g + j, np.full(len(i), level), verify)
    return [np.concatenate(x) for x in zip(*kept)] if kept else [np.zeros(0, np.int64)] * 3


class Stretches:
    """Shingles (32 bits) of stretches that lie one after the other in ``codes``; ``around`` has
    the first and last start of each, counted from its first minimum."""

    def __init__(self, codes: np.ndarray, around: np.ndarray):
        self.codes, self.around = codes, around
        size = around[:, 1] - around[:, 0] + SPAN
        self.begin = np.cumsum(size) - size
        of = np.repeat(np.arange(len(size)), size).astype(U64) << U64(32) | codes
        self.before = np.full(len(codes), -1)  # where a stretch had the same shingle before
        x = np.sort(of)
        repeats = np.unique(x[1:][x[1:] == x[:-1]] >> U64(32)).astype(np.int64)
        if len(repeats):
            n = size[repeats]
            at = np.repeat(self.begin[repeats] - (np.cumsum(n) - n), n) + np.arange(n.sum())
            at = at[np.argsort(of[at], kind="stable")]
            again = np.flatnonzero(~firsts(of[at]))
            self.before[at[again]] = at[again - 1]

    def windows(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(stretch, start, hash of its shingles, repeats included, in any order) of each passage."""
        n = self.around[:, 1] - self.around[:, 0] + 1
        of = np.repeat(np.arange(len(n)), n)
        nth = np.arange(len(of)) - np.repeat(np.cumsum(n) - n, n)
        sums = np.concatenate((np.zeros(1, U64), np.cumsum(mix(self.codes.astype(U64), 25), dtype=U64)))
        at = self.begin[of] + nth
        return of, self.around[of, 0] + nth, sums[at + SPAN] - sums[at]

    def slide(self, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The best similarity of passages of a[i] and b[i] that begin at the same distance from
        the minima, and those two starts.  Stretches without a common start are compared
        where they come nearest."""
        fa, la, fb, lb = *self.around[a].T, *self.around[b].T
        low, high = np.maximum(fa, fb), np.minimum(la, lb)
        x, y = np.clip(low, fa, la), np.clip(low, fb, lb)  # first starts
        many = np.maximum(high - low + 1, 1)
        best, at = np.zeros(len(a)), np.zeros(len(a), np.int64)
        order = np.argsort(many, kind="stable")
        for k in range(0, len(a), 512):
            p = order[k: k + 512]
            best[p], at[p] = self._slide(self.begin[a[p]] + x[p] - fa[p], self.begin[b[p]] + y[p] - fb[p], many[p])
        return best, x + at, y + at

    def _slide(self, a: np.ndarray, b: np.ndarray, many: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        most = int(many.max())
        step = np.arange(most + SPAN - 1)

        def spans(begin):
            """Shingles, and the first and last passage in which each is the first of its value."""
            at = np.minimum(begin[:, None] + step, len(self.codes) - 1)
            lo = np.maximum(np.maximum(step - SPAN + 1, 0), self.before[at] - begin[:, None] + 1)
            return self.codes[at], lo, np.minimum(step, many[:, None] - 1)

        def counted(of, lo, hi):
            own = lo <= hi
            n = len(a) * (most + 1)
            up, down = (np.bincount(of[own] * (most + 1) + z[own], minlength=n) for z in (lo, hi + 1))
            return np.cumsum((up - down).reshape(len(a), most + 1), axis=1)[:, :most]

        (ca, alo, ahi), (cb, blo, bhi) = spans(a), spans(b)
        of = np.broadcast_to(np.arange(len(a))[:, None], ca.shape)
        na, nb = counted(of, alo, ahi), counted(of, blo, bhi)
        k, at = np.divmod(np.flatnonzero(ca[:, :, None] == cb[:, None, :]), len(step) ** 2)
        i, j = np.divmod(at, len(step))
        both = counted(k, np.maximum(alo[k, i], blo[k, j]), np.minimum(ahi[k, i], bhi[k, j]))
        alike = np.where(np.arange(most) < many[:, None], both / np.maximum(na + nb - both, 1), -1.0)
        at = alike.argmax(axis=1)
        return alike[np.arange(len(a)), at], at


def edge_table(a_doc, a_start, b_doc, b_start, agree, similarity) -> pa.Table:
    """Links between documents, the smaller one first; of each pair of documents the most similar."""
    flip = a_doc > b_doc
    a_doc, b_doc = np.where(flip, b_doc, a_doc), np.where(flip, a_doc, b_doc)
    a_start, b_start = np.where(flip, b_start, a_start), np.where(flip, a_start, b_start)
    cols = (a_doc, a_start, b_doc, b_start, agree, similarity)
    order = np.lexsort((b_start, a_start, -agree, -similarity, b_doc, a_doc))
    order = order[(a_doc != b_doc)[order]]
    order = order[firsts(a_doc[order]) | firsts(b_doc[order])]
    return pa.Table.from_arrays([pa.array(c[order].astype(f.type.to_pandas_dtype()), f.type) for c, f in zip(cols, EDGES)], schema=EDGES)


def best_edges(tables: list[pa.Table]) -> list[pa.RecordBatch]:
    return edge_table(*[c.to_numpy() for c in pa.concat_tables(tables).columns]).to_batches()


def packed_edges(edges: pa.Table) -> bytes:
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, EDGES) as w:
        w.write_table(edges)
    return sink.getvalue().to_pybytes()


def equal_edges(a: np.ndarray, b: np.ndarray, doc: np.ndarray, place: np.ndarray, around: np.ndarray) -> pa.Table:
    """Links of equal stretches: their passages that begin half a length before the minimum,
    or as near to that as can be."""
    start = place[:, 1] + np.clip(-(SPAN // 2), around[:, 0], around[:, 1])
    return edge_table(doc[a], start[a], doc[b], start[b], np.full(len(a), EQUAL), np.ones(len(a)))


def packed_entries(uid: int, p: Passages, rows: np.ndarray, heavy: np.ndarray, ranges: int) -> Iterator[tuple]:
    """ENTRIES rows of a block."""
    sign, content, key, doc, c = p.signatures(p.signed_at(rows)), p.contents(rows), p.key[rows], p.doc[rows], p.c[rows]
    around = np.stack([p.first[rows] - c, p.last[rows] - c], 1).astype(np.int8)
    place = np.stack([doc, c - p.first_word[doc]], 1).astype(np.int32)
    ids = p.ids[doc]
    order = np.lexsort((ids, content, key))
    new = firsts(key[order]) | firsts(content[order])
    head = order[new][np.cumsum(new) - 1]
    rest = ~new & (ids[order] != ids[head])
    if rest.any():
        edges = equal_edges(head[rest], order[rest], ids, place, around.astype(np.int64))
        yield (-1 - int(uid % ranges), 0, uid, -1, 0, *[None] * 6, packed_edges(edges))
    order = order[new]
    salts = max(SALTS, ranges)
    salt = np.where(heavy, 1 + (content >> U64(20)).astype(np.int64) % salts, 0)
    order = order[np.lexsort((key[order], salt[order], key[order] >> U64(32)))]
    group = (key[order] >> U64(32)).astype(np.int64) * (salts + 1) + salt[order]
    cut = np.flatnonzero(firsts(group))
    for begin, end in zip(cut, [*cut[1:], len(order)]) if len(order) else ():
        k = order[begin:end]
        yield (int(key[k[0]] >> U64(32)), int(salt[k[0]]), uid, -1, len(k), key[k].astype(np.uint32).tobytes(), sign[k].tobytes(),
               ids[k].tobytes(), place[k].tobytes(), around[k].tobytes(), content[k].tobytes(), None)


COLUMNS = {"keys": (np.uint32, 1), "signatures": (np.uint16, HASHES), "doc": (np.int64, 1), "place": (np.int32, 2),
           "around": (np.int8, 2), "content": (U64, 1), "codes": (np.uint32, 1)}


def column(data: bytes, name: str) -> np.ndarray:
    kind, width = COLUMNS[name]
    x = np.frombuffer(data, kind)
    return x.reshape(-1, width) if width > 1 else x


def joined(rows: list[dict], name: str) -> np.ndarray:
    return np.concatenate([column(r[name], name) for r in rows])


def gather(group: pa.Table) -> pa.Table:
    """ENTRIES of one range and salt -> links of equal stretches, and the entries that are
    members: one of each content, if another may be linked to it under its key."""
    rows = group.to_pylist()
    out = [tuple(r.values()) for r in rows if r["edges"] is not None]
    rows = [r for r in rows if r["edges"] is None]
    if rows:
        key, doc, content = joined(rows, "keys"), joined(rows, "doc"), joined(rows, "content")
        order = np.lexsort((doc, content, key))
        new = firsts(key[order]) | firsts(content[order])
        head, heads = order[new][np.cumsum(new) - 1], order[new]
        if not new.all():
            edges = equal_edges(head[~new], order[~new], doc, joined(rows, "place"), joined(rows, "around").astype(np.int64))
            out.append((rows[0]["range"], rows[0]["salt"], rows[0]["uid"], -1, 0, *[None] * 6, packed_edges(edges)))
        if not rows[0]["salt"]:
            begin = np.flatnonzero(firsts(key[heads]))
            apart = np.minimum.reduceat(doc[heads], begin) != np.maximum.reduceat(doc[heads], begin)
            heads = heads[np.repeat(apart, np.diff(np.append(begin, len(heads))))]
        member = np.zeros(len(key), bool)
        member[heads] = True
        end = 0
        for r in rows:
            own = np.flatnonzero(member[end: end + r["n"]])
            keys = key[end: end + r["n"]][own]
            end += r["n"]
            # a heavy key's members are dealt apart from others
            for k in np.unique(keys).tolist() if r["salt"] else [-1] if len(own) else []:
                part = own[keys == k] if r["salt"] else own
                out.append((r["range"], r["salt"], r["uid"], k, len(part),
                            *[column(r[n], n)[part].tobytes() for n in ("keys", "signatures", "doc", "place", "around")], None, None))
    cols = list(zip(*out)) or [[]] * len(ENTRIES)
    return pa.Table.from_arrays([pa.array(c, f.type) for c, f in zip(cols, ENTRIES)], schema=ENTRIES)


def verified_edges(key, sign, doc, place, around, codes, similarity: float) -> pa.Table:
    """Links between members that meet (sorted by key): enough of the verified pairs to join all
    that are verified or have an equal passage."""
    s = Stretches(codes, around)
    # rows of one document, under whichever keys, and such with an equal passage are of one class
    label = np.arange(len(key))
    order = np.argsort(doc, kind="stable")
    new = firsts(doc[order])
    join(label, order[new][np.cumsum(new) - 1], order)
    of, start, content = s.windows()
    content = mix(content ^ mix(key[of].astype(U64), 24), 23)
    order = np.argsort(content)
    new = firsts(content[order])
    head = np.minimum.reduceat(order, np.flatnonzero(new))[np.cumsum(new) - 1]
    head, rest = head[head != order], order[head != order]
    join(label, of[head], of[rest])
    equal = edge_table(doc[of[head]], place[of[head], 1] + start[head], doc[of[rest]], place[of[rest], 1] + start[rest],
                       np.full(len(rest), EQUAL), np.ones(len(rest)))
    held = [(np.zeros(0, np.int64),) * 2 + (np.zeros(0),) + (np.zeros(0, np.int64),) * 2]

    def verify(a, b):
        alike, x, y = s.slide(a, b)
        good = alike >= similarity
        held.append((a[good], b[good], alike[good], x[good], y[good]))
        return good

    candidates(sign, key, label, verify)
    a, b, alike, x, y = (np.concatenate(c) for c in zip(*held))
    agree = (sign[a] == sign[b]).sum(axis=1)
    return pa.concat_tables([equal, edge_table(doc[a], place[a, 1] + x, doc[b], place[b, 1] + y, agree, alike)])


def dealt(members: DataFrame) -> DataFrame:
    """``members`` with the cells in which they meet others of their range and key: a heavy key's
    are dealt to chunks, of which each pair is a cell."""
    heavy = members.filter("key >= 0")
    chunks = heavy.groupBy("range", "key").agg(F.ceil(F.sum("n") / CHUNK).alias("t"))
    own = heavy.join(chunks, ["range", "key"]).withColumn("own", F.pmod(F.xxhash64("uid", "salt"), "t"))
    others = F.filter(F.sequence(F.lit(0).cast("long"), F.col("t") - 1), lambda i: (i != F.col("own")) | (F.col("t") == 1))
    own = own.withColumn("cells", F.transform(others, lambda i: F.least(i, "own") * F.col("t") + F.greatest(i, "own")))
    light = members.filter("key < 0").withColumn("cells", F.array(F.lit(0).cast("long")))
    return light.unionByName(own.select(*light.columns))


def near_passages(docs: DataFrame, similarity: float = 0.8) -> DataFrame:
    """Verified pairs (a_doc, a_start, b_doc, b_start, agree, similarity) with
    word positions of near-duplicate passages; enough of them to connect
    what is linked, not all pairs of a group."""
    blocks = to_blocks(docs, [])
    total = blocks.agg(F.sum("n_bytes")).first()[0] or 0
    ranges = max(1, -(-total // RANGE_BYTES))

    def send_keys(batches):
        for rb in batches:
            for row in rb.to_pylist():
                p = Passages(row, ranges)
                yield from packed_keys(row["uid"], p.key, p.ids[p.doc], ranges)

    def send_entries(batches):
        for rb in batches:
            for row in rb.to_pylist():
                p = Passages(row, ranges)
                hot, heavy = found(p.key, row["hot"])
                rows = np.flatnonzero(hot)
                for out in packed_entries(row["uid"], p, rows, heavy[rows], ranges):
                    yield batch_of(ENTRIES, out)

    texts = blocks.drop("rest")
    hot = shared_keys(texts.mapInArrow(send_keys, KEYS_DDL))
    entries = texts.join(hot.hint("shuffle_hash"), "uid").mapInArrow(send_entries, ENTRY_DDL)
    met = stored(entries.groupBy("range", "salt").applyInArrow(gather, ENTRY_DDL), "passage_members")
    members = met.filter("edges is null").drop("edges", "content")
    asked = dealt(members)
    asked = asked.groupBy("uid").agg(F.collect_list(F.struct(*[c for c in asked.columns if c != "uid"])).alias("asked"))

    def answer(batches):
        for rb in batches:
            for row in rb.to_pylist():
                ends = np.cumsum(np.frombuffer(row["lens"], np.int64))
                begin = np.concatenate(([0], ends[:-1]))
                needed = np.unique(np.concatenate([column(q["place"], "place")[:, 0] for q in row["asked"]]))
                parts = [row["data"][begin[d]: ends[d]] for d in needed.tolist()]
                words, sizes = word_hashes(b"".join(parts), np.cumsum(list(map(len, parts))))
                first = np.cumsum(sizes) - sizes
                codes = (shingles(words) >> U64(32)).astype(np.uint32)
                for q in row["asked"]:
                    place, around = column(q["place"], "place").astype(np.int64), column(q["around"], "around").astype(np.int64)
                    at = first[np.searchsorted(needed, place[:, 0])] + place[:, 1] + around[:, 0]
                    size = around[:, 1] - around[:, 0] + SPAN
                    mine = codes[np.repeat(at - (np.cumsum(size) - size), size) + np.arange(size.sum())].tobytes()
                    for cell in q["cells"]:
                        yield batch_of(MEMBERS, (q["range"], q["key"], cell, q["keys"], q["signatures"], q["doc"], q["place"],
                                                 q["around"], mine))

    def verified(group: pa.Table) -> pa.Table:
        rows = group.to_pylist()
        key, around, codes = joined(rows, "keys"), joined(rows, "around").astype(np.int64), joined(rows, "codes")
        doc = joined(rows, "doc")
        order = np.lexsort((doc, key))
        size = around[:, 1] - around[:, 0] + SPAN
        begin, size = (np.cumsum(size) - size)[order], size[order]
        codes = codes[np.repeat(begin - (np.cumsum(size) - size), size) + np.arange(size.sum())]
        return verified_edges(key[order], joined(rows, "signatures")[order], doc[order], joined(rows, "place")[order].astype(np.int64),
                              around[order], codes, similarity)

    def unpacked(batches):
        # many ranges name the same pair of documents
        tables: list[pa.Table] = []
        for rb in batches:
            tables += [pa.ipc.open_stream(e.as_py()).read_all() for e in rb.column(0)]
            if sum(map(len, tables)) >= EDGES_HELD:
                yield from best_edges(tables)
                tables = []
        if tables:
            yield from best_edges(tables)

    equal = met.filter("edges is not null").select("edges").mapInArrow(unpacked, EDGE_DDL)
    near = texts.join(asked.hint("shuffle_hash"), "uid").mapInArrow(answer, MEMBER_DDL).groupBy("range", "key", "cell").applyInArrow(
        verified, EDGE_DDL)
    links = equal.unionByName(near).groupBy("a_doc", "b_doc").agg(
        F.max(F.struct("similarity", "agree", (-F.col("a_start")).alias("s"), "a_start", "b_start")).alias("e"))
    return links.select("a_doc", "e.a_start", "b_doc", "e.b_start", "e.agree", "e.similarity")


def passage_classes(docs: DataFrame, similarity: float = 0.8) -> DataFrame:
    """Documents that share a near-duplicate passage with another: (doc_id,
    class_id, partner_id, start_word, n_words, partner_start, similarity).

    class_id is the smallest doc_id of the class (documents linked through passages);
    partner_id is a document that the passage at start_word was verified against: of the
    verified links the most similar one, not of all documents, since a pair is left out where
    verified links join its ends already, in groups of every size.  A document without such a passage has no row.  Null
    text counts as empty; texts shorter than a passage have none.  Rows of one
    doc_id are not matched with each other and count as one document; rows
    with a null doc_id take no part.  Empty table: empty result.  Other columns
    are not read.
    """
    pairs = stored(near_passages(docs, similarity), "passage_links")
    classes = components(pairs.select(F.col("a_doc").alias("u"), F.col("b_doc").alias("v")))
    both = pairs.select(F.col("a_doc").alias("doc_id"), F.col("a_start").alias("start_word"), F.col("b_doc").alias("partner_id"),
                        F.col("b_start").alias("partner_start"), "similarity").unionByName(
        pairs.select(F.col("b_doc").alias("doc_id"), F.col("b_start").alias("start_word"), F.col("a_doc").alias("partner_id"),
                     F.col("a_start").alias("partner_start"), "similarity"))
    best = both.groupBy("doc_id").agg(F.max(F.struct("similarity", (-F.col("partner_id")).alias("m"), "start_word", "partner_start",
                                                     "partner_id")).alias("b"))
    return best.join(classes.withColumnsRenamed({"node": "doc_id", "root": "class_id"}), "doc_id").select(
        "doc_id", "class_id", "b.partner_id", "b.start_word", F.lit(PASSAGE).alias("n_words"), "b.partner_start", "b.similarity")
