"""Repeated byte strings by a sparse suffix array, merged in a distributed way.

Task: remove each byte covered by a ``width``-byte string that also starts in a
document with a smaller doc_id.

1. Documents are packed into blocks (a table bucketed by block, so later joins
   with it move no text).  Of the ``width - GRAM + 1`` grams in a string, the one with
   the least hash is its anchor.  Equal strings have equal anchors at equal places,
   so only suffixes that start at anchors (about one byte in 16) need sorting.
2. Blocks exchange the hashes of their anchors, sorted and packed by range.
   An anchor that no second document has is dropped: none of its strings repeat.
3. Each block sorts the suffixes of its remaining anchors, as far as their strings reach, and
   sends front-coded runs (shared prefix with the previous suffix, then the tail) to the
   anchor's range.  Occurrences with the same bytes on both sides are told apart at once: all
   but the smallest document's are removed there and only that one is sent.
4. A range merges its runs with loser trees that carry longest common prefixes: two
   heads are compared only where both are known to share as much with the last
   winner.  Each gram has a tree of its own, and trees of a depth take their steps
   together as array operations.  Merged order and prefix lengths give, for each length, classes of
   equal right sides; the left sides are classed alike.  A string is a pair of
   classes; all of its occurrences but those in the smallest document are removed.
5. The removed strings go back to their blocks, where the rest of each text is put
   together.

An anchor with very many occurrences (``exchange.HEAVY``) is spread: each of its strings goes to
a range and salt by its own hash, so strings of a hot anchor are classed in many tasks, and
with its own bytes alone, so a block sends a string that many of its documents share once.
There are SALTS groups of such strings or, if more, one a range: a block's rows grow with the
ranges, not with ranges times salts.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema

from acctlens.llm.blocks import batch_of
from acctlens.llm.common import parallelism, utf8_rows
from acctlens.llm.exchange import KEYS_DDL, firsts, found, key_of, packed_keys, shared_keys
from acctlens.session import scratch_path

GRAM = 20
BLOCK_BYTES = 8 << 20
BLOCK_ROWS = 1 << 16
RANGE_BYTES = 16 << 20
SALTS = 256
STEP = 1 << 16
BATCH_BYTES = 4 << 20
ZSTD = pa.Codec("zstd", 1)
#: How many steps of a single tree take the time of one of many together.
TOGETHER = 25

U64 = np.uint64
_MIX1, _MIX2 = U64(0x9E3779B97F4A7C15), U64(0xC2B2AE3D27D4EB4F)
BYTE_HASH = np.random.default_rng(20).integers(1, 1 << 32, 256, dtype=np.uint32)

BLOCKS = pa.schema([("n", pa.int32()), ("n_bytes", pa.int64()), ("ids", pa.binary()), ("known", pa.binary()),
                    ("lens", pa.binary()), ("data", pa.binary()), ("rest", pa.binary())])
BLOCKS_DDL = "n int, n_bytes long, ids binary, known binary, lens binary, data binary, rest binary"
RUNS = pa.schema([("range", pa.int32()), ("salt", pa.int32()), ("uid", pa.int64()), ("spans", pa.binary()),
                  ("n", pa.int32()), ("n_tails", pa.int64()), ("n_lefts", pa.int64()), ("packed", pa.binary())])
RUNS_DDL = "range int, salt int, uid long, spans binary, n int, n_tails long, n_lefts long, packed binary"
SPANS = pa.schema([("uid", pa.int64()), ("spans", pa.binary())])


# ---- anchors ----------------------------------------------------------------

def anchors(data: np.ndarray, ends: np.ndarray, width: int) -> tuple[np.ndarray, ...]:
    """Of texts that lie side by side in ``data`` and end at ``ends``: (anchor,
    first string, last string) - consecutive strings with the same anchor."""
    starts = np.concatenate(([0], ends[:-1]))
    full = ends - starts >= width
    if not full.any():
        return (np.zeros(0, np.int64),) * 3
    n, reach = len(data), width + GRAM
    out = []
    for at in range(0, n, STEP):
        piece = data[at: at + STEP + reach]
        v = _gram_hashes(piece)
        v = (v.astype(U64) << U64(32)) | np.arange(at, at + len(v), dtype=U64)
        out.append(_window_min(v, width - GRAM + 1)[: min(STEP, n - at)].astype(np.uint32))
    least = np.concatenate(out)
    # where the anchor changes, and the first string of each document; strings that lie within a document
    change = np.flatnonzero(least[1:] != least[:-1]) + 1
    of = np.searchsorted(ends, change, side="right")
    change = change[(change > starts[of]) & (change <= ends[of] - width)]
    first = np.sort(np.concatenate((change, starts[full])))
    final = ends[np.searchsorted(ends, first, side="right")] - width
    last = np.minimum(final, np.append(first[1:], n) - 1)
    return least[first].astype(np.int64), first, last


def _gram_hashes(x: np.ndarray) -> np.ndarray:
    """32-bit hashes of GRAM = 16 + 4 bytes from each position on (doubling)."""
    h = BYTE_HASH[x]
    four = None
    for n in (1, 2, 4, 8):
        h = _joined(h, h, n)
        if n == 2:
            four = h
    h = _joined(h, four, 16)
    h ^= h >> np.uint32(15)
    h *= np.uint32(0x2C1B3C6D)
    return h ^ (h >> np.uint32(13))


def _joined(a: np.ndarray, b: np.ndarray, n: int) -> np.ndarray:
    m = max(0, min(len(a), len(b) - n))
    out = a[:m] * np.uint32(0x85EBCA6B)
    out ^= out >> np.uint32(16)
    out += b[n: n + m]
    return out


def _window_min(v: np.ndarray, width: int) -> np.ndarray:
    have = 1
    while have < width:
        more = min(have, width - have)
        v = np.minimum(v[:-more], v[more:]) if len(v) > more else v[:0]
        have += more
    return v


def rows_of(data: np.ndarray, at: np.ndarray, n: int, back: bool = False) -> np.ndarray:
    """A matrix of the n bytes from each position on (or back before it)."""
    pad = np.zeros(n, np.uint8)
    wide = np.lib.stride_tricks.sliding_window_view(np.concatenate((pad, data, pad)), n)
    return wide[at][:, ::-1] if back else wide[at + n]


def gram_keys(data: np.ndarray, at: np.ndarray, ranges: int) -> np.ndarray:
    """The exchange's key of each anchor's gram."""
    words = np.ascontiguousarray(np.pad(rows_of(data, at, GRAM), ((0, 0), (0, 24 - GRAM)))).view(U64)
    h = np.zeros(len(at), U64)
    for j in range(3):
        h = (h ^ words[:, j]) * _MIX1
        h ^= h >> U64(29)
        h *= _MIX2
        h ^= h >> U64(32)
    return key_of(h, ranges)


class Block:
    def __init__(self, row: dict, width: int):
        self.row = row
        self.ids = np.frombuffer(row["ids"], np.int64)
        self.known = np.frombuffer(row["known"], bool)
        self.ends = np.cumsum(np.frombuffer(row["lens"], np.int64))
        self.data = np.frombuffer(row["data"], np.uint8)
        self.width = width

    def anchors(self):
        at, first, last = anchors(self.data, self.ends, self.width)
        doc = np.searchsorted(self.ends, at, side="right")
        keep = self.known[doc]
        return at[keep], first[keep], last[keep], doc[keep]


# ---- blocks -----------------------------------------------------------------

def to_blocks(docs: DataFrame, others: list[str]) -> DataFrame:
    """Documents packed in a table bucketed by ``uid``."""
    spark = docs.sparkSession
    frame = docs.select(F.col("doc_id").cast("long").alias("_id"), F.col("text").alias("_text"), *others)

    def run(batches: Iterator[pa.RecordBatch]):
        ids, texts, rest, size = [], [], [], 0

        def block():
            other = pa.Table.from_batches(rest).combine_chunks() if others else None
            sink = pa.BufferOutputStream()
            if other is not None:
                with pa.ipc.new_stream(sink, other.schema) as w:
                    w.write_table(other)
            return batch_of(BLOCKS, (
                len(ids), size, np.array([i or 0 for i in ids], np.int64).tobytes(),
                np.array([i is not None for i in ids], bool).tobytes(),
                np.fromiter(map(len, texts), np.int64, len(texts)).tobytes(), b"".join(texts),
                sink.getvalue().to_pybytes()))

        for rb in batches:
            from_row = 0
            columns = rb.select(others) if others else None
            for i, (doc_id, text) in enumerate(zip(rb.column(0).to_pylist(), utf8_rows(rb, "_text"))):
                ids.append(doc_id)
                texts.append(text)
                size += len(text)
                if size >= BLOCK_BYTES or len(ids) == BLOCK_ROWS:
                    if others:
                        rest.append(columns.slice(from_row, i + 1 - from_row))
                    from_row = i + 1
                    yield block()
                    ids, texts, rest, size = [], [], [], 0
            if others and from_row < rb.num_rows:
                rest.append(columns.slice(from_row))
        if ids:
            yield block()

    packed = frame.mapInArrow(run, BLOCKS_DDL).select(F.monotonically_increasing_id().alias("uid"), *BLOCKS.names)
    name = f"suffix_blocks_{uuid.uuid4().hex}"
    (packed.write.format("parquet").option("compression", "zstd").option("path", scratch_path(spark, f"llm/{name}"))
     .bucketBy(parallelism(spark), "uid").saveAsTable(name))
    return spark.table(name)


# ---- runs of suffixes -----------------------------------------------------------

def padded(m: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Byte rows, zero-filled, with their length behind, as whole words: rows
    compare like their strings."""
    n, w = m.shape
    out = np.zeros((n, -(-(w + 1) // 8) * 8), np.uint8)
    out[:, :w], out[:, w] = m, size
    return out


def ordered(rows: np.ndarray, group: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(order by group and bytes, marks of the first of equal ones).  Words are
    looked at one after the other, only where those before left a tie."""
    words = rows.view(">u8")
    order = np.argsort(group, kind="stable")
    new = firsts(group[order])
    for j in range(words.shape[1]):
        alone = new & np.append(new[1:], True)
        tied = np.flatnonzero(~alone)
        if not len(tied):
            break
        rank = np.cumsum(new[tied])
        o, w = order[tied], words[order[tied], j].astype(U64)
        by = np.lexsort((w, rank))
        order[tied], w = o[by], w[by]
        new[tied[1:]] |= w[1:] != w[:-1]
    return order, new


def shared_prefix(m: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Of each row with the one before."""
    out = np.zeros(len(m), np.int64)
    if len(m) > 1:
        differ = m[1:] != m[:-1]
        first = np.where(differ.any(axis=1), differ.argmax(axis=1), m.shape[1])
        out[1:] = np.minimum(first, np.minimum(size[1:], size[:-1]))
    return out


def runs_of(b: Block, hot: list, ranges: int) -> Iterator[tuple]:
    """RUNS rows of a block: front-coded suffixes by (range, salt), and the
    spans that are already certain."""
    width, uid = b.width, b.row["uid"]
    at, first, last, doc = b.anchors()
    key = gram_keys(b.data, at, ranges)
    keep, heavy = found(key, hot)
    at, first, last, doc, key, heavy = (x[keep] for x in (at, first, last, doc, key, heavy))
    hi, lo = at - first, at - last  # offsets of the anchor in its strings
    part, salt = (key >> U64(32)).astype(np.int64), np.zeros(len(at), np.int64)
    if heavy.any():  # a row for each string of a heavy anchor
        times = np.where(heavy, hi - lo + 1, 1)
        pick = np.repeat(np.arange(len(at)), times)
        nth = np.arange(len(pick)) - np.repeat(np.cumsum(times) - times, times)
        at, doc, part, salt, heavy = (x[pick] for x in (at, doc, part, salt, heavy))
        hi, lo = hi[pick] - np.where(heavy, nth, 0), np.where(heavy, hi[pick] - nth, lo[pick])
        h = _string_hash(b.data, (at - hi)[heavy], width)
        part[heavy], salt[heavy] = h % ranges, 1 + h // ranges % max(1, SALTS // ranges)
    ids, begin = b.ids[doc], b.ends[doc] - np.frombuffer(b.row["lens"], np.int64)[doc]
    # what the strings of an entry reach on either side
    right = padded(rows_of(b.data, at, width) * (np.arange(width) < (width - lo)[:, None]), width - lo)
    left = padded(rows_of(b.data, at, width - GRAM, back=True) * (np.arange(width - GRAM) < hi[:, None]), hi)
    order, new = ordered(np.concatenate([right, left], axis=1), part * (SALTS + 1) + salt)
    at, doc, part, salt, hi, lo, ids, begin = (x[order] for x in (at, doc, part, salt, hi, lo, ids, begin))
    # the same bytes on both sides: the smallest document decides
    certain = np.zeros(len(at), bool)
    if len(at):
        certain = ids > np.minimum.reduceat(ids, np.flatnonzero(new))[np.cumsum(new) - 1]
    if certain.any():
        spans = np.stack([doc, at - hi - begin, at - lo + width - begin], 1)[certain].astype(np.uint32)
        yield (-1 - int(uid % ranges), 0, uid, spans.tobytes(), *[None] * 4)
    sent = np.flatnonzero(~certain)
    if not len(sent):
        return
    order, at, doc, part, salt, hi, lo, ids, begin = (x[sent] for x in (order, at, doc, part, salt, hi, lo, ids, begin))
    m, column = right[order, :width], np.arange(width)
    cuts = np.flatnonzero(firsts(part * (SALTS + 1) + salt))
    lcp = shared_prefix(m, width - lo)
    lcp[cuts] = 0
    tails = m[(column >= lcp[:, None]) & (column < (width - lo)[:, None])]
    lefts = left[order, : width - GRAM][column[: width - GRAM] < hi[:, None]]
    tail_at, left_at = (np.concatenate(([0], np.cumsum(x))) for x in (width - lo - lcp, hi))
    lcp, place = lcp.astype(np.uint8), np.stack([doc, at - begin], 1).astype(np.uint32)
    offsets = np.stack([hi, lo], 1).astype(np.uint8)
    for c, end in zip(cuts.tolist(), [*cuts[1:].tolist(), len(at)]):
        t, f = tails[tail_at[c]: tail_at[end]], lefts[left_at[c]: left_at[end]]
        yield int(part[c]), int(salt[c]), uid, None, end - c, len(t), len(f), _packed(
            lcp[c:end], t, f, ids[c:end], place[c:end], offsets[c:end])


def _packed(lcp, tails, lefts, ids, place, offsets) -> bytes:
    """Bytes of equal weight lie together, which compresses better."""
    by_weight = [x.view(np.uint8).reshape(len(lcp), -1).T.tobytes() for x in (ids, place, offsets)]
    return ZSTD.compress(b"".join([lcp.tobytes(), tails.tobytes(), lefts.tobytes(), *by_weight]), asbytes=True)


def _unpacked(r: dict) -> list[np.ndarray]:
    n, sizes = r["n"], [r["n"], r["n_tails"], r["n_lefts"], 8 * r["n"], 8 * r["n"], 2 * r["n"]]
    x = np.frombuffer(ZSTD.decompress(r["packed"], sum(sizes)), np.uint8)
    lcp, tails, lefts, *by_weight = np.split(x, np.cumsum(sizes)[:-1])
    ids, place, offsets = (np.ascontiguousarray(y.reshape(-1, n).T) for y in by_weight)
    return [lcp, tails, lefts, ids.view(np.int64).ravel(), place.view(np.uint32), offsets]


def _string_hash(data: np.ndarray, at: np.ndarray, width: int) -> np.ndarray:
    m = rows_of(data, at, width)
    words = np.ascontiguousarray(np.pad(m, ((0, 0), (0, -width % 8)))).view(U64)
    h = np.zeros(len(at), U64)
    for j in range(words.shape[1]):
        h = (h ^ words[:, j]) * _MIX1
        h ^= h >> U64(31)
    return (h >> U64(16)).astype(np.int64)


# ---- merging ----------------------------------------------------------------------

def decoded_runs(lcp: np.ndarray, size: np.ndarray, tails: np.ndarray, width: int) -> np.ndarray:
    """Rows (zero-filled) of front-coded runs, one behind the other."""
    m = np.zeros((len(lcp), width), np.uint8)
    column = np.arange(width)
    m[(column >= lcp[:, None]) & (column < size[:, None])] = tails
    more = np.flatnonzero(lcp)
    for c in range(width):
        more = more[lcp[more] > c]
        if not len(more):
            break
        begin = np.ones(len(more), bool)
        begin[1:] = more[1:] != more[:-1] + 1
        m[more, c] = m[np.maximum.accumulate(np.where(begin, more - 1, 0)), c]
    return m


def loser_tree_merge(runs: list[tuple[list[bytes], list[int]]]) -> tuple[list[int], list[int]]:
    """Merge sorted runs of (strings, prefix shared with the string before).

    Returns the run that each output string comes from and the prefix that it
    shares with the output string before it.  ``known[r]`` is how much
    the head of run r shares with the last winner it met; on a path to the root
    both sides refer to the same winner, so unequal numbers decide without
    looking at the strings, and equal ones are where comparing begins.
    """
    k = len(runs)
    leaves = 1 << max(0, (k - 1).bit_length())
    strings = [r[0] for r in runs] + [[] for _ in range(leaves - k)]
    prefixes = [r[1] for r in runs]
    head: list[bytes | None] = [s[0] if s else None for s in strings]
    known, taken, losers = [0] * leaves, [0] * leaves, [0] * leaves

    def play(a: int, b: int) -> tuple[int, int]:
        """(winner, loser) of two heads with equal ``known``."""
        x, y = head[a], head[b]
        if y is None:
            return a, b
        if x is None:
            return b, a
        i = known[a]
        if x == y:
            known[b if a < b else a] = len(x)
            return (a, b) if a < b else (b, a)
        end = min(len(x), len(y))
        while i < end and x[i] == y[i]:
            i += 1
        if i == len(x) or i < len(y) and x[i] < y[i]:
            known[b] = i
            return a, b
        known[a] = i
        return b, a

    def build(node: int) -> int:
        if node >= leaves:
            return node - leaves
        won, losers[node] = play(build(2 * node), build(2 * node + 1))
        return won

    winner = build(1) if leaves > 1 else 0
    order, shared = [], []
    while head[winner] is not None:
        order.append(winner)
        shared.append(known[winner])
        taken[winner] += 1
        nth = taken[winner]
        if nth < len(strings[winner]):
            head[winner], known[winner] = strings[winner][nth], prefixes[winner][nth]
        else:
            head[winner], known[winner] = None, -1
        node = (winner + leaves) >> 1
        while node:
            other = losers[node]
            a, b = known[winner], known[other]
            if a < b:
                losers[node], winner = winner, other
            elif a == b:
                winner, losers[node] = play(winner, other)
            node >>= 1
    return order, shared


def merged_lanes(rows: np.ndarray, lane: np.ndarray, run: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(order, bytes shared with the row before) of runs one behind the other,
    merged lane by lane; rows of a lane are sorted within each run.

    Each lane has a loser tree of its own, with a leaf for each of its runs.  Trees of one
    depth take their steps together, one array operation for all of them.
    """
    order = np.argsort(lane, kind="stable")
    rows, run, new_lane = rows[order], run[order], firsts(lane[order])
    segment = np.flatnonzero(new_lane | firsts(run))
    prefix = np.zeros(len(rows), np.int64)
    prefix[1:] = _equal_bytes(rows[1:], rows[:-1])
    prefix[segment] = 0
    begin = np.flatnonzero(new_lane)
    n = np.diff(np.append(begin, len(rows)))
    leaf = np.searchsorted(segment, begin)
    k = np.diff(np.append(leaf, len(segment)))
    segment = np.append(segment, len(rows))
    out, shared = np.arange(len(rows)), prefix.copy()
    depth = np.ceil(np.log2(k))
    for kind in np.unique(depth[k > 1]):
        lanes = np.flatnonzero(depth == kind)
        lanes = lanes[np.argsort(-n[lanes], kind="stable")]
        # the longest lanes go one by one: a step for all costs as much as TOGETHER single ones
        few = np.argmin(np.concatenate(([0], np.cumsum(n[lanes]))) + TOGETHER * np.append(n[lanes], 0))
        for x in lanes[:few]:
            ends = segment[leaf[x]: leaf[x] + k[x] + 1]
            strings = rows[ends[0]: ends[-1]].view(f"V{rows.shape[1]}").ravel().tolist()
            ends, known = (ends - ends[0]).tolist(), prefix[ends[0]: ends[-1]].tolist()
            picked, known = loser_tree_merge([(strings[a:z], known[a:z]) for a, z in zip(ends, ends[1:])])
            # merging keeps the order within a run, so its n-th row is the n-th of it in the output
            out[begin[x] + np.argsort(picked, kind="stable")] = begin[x] + np.arange(n[x])
            shared[begin[x]: begin[x] + n[x]] = known
        if few < len(lanes):
            x = lanes[few:]
            _merge_together(rows, prefix, segment, begin[x], n[x], leaf[x], k[x], out, shared)
    return order[out], shared


def _equal_bytes(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    differ = a != b
    first = differ.argmax(axis=1)
    return np.where(differ[np.arange(len(a)), first], first, a.shape[1])


def _merge_together(rows, prefix, segment, begin, n, leaf, k, out, shared) -> None:
    """``loser_tree_merge`` for many lanes at once, longest first: lanes that are done are the last ones."""
    lanes, leaves = len(n), 1 << int(k.max() - 1).bit_length()
    nth = leaf[:, None] + np.minimum(np.arange(leaves), k[:, None])
    head, end = segment[nth], segment[np.minimum(nth + 1, len(segment) - 1)]
    end[np.arange(leaves) >= k[:, None]] = 0
    known = np.where(head < end, 0, -1)
    losers = np.zeros((lanes, leaves), np.int64)

    def play(lane, a, b):
        """(winners, losers); heads with equal ``known`` are compared."""
        known_a, known_b = known[lane, a], known[lane, b]
        wins = known_a > known_b
        even = np.flatnonzero((known_a == known_b) & (known_a >= 0))
        if len(even):
            at, x, y = lane[even], a[even], b[even]
            one, two = rows[head[at, x]], rows[head[at, y]]
            same = _equal_bytes(one, two)
            where = np.minimum(same, rows.shape[1] - 1)
            each = np.arange(len(even))
            less = np.where(same < rows.shape[1], one[each, where] < two[each, where], x < y)
            wins[even] = less
            known[at, np.where(less, y, x)] = same
        return np.where(wins, a, b), np.where(wins, b, a)

    every = np.arange(lanes)
    level = [np.full(lanes, x) for x in range(leaves)]
    while len(level) > 1:
        played = [play(every, a, b) for a, b in zip(level[::2], level[1::2])]
        level = [w for w, _ in played]
        for j, (_, lost) in enumerate(played):
            losers[:, len(level) + j] = lost
    winner = level[0]
    active = np.searchsorted(-n, -np.arange(n[0]), side="left")
    for step in range(int(n[0])):
        lane, winner = every[: active[step]], winner[: active[step]]
        at = head[lane, winner]
        out[begin[lane] + step], shared[begin[lane] + step] = at, known[lane, winner]
        more = at + 1 < end[lane, winner]
        head[lane, winner] = at + 1
        known[lane, winner] = np.where(more, prefix[np.where(more, at + 1, 0)], -1)
        node = (winner + leaves) >> 1
        for _ in range(leaves.bit_length() - 1):
            winner, losers[lane, node] = play(lane, winner, losers[lane, node])
            node >>= 1


def removed_spans(group: pa.Table, width: int) -> Iterator[tuple[int, np.ndarray]]:
    """(uid, rows of (document in block, from, to)) for one range."""
    rows = group.to_pylist()
    for r in rows:
        if r["spans"] is not None:
            yield r["uid"], np.frombuffer(r["spans"], np.uint32).reshape(-1, 3)
    rows = [r for r in rows if r["spans"] is None]
    if not rows:
        return
    run = np.repeat(np.arange(len(rows)), [r["n"] for r in rows])
    lcp, tails, lefts, doc, place, offsets = map(np.concatenate, zip(*map(_unpacked, rows)))
    size, offsets = width - offsets[:, 1].astype(np.int64), offsets.astype(np.int64)
    right = padded(decoded_runs(lcp, size, tails, width), size)
    at, shared = merged_lanes(right, gram_keys(right.ravel(), np.arange(len(run)) * right.shape[1], 1 << 24), run)
    del right
    left = np.zeros((len(run), width - GRAM), np.uint8)
    left[np.arange(width - GRAM) < offsets[:, :1]] = lefts
    doc, place, offsets, run = doc[at], place[at], offsets[at], run[at]
    hi, lo = offsets.T
    shared[1:] = np.minimum(shared[1:], width - np.maximum(lo[1:], lo[:-1]))
    left = left[at]
    by_left, _ = ordered(padded(left, hi), np.zeros(len(run), np.int64))
    left_shared = shared_prefix(left[by_left], hi[by_left])
    gone = np.zeros((len(run), width - GRAM + 1), bool)
    left_class = np.empty(len(run), np.int64)
    for back in range(width - GRAM + 1):
        mine = np.flatnonzero((hi >= back) & (lo <= back))
        if len(mine) < 2:
            continue
        right_class = np.cumsum(shared < width - back)[mine]
        left_class[by_left] = np.cumsum(left_shared < back)
        new = firsts(right_class)  # an entry alone in its right class has no partner
        some = np.flatnonzero(~(new & np.append(new[1:], True)))
        mine, both = mine[some], right_class[some] * len(run) + left_class[mine[some]]
        o = np.argsort(both, kind="stable")
        both, d = both[o], doc[mine][o]
        if not len(o):
            continue
        new = firsts(both)
        least = np.minimum.reduceat(d, np.flatnonzero(new))[np.cumsum(new) - 1]
        gone[mine[o[d > least]], back] = True
    # neighbouring strings of an entry make one span
    edge = np.diff(np.pad(gone, ((0, 0), (1, 1))).astype(np.int8), axis=1)
    e, from_back = np.nonzero(edge == 1)
    _, to_back = np.nonzero(edge == -1)
    begin = place[e, 1].astype(np.int64) - (to_back - 1)
    end = place[e, 1].astype(np.int64) - from_back + width
    o = np.argsort(run[e], kind="stable")
    spans, of = np.stack([place[e, 0].astype(np.int64), begin, end], 1).astype(np.uint32)[o], run[e][o]
    cuts = np.flatnonzero(firsts(of)).tolist() if len(of) else []
    for c, z in zip(cuts, [*cuts[1:], len(of)]):
        yield rows[of[c]]["uid"], spans[c:z]


# ---- the operator ------------------------------------------------------------------

def together(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Small batches as few larger ones."""
    some, size = [], 0
    for rb in batches:
        some.append(rb)
        size += rb.nbytes
        if size >= BATCH_BYTES:
            yield pa.concat_batches(some)
            some, size = [], 0
    if some:
        yield pa.concat_batches(some)


def removals(docs: DataFrame, width: int, others: list[str]) -> DataFrame:
    """Blocks with ``gone``: the packed spans to remove from their texts."""
    blocks = to_blocks(docs, others)
    total = blocks.agg(F.sum("n_bytes")).first()[0] or 0
    ranges = max(1, -(-total // RANGE_BYTES))

    def send_keys(batches):
        for rb in batches:
            for row in rb.to_pylist():
                b = Block(row, width)
                at, _, _, doc = b.anchors()
                yield from together(packed_keys(row["uid"], gram_keys(b.data, at, ranges), b.ids[doc], ranges))

    texts = blocks.drop("rest")
    hot = shared_keys(texts.mapInArrow(send_keys, KEYS_DDL))

    def send(batches):
        for rb in batches:
            for row in rb.to_pylist():
                yield from together(batch_of(RUNS, out) for out in runs_of(Block(row, width), row["hot"], ranges))

    def merge(group: pa.Table) -> pa.Table:
        found: dict[int, list[np.ndarray]] = {}
        for uid, spans in removed_spans(group, width):
            found.setdefault(uid, []).append(spans)
        return pa.Table.from_arrays([pa.array(list(found), pa.int64()),
                                     pa.array([np.concatenate(x).tobytes() for x in found.values()], pa.binary())],
                                    schema=SPANS)

    runs = texts.join(hot.hint("shuffle_hash"), "uid").mapInArrow(send, RUNS_DDL)
    spans = runs.groupBy("range", "salt").applyInArrow(merge, "uid long, spans binary")
    gone = spans.groupBy("uid").agg(F.collect_list("spans").alias("gone"))
    return blocks.join(gone.hint("shuffle_hash"), "uid", "left")


def kept_texts(row: dict) -> Iterator[tuple[int | None, int, int, int, bytes]]:
    """(doc_id, bytes, removed, spans, what is left) of each text of a block."""
    ids, known = np.frombuffer(row["ids"], np.int64), np.frombuffer(row["known"], bool)
    lens = np.frombuffer(row["lens"], np.int64)
    spans = np.frombuffer(b"".join(row["gone"] or []), np.uint32).reshape(-1, 3).astype(np.int64)
    spans = spans[np.lexsort((spans[:, 1], spans[:, 0]))]
    cut = np.searchsorted(spans[:, 0], np.arange(len(ids) + 1))
    data, at = row["data"], 0
    for i, n in enumerate(lens.tolist()):
        text = data[at: at + n]
        at += n
        kept, done, removed, runs = [], 0, 0, 0
        end = -1
        for _, a, b in spans[cut[i]: cut[i + 1]].tolist():
            if a > end:
                if end >= 0:
                    removed += end - start  # noqa: F821
                    kept.append(text[done:start])  # noqa: F821
                    done = end
                start, runs = a, runs + 1  # noqa: F841
                end = b
            elif b > end:
                end = b
        if end >= 0:
            removed += end - start
            kept.append(text[done:start])
            done = end
        kept.append(text[done:])
        yield (int(ids[i]) if known[i] else None), n, removed, runs, b"".join(kept)


def suffix_dedup(docs: DataFrame, width: int = 50) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256) for every row.

    Null text counts as empty; texts shorter than ``width`` bytes keep all.  Rows
    of one doc_id do not remove from each other; rows with a null doc_id neither remove
    nor lose anything.  Empty table: empty result.  Other columns are not read.
    """
    schema = pa.schema([("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("n_removed", pa.int64()),
                        ("n_spans", pa.int64()), ("kept_sha256", pa.string())])

    def run(batches):
        for rb in batches:
            for row in rb.to_pylist():
                out = [(d, n, r, s, hashlib.sha256(k).hexdigest()) for d, n, r, s, k in kept_texts(row)]
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), schema)], schema=schema)

    return removals(docs, width, []).drop("rest").mapInArrow(
        run, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string")


def drop_repeats(docs: DataFrame, width: int = 50) -> DataFrame:
    """``docs`` with the repeats cut out of ``text`` (characters that a cut
    splits go) and ``n_chars``, if there, measured anew; documents that lose
    everything go."""
    target = to_arrow_schema(docs.schema)

    def run(batches):
        for rb in batches:
            for row in rb.to_pylist():
                rest = pa.ipc.open_stream(row["rest"]).read_all()
                kept = list(kept_texts(row))
                texts = [k.decode("utf-8", "ignore") for *_, k in kept]
                cols = [pa.array(texts, f.type) if f.name == "text" else
                        pa.array(map(len, texts), f.type) if f.name == "n_chars" else
                        rest.column(f"c{i}").combine_chunks().cast(f.type) for i, f in enumerate(target)]
                stay = pa.array([not (n and r == n) for _, n, r, _, _ in kept])
                yield from pa.Table.from_arrays(cols, schema=target).filter(stay).to_batches()

    others = [F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(docs.columns) if c not in ("text", "n_chars")]
    wide = docs.select("doc_id", "text", *others)
    names = [c for c in wide.columns if c not in ("doc_id", "text")]
    return removals(wide, width, names).mapInArrow(run, docs.schema)
