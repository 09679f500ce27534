"""Approximate nearest neighbours by multi-index hashing.

Codes: vectors are scaled to unit length, centred, turned by a learned rotation
(principal axes, then iterative quantisation) and cut to their signs.  Every
row is indexed: a block of rows is written with, for each substring of the code
(of about log2(rows) bits), its rows in the order of the substring and the start of each bucket.

Probing goes ring by ring: all buckets whose substring differs by 0, 1, 2 ... bits.
By the pigeonhole bound, after ring ``a`` over ``parts`` substrings every code within
parts * (a + 1) - 1 bits has been seen.  Codes seen and near enough are reranked by exact cosines.
A query's radius shrinks as it finds neighbours: a row with a cosine of s or more lies,
with probability ``coverage``, within the number of bits fitted for s, so probing stops as soon as
that many bits, for the k-th best cosine so far, are covered.  Until k rows are found the radius is the whole code.
Each query is searched in its own block first; its k-th cosine there bounds the radius in all others.

The rotation and the bits by cosine are fitted on at most ``SAMPLE`` rows; how many rows the
table has doesn't enter into them.
"""

from __future__ import annotations

import math
from functools import lru_cache

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from acctlens.llm.blocks import BLOCK, PACKED, QUERY_BLOCK, SCHEMA, against, batch_of, pack, unpack, usable
from acctlens.llm.common import stored

SAMPLE = 4096
PART_BITS, MOST_BITS = 8, 16
STEPS, ENOUGH = 40, 50  # steps of the cosine; pairs from which a step has a radius of its own
ONES = np.array([bin(i).count("1") for i in range(256)], np.uint8)


def unit(m: np.ndarray) -> np.ndarray:
    size = np.sqrt((m * m).sum(axis=1, keepdims=True))
    return m / np.where(size > 0, size, 1)


def fitted_rotation(sample: np.ndarray, rounds: int = 30, seed: int = 11) -> tuple[np.ndarray, np.ndarray]:
    """(mean, rotation) of iterative quantisation on unit vectors."""
    mean = sample.mean(axis=0)
    x = sample - mean
    _, axes = np.linalg.eigh(x.T @ x)
    width = x.shape[1]
    turn, _ = np.linalg.qr(np.random.default_rng(seed).standard_normal((width, width)))
    v = x @ axes
    for _ in range(rounds):
        u, _, w = np.linalg.svd(np.where(v @ turn >= 0, 1.0, -1.0).T @ v)
        turn = (u @ w).T
    return mean, axes @ turn


def codes_of(m: np.ndarray, mean: np.ndarray, rotation: np.ndarray) -> np.ndarray:
    """Binary codes, a byte for each substring."""
    x = np.zeros((len(m), len(mean)))
    x[:, : min(m.shape[1], len(mean))] = m[:, : len(mean)]
    return np.packbits((unit(x) - mean) @ rotation >= 0, axis=1)


def parts_of(width: int, rows: int) -> list[tuple[int, int]]:
    """Substrings (first bit, end) of about log2(rows) bits each."""
    bits = min(MOST_BITS, max(PART_BITS, round(math.log2(max(rows, 2)))))
    edges = np.linspace(0, width, -(-width // bits) + 1).round().astype(int).tolist()
    return list(zip(edges, edges[1:]))


def substrings(codes: np.ndarray, parts: list[tuple[int, int]]) -> np.ndarray:
    """(parts, rows): the number that each substring spells."""
    bits = np.unpackbits(codes, axis=1)
    return np.stack([bits[:, lo:hi] @ (1 << np.arange(hi - lo)) for lo, hi in parts])


def substring_index(codes: np.ndarray, parts: list[tuple[int, int]]) -> list[tuple[np.ndarray, np.ndarray]]:
    """For every substring: rows by its value, and where each value starts."""
    out = []
    for value, (lo, hi) in zip(substrings(codes, parts), parts):
        order = np.argsort(value, kind="stable")
        out.append((order.astype(np.int32), np.searchsorted(value[order], np.arange((1 << hi - lo) + 1)).astype(np.int32)))
    return out


def index_bytes(codes: np.ndarray, parts: list[tuple[int, int]]) -> bytes:
    return codes.tobytes() + b"".join(x.tobytes() for pair in substring_index(codes, parts) for x in pair)


def index_from(data: bytes, n: int, parts: list[tuple[int, int]]) -> tuple[np.ndarray, list[tuple[np.ndarray, np.ndarray]]]:
    """Codes and index of a block, as ``index_bytes`` wrote them."""
    at = n * parts[-1][1] // 8
    codes, index = np.frombuffer(data, np.uint8, at).reshape(n, -1), []
    for lo, hi in parts:
        pair = []
        for size in (n, (1 << hi - lo) + 1):
            pair.append(np.frombuffer(data, np.int32, size, at))
            at += 4 * size
        index.append(tuple(pair))
    return codes, index


@lru_cache(maxsize=64)
def rings(bits: int) -> list[np.ndarray]:
    """Numbers of ``bits`` bits by how many of them are set."""
    every = np.arange(1 << bits, dtype=np.uint32)
    many = ONES[every.view(np.uint8).reshape(-1, 4)].sum(axis=1)
    return [every[many == a].astype(np.int64) for a in range(bits + 1)]


def in_ring(values: np.ndarray, a: int, index: list, parts: list[tuple[int, int]], seen: np.ndarray) -> np.ndarray:
    """Rows not seen so far, one of whose substrings differs from ``values`` by ``a`` bits; marks them as seen."""
    new = []
    for value, (order, starts), (lo, hi) in zip(values.tolist(), index, parts):
        if a > hi - lo:
            continue
        bucket = rings(hi - lo)[a] ^ value
        begin, size = starts[bucket], starts[bucket + 1] - starts[bucket]
        held = size > 0
        begin, size = begin[held], size[held]
        rows = order[np.repeat(begin - (np.cumsum(size) - size), size) + np.arange(size.sum())]
        rows = rows[~seen[rows]]
        seen[rows] = True
        new.append(rows)
    return np.concatenate(new) if new else np.zeros(0, np.int32)


def radius_by_cosine(sample: np.ndarray, codes: np.ndarray, coverage: float, queries: int = 256) -> np.ndarray:
    """For each step of the cosine from -1 on the bits within which ``coverage`` of the
    sample's pairs with such a cosine lie.  A step with few pairs takes the radius of the one before, which is wider."""
    u = unit(sample)
    width = codes.shape[1] * 8
    of, bits = [], []
    for i in range(min(queries, len(u))):
        other = np.arange(len(u)) != i
        of.append(step_of((u @ u[i])[other]))
        bits.append(ONES[codes ^ codes[i]].sum(axis=1)[other])
    of, bits = np.concatenate(of), np.concatenate(bits)
    out = np.full(STEPS + 1, float(width))
    for x in range(STEPS + 1):
        own = bits[of == x]
        out[x] = np.ceil(np.quantile(own, coverage)) if len(own) >= ENOUGH else out[x - 1] if x else width
    return np.maximum.accumulate(out[::-1])[::-1].astype(np.int64)


def step_of(cosine):
    return np.clip(np.floor((np.asarray(cosine) + 1) * STEPS / 2), 0, STEPS).astype(np.int64)


def search(code: np.ndarray, codes: np.ndarray, index: list, parts: list[tuple[int, int]], radii: np.ndarray, score, k: int,
           least: float = -math.inf, skip: int = -1) -> tuple[np.ndarray, np.ndarray, int]:
    """(rows reranked, their scores, number of rows seen in buckets) for a query whose
    k-th best score elsewhere is ``least``; row ``skip`` takes no part."""
    width = codes.shape[1] * 8
    seen = np.zeros(len(codes), bool)
    if skip >= 0:
        seen[skip] = True
    values = substrings(code[None], parts)[:, 0]
    need = width if least == -math.inf else int(radii[step_of(least)])
    waiting, far = np.zeros(0, np.int32), np.zeros(0, np.int64)
    rows, scores, probed = np.zeros(0, np.int32), np.zeros(0), 0
    a = 0
    while True:
        new = in_ring(values, a, index, parts, seen)
        probed += len(new)
        waiting = np.concatenate([waiting, new])
        far = np.concatenate([far, ONES[codes[new] ^ code].sum(axis=1, dtype=np.int64)])
        reach = min(width, len(parts) * (a + 1) - 1)  # no code this near is unseen
        near = far <= min(reach, need)
        if near.any():
            rows = np.concatenate([rows, waiting[near]])
            scores = np.concatenate([scores, score(waiting[near])])
            waiting, far = waiting[~near], far[~near]
            if len(rows) >= k:
                least = max(least, float(np.partition(scores, len(scores) - k)[len(scores) - k]))
                need = min(need, int(radii[step_of(least)]))
        if reach >= need:
            return rows, scores, probed
        a += 1


def best_rows(rows: np.ndarray, scores: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The k best, ties to the smaller row."""
    order = np.lexsort((rows, -scores))[:k]
    return rows[order], scores[order]


def ann_search(vectors: DataFrame, k: int = 5, every: int = 50, coverage: float = 0.97, sample_rows: int = SAMPLE,
               id_column: str = "vec_id", vector_column: str = "embedding") -> DataFrame:
    """(query_id, rank, vec_id, score): the k nearest by cosine found for each
    row whose id is divisible by ``every``, over all rows but its own.

    Rows without an id, with a null or zero vector or with null or non-finite
    components take no part.  Ties go to the smaller id; repeated rows are
    candidates and queries of their own.  Unequal lengths: missing components
    count as zero.  Fewer than k candidates: all.  Empty table: empty result.
    """
    rows = usable(vectors, id_column, vector_column).filter(F.exists("v", lambda x: x != 0))
    total = rows.count()
    if not total:
        return rows.select(F.col("id").alias("query_id"), F.lit(1).alias("rank"), F.col("id").alias("vec_id"),
                           F.lit(0.0).alias("score"))
    drawn = rows.sample(min(1.0, 1.3 * sample_rows / total), seed=5).limit(sample_rows) if total > sample_rows else rows
    lists = [r.v for r in drawn.collect()]
    width = -(-max(map(len, lists)) // PART_BITS) * PART_BITS
    sample = np.zeros((len(lists), width))
    for i, x in enumerate(lists):
        sample[i, : len(x)] = x
    mean, rotation = fitted_rotation(unit(sample))
    radii = radius_by_cosine(sample, codes_of(sample, mean, rotation), coverage)
    parts = parts_of(rotation.shape[1], min(total, BLOCK))

    blocks = pack(rows, lambda m: m, "ann_index", lambda m: index_bytes(codes_of(m, mean, rotation), parts))

    def searcher(n, w, ids, vectors, extra):
        """What searches a block for a query vector."""
        ids, cm = unpack(n, w, ids, vectors, np.float64)
        codes, index = index_from(extra, len(ids), parts)
        sizes = np.sqrt((cm * cm).sum(axis=1))

        def one(v, least, skip):
            shared = min(len(v), cm.shape[1])

            def cosine(near):
                return (cm[near, :shared] * v[:shared]).sum(axis=1) / (sizes[near] * np.sqrt((v * v).sum()))

            code = codes_of(v[None], mean, rotation)[0]
            return best_rows(*search(code, codes, index, parts, radii, cosine, k, least, skip)[:2], k)
        return ids, cm, one

    def ask(batches):
        # a query's extra: its row in its own block, then its k-th cosine there
        for rb in batches:
            for c in rb.to_pylist():
                ids, cm, one = searcher(c["n"], c["width"], c["ids"], c["vectors"], c["extra"])
                at = np.flatnonzero(ids % every == 0)
                for lo in range(0, len(at), QUERY_BLOCK):
                    own = at[lo: lo + QUERY_BLOCK]
                    near = [one(cm[r], -math.inf, r)[1] for r in own.tolist()]
                    least = np.array([x[k - 1] if len(x) == k else -math.inf for x in near])
                    yield batch_of(SCHEMA, (c["block"], len(own), c["width"], ids[own].tobytes(), cm[own].tobytes(),
                                            own.astype(np.int32).tobytes() + least.tobytes()))

    def best(q, c):
        _, qm = unpack(q["n"], q["width"], q["ids"], q["vectors"], np.float64)
        own, least = np.frombuffer(q["extra"], np.int32, q["n"]), np.frombuffer(q["extra"][4 * q["n"]:], np.float64)
        ids, _, one = searcher(c["n"], c["width"], c["ids"], c["vectors"], c["extra"])
        home = q["block"] == c["block"]
        found = [one(v, -math.inf if home else s, r if home else -1) for v, s, r in zip(qm, least.tolist(), own.tolist())]
        rows, scores = (np.concatenate(x) for x in zip(*found))
        return np.repeat(np.arange(len(found)), [len(r) for r, _ in found]), ids[rows], scores

    queries = stored(blocks.mapInArrow(ask, PACKED), "ann_queries")
    found = against(queries, blocks, best, [F.desc("score_double"), F.asc("vec_id")], k)
    return found.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", F.col("score_double").alias("score"))
