"""Exact top-k search by exhaustive term-at-a-time accumulation.

A term is a dimension; a vector's weight for it is floor(256 * x).  A block of
candidates is a set of posting lists, one for each term.  A block of queries
goes through its terms one at a time: every query row that has the term
scatters its weight times the postings into its dense array of scores.  A
partition selection takes the best of each array; blocks are merged per query.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from acctlens.llm.blocks import against, every_nth_query, pack, unpack, usable

ROWS_AT_ONCE = 32


def quantised(m: np.ndarray) -> np.ndarray:
    return np.floor(256.0 * m).astype(np.int64)


def accumulate(queries: np.ndarray, candidates: np.ndarray) -> np.ndarray:
    """Inner products: query rows x candidates, one term after the other."""
    scores = np.zeros((len(queries), len(candidates)), np.int64)
    for term in range(min(queries.shape[1], candidates.shape[1])):
        weights = queries[:, term]
        rows = np.flatnonzero(weights)
        column = candidates[:, term]
        at = np.flatnonzero(column)
        if not len(rows) or not len(at):
            continue
        if 2 * len(at) >= len(column):  # a posting list that long is kept whole
            if len(rows) == len(queries):
                scores += np.multiply.outer(weights, column)
            else:
                scores[rows] += np.multiply.outer(weights[rows], column)
        else:
            scores[np.ix_(rows, at)] += np.multiply.outer(weights[rows], column[at])
    return scores


def select_best(scores: np.ndarray, k: int, barred: int | None) -> np.ndarray:
    """Positions of the k best, ties to the smaller position."""
    if barred is not None:
        keep = np.delete(np.arange(len(scores)), barred)
        return keep[select_best(scores[keep], k, None)]
    if len(scores) > k:
        edge = np.partition(scores, len(scores) - k)[len(scores) - k]
        above, equal = np.flatnonzero(scores > edge), np.flatnonzero(scores == edge)
        return np.concatenate([above, equal[: k - len(above)]])
    return np.arange(len(scores))


def exact_top_k(vectors: DataFrame, k: int = 5, every: int = 50, id_column: str = "vec_id",
                vector_column: str = "embedding") -> DataFrame:
    """(query_id, rank, vec_id, score): the k highest inner products for each
    row whose id is divisible by ``every``, over all rows but its own.

    Rows without an id, with a null vector, or with null or non-finite components
    take no part.  Ties go to the smaller id; repeated rows are candidates and
    queries of their own (a row bars only itself).  Unequal lengths: missing
    components count as zero.  Fewer than k candidates: all.  Empty table:
    empty result.
    """
    blocks = pack(usable(vectors, id_column, vector_column), quantised, "topk_blocks")
    queries = every_nth_query(blocks, every, np.int64)

    def best(q, c):
        _, qm = unpack(q["n"], q["width"], q["ids"], q["vectors"], np.int64)
        ids, cm = unpack(c["n"], c["width"], c["ids"], c["vectors"], np.int64)
        own = np.frombuffer(q["extra"], np.int32)
        cm = np.asfortranarray(cm)
        rows, at, scores = [], [], []
        for first in range(0, len(qm), ROWS_AT_ONCE):
            for r, s in enumerate(accumulate(qm[first: first + ROWS_AT_ONCE], cm), first):
                top = select_best(s, k, int(own[r]) if q["block"] == c["block"] else None)
                rows.append(np.full(len(top), r))
                at.append(top)
                scores.append(s[top])
        rows, at, scores = map(np.concatenate, (rows, at, scores))
        return rows, ids[at], scores

    found = against(queries, blocks, best, [F.desc("score_long"), F.asc("vec_id")], k)
    return found.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", F.col("score_long").alias("score"))
