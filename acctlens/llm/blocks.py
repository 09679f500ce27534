"""Vectors packed into blocks of rows, and a query set held against them.

``pack`` turns a table of vectors into rows of up to ``BLOCK`` vectors each;
``against`` joins every block of queries with every block of candidates over
numbered lanes (an equi-join of a few large rows, spread over all executors)
and hands the pairs of blocks to a scoring function, which returns the best few
of each query; a window per query merges them.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from acctlens.llm.common import stored

BLOCK = 8192
QUERY_BLOCK = 512

PACKED = "block long, n int, width int, ids binary, vectors binary, extra binary"
SCHEMA = pa.schema([("block", pa.int64()), ("n", pa.int32()), ("width", pa.int32()), ("ids", pa.binary()),
                     ("vectors", pa.binary()), ("extra", pa.binary())])
FOUND = pa.schema([("q_block", pa.int64()), ("q_row", pa.int32()), ("query_id", pa.int64()), ("vec_id", pa.int64()),
                   ("score_long", pa.int64()), ("score_double", pa.float64())])
FOUND_DDL = "q_block long, q_row int, query_id long, vec_id long, score_long long, score_double double"


def usable(vectors: DataFrame, id_column: str, vector_column: str) -> DataFrame:
    """(id, v): rows with an id and a vector of finite components only."""
    x = F.col(vector_column).cast("array<double>")
    fine = F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    return vectors.select(F.col(id_column).cast("long").alias("id"), x.alias("v")).filter("id is not null").filter(fine)


def matrix(lists: list, dtype=np.float64) -> np.ndarray:
    """Rows of possibly unequal length, short ones filled with zeros."""
    width = max(map(len, lists), default=0)
    if all(len(x) == width for x in lists):
        return np.array(lists, dtype=dtype).reshape(len(lists), width)
    out = np.zeros((len(lists), width), dtype)
    for i, x in enumerate(lists):
        out[i, : len(x)] = x
    return out


def batch_of(schema: pa.Schema, row: tuple) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([x], f.type) for x, f in zip(row, schema)], schema=schema)


def unpack(n: int, width: int, ids: bytes, vectors: bytes, dtype) -> tuple[np.ndarray, np.ndarray]:
    return np.frombuffer(ids, np.int64), np.frombuffer(vectors, dtype).reshape(n, width)


def pack(vectors: DataFrame, convert: Callable[[np.ndarray], np.ndarray], name: str,
         extra: Callable[[np.ndarray], bytes] | None = None) -> DataFrame:
    """(id, v) -> stored table of blocks; rows of a block are in the order of
    their id, so a smaller row number is a smaller id."""

    def run(batches: Iterator[pa.RecordBatch]):
        ids: list[int] = []
        rows: list = []

        def block():
            order = np.argsort(np.array(ids, np.int64), kind="stable")
            m = convert(matrix(rows))[order]
            return batch_of(SCHEMA, (0, len(ids), m.shape[1], np.array(ids, np.int64)[order].tobytes(), m.tobytes(),
                                     extra(m) if extra else None))

        for rb in batches:
            for i, v in zip(rb.column(0).to_pylist(), rb.column(1).to_pylist()):
                ids.append(i)
                rows.append(v)
                if len(ids) == BLOCK:
                    yield block()
                    ids, rows = [], []
        if ids:
            yield block()

    packed = vectors.mapInArrow(run, PACKED).drop("block")
    packed = stored(packed.select(F.monotonically_increasing_id().alias("block"), *packed.columns), name)
    return packed


def every_nth_query(blocks: DataFrame, every: int, dtype) -> DataFrame:
    """Blocks of the rows whose id is divisible by ``every``; ``extra`` holds
    the row numbers they have in their candidate block."""

    def run(batches):
        for rb in batches:
            for b, n, width, ids, vectors in zip(*[rb.column(i).to_pylist() for i in range(5)]):
                i, v = unpack(n, width, ids, vectors, dtype)
                at = np.flatnonzero(i % every == 0)
                for k in range(0, len(at), QUERY_BLOCK):
                    sel = at[k: k + QUERY_BLOCK]
                    yield batch_of(SCHEMA, (b, len(sel), width, i[sel].tobytes(), v[sel].tobytes(),
                                            sel.astype(np.int32).tobytes()))

    return blocks.mapInArrow(run, PACKED)


def against(queries: DataFrame, blocks: DataFrame, best: Callable, order: list, k: int) -> DataFrame:
    """The k best of each query row over all blocks; ``best(query, block)``
    gets the fields of both and yields (row of the query, candidate id, score)
    arrays."""
    lanes = max(1, blocks.count())
    numbered = blocks.select(F.struct("*").alias("c"), F.pmod(F.xxhash64("block"), F.lit(lanes)).alias("lane"))
    sent = queries.select(F.struct("*").alias("q"), F.explode(F.sequence(F.lit(0).cast("long"), F.lit(lanes - 1).cast("long"))).alias("lane"))
    pairs = sent.hint("shuffle_hash").join(numbered, "lane").select("q", "c")

    def run(batches):
        for rb in batches:
            for i in range(rb.num_rows):
                q, c = rb.column(0)[i].as_py(), rb.column(1)[i].as_py()
                rows, ids, scores = best(q, c)
                if not len(rows):
                    continue
                whole = scores.dtype.kind == "i"
                nothing = pa.nulls(len(rows))
                yield pa.RecordBatch.from_arrays([
                    pa.array(np.full(len(rows), q["block"], np.int64)),
                    pa.array(np.frombuffer(q["extra"], np.int32)[rows]),
                    pa.array(np.frombuffer(q["ids"], np.int64)[rows]), pa.array(ids),
                    pa.array(scores, pa.int64()) if whole else nothing.cast(pa.int64()),
                    nothing.cast(pa.float64()) if whole else pa.array(scores, pa.float64())], schema=FOUND)

    found = pairs.mapInArrow(run, FOUND_DDL)
    ranked = found.withColumn("rank", F.row_number().over(Window.partitionBy("q_block", "q_row").orderBy(*order)))
    return ranked.filter(F.col("rank") <= k)
