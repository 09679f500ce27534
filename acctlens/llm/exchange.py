"""Which 32-bit keys of a block occur in other documents: an exchange of
packed, sorted keys by range of their hash.

Keys are ``range << 32 | 32 bits``.  Equal bits of unequal things only add work for
the caller, who compares what stands behind a key.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from acctlens.llm.blocks import batch_of

U64 = np.uint64
#: Occurrences from which a key is called heavy.
HEAVY = 20_000

KEYS = pa.schema([("range", pa.int32()), ("uid", pa.int64()), ("keys", pa.binary()), ("counts", pa.binary()),
                  ("many", pa.binary())])
KEYS_DDL = "range int, uid long, keys binary, counts binary, many binary"
SHARED = pa.schema([("uid", pa.int64()), ("range", pa.int32()), ("keys", pa.binary()), ("heavy", pa.binary())])


def key_of(h: np.ndarray, ranges: int) -> np.ndarray:
    """Keys from 64-bit hashes."""
    return (((h >> U64(40)) * U64(ranges)) >> U64(24) << U64(32)) | ((h >> U64(8)) & U64(0xFFFFFFFF))


def by_range(sorted_keys: np.ndarray, ranges: int) -> Iterator[tuple[int, slice]]:
    cut = np.searchsorted(sorted_keys, np.arange(ranges + 1, dtype=U64) << U64(32))
    for r in np.flatnonzero(np.diff(cut)):
        yield int(r), slice(cut[r], cut[r + 1])


def firsts(sorted_values: np.ndarray) -> np.ndarray:
    """Marks the first of each run of equal values."""
    new = np.ones(len(sorted_values), bool)
    new[1:] = sorted_values[1:] != sorted_values[:-1]
    return new


def packed_keys(uid: int, key: np.ndarray, ids: np.ndarray, ranges: int) -> Iterator[pa.RecordBatch]:
    """KEYS rows of a block: each key once, with its occurrences and whether
    more than one doc_id has it."""
    order = np.argsort(key, kind="stable")
    key, ids = key[order], ids[order]
    begin = np.flatnonzero(firsts(key))
    if not len(begin):
        return
    count = np.minimum(np.diff(np.append(begin, len(key))), 65535).astype(np.uint16)
    many = np.minimum.reduceat(ids, begin) != np.maximum.reduceat(ids, begin)
    key = key[begin]
    for r, s in by_range(key, ranges):
        yield batch_of(KEYS, (r, uid, key[s].astype(np.uint32).tobytes(), count[s].tobytes(), many[s].tobytes()))


def _meet(group: pa.Table) -> pa.Table:
    uid = group.column("uid").to_pylist()
    keys = [np.frombuffer(x, np.uint32) for x in group.column("keys").to_pylist()]
    key = np.concatenate(keys)
    count = np.concatenate([np.frombuffer(x, np.uint16) for x in group.column("counts").to_pylist()]).astype(np.int64)
    many = np.concatenate([np.frombuffer(x, bool) for x in group.column("many").to_pylist()])
    order = np.argsort(key, kind="stable")
    new = firsts(key[order])
    begin = np.flatnonzero(new)
    of = np.empty(len(key), np.int64)
    of[order] = np.cumsum(new) - 1
    total = np.add.reduceat(count[order], begin)
    hot = (np.diff(np.append(begin, len(key))) > 1) | np.logical_or.reduceat(many[order], begin)
    out, end = [], 0
    for u, k in zip(uid, keys):
        s = of[end: end + len(k)]
        end += len(k)
        mine = hot[s]
        if mine.any():
            out.append((u, group.column("range")[0].as_py(), k[mine].tobytes(), (total[s][mine] > HEAVY).tobytes()))
    cols = list(zip(*out)) or [[]] * 4
    return pa.Table.from_arrays([pa.array(c, f.type) for c, f in zip(cols, SHARED)], schema=SHARED)


def shared_keys(keys: DataFrame) -> DataFrame:
    """KEYS rows -> (uid, hot): for each block its keys that a second
    document has, with a flag for heavy ones."""
    met = keys.groupBy("range").applyInArrow(_meet, "uid long, range int, keys binary, heavy binary")
    return met.groupBy("uid").agg(F.collect_list(F.struct("range", "keys", "heavy")).alias("hot"))


def found(key: np.ndarray, hot: list[dict]) -> tuple[np.ndarray, np.ndarray]:
    """(whether a key is among the shared ones, whether it is heavy)."""
    wanted = np.concatenate([(U64(h["range"]) << U64(32)) | np.frombuffer(h["keys"], np.uint32).astype(U64) for h in hot])
    heavy = np.concatenate([np.frombuffer(h["heavy"], bool) for h in hot])
    order = np.argsort(wanted)
    wanted, heavy = wanted[order], heavy[order]
    where = np.minimum(np.searchsorted(wanted, key), len(wanted) - 1)
    return wanted[where] == key, heavy[where]
