"""SimHash near-duplicates through a vantage-point tree.

Fingerprints are 64 majority bits over the XXH64 values of word shingles.
Equal fingerprints are one entry.  A vantage-point tree over the entries is
drawn from a bounded sample: each inner node holds a fingerprint and a radius.
An entry lives in one leaf.  For links of up to ``bits`` differing bits, the
triangle inequality says which other leaves can hold a partner: at a node,
an entry within ``bits`` of the sphere is also sent to the other side (to be
compared with what lives there), and all else is pruned.  A pair on two sides of
a sphere is found on the inner side only, so entries that live outside visit the
inside and not the other way round.

Leaves are the shards: every leaf compares its visitors with its residents, along a
further vantage point of its own, and returns a spanning forest of the links it
finds instead of all pairs.  A leaf that is larger than planned (a cloud of near
copies that no sphere divides) is dealt out as pairs of chunks.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from acctlens.llm.common import stored, utf8_rows
from acctlens.llm.graph import components

LEAF = 8192
MAX_DEPTH = 12
SAMPLE = 1 << 16
CHUNK = 2 * LEAF
CELLS = 1 << 20
SHINGLES_AT_ONCE = 1 << 16

FP = pa.schema([("doc_id", pa.int64()), ("fp", pa.int64())])
ROUTED = pa.schema([("leaf", pa.int32()), ("fp", pa.int64()), ("home", pa.bool_())])
LINK = pa.schema([("u", pa.int64()), ("v", pa.int64())])


def fingerprint(text: bytes, words_in_shingle: int = 3, seed: int = 42) -> int:
    words = text.lower().split()
    if not words:
        return 0
    line = b" ".join(words)
    k = min(words_in_shingle, len(words))
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    digest, n = xxhash.xxh64_intdigest, len(words) - k + 1
    ones = np.zeros(64, np.int64)
    for at in range(0, n, SHINGLES_AT_ONCE):
        part = slice(at, min(n, at + SHINGLES_AT_ONCE))
        h = np.array([digest(line[a:b], seed) for a, b in zip(starts[part].tolist(), ends[k - 1:][part].tolist())], np.uint64)
        ones += np.add.reduce(np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little"), axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > n, bitorder="little").view(np.int64)[0])


def fingerprints(docs: DataFrame, words_in_shingle: int = 3) -> DataFrame:
    def run(batches):
        for rb in batches:
            fps = [fingerprint(t, words_in_shingle) for t in utf8_rows(rb, "text")]
            yield pa.RecordBatch.from_arrays([rb.column(0).cast(pa.int64()), pa.array(fps, pa.int64())], schema=FP)

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, "doc_id long, fp long")


def distance(a: np.ndarray, b) -> np.ndarray:
    return np.bitwise_count((a ^ b).view(np.uint64))  # of a negative number it would count the absolute value's bits


def vantage_tree(sample: np.ndarray, depth: int, seed: int = 3) -> list[tuple[int, int] | None]:
    """Heap of (vantage point, radius); None where a node is a leaf.  The point
    with the widest spread of distances among a few is taken, at the median."""
    heap: list[tuple[int, int] | None] = [None] * (1 << depth)
    rng = np.random.default_rng(seed)

    def split(at: int, own: np.ndarray, level: int):
        if level == depth or len(own) < 2:
            return
        tried = rng.choice(own, min(8, len(own)), replace=False)
        spread = [distance(own, tried[i: i + 1]) for i in range(len(tried))]
        best = int(np.argmax([d.std() for d in spread]))
        d = spread[best]
        radius = int(np.median(d))
        if not (d > radius).any():
            radius -= 1
        if radius < 0 or not (d <= radius).any():
            return
        heap[at] = (int(tried[best]), radius)
        split(2 * at, own[d <= radius], level + 1)
        split(2 * at + 1, own[d > radius], level + 1)

    split(1, sample, 0)
    return heap


def route(fps: np.ndarray, heap: list, bits: int):
    """Yields (leaf, fingerprints, whether they live there)."""
    todo = [(1, fps, fps[:0])]
    while todo:
        at, own, guests = todo.pop()
        if at >= len(heap) or heap[at] is None:
            for entries, home in ((own, True), (guests, False)):
                if len(entries):
                    yield at, entries, home
            continue
        point, radius = heap[at]
        d, g = distance(own, np.array([point])).astype(int), distance(guests, np.array([point])).astype(int)
        todo.append((2 * at, own[d <= radius], np.concatenate([own[(d > radius) & (d <= radius + bits)],
                                                               guests[g <= radius + bits]])))
        todo.append((2 * at + 1, own[d > radius], guests[g > radius - bits]))


def forest(residents: np.ndarray, queries: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Links of a spanning forest over the pairs (query, resident) within
    ``bits``.  Both sides are ordered by their distance to one resident; only
    slices whose distances differ by at most ``bits`` meet."""
    nodes = np.unique(np.concatenate([residents, queries]))
    label = np.arange(len(nodes))
    if not len(residents) or not len(queries):
        return nodes[:0], nodes[:0]
    point = residents[:1]
    residents = residents[np.argsort(distance(residents, point), kind="stable")]
    queries = queries[np.argsort(distance(queries, point), kind="stable")]
    steps = np.arange(66)
    r_from = np.searchsorted(distance(residents, point), steps)
    q_from = np.searchsorted(distance(queries, point), steps)
    r_at, q_at = np.searchsorted(nodes, residents), np.searchsorted(nodes, queries)
    for d in range(65):
        lo, hi = r_from[max(0, d - bits)], r_from[min(65, d + bits + 1)]
        if lo == hi:
            continue
        rows = max(1, CELLS // (hi - lo))
        for a in range(q_from[d], q_from[d + 1], rows):
            b = min(a + rows, q_from[d + 1])
            i, j = np.nonzero(distance(queries[a:b, None], residents[None, lo:hi]) <= bits)
            join(label, q_at[a:b][i], r_at[lo:hi][j])
    tied = np.flatnonzero(label != np.arange(len(nodes)))
    return nodes[tied], nodes[label[tied]]


def join(label: np.ndarray, u: np.ndarray, v: np.ndarray) -> None:
    """Merge the labels of u[i] and v[i], in place; labels end at roots."""
    while len(u):
        a, b = label[u], label[v]
        apart = a != b
        u, v, a, b = u[apart], v[apart], a[apart], b[apart]
        if not len(u):
            return
        np.minimum.at(label, np.maximum(a, b), np.minimum(a, b))
        while True:
            up = label[label]
            if (up == label).all():
                break
            label[:] = up


def near_links(entries: DataFrame, bits: int = 3) -> DataFrame:
    """Distinct ``fp`` -> links (u, v) that join all pairs within ``bits``."""
    count = entries.count()
    depth = 0
    while depth < MAX_DEPTH and (count >> depth) > LEAF:
        depth += 1
    heap: list = [None]
    if depth:
        drawn = entries.select("fp").sample(min(1.0, 1.1 * SAMPLE / count), seed=9).limit(SAMPLE).toArrow()
        heap = vantage_tree(np.sort(drawn.column(0).to_numpy()), depth)

    def send(batches):
        for rb in batches:
            for leaf, fps, home in route(rb.column(0).to_numpy(zero_copy_only=False), heap, bits):
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(fps), leaf, np.int32)), pa.array(fps),
                                                  pa.array(np.full(len(fps), home))], schema=ROUTED)

    routed = stored(entries.select("fp").mapInArrow(send, "leaf int, fp long, home boolean"), "simhash_routed")
    # at most 2^MAX_DEPTH leaves
    leaves = routed.groupBy("leaf").agg(F.ceil(F.sum(F.col("home").cast("int")) / CHUNK).alias("t"),
                                        F.ceil(F.count(F.lit(1)) / (4 * CHUNK)).alias("q"))
    dealt = (routed.join(F.broadcast(leaves.withColumn("t", F.greatest("t", F.lit(1)))), "leaf")
             .withColumn("own_t", F.pmod(F.xxhash64("fp"), "t")).withColumn("own_q", F.pmod(F.xxhash64("fp", F.lit(1)), "q")))
    # a role is bit 1 for a resident that is searched, bit 2 for an entry that searches
    as_query = F.transform(F.sequence(F.lit(0).cast("long"), F.col("t") - 1), lambda i: F.struct(
        i.alias("t"), F.col("own_q").alias("q"), F.when(F.col("home") & (i == F.col("own_t")), 3).otherwise(2).alias("role")))
    as_target = F.transform(
        F.filter(F.sequence(F.lit(0).cast("long"), F.col("q") - 1), lambda i: F.col("home") & (i != F.col("own_q"))),
        lambda i: F.struct(F.col("own_t").alias("t"), i.alias("q"), F.lit(1).alias("role")))
    cells = dealt.select("leaf", "fp", F.explode(F.concat(as_query, as_target)).alias("c")).select(
        "leaf", "c.t", "c.q", "fp", "c.role")

    def search(group: pa.Table) -> pa.Table:
        fps, role = group.column("fp").to_numpy(), group.column("role").to_numpy()
        u, v = forest(np.unique(fps[role & 1 > 0]), np.unique(fps[role & 2 > 0]), bits)
        return pa.table([pa.array(u, pa.int64()), pa.array(v, pa.int64())], schema=LINK)

    return cells.groupBy("leaf", "t", "q").applyInArrow(search, "u long, v long")


def _rooted(docs: DataFrame, words_in_shingle: int, bits: int) -> DataFrame:
    """(fp, doc_id, root, component_id) for every row of ``docs``; ``root`` tells components apart."""
    rows = stored(fingerprints(docs, words_in_shingle), "simhash_rows")
    entries = stored(rows.groupBy("fp").agg(F.min("doc_id").alias("rep")), "simhash_entries")
    roots = components(near_links(entries, bits)).withColumnRenamed("node", "fp")
    rooted = entries.join(roots, "fp", "left").select("fp", "rep", F.coalesce("root", "fp").alias("root"))
    named = rooted.join(rooted.groupBy("root").agg(F.min("rep").alias("component_id")), "root").select("fp", "root", "component_id")
    return rows.join(named, "fp")


def simhash_groups(docs: DataFrame, words_in_shingle: int = 3, bits: int = 3) -> DataFrame:
    """(doc_id, fingerprint, component_id) for every row of ``docs``.

    Null text counts as empty; texts without words have fingerprint zero and
    link like any other; shorter texts than a shingle are one shingle.  Exact
    copies and repeated rows share an entry of the tree, so groups of any size cost
    one entry.  Rows with a null doc_id stay, but name no component unless all
    of it has none.  Empty table: empty result.  Other columns are not read.
    """
    return _rooted(docs, words_in_shingle, bits).select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def drop_near_copies(docs: DataFrame, words_in_shingle: int = 3, bits: int = 3) -> DataFrame:
    """``docs`` less all but one row of each group: one with the smallest doc_id.  Rows of one
    doc_id whose texts are in different groups are judged apart.  Rows with a null doc_id stay."""
    rows = stored(_rooted(docs, words_in_shingle, bits).filter("doc_id is not null").select("doc_id", "fp", "root", "component_id"),
                  "simhash_known")
    least = rows.filter("doc_id = component_id").groupBy("root").agg(F.min(F.struct("doc_id", "fp")).alias("k")).select("k.*")
    keep = stored(least.join(rows.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n")), "doc_id"), "simhash_keep")
    once = docs.join(keep.filter("n = 1").hint("shuffle_hash"), "doc_id", "left_semi")
    # rows of a repeated doc_id are told apart by their fingerprints
    names = docs.columns
    at = names.index("text")
    repeated = docs.join(keep.filter("n > 1"), "doc_id", "left_semi").select(*names).toDF(*[f"c{i}" for i in range(len(names))])

    def with_fingerprint(batches):
        for rb in batches:
            fps = [fingerprint(t, words_in_shingle) for t in utf8_rows(rb, f"c{at}")]
            yield pa.RecordBatch.from_arrays([*rb.columns, pa.array(fps, pa.int64())], names=[*rb.schema.names, "fp"])

    kind = StructType([*repeated.schema.fields, StructField("fp", LongType())])
    doc = f"c{names.index('doc_id')}"
    wanted = keep.filter("n > 1").select(F.col("doc_id").alias(doc), "fp")
    several = repeated.mapInArrow(with_fingerprint, kind).join(wanted, [doc, "fp"], "left_semi").dropDuplicates([doc, "fp"])
    several = several.select(*[f"c{i}" for i in range(len(names))]).toDF(*names)
    return once.unionByName(several).unionByName(docs.filter("doc_id is null")).select(*names)
