"""Merkle manifest of a table by time-forward processing.

Every row is a leaf.  The leaves of a tree stand in a fixed order; runs of
``FAN`` consecutive nodes hash to their parent until one node is left.  Each
source is a tree, and the roots of the sources are the leaves of one more tree.

A node's label is (tree, level, index), and a node's digest is a message to its
parent's label.  The queue of messages is external: Spark's sort brings the nodes
of a chunk (``FAN ** LEVELS`` consecutive ones, a whole subtree) to one task in
label order, where a heap hands the digests on through ``LEVELS`` levels; the
chunk's root is the message to the next round, a table ``CHUNK`` times smaller.
A reversed sweep then goes down the same rounds: a parent's proof is the
message to its children, who put their own siblings before it, until the leaves
have whole proofs.  A task holds one chunk, whatever the size of a tree.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from hashlib import sha256

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from acctlens.llm.common import batch, stored

FAN = 16
LEVELS = 3
CHUNK = FAN ** LEVELS

FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
CAPITALS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"

NODE_COLUMNS = ("tree", "pos", "total", "digest", "doc_id", "altered")
NODES = pa.schema([("tree", pa.string()), ("pos", pa.int64()), ("total", pa.int64()), ("digest", pa.binary()),
                   ("doc_id", pa.int64()), ("altered", pa.binary())])
NODES_DDL = "tree string, pos long, total long, digest binary, doc_id long, altered binary"
MESSAGES = pa.schema([("tree", pa.string()), ("pos", pa.int64()), ("proof", pa.binary()), ("subroot", pa.binary())])
MESSAGES_DDL = "tree string, pos long, proof binary, subroot binary"
LEAVES = pa.schema([("doc_id", pa.int64()), ("leaf", pa.string()), ("subroot", pa.string()), ("proof", pa.binary()),
                    ("proof_sha256", pa.string()), ("folded_root", pa.string())])
LEAVES_DDL = "doc_id long, leaf string, subroot string, proof binary, proof_sha256 string, folded_root string"
ROWS_OUT = 4096


# ---- digests and proofs -----------------------------------------------------------
def digest_of(children: list[bytes]) -> bytes:
    """SHA-256 of the children's digests as lowercase hex text."""
    return sha256(b"".join(children).hex().encode()).digest()


def step(run: list[bytes], own: int) -> bytes:
    """One level of a proof: place in the run, size of the run, siblings."""
    return bytes((own, len(run))) + b"".join(run[:own]) + b"".join(run[own + 1:])


def steps_of(proof: bytes) -> Iterator[tuple[int, bytes]]:
    """(place, siblings) of each level, upward."""
    at = 0
    while at < len(proof):
        own, size = proof[at], proof[at + 1]
        at += 2
        yield own, proof[at: at + 32 * (size - 1)]
        at += 32 * (size - 1)


def fold(digest: bytes, proof: bytes) -> bytes:
    """The root that a node's digest and its proof lead to."""
    for own, siblings in steps_of(proof):
        digest = sha256((siblings[: 32 * own] + digest + siblings[32 * own:]).hex().encode()).digest()
    return digest


def proof_digest(proof: bytes) -> str:
    return sha256(b"".join(s for _, s in steps_of(proof)).hex().encode()).hexdigest()


# ---- sweeps over one chunk ---------------------------------------------------------
def climb(digests: list[bytes], total: int) -> list[list[bytes]]:
    """Digests of a chunk's nodes by level, from its leaves to its root.

    ``total`` is how many nodes the whole tree has beside these; a level is built
    while there is more than one.  Messages wait in a heap ordered by label."""
    levels: list[list[bytes]] = [digests]
    queue: list[tuple[int, int, int, bytes]] = []
    left = [total]
    while left[-1] > 1 and len(left) <= LEVELS:
        left.append(-(-left[-1] // FAN))
        levels.append([])
    if len(levels) > 1:
        queue = [(1, i // FAN, i, d) for i, d in enumerate(digests)]  # in order, so a heap
    while queue:
        level, index, _, first = heapq.heappop(queue)
        run = [first]
        while queue and queue[0][:2] == (level, index):
            run.append(heapq.heappop(queue)[3])
        own = digest_of(run)
        levels[level].append(own)
        if level + 1 < len(levels):
            heapq.heappush(queue, (level + 1, index // FAN, index, own))
    return levels


def descend(levels: list[list[bytes]], proof: bytes) -> Iterator[bytes]:
    """Proofs of a chunk's leaves in order, from the proof of its root: labels
    are passed in reverse, a node sending its proof to its children."""
    proofs = [proof]
    for level in range(len(levels) - 2, -1, -1):
        below = levels[level]
        of_level = (step(below[i - i % FAN: i - i % FAN + FAN], i % FAN) + up for i, up in
                    ((i, proofs[i // FAN]) for i in range(len(below))))
        if level == 0:
            yield from of_level
            return
        proofs = list(of_level)
    yield from proofs


# ---- Spark rounds ------------------------------------------------------------------
def numbered(nodes: DataFrame, order: list[Column], name: str) -> DataFrame:
    """Adds ``pos`` (place within ``tree``, by ``order``) and ``total``.

    Rows are dealt by ranges of (tree, order), so a tree of any size is spread; the
    places come from one small row a tree and range."""
    at = nodes.repartitionByRange("tree", *order).sortWithinPartitions("tree", *order)
    at = stored(at.select("*", F.monotonically_increasing_id().alias("_at")), name)
    part = F.shiftright("_at", 33).alias("_part")
    pieces = at.groupBy(part, "tree").agg(F.count(F.lit(1)).alias("_n"), F.min("_at").alias("_first"))
    tree = Window.partitionBy("tree")
    before = tree.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    pieces = pieces.select("_part", "tree", (F.coalesce(F.sum("_n").over(before), F.lit(0)) - F.col("_first")).alias("_shift"),
                           F.sum("_n").over(tree).alias("total"))
    return (at.withColumn("_part", part).join(pieces, ["_part", "tree"])
            .withColumn("pos", F.col("_at") + F.col("_shift")).drop("_part", "_at", "_shift"))


def dealt(nodes: DataFrame) -> DataFrame:
    """Nodes of a chunk together and in label order; a message to its root, if
    there is one, before them."""
    chunk = F.when(F.col("total").isNull(), F.col("pos")).otherwise(F.floor(F.col("pos") / CHUNK)).alias("chunk")
    return (nodes.select("*", chunk).repartition("tree", "chunk")
            .sortWithinPartitions("tree", "chunk", F.col("total").isNotNull(), "pos"))


def chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[tuple, list[tuple]]]:
    """((tree, chunk), rows) of sorted rows whose last column is the chunk."""
    key, rows = None, []
    for rb in batches:
        cols = [c.to_pylist() for c in rb.columns]
        for row in zip(*cols):
            if (row[0], row[-1]) != key:
                if rows:
                    yield key, rows
                key, rows = (row[0], row[-1]), []
            rows.append(row)
    if rows:
        yield key, rows


def in_batches(rows: Iterator[tuple], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    out: list[tuple] = []
    for row in rows:
        out.append(row)
        if len(out) == ROWS_OUT:
            yield batch(schema, list(zip(*out)))
            out = []
    if out:
        yield batch(schema, list(zip(*out)))


def rise(nodes: DataFrame) -> DataFrame:
    """A round upward: one row for the root of each chunk."""

    def roots(batches):
        for (tree, chunk), rows in chunks(batches):
            total = rows[0][2]
            levels = climb([r[3] for r in rows], total)
            for _ in levels[1:]:
                total = -(-total // FAN)
            yield tree, chunk, total, levels[-1][0], None, None

    return dealt(nodes.select(*NODE_COLUMNS)).mapInArrow(lambda b: in_batches(roots(b), NODES), NODES_DDL)


def rounds(nodes: DataFrame, name: str) -> list[DataFrame]:
    """Tables of the rounds, from the leaves of all trees to their roots."""
    out = [nodes]
    while out[-1].filter("total > 1").limit(1).count():
        out.append(stored(rise(out[-1]), name))
    return out


def with_messages(nodes: DataFrame, messages: DataFrame) -> DataFrame:
    """Nodes of a round and the proofs of their chunks' roots, dealt together."""
    n = nodes.select(*NODE_COLUMNS, F.lit(None).cast("binary").alias("proof"), F.lit(None).cast("binary").alias("subroot"))
    empty = [F.lit(None).cast(t).alias(c) for c, t in (("total", "long"), ("digest", "binary"), ("doc_id", "long"), ("altered", "binary"))]
    return dealt(n.unionByName(messages.select("tree", "pos", *empty, "proof", "subroot")))


def delivered(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[tuple, bytes, bytes]]:
    """(node row, its proof, its tree's subroot) of dealt rows."""
    for _, rows in chunks(batches):
        message, nodes = rows[0], rows[1:]
        levels = climb([r[3] for r in nodes], nodes[0][2])
        for node, proof in zip(nodes, descend(levels, message[6])):
            yield node, proof, message[7]


def sink(nodes: DataFrame, messages: DataFrame, subroots: bool) -> DataFrame:
    """A round downward: the messages to the nodes of a table.  ``subroots``:
    these nodes are themselves the subroots, named by ``altered``."""

    def rows(batches):
        for node, proof, subroot in delivered(batches):
            if subroots:
                yield node[5].decode(), 0, proof, node[3]
            else:
                yield node[0], node[1], proof, subroot

    return with_messages(nodes, messages).mapInArrow(lambda b: in_batches(rows(b), MESSAGES), MESSAGES_DDL)


def proofs_of(levels: list[DataFrame], messages: DataFrame, name: str, subroots: bool = False) -> DataFrame:
    """Messages to the nodes of ``levels[0]`` from those to the roots."""
    for k in range(len(levels) - 1, -1, -1):
        messages = sink(levels[k], messages, subroots and k == 0)
        if k:
            messages = stored(messages, name)
    return messages


# ---- the manifest ------------------------------------------------------------------
def _field(c: Column) -> Column:
    s = c.cast("string")
    return F.when(s.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(s).cast("string"), F.lit(":"), s))


def leaf_digest(columns: dict[str, Column]) -> Column:
    """SHA-256 over the fields, each as its UTF-8 length, ``:`` and value, or ``-``."""
    return F.unhex(F.sha2(F.concat(*[_field(c) for c in columns.values()]), 256))


def tampered_text(text: Column) -> Column:
    return F.translate(text, CAPITALS, CAPITALS.lower())


def picked_for_tampering(doc_id: Column, every: int = 5) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % every == 0, F.lit(False))


def merkle_manifest(docs: DataFrame, every: int = 5) -> DataFrame:
    """doc_id, leaf, subroot, root, proof (binary: per level upward one byte place,
    one byte run size, the siblings' 32-byte digests), proof_sha256,
    folded_root and verified of each row.

    Where ``every`` divides the CRC-32 of doc_id as text, the root is folded from
    the leaf with the text's A-Z lower-cased, so it differs from ``root``
    if that text has capitals; elsewhere from the leaf itself.

    Leaves ascend by doc_id within their source, null doc_ids first; equal ids
    by their leaf's digest, and rows equal in all fields are leaves of their own.
    Null and empty values hash differently.  A null doc_id is never tampered with.
    A text of any length is hashed whole by Spark's own functions.  An empty table
    gives an empty result; other columns are left out.
    """
    columns = {c: docs[c] for c in FIELDS}
    altered = leaf_digest(columns | {"text": tampered_text(docs["text"])})
    # written first: finding the ranges reads the rows once more, which should not hash the texts again
    leaves = stored(docs.select(
        F.coalesce(F.concat(F.lit("+"), docs["source"]), F.lit("")).alias("tree"), docs["doc_id"].cast("long").alias("doc_id"),
        leaf_digest(columns).alias("digest"), F.when(picked_for_tampering(docs["doc_id"], every), altered).alias("altered")), "merkle_digests")
    by_id = [F.col("doc_id").asc_nulls_first(), F.col("digest")]
    sources = rounds(stored(numbered(leaves, by_id, "merkle_order"), "merkle_leaves"), "merkle_up")

    subroots = sources[-1].select(F.lit("").alias("tree"), "digest", F.lit(None).cast("long").alias("doc_id"),
                                  F.col("tree").cast("binary").alias("altered"))
    top = rounds(stored(numbered(subroots, [F.col("altered")], "merkle_order"), "merkle_subroots"), "merkle_up")
    whole = top[-1].select(F.hex("digest")).first()
    root = whole[0].lower() if whole else None

    start = top[-1].select("tree", F.lit(0).cast("long").alias("pos"), F.unhex(F.lit("")).alias("proof"),
                           F.lit(None).cast("binary").alias("subroot"))
    to_sources = stored(proofs_of(top, start, "merkle_down", subroots=True), "merkle_down")
    to_chunks = to_sources
    for k in range(len(sources) - 1, 0, -1):
        to_chunks = stored(sink(sources[k], to_chunks, False), "merkle_down")

    def rows(batches):
        for node, proof, subroot in delivered(batches):
            leaf, changed = node[3], node[5]
            yield (node[4], leaf.hex(), subroot.hex(), proof, proof_digest(proof),
                   fold(leaf if changed is None else changed, proof).hex())

    out = with_messages(sources[0], to_chunks).mapInArrow(lambda b: in_batches(rows(b), LEAVES), LEAVES_DDL)
    root = F.lit(root).cast("string")
    return out.select("doc_id", "leaf", "subroot", root.alias("root"), "proof", "proof_sha256", "folded_root",
                      (F.col("folded_root") == root).alias("verified"))
