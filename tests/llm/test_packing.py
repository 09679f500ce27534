"""Packing: ids against the tokenizers library, the plan against bounds and brute force."""

import itertools
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from acctlens.llm.packing import CLASSES, Ids, nnls, patterns, placed, plan, token_pieces
from acctlens.llm.queries import WORDS, op13_packing
from tests.conftest import SF_SMALL
from tests.llm.helpers import DOCS, documents, edge_rows, prose

FILE = public_tokenizers.path(WORDS)


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(FILE)


def brute_ids(library, text):
    return library.encode(text or "", add_special_tokens=False).ids + [1]


ODD = ["a<|endoftext|>B <|ENDOFTEXT|>", "H̱ello İstanbul İ", "it's I'LL don't. x.y, a,b ... end!", "é. ÉÀ×é÷",
       "\x1c a\x1cb \u0085c d e", "中文 字.", "123 4.5", "ὈΔΥΣΣΕΎΣ", "", "  ", "Å K",
       "'s 't", "ﬁne ªb ²c aʰ", "Über, À.", "\U0001f389 \U0001f468‍\U0001f469", "a.\tb\x0bc\x0cd\re\nf", "é. é"]


def test_ids_equal_the_library(library):
    ids, texts = Ids(FILE), ODD + [prose(k, 300) for k in range(5)]
    for _ in range(2):  # again from memory
        got, counts = ids.of(pa.array(texts, pa.large_string()))
        for t, own in zip(texts, np.split(got, np.cumsum(counts)[:-1])):
            assert own.tolist() == brute_ids(library, t)[:-1], t


def test_long_text_in_slices(spark, library):
    text = " ".join([prose(k, 20000) for k in range(6)] * 14) + " " + "a" * 100_000
    assert len(text) > 9 << 20
    want = brute_ids(library, text)
    assert np.concatenate(list(Ids(FILE).of_long(text.encode()))).tolist() == want[:-1]
    pieces = token_pieces(documents(spark, [(1, text), (2, "a"), (3, text[:100])]), FILE, capacity=4096).collect()
    assert [i for r in pieces if r.doc_id == 1 for i in np.frombuffer(r.ids, "<u4").tolist()] == want
    assert {r.length for r in pieces if r.doc_id == 1 and r.start + 4096 < len(want)} == {4096} and sum(r.doc_id != 1 for r in pieces) == 2


def test_nnls_against_every_support():
    rng = np.random.default_rng(0)
    for _ in range(20):
        a, b = rng.random((5, 6)), rng.normal(size=5) + 0.5
        best = min(np.linalg.norm(b), *(np.linalg.norm(a[:, s] @ x - b) for k in range(1, 6) for s in map(list, itertools.combinations(range(6), k))
                                        for x in [np.linalg.lstsq(a[:, s], b, rcond=None)[0]] if (x >= 0).all()))
        x = nnls(a, b)
        assert (x >= 0).all() and np.linalg.norm(a @ x - b) <= best + 1e-9


def test_patterns_are_all_fillings():
    want = {c for k in (1, 2, 3) for c in itertools.combinations_with_replacement(range(12, 0, -1), k) if sum(c) == 12}
    assert set(patterns(12, 3)) == want and len(patterns(12, 3)) == len(want)


def spread(p):
    """A plan's rows as {sequence: [(offset, length)]}, with each length's ranks in order."""
    out, ranks = {}, {}
    for length, rank, copies, first, count, offset in p.rows:
        assert rank == ranks.get(length, 0)
        ranks[length] = rank + copies * count
        for s in range(first, first + count):
            out.setdefault(s, []).extend((offset + k * length, length) for k in range(copies))
    return out, ranks


@pytest.mark.parametrize("kind", ["mixed", "full", "halves", "tiny", "one", "big", "none"])
def test_plan_places_everything_once(kind):
    capacity, rng = 4096, np.random.default_rng(5)
    lengths = {"mixed": np.minimum(capacity, rng.lognormal(6, 1.3, 6000).astype(int) + 1), "full": np.full(50, capacity),
               "halves": np.full(501, 2048), "tiny": np.full(9000, 3), "one": np.array([17]), "big": np.full(40, 3000),
               "none": np.array([], int)}[kind]
    h = np.bincount(lengths, minlength=capacity + 1)
    p = plan(h, capacity)
    sequences, ranks = spread(p)
    assert ranks == {length: n for length, n in enumerate(h.tolist()) if n}
    for at in sequences.values():
        end = 0
        for offset, length in sorted(at):
            assert offset == end
            end += length
        assert end <= capacity
    assert p.sequences == len(sequences)
    bound = {"big": 40, "tiny": -(-9000 // 1365)}.get(kind, -(-int(lengths.sum()) // capacity))
    assert p.sequences <= bound * 1.01 + 1


def test_plan_size_is_bounded_by_capacity():
    rng = np.random.default_rng(6)
    h = rng.integers(0, 10 ** 7, 4097)
    h[0] = 0
    p = plan(h, 4096)
    assert len(p.rows) < 12 * 4096
    assert p.sequences <= -(-int((h * np.arange(4097)).sum()) // 4096) * 1.02


def test_edge_rows_and_clashing_names(spark, library):
    rows = edge_rows() + [(50 + k, t) for k, t in enumerate(ODD)]
    pieces = token_pieces(documents(spark, rows, clash=True), FILE, capacity=256)
    got = placed(pieces, capacity=256).collect()
    want = []
    for d, t in rows:
        ids = brute_ids(library, t)
        want += [(d, k // 256, k, ids[k: k + 256]) for k in range(0, len(ids), 256)]
    key = lambda r: (str(r[0]), r[1], r[3])
    assert sorted(((r.doc_id, r.piece, r.start, np.frombuffer(r.ids, "<u4").tolist()) for r in got), key=key) == sorted(want, key=key)
    check_places([(r.sequence_id, r.offset, r.length) for r in got], 256)


def check_places(rows, capacity):
    by = {}
    for s, offset, length in rows:
        by.setdefault(s, []).append((offset, length))
    for at in by.values():
        end = 0
        for offset, length in sorted(at):
            assert offset == end
            end += length
        assert end <= capacity
    return len(by)


def test_other_columns_and_a_hot_length(spark):
    rows = spark.range(3000).select(F.when(F.col("id") % 3 == 0, 100).otherwise(F.col("id") % 90 + 1).alias("length"),
                                    F.col("id").alias("sequence"), F.lit("x").alias("_at"), F.lit("y").alias("_rank"), F.lit(1).alias("_part"))
    got = placed(rows.repartition(13), capacity=128).collect()
    assert sorted(r.sequence for r in got) == list(range(3000))
    check_places([(r.sequence_id, r.offset, r.length) for r in got], 128)


def test_empty_table_and_bad_lengths(spark):
    assert placed(token_pieces(spark.createDataFrame([], DOCS), FILE)).collect() == []
    with pytest.raises(ValueError, match="length 0"):
        placed(spark.range(1).select(F.lit(0).alias("length")), capacity=8)


def test_query_digests_and_few_sequences(spark, library):
    got = op13_packing(spark, SF_SMALL).collect()
    ids = {r.doc_id: brute_ids(library, r.text) for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()}
    assert {r.doc_id for r in got} == set(ids)
    assert sum(r.length for r in got) == sum(map(len, ids.values()))
    for r in got:
        own = ids[r.doc_id][r.start: r.start + r.length]
        assert r.start == 4096 * r.piece and r.length == len(own)
        assert r.ids_crc32 == zlib.crc32(np.array(own, "<u4").tobytes())
    n = check_places([(r.sequence_id, r.offset, r.length) for r in got], 4096)
    assert n <= -(-sum(r.length for r in got) // 4096) + 2
    assert CLASSES == 128
