"""Merkle manifest against a direct construction."""

import hashlib
import zlib
from collections import defaultdict

import duckdb

from acctlens.llm.merkle import fold, merkle_manifest
from acctlens.llm.queries import OP12_SQL
from tests.llm.helpers import DOCS, documents, edge_rows, prose


def H(s):
    return hashlib.sha256(s.encode()).hexdigest()


def brute_leaf(row):
    return H("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in row))


def brute(rows):
    """rows: (doc_id, text, lang, source, n_chars) -> sorted result rows"""
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    by = defaultdict(list)
    for d, text, lang, source, n in rows:
        leaf = brute_leaf((d, source, lang, n, text))
        tampered = d is not None and zlib.crc32(str(d).encode()) % 5 == 0 and text is not None
        by[source].append((d, leaf, brute_leaf((d, source, lang, n, text.translate(lower))) if tampered else leaf))

    def climb(level):
        paths, at = [[] for _ in level], list(range(len(level)))
        while len(level) > 1:
            runs = [level[i: i + 16] for i in range(0, len(level), 16)]
            for k, i in enumerate(at):
                paths[k].append((runs[i // 16][: i % 16], runs[i // 16][i % 16 + 1:]))
                at[k] = i // 16
            level = [H("".join(r)) for r in runs]
        return level[0], paths

    order = sorted(by, key=lambda s: (s is not None, (s or "").encode()))
    trees = {}
    for s in order:
        by[s].sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1]))
        trees[s] = climb([leaf for _, leaf, _ in by[s]])
    if not order:
        return []
    root, tops = climb([trees[s][0] for s in order])
    out = []
    for s, top in zip(order, tops):
        for (d, leaf, now), path in zip(by[s], trees[s][1]):
            proof = ""
            for before, after in path + top:
                now = H("".join(before) + now + "".join(after))
                proof += "".join(before + after)
            out.append((d, leaf, trees[s][0], root, H(proof), now, now == root))
    return sorted(out, key=str)


COLUMNS = ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]


def check(spark, rows, df=None):
    df = spark.createDataFrame(rows, DOCS) if df is None else df
    got = merkle_manifest(df).select(COLUMNS).collect()
    assert sorted(map(tuple, got), key=str) == brute(rows)
    return got


def with_fields(rows):
    return [(r[0], r[1], "en", r[2] if len(r) > 2 else "s", len(r[1]) if r[1] is not None else None) for r in rows]


def test_edge_rows_and_clashing_names(spark):
    rows = edge_rows() + [(40, "Capitals HERE", None), (41, "x", "é"), (42, "y", ""), (40, "Capitals HERE", None)]
    check(spark, with_fields(rows), documents(spark, rows, clash=True).withColumnRenamed("x", "pos"))


def test_empty_table(spark):
    assert merkle_manifest(spark.createDataFrame([], DOCS)).collect() == []


def test_one_row_is_its_own_root(spark):
    (row,) = check(spark, with_fields([(1, "abc")]))
    assert row.leaf == row.subroot == row.root and row.proof_sha256 == H("")


def test_hot_source_over_several_chunks_and_many_sources(spark):
    """A source of more than one chunk, sizes round powers of 16, 300 sources of one row."""
    rows = [(i, f"Text {i}", "hot") for i in range(4200)] + [(5000 + i, "T", f"s{k}") for k in (15, 16, 17, 256, 257) for i in range(k)]
    rows += [(9000 + i, "One", f"x{i}") for i in range(300)]
    got = check(spark, with_fields(rows))
    assert {r.verified for r in got} == {True, False}


def test_repeated_ids_and_null_ids(spark):
    check(spark, with_fields([(None, "a")] * 20 + [(3, "b")] * 20 + [(3, "C")] * 20 + [(None, None)]))


def test_proof_folds_back_and_tampering_shows(spark):
    rows = with_fields([(i, prose(i, 5).title()) for i in range(100)])
    for r in merkle_manifest(spark.createDataFrame(rows, DOCS)).collect():
        assert fold(bytes.fromhex(r.leaf), bytes(r.proof)).hex() == r.root
        assert r.verified == (zlib.crc32(str(r.doc_id).encode()) % 5 != 0)


def test_sql_on_edge_rows(spark):
    rows = with_fields(edge_rows() + [(40 + i, f"Doc {i}", f"s{i % 3}") for i in range(60)] + [(200, "q", None)])
    docs = spark.createDataFrame(rows, DOCS)
    con = duckdb.connect()
    con.register("documents", docs.toArrow())
    want = con.execute(OP12_SQL).fetchall()
    assert sorted(map(tuple, merkle_manifest(docs).select(COLUMNS).collect()), key=str) == sorted(want, key=str)
