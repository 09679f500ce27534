"""The stages against brute force, and the registered queries."""

import re

import duckdb
import pytest
import tiktoken

import __spark_entry__ as entry
import corpus_pipeline
from acctlens.llm.bpe import read_ranks
from acctlens.llm.mixing import mix_sizes
from acctlens.llm.quality import quality_scores
from acctlens.llm.queries import ORACLE_SQL, QUERIES, tokenizer_files
from tests.llm.helpers import DOCS, brute_components, brute_kept, documents, edge_rows
from tools.oracle_check import rows

SF = "/root/testdata/sf0.001"


def test_every_operator_is_registered():
    assert {int(re.match(r"op(\d+)_", k)[1]) for k in QUERIES} == set(range(1, 14))
    assert "pipeline" in entry.queries() and [n for n, _ in corpus_pipeline.STAGES][0] == "quality classifier"


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_oracles(spark, name):
    con = duckdb.connect()
    for t in ("documents", "embeddings", "pages"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    got, want = QUERIES[name](spark, SF).toPandas(), con.execute(ORACLE_SQL[name]).df()
    assert sorted(got.columns) == sorted(want.columns) and rows(got) == rows(want)


def test_stages_equal_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    text = lambda df: sorted((r.doc_id, r.text) for r in df.collect())
    done = {}
    kept = docs
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, kept, SF).cache()
        if name != corpus_pipeline.STAGES[-1][0]:
            assert out.columns == docs.columns
        done[name] = (kept, out)
        kept = out
    names = [n for n, _ in corpus_pipeline.STAGES]
    before, after = done[names[0]]
    good = {r.doc_id for r in quality_scores(before, spark.read.parquet(f"{SF}/labels.parquet")).collect() if r.score >= corpus_pipeline.REJECT_BELOW}
    assert [d for d, _ in text(after)] == sorted(good)
    before, after = done[names[1]]
    assert [d for d, _ in text(after)] == sorted({c for _, _, c in brute_components(text(before))})
    before, after = done[names[2]]
    want = [(d, bytes(x for x, g in zip(b, m) if not g).decode("utf-8", "ignore")) for d, m, b in brute_kept(text(before))
            if not (len(b) and sum(m) == len(b))]
    assert text(after) == sorted(want)
    before, after = done[names[3]]
    taken = {r.doc_id: r.taken for r in mix_sizes(before).collect() if r.taken}
    got = {}
    for d, t in text(after):
        got[d] = got.get(d, 0) + len(re.findall(r"[^\x20\x09-\x0D]+", t))
    assert got == taken
    before, after = done[names[4]]
    path, pattern = tokenizer_files()
    enc = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=read_ranks(path), special_tokens={})
    assert sorted((r.doc_id, list(r.ids)) for r in after.collect()) == sorted((d, enc.encode_ordinary(t)) for d, t in text(before))
    assert all(r.round_trip for r in after.collect())
    whole = corpus_pipeline.run(spark, SF)
    assert sorted((r.doc_id, list(r.ids)) for r in whole.collect()) == sorted((r.doc_id, list(r.ids)) for r in after.collect())


def test_stages_on_edge_cases(spark):
    """Nulls in any column, repeated rows, very long texts, clashing names, no rows."""
    rows = edge_rows()
    odd = documents(spark, rows, clash=True).selectExpr("*", "'y' as n_tokens", "'z' as c0")
    nulls = spark.createDataFrame([(None, None, None, None, None), (70, "some words here", None, None, None)], DOCS)
    for docs in (odd.repartition(3), documents(spark, []), nulls, documents(spark, rows).select("doc_id", "text", "lang", "source", "n_chars")):
        for name, stage in corpus_pipeline.STAGES:
            out = stage(spark, docs, SF)
            if name != corpus_pipeline.STAGES[-1][0]:
                assert out.columns == docs.columns and [f.dataType for f in out.schema] == [f.dataType for f in docs.schema], name
            got = out.collect()
            assert got or docs.isEmpty() or "suffix" in name or "mixing" in name, name
