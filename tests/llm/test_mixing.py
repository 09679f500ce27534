import re

import pytest

from acctlens.llm.mixing import apportion, mix_sizes, mix_sources, mixed_documents
from tests.llm.helpers import documents, edge_rows, prose

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute_targets(sizes, share=1.5, most=2.0):
    """sizes: source -> words; reshare the excess until none is above."""
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode("utf-32-be")))
    weight = {s: (3, 1, 2)[i % 3] for i, s in enumerate(names)}
    target, open_, left = {}, set(names), share * sum(sizes.values())
    while open_:
        total = sum(weight[s] for s in open_)
        over = [s for s in open_ if left * weight[s] / total >= most * sizes[s]]
        if not over:
            return target | {s: left * weight[s] / total for s in open_}
        for s in over:
            target[s] = most * sizes[s]
            left -= target[s]
            open_.discard(s)
    return target


def rows():
    out = [(i, prose(i, 20 + i * 7 % 400), f"src{i % 5}") for i in range(160)]
    out += [(1000 + i, prose(i, 300), "big") for i in range(200)]
    out += [(d and 5000 + d, t, s) for (d, t), s in zip(edge_rows(), [None, "é", "Z", "Z", "Z", "\U0001f389", "\uffee", "\uffee", None] * 2)]
    return out + [(3000, "", "none"), (3001, None, "none")]


def test_contract(spark):
    data = rows()
    df = documents(spark, data, clash=True)
    out = mix_sizes(df, rows_per_shard=32).collect()
    assert len(out) == len(data)
    size = {}
    for _, t, s in data:
        size[s] = size.get(s, 0) + len(WORD.findall(t or ""))
    want = brute_targets(size)
    by_id = {}
    for d, t, s in data:
        by_id.setdefault(d, []).append((len(WORD.findall(t or "")), s))
    taken = {}
    for r in out:
        assert 0 <= r.taken <= 2 * r["size"]
        s = next(s for n, s in by_id[r.doc_id] if n == r["size"])
        assert r.source_size == size[s] and r.target == pytest.approx(want[s])
        taken[s] = taken.get(s, 0) + r.taken
    for s in size:
        assert abs(taken[s] - want[s]) <= 16 + 1e-9, s
    again = mix_sizes(df.repartition(7), rows_per_shard=32).collect()
    assert sorted(map(str, out)) == sorted(map(str, again))


def test_empty_table_and_texts(spark):
    assert mix_sizes(documents(spark, [])).collect() == []
    (r,) = mix_sizes(documents(spark, [(1, None)])).collect()
    assert (r["size"], r.taken, r.target) == (0, 0, 0.0)


@pytest.mark.parametrize("votes,seats", [([5, 5, 5], 2), ([100, 1, 1, 1], 9), ([53, 24, 23], 100), ([1, 0, 0], 4), ([7], 3),
                                         ([340, 280, 160, 60, 15], 7), ([10**9, 3, 3], 10**6)])
def test_apportion_is_sainte_lague(spark, votes, seats):
    df = spark.createDataFrame([(i, v, seats) for i, v in enumerate(votes)], "i int, v long, m long")
    got = {r.i: r.q for r in apportion(df, "v", "m", [], ["i"], "q").collect()}
    assert sum(got.values()) == seats
    # no seat could move to a higher quotient
    last = {i: votes[i] / (2 * got[i] - 1) if got[i] else float("inf") for i in got}
    nxt = {i: votes[i] / (2 * got[i] + 1) for i in got}
    assert min(last.values()) >= max(nxt.values())


def test_documents_of_the_mix_hold_the_taken_words(spark):
    df = documents(spark, [r for r in rows() if r[0] not in (None, 5002)])
    want = {r.doc.doc_id: r.taken for r in mix_sources(df).collect() if r.taken}
    got = {}
    text = {d: t for d, t, _ in rows()}
    out = mixed_documents(df)
    assert out.columns == df.columns
    for r in out.collect():
        got[r.doc_id] = got.get(r.doc_id, 0) + len(WORD.findall(r.text))
        assert r.n_chars == len(r.text)
        assert r.text in text[r.doc_id] or " ".join(WORD.findall(r.text)) in " ".join(WORD.findall(text[r.doc_id]))
    assert got == want
