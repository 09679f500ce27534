import hashlib
import random

import numpy as np
import pyarrow as pa
import pytest

from acctlens.llm import exchange, suffixes
from acctlens.llm.suffixes import RUNS, Block, drop_repeats, loser_tree_merge, removed_spans, runs_of, suffix_dedup
from tests.llm.helpers import brute_kept, documents, edge_rows, prose


def repeating_rows(seed=0, n=40):
    r = random.Random(seed)
    shared = [prose(900 + i, 25) for i in range(6)]
    rows = []
    for d in range(n):
        parts = [prose(1000 + d, r.randrange(5, 60))] + [r.choice(shared) for _ in range(r.randrange(3))]
        r.shuffle(parts)
        rows.append((r.randrange(1000), r.choice([" ", "", "é"]).join(parts)))
    return rows + [(2000, "ab" * 200), (2001, "ab" * 100), (1999, "b" * 49), (1998, "b" * 50), (2002, "b" * 51)]


def check(got, rows):
    want = sorted(((d, len(b), sum(m), sum(1 for x in m.split(b"\0") if x),
                    hashlib.sha256(bytes(x for x, gone in zip(b, m) if not gone)).hexdigest())
                   for d, m, b in brute_kept(rows)), key=str)
    assert sorted((tuple(r) for r in got), key=str) == want


def test_equals_brute_force(spark):
    rows = edge_rows() + repeating_rows()
    df = documents(spark, rows, clash=True).repartition(5)
    check(suffix_dedup(df).collect(), rows)
    assert suffix_dedup(documents(spark, [])).collect() == []


def test_cut_texts(spark):
    rows = [(d, t) for d, t in repeating_rows(3)]
    kept = {}
    for d, m, b in brute_kept(rows):
        if not (len(b) and sum(m) == len(b)):
            kept.setdefault(d, []).append(bytes(x for x, gone in zip(b, m) if not gone).decode("utf-8", "ignore"))
    out = drop_repeats(documents(spark, rows))
    assert out.columns == ["doc_id", "text", "lang", "source", "n_chars"]
    got = {}
    for r in out.collect():
        assert r.n_chars == len(r.text)
        got.setdefault(r.doc_id, []).append(r.text)
    assert {d: sorted(t) for d, t in got.items()} == {d: sorted(t) for d, t in kept.items()}


@pytest.mark.parametrize("heavy", [2, 10**9])
def test_hot_anchors_are_spread(monkeypatch, heavy):
    """The same steps in one process, with and without salts."""
    monkeypatch.setattr(exchange, "HEAVY", heavy)
    rows, width, ranges = repeating_rows(7), 50, 3
    blocks = []
    for uid in range(4):
        part = rows[uid::4]
        texts = [t.encode() for _, t in part]
        blocks.append(Block({"uid": uid, "ids": np.array([d for d, _ in part]).tobytes(), "known": np.ones(len(part), bool).tobytes(),
                             "lens": np.array([len(t) for t in texts]).tobytes(), "data": b"".join(texts)}, width))
    sent = {}
    for b in blocks:
        at, _, _, doc = b.anchors()
        for rb in exchange.packed_keys(b.row["uid"], suffixes.gram_keys(b.data, at, ranges), b.ids[doc], ranges):
            sent.setdefault(rb.column(0)[0].as_py(), []).append(rb)
    hot = {}
    for batches in sent.values():
        for r in exchange._meet(pa.Table.from_batches(batches)).to_pylist():
            hot.setdefault(r["uid"], []).append(r)
    groups = {}
    for b in blocks:
        for out in runs_of(b, hot[b.row["uid"]], ranges):
            groups.setdefault(out[:2], []).append(out)
    assert (max(salt for _, salt in groups) > 0) == (heavy == 2)
    gone = {uid: [] for uid in range(4)}
    for g in groups.values():
        for uid, spans in removed_spans(pa.Table.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*g), RUNS)], schema=RUNS), width):
            gone[uid].append(spans.tobytes())
    got = []
    for b in blocks:
        for d, n, removed, runs, kept in suffixes.kept_texts({**b.row, "gone": gone[b.row["uid"]]}):
            got.append((d, n, removed, runs, hashlib.sha256(kept).hexdigest()))
    check(got, rows)


def test_loser_tree_merges_with_prefixes():
    r = random.Random(2)
    for k in (1, 2, 3, 7):
        runs, everything = [], []
        for _ in range(k):
            words = sorted(bytes(r.choice(b"ab\0") for _ in range(r.randrange(1, 9))) for _ in range(r.randrange(1, 30)))
            share = [0] + [next((i for i in range(min(len(a), len(b))) if a[i] != b[i]), min(len(a), len(b)))
                           for a, b in zip(words, words[1:])]
            runs.append((words, share))
            everything += words
        order, shared = loser_tree_merge(runs)
        taken = [iter(w) for w, _ in runs]
        out = [next(taken[i]) for i in order]
        assert out == sorted(everything)
        for a, b, p in zip(out, out[1:], shared[1:]):
            assert a[:p] == b[:p] and (len(a) == p or len(b) == p or a[p] != b[p])


def sent_runs(rows, ranges, width=50):
    """RUNS rows of a block of these texts if all of its anchors are heavy."""
    texts = [t.encode() for _, t in rows]
    b = Block({"uid": 1, "ids": np.array([d for d, _ in rows]).tobytes(), "known": np.ones(len(rows), bool).tobytes(),
               "lens": np.array([len(t) for t in texts]).tobytes(), "data": b"".join(texts)}, width)
    at, *_ = b.anchors()
    hot = {}
    for key in np.unique(suffixes.gram_keys(b.data, at, ranges)).tolist():
        hot.setdefault(key >> 32, []).append(key & 0xFFFFFFFF)
    hot = [{"range": r, "keys": np.array(k, np.uint32).tobytes(), "heavy": np.ones(len(k), bool).tobytes()} for r, k in hot.items()]
    return [dict(zip(RUNS.names, out)) for out in runs_of(b, hot, ranges)]


def test_a_block_sends_a_string_of_hot_anchors_once():
    passage = prose(77, 40)
    rows = [(d, prose(5000 + d, 12) + passage + prose(6000 + d, 12)) for d in range(60)]
    strings = {t[i: i + 50] for _, t in ((d, t.encode()) for d, t in rows) for i in range(len(t) - 49)}
    out = [r for r in sent_runs(rows, 40) if r["spans"] is None]
    assert sum(r["n"] for r in out) == len(strings)
    assert sum(r["salt"] > 0 for r in out) == len(out) <= 40 * max(1, suffixes.SALTS // 40)
    assert len(sent_runs(rows, 1000)) <= 1 + 1000  # a row for each range, not for each range and salt


@pytest.mark.parametrize("together", [0, 3, 10**9])
def test_lanes_are_merged_with_prefixes(monkeypatch, together):
    monkeypatch.setattr(suffixes, "TOGETHER", together)
    r = random.Random(4)
    rows = []
    for run in range(9):
        for lane in range(40):
            words = [bytes(r.choice(b"ab\0") for _ in range(r.randrange(1, 9))) for _ in range(r.choice([0, 1, 2, 5, lane]))]
            rows += [(run, lane, w) for w in sorted(words)]
    size = np.array([len(w) for *_, w in rows])
    m = suffixes.padded(np.array([list(w.ljust(8, b"\0")) for *_, w in rows], np.uint8), size)
    order, shared = suffixes.merged_lanes(m, np.array([x for _, x, _ in rows], np.uint64), np.array([x for x, *_ in rows]))
    assert [rows[i][1:] for i in order] == sorted(x[1:] for x in rows)
    for i, (a, b) in enumerate(zip(order, order[1:]), 1):
        same = m[a] != m[b]
        assert shared[i] == (0 if rows[a][1] != rows[b][1] else same.argmax() if same.any() else m.shape[1])
